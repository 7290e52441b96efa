"""Text features, vocabularies and text learners."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise import fixed
from foldwise.catalog import query
from foldwise.catalog.aggregates import all_rounded
from foldwise.catalog.bind import WITH_APPLICANTS
from foldwise.catalog.sqltext import r6
from foldwise.functions import text as X
from foldwise.functions import vectors as V
from foldwise.functions.rows import rounded
from foldwise.operators import lexicon, tfidf

ENGLISH_UP, ENGLISH_DOWN, ENGLISH_BUT = ("the", "and", "her"), ("not", "of", "in "), ("but", "on ")


# ------------------------------------------------------------------ SQL fragments
def hits(text, needle):
    return f"CAST((length({text}) - length(replace({text}, '{needle}', ''))) / {len(needle)} AS INT)"


def all_hits(text, needles):
    return " + ".join(hits(text, n) for n in needles)


def shape_sql(t, up, down, but):
    low = f"lower({t})"
    words = f"len(list_filter(regexp_split_to_array({t}, '[\\s\\p{{Z}}]+'), lambda x: x <> ''))"
    return {"text_char_len": f"CAST(length({t}) AS INT)", "text_word_count": f"CAST({words} AS INT)",
            "text_sentence_count": f"{hits(t, '.')} + 1", "text_pos_hits": all_hits(low, up),
            "text_neg_hits": all_hits(low, down), "text_contrast_hits": all_hits(low, but),
            "text_sentiment_balance": f"({all_hits(low, up)}) - ({all_hits(low, down)})"}


MARK = "(?:" + "|".join(fixed.CONTRAST_MARKERS) + ")"
SIDES = f"""sides AS (SELECT student_id, regexp_matches(lower(feedback), '{MARK}') AS found,
    CASE WHEN regexp_matches(lower(feedback), '{MARK}') THEN regexp_extract(lower(feedback), '(?s)^(.*?){MARK}', 1)
      ELSE lower(feedback) END AS a,
    CASE WHEN regexp_matches(lower(feedback), '{MARK}') THEN regexp_replace(lower(feedback), '(?s)^.*?{MARK}', '')
      ELSE '' END AS b FROM applicants)"""


def mention_sql():
    keys = {}
    for needle, name in fixed.MENTIONS.items():
        keys.setdefault(name, []).append(needle)
    praise = {n: "(" + all_hits("a", k) + ")" for n, k in keys.items()}
    crit = {n: "(" + all_hits("b", k) + ")" for n, k in keys.items()}
    out = {"m_has_contrast": "CAST(found AS INT)", "m_praise_total": " + ".join(praise.values()),
           "m_crit_total": " + ".join(crit.values())}
    out |= {f"m_praise_{n}": e for n, e in praise.items()}
    out |= {f"m_crit_{n}": e for n, e in crit.items()}
    out |= {f"m_net_{n}": f"{praise[n]} - {crit[n]}" for n in keys}
    return ", ".join(f"{e} AS {n}" for n, e in out.items())


def word_terms_sql(src, low, high, id_col="doc_id", text="text", tag=""):
    runs = ", ".join("toks" if n == 1 else
                     f"list_transform(range(1, greatest(len(toks) - {n} + 2, 1)), lambda i: array_to_string(toks[i:i+{n - 1}], ' '))"
                     for n in range(low, high + 1))
    return f"""toks{tag} AS (SELECT {id_col}, regexp_extract_all(lower(coalesce({text}, '')), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS toks FROM {src}),
  tf{tag} AS (SELECT {id_col}, term, count(*) AS tf FROM (SELECT {id_col}, unnest(flatten([{runs}])) AS term FROM toks{tag})
    GROUP BY {id_col}, term)"""


def char_terms_sql(src, low, high, id_col="doc_id", text="text", tag=""):
    sizes = ", ".join(map(str, range(low, high + 1)))
    return f"""wrds{tag} AS (SELECT {id_col}, unnest(list_filter(regexp_split_to_array(lower(coalesce({text}, '')), '[\\s\\p{{Z}}]+'), lambda x: x <> '')) AS w FROM {src}),
  pads{tag} AS (SELECT {id_col}, concat(' ', w, ' ') AS w, count(*) AS c FROM wrds{tag} GROUP BY {id_col}, w),
  lens{tag} AS (SELECT {id_col}, w, c, unnest(list_filter([{sizes}], lambda n: n = {low} OR length(w) >= n)) AS n FROM pads{tag}),
  tf{tag} AS (SELECT {id_col}, term, CAST(sum(c) AS BIGINT) AS tf FROM (SELECT {id_col}, c,
    unnest(list_transform(range(1, greatest(length(w) - n + 1, 1) + 1), lambda i: substr(w, i, n))) AS term FROM lens{tag})
    GROUP BY {id_col}, term)"""


def vocab_sql(src, min_df, top, tag="", offset=0):
    return f"""picked{tag} AS (SELECT term, count(*) AS df, sum(tf) AS total FROM tf{tag} GROUP BY term
    HAVING count(*) >= {min_df} ORDER BY total DESC, term LIMIT {top}),
  vocab{tag} AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 + {offset} AS INT) AS term_id, df,
    ln((1.0 + (SELECT count(*) FROM {src})) / (1 + df)) + 1 AS idf FROM picked{tag})"""


def weights_sql(id_col="doc_id", tag="", tf="tf"):
    return f"""raw{tag} AS (SELECT {id_col}, term_id, (1 + ln(tf)) * idf AS w FROM {tf}{tag} JOIN vocab{tag} USING (term)),
  unit{tag} AS (SELECT {id_col}, term_id, w / sqrt(sum(w * w) OVER (PARTITION BY {id_col})) AS weight FROM raw{tag})"""


# ------------------------------------------------------------- scalar and lexicon
@query("h01_h02_text_statistics", f"""SELECT doc_id, {", ".join(
    f"{e} AS {n}" for n, e in shape_sql("text", ENGLISH_UP, ENGLISH_DOWN, ENGLISH_BUT).items())} FROM documents""")
def _(t):
    made = lexicon.shape_columns("text", ENGLISH_UP, ENGLISH_DOWN, ENGLISH_BUT)
    return t("documents").select("doc_id", *[e.alias(n) for n, e in made.items()])


@query("h03_split_at_first_marker", """SELECT doc_id,
  regexp_matches(lower(text), '(?:but|not|and )') AS found,
  md5(CASE WHEN regexp_matches(lower(text), '(?:but|not|and )') THEN regexp_extract(lower(text), '(?s)^(.*?)(?:but|not|and )', 1) ELSE lower(text) END) AS before,
  md5(CASE WHEN regexp_matches(lower(text), '(?:but|not|and )') THEN regexp_replace(lower(text), '(?s)^.*?(?:but|not|and )', '') ELSE '' END) AS after
  FROM documents""")
def _(t):
    before, after, found = X.split_once(F.lower("text"), ("but", "not", "and "))
    return t("documents").select("doc_id", found.alias("found"), F.md5(before).alias("before"),
                                 F.md5(after).alias("after"))


@query("h04_h05_prefixed_text_key", """SELECT doc_id, md5(concat('query: ', coalesce(text, ''))) AS k FROM documents""")
def _(t):
    return t("documents").select("doc_id", F.md5(F.concat(F.lit("query: "), F.coalesce("text", F.lit("")))).alias("k"))


@query("h09_unit_vectors", f"""SELECT vec_id,
  {r6("sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))))")} AS norm,
  i, {r6("CAST(embedding[i + 1] AS DOUBLE) / sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))))")} AS x
  FROM (SELECT *, CAST(unnest(range(len(embedding))) AS INT) AS i FROM embeddings)""")
def _(t):
    made = t("embeddings").select("vec_id", rounded(F.sqrt(V.dot("embedding", "embedding"))).alias("norm"),
                                  F.posexplode(V.unit("embedding")).alias("i", "x"))
    return made.withColumn("x", rounded("x"))


@query("t01_lexicon_features", f"""{WITH_APPLICANTS} SELECT student_id, {", ".join(
    f"{e} AS {n}" for n, e in shape_sql("feedback", fixed.POSITIVE, fixed.NEGATIVE, fixed.CONTRAST).items())}
  FROM applicants""")
def _(t):
    made = lexicon.shape_columns("feedback")
    return t.applicants().select("student_id", *[e.alias(n) for n, e in made.items()])


@query("t02_mentions_around_contrast", f"{WITH_APPLICANTS}, {SIDES} SELECT student_id, {mention_sql()} FROM sides")
def _(t):
    df = lexicon.with_mentions(t.applicants().select("student_id", "feedback"), "feedback")
    return df.select("student_id", *lexicon.mention_columns())


# ------------------------------------------------------------------------ TF-IDF
@query("f04_vocabulary", f"""WITH {word_terms_sql("documents", 1, 2)}, {vocab_sql("documents", 2, 20000)}
  SELECT term, term_id, df, {r6("idf")} AS idf FROM vocab""")
def _(t):
    made = tfidf.fit_vectoriser(t("documents"), "doc_id", "text", [tfidf.PROFILE_WORDS])
    return made.terms().select("term", "term_id", "df", rounded("idf").alias("idf"))


@query("t03_word_tfidf", f"""WITH {word_terms_sql("documents", 1, 3)}, {vocab_sql("documents", 2, 5000)}, {weights_sql()}
  SELECT doc_id, term_id, {r6("weight")} AS weight FROM unit""")
def _(t):
    made = tfidf.fit_vectoriser(t("documents"), "doc_id", "text", [tfidf.WORDS])
    return all_rounded(made.long(t("documents"), "doc_id", "text"))


@query("t04_char_tfidf", f"""WITH {char_terms_sql("documents", 3, 5)}, {vocab_sql("documents", 3, 30000)}, {weights_sql()}
  SELECT doc_id, term_id, {r6("weight")} AS weight FROM unit""")
def _(t):
    made = tfidf.fit_vectoriser(t("documents"), "doc_id", "text", [tfidf.CHARS])
    return all_rounded(made.long(t("documents"), "doc_id", "text"))


@query("t05_vocabulary_on_new_texts", f"""WITH {word_terms_sql("documents", 1, 3)}, {vocab_sql("documents", 2, 5000)},
  {word_terms_sql("benchmark", 1, 3, "item_id", tag="n")},
  raw AS (SELECT item_id, term_id, (1 + ln(tf)) * idf AS w FROM tfn JOIN vocab USING (term))
  SELECT item_id, term_id, {r6("w / sqrt(sum(w * w) OVER (PARTITION BY item_id))")} AS weight FROM raw""")
def _(t):
    made = tfidf.fit_vectoriser(t("documents"), "doc_id", "text", [tfidf.WORDS])
    return all_rounded(made.long(t("benchmark"), "item_id", "text"))


@query("t06_stacked_blocks", f"""WITH {word_terms_sql("conv", 1, 3, "id", tag="w").replace("toksw AS", "conv AS (SELECT concat_ws('-', conv_id, turn) AS id, text FROM conversations), toksw AS", 1)},
  {vocab_sql("conv", 2, 5000, "w")}, {weights_sql("id", "w")},
  {char_terms_sql("conv", 3, 5, "id", tag="c")},
  {vocab_sql("conv", 3, 30000, "c", "(SELECT count(*) FROM vocabw)")}, {weights_sql("id", "c")}
  SELECT id, term_id, {r6("weight")} AS weight FROM unitw UNION ALL SELECT id, term_id, {r6("weight")} FROM unitc""")
def _(t):
    df = t("conversations").select(F.concat_ws("-", "conv_id", "turn").alias("id"), "text")
    made = tfidf.fit_vectoriser(df, "id", "text")
    return all_rounded(made.long(df, "id", "text"))
