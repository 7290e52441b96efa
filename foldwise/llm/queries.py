"""The registered queries of this subpackage, over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foldwise.llm import (chat, digest, jaccard, language, merkle, mixture, packing, passages, quality, runs, substrings, tokencount,
                          tokenfiles, topk, whiten)
from foldwise.llm.common import Scratch, only, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file lies on this installation."""
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document written as indexed shards, then read back by key."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    tokenfiles.write(docs, scratch.root, vocabulary("word_bpe_49k.json"), "dropped", end_id=1, width=2)
    keys = only(docs, doc_id="doc_id").withColumn(
        "copy", F.row_number().over(Window.partitionBy("doc_id").orderBy("doc_id")) - 1)
    return tokenfiles.checksums(spark, scratch.root, keys).drop("copy")


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids packed into windows of 1024 in the proportions of the sources."""
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), "joined", end_id=0)


@query
def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the size of its shingle set and the smallest document it is linked with."""
    return jaccard.join(table(spark, sf_dir, "documents"))


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text, paragraph and passage of fifty words or more that repeats another or is repeated, and which of them go."""
    return substrings.repeated(table(spark, sf_dir, "documents"))


@query
def paragraph_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every paragraph of five words or more that repeats another, with the one that is kept: what the pipeline removes first."""
    return passages.repeated(table(spark, sf_dir, "documents"))


@query
def passage_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the pipeline removes then: every stretch of fifty words or more that stands, word for word, somewhere before, within paragraphs and across them."""
    return runs.repeated(table(spark, sf_dir, "documents"))


def quality_model(docs: DataFrame, spark: SparkSession, sf_dir: str) -> quality.Model:
    """Learned from the labels of documents that are not held out."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return quality.fit(only(docs, doc_id="doc_id", text="text"), labels.where(quality.fold("doc_id", 3) != 1))


@query
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality by its compressed sizes."""
    docs = only(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    scored = quality.score(docs, quality_model(docs, spark, sf_dir))
    return scored.select("doc_id", F.coalesce(quality.fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
                         F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language by its nearest centroid."""
    docs = only(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text", lang="lang")
    model = language.fit(docs.where(quality.fold("doc_id", 5) != 0))
    found = language.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(quality.fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
                        "lang_pred", "score", "rejected")


@query
def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document and of its edited text."""
    return digest.compare(table(spark, sf_dir, "documents"))


@query
def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best partners, by inner product, of every fiftieth vector among all others."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), topk.integers("embedding", 256.0).alias("v"))
    return topk.top_k(vectors.where("id % 50 = 0"), vectors, 5)


SQL["op6_exact_top_k"] = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
long AS (SELECT row, vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM (SELECT *, row_number() OVER () AS row FROM usable)),
scored AS (SELECT q.row AS query, q.vec_id AS query_id, c.row AS row, c.vec_id AS vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM long q JOIN long c ON q.d = c.d AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY ALL)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) <= 5"""


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of words and of tokens under a unigram model."""
    return tokencount.counts(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query
def op9_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document a mix in the proportions 5, 2, 1 takes."""
    return mixture.mix(table(spark, sf_dir, "documents")).drop("text_hash")


SQL["op9_source_mixture"] = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':mix')) AS h FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS w
  FROM sized GROUP BY source),
levels AS (
  SELECT 0 AS turn, 0.0::DOUBLE AS level
  UNION ALL
  SELECT turn + 1, (SELECT (1.5 * sum(source_size)::DOUBLE - 2.0 * coalesce(sum(source_size) FILTER (2.0 * source_size <= w * level), 0)::DOUBLE)
    / sum(w) FILTER (2.0 * source_size > w * level) FROM sources)
  FROM levels WHERE turn < 40),
targets AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, w * (SELECT max(level) FROM levels)) AS target FROM sources),
queued AS (
  SELECT s.*, t.source_size, t.target,
    sum(size) OVER (PARTITION BY s.source ORDER BY h ROWS UNBOUNDED PRECEDING) - size AS pos
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
parts AS (
  SELECT *, CAST(floor(target) AS BIGINT) // greatest(source_size, 1) AS rounds,
    CAST(floor(target) AS BIGINT) % greatest(source_size, 1) AS rest, row_number() OVER () AS uid FROM queued),
-- the schedule: multiples of the golden ratio fall into the sources' intervals
needs AS (SELECT source, (source_size + 1023) // 1024 AS blocks,
    (CAST(floor(target) AS BIGINT) // greatest(source_size, 1)) * ((source_size + 1023) // 1024)
      + (CAST(floor(target) AS BIGINT) % greatest(source_size, 1) + 1023) // 1024 AS slots FROM targets),
intervals AS (SELECT source, blocks, slots, sum(slots) OVER (ORDER BY encode(source) NULLS LAST) - slots AS low FROM needs),
whole AS (SELECT sum(slots)::BIGINT AS total FROM needs),
points AS (SELECT k, (k * 0.6180339887498949::DOUBLE - floor(k * 0.6180339887498949::DOUBLE)) * total::DOUBLE AS x
  FROM (SELECT total, unnest(range(1, CAST(floor(total * 2.75::DOUBLE) AS BIGINT) + 2)) AS k FROM whole)),
hits AS (SELECT k, source, blocks, slots, row_number() OVER (PARTITION BY source ORDER BY k) - 1 AS r
  FROM points JOIN intervals ON x >= low AND x < low + slots),
used AS (SELECT k, source, r // blocks AS round, r % blocks AS block FROM hits WHERE r < slots),
met AS (SELECT uid, k FROM parts p JOIN used u ON u.source IS NOT DISTINCT FROM p.source AND block BETWEEN pos // 1024 AND (pos + size - 1) // 1024
  WHERE size > 0 AND (round < rounds OR (round = rounds AND least(pos + size, (block + 1) * 1024, rest) > greatest(pos, block * 1024)))),
slots AS (SELECT uid, min(k) AS first_slot, count(*) AS n_slots FROM met GROUP BY uid)
SELECT doc_id, size, source_size, target,
  CAST(rounds * size + greatest(0, least(pos + size, rest) - pos) AS BIGINT) AS taken,
  CAST(first_slot AS BIGINT) AS first_slot, CAST(coalesce(n_slots, 0) AS BIGINT) AS n_slots
FROM parts LEFT JOIN slots USING (uid)"""


_WORDS = r"""regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+')"""
#: From ``items(uid, ws)``: their distinct shingles, links of similarity 0.8, and every item that a chain of links reaches.
_LINKED = """shingled AS (SELECT DISTINCT uid, CASE WHEN len(ws) < 5 THEN ws ELSE list_slice(ws, i, i + 4) END AS g
    FROM (SELECT uid, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM items WHERE len(ws) > 0)),
  sizes AS (SELECT uid, count(*) AS n FROM shingled GROUP BY uid),
  common AS (SELECT a.uid AS a, b.uid AS b, count(*) AS o FROM shingled a JOIN shingled b ON a.g = b.g AND a.uid < b.uid GROUP BY 1, 2),
  links AS (SELECT a, b FROM common JOIN sizes x ON x.uid = a JOIN sizes y ON y.uid = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
  edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
  reached AS (SELECT uid AS node, uid AS other FROM sizes UNION SELECT r.node, e.b FROM reached r JOIN edges e ON r.other = e.a)"""

SQL["op7_ngram_jaccard_join"] = f"""WITH RECURSIVE items AS (SELECT row_number() OVER () AS uid, doc_id, {_WORDS.format(text="text")} AS ws FROM documents),
  {_LINKED},
  roots AS (SELECT node, min(doc_id) AS component FROM reached JOIN items ON uid = other GROUP BY node)
  SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, doc_id) AS component_id,
    (SELECT count(*) FROM edges WHERE a = items.uid) AS n_links
  FROM items LEFT JOIN sizes USING (uid) LEFT JOIN roots ON node = items.uid"""

SQL["paragraph_repeats"] = f"""WITH RECURSIVE parts AS (
    SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS paragraph, unnest(string_split(text, chr(10))) AS part FROM documents),
  items AS (SELECT row_number() OVER (ORDER BY doc_id, paragraph) AS uid, doc_id, paragraph, ws
    FROM (SELECT doc_id, paragraph, {_WORDS.format(text="part")} AS ws FROM parts) WHERE len(ws) >= 5),
  {_LINKED},
  roots AS (SELECT node, min(other) AS root, count(*) AS n_members FROM reached GROUP BY node HAVING count(*) > 1)
  SELECT i.doc_id, CAST(i.paragraph AS BIGINT) AS paragraph, CAST(len(i.ws) AS BIGINT) AS n_words, n_members,
    k.doc_id AS kept_doc_id, CAST(k.paragraph AS BIGINT) AS kept_paragraph, root <> node AS removed
  FROM roots JOIN items i ON i.uid = node JOIN items k ON k.uid = root"""


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, its proof, and the root that its digest leads to once a third of the texts are altered."""
    manifest = merkle.Manifest(merkle.documents(spark, table(spark, sf_dir, "documents")), Scratch(spark))
    return manifest.check().withColumnRenamed("key", "doc_id")


_FIELD = "coalesce(concat(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR), ':', CAST({0} AS VARCHAR)), '-')"
_LEAF = "sha256(concat(" + ", ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars")) + ", " + _FIELD + "))"
#: The checksum of an id's digits, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda r, i: xor(r // 2, 3988292384::BIGINT * (r % 2)))), 4294967295::BIGINT)"""
#: All levels over lists of nodes, by group; the last level has one node.
_LEVELS = """{0} AS (SELECT g, 0 AS level, nodes FROM {1}
    UNION ALL SELECT g, level + 1, list_transform(range(0, (len(nodes) + 7) // 8), lambda i: sha256(array_to_string(nodes[8 * i + 1:8 * i + 8], '')))
    FROM {0} WHERE len(nodes) > 1)"""
#: From a digest at a place to the last level, with all siblings on the way.
_CLIMBED = """{0} AS (SELECT id, g, pos, 0 AS level, digest, '' AS siblings FROM {1}
    UNION ALL SELECT id, c.g, pos // 8, c.level + 1,
      sha256(concat(array_to_string(nodes[pos // 8 * 8 + 1:pos], ''), digest, array_to_string(nodes[pos + 2:pos // 8 * 8 + 8], ''))),
      concat(siblings, array_to_string(nodes[pos // 8 * 8 + 1:pos], ''), array_to_string(nodes[pos + 2:pos // 8 * 8 + 8], ''))
    FROM {0} c JOIN {2} l ON l.g = c.g AND l.level = c.level WHERE len(nodes) > 1)"""

SQL["op12_merkle_manifest"] = f"""WITH RECURSIVE hashed AS (
    SELECT row_number() OVER () AS id, doc_id, coalesce('.' || lang, '') AS g, {_LEAF.format("text")} AS leaf,
      CASE WHEN ({_CRC}) % 3 = 0 THEN {_LEAF.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
        END AS altered FROM documents),
  leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM hashed),
  grouped AS (SELECT g, list(leaf ORDER BY pos) AS nodes FROM leaves GROUP BY g),
  {_LEVELS.format("levels", "grouped")},
  subroots AS (SELECT g, nodes[1] AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS place FROM levels WHERE len(nodes) = 1),
  tops AS (SELECT '' AS g, list(subroot ORDER BY place) AS nodes FROM subroots HAVING count(*) > 0),
  {_LEVELS.format("top_levels", "tops")},
  offered AS (SELECT id, g, pos, coalesce(altered, leaf) AS digest FROM leaves),
  {_CLIMBED.format("climbed", "offered", "levels")},
  at_subroot AS (SELECT id, g, digest, siblings FROM climbed c WHERE level = (SELECT max(level) FROM levels l WHERE l.g = c.g)),
  upper_start AS (SELECT id, '' AS g, place AS pos, digest FROM at_subroot JOIN subroots USING (g)),
  {_CLIMBED.format("upper", "upper_start", "top_levels")},
  at_root AS (SELECT id, digest, siblings FROM upper WHERE level = (SELECT max(level) FROM top_levels))
  SELECT doc_id, leaf, subroot, (SELECT nodes[1] FROM top_levels WHERE len(nodes) = 1) AS root,
    sha256(concat(a.siblings, r.siblings)) AS proof_sha256, r.digest AS folded_root,
    r.digest = (SELECT nodes[1] FROM top_levels WHERE len(nodes) = 1) AS verified
  FROM leaves JOIN at_subroot a USING (id) JOIN at_root r USING (id) JOIN subroots s ON s.g = leaves.g"""


@query
def op11_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one made of control strings, formatted into windows, written, read back and digested."""
    turns = only(table(spark, sf_dir, "conversations"), conv_id="conv_id", turn="turn", role="role", text="text")
    odd = spark.createDataFrame([(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")], turns.schema)
    scratch = Scratch(spark)
    windows = scratch.keep(chat.windows(turns.unionByName(odd), vocabulary("byte_bpe_50k.json"), scratch), "windows")
    return chat.digests(windows, scratch)


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the first 16 whitened components of all distinct vectors."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), whiten.integers("embedding", 64, 1_000_000).alias("x"))
    scratch = Scratch(spark)
    return whiten.project(vectors, whiten.fit(vectors, scratch, 16)).withColumnRenamed("id", "vec_id")


SQL["op3_substring_dedup"] = f"""WITH RECURSIVE said AS (SELECT doc_id, text, {_WORDS.format(text="text")} AS ws FROM documents),
  long AS (SELECT doc_id, ws, min(doc_id) OVER (PARTITION BY ws) AS head, count(*) OVER (PARTITION BY ws) AS copies FROM said WHERE len(ws) >= 50),
  runs AS (SELECT doc_id, i AS place, md5(array_to_string(list_slice(ws, i + 1, i + 50), ' ')) AS run
    FROM (SELECT doc_id, ws, unnest(range(len(ws) - 49)) AS i FROM long WHERE doc_id = head)),
  firsts AS (SELECT *, first_value(doc_id) OVER w AS kept_doc_id, first_value(place) OVER w AS kept_word FROM runs WINDOW w AS (PARTITION BY run ORDER BY doc_id, place)),
  gone AS (SELECT *, lag(place) OVER (PARTITION BY doc_id ORDER BY place) AS before FROM firsts WHERE doc_id <> kept_doc_id OR place >= kept_word + 50),
  marked AS (SELECT *, sum(CASE WHEN before IS NULL OR place > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY place) AS span FROM gone),
  spans AS (SELECT doc_id, min(place) AS first_word, max(place) + 50 - min(place) AS n_words, arg_min(kept_doc_id, place) AS kept_doc_id, arg_min(kept_word, place) AS kept_word
    FROM marked GROUP BY doc_id, span),
  parts AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS paragraph, unnest(string_split(text, chr(10))) AS part FROM documents),
  counted AS (SELECT doc_id, paragraph, {_WORDS.format(text="part")} AS ws FROM parts),
  starts AS (SELECT *, sum(len(ws)) OVER (PARTITION BY doc_id ORDER BY paragraph) - len(ws) AS start FROM counted),
  items AS (SELECT row_number() OVER (ORDER BY doc_id, start) AS uid, doc_id, start, ws FROM starts WHERE len(ws) >= 50),
  {_LINKED},
  roots AS (SELECT node, min(other) AS root FROM reached GROUP BY node HAVING count(*) > 1)
  SELECT 'text' AS kind, doc_id, 0::BIGINT AS first_word, len(ws)::BIGINT AS n_words, head AS kept_doc_id, 0::BIGINT AS kept_word, doc_id <> head AS removed
    FROM long WHERE copies > 1
  UNION ALL SELECT 'paragraph', i.doc_id, i.start::BIGINT, len(i.ws)::BIGINT, k.doc_id, k.start::BIGINT, root <> node
    FROM roots JOIN items i ON i.uid = node JOIN items k ON k.uid = root
  UNION ALL SELECT 'passage', doc_id, first_word::BIGINT, n_words::BIGINT, kept_doc_id, kept_word::BIGINT, true FROM spans
  UNION ALL SELECT DISTINCT 'passage', kept_doc_id, kept_word::BIGINT, 50::BIGINT, kept_doc_id, kept_word::BIGINT, false FROM spans"""
