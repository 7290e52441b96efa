import math

from foldwise import fixed
from foldwise.functions import text as X
from foldwise.operators import lexicon, tfidf
from pyspark.sql import functions as F


def test_mentions_and_contrast(spark):
    rows = [(1, "Proje kalite iyi, SQL güçlü. Ancak iletişim ve ekip zayıf. Fakat proje"), (2, "ama yok"), (3, "")]
    df = spark.createDataFrame(rows, "id long, t string")
    got = {r["id"]: r for r in lexicon.with_mentions(df, "t").collect()}
    one = got[1]
    assert (one["m_praise_projq"], one["m_praise_proj"], one["m_praise_sql"]) == (1, 1, 1)
    assert (one["m_crit_comm"], one["m_crit_team"], one["m_crit_proj"], one["m_net_proj"]) == (1, 1, 1, 0)
    assert one["m_has_contrast"] == 1 and one["m_praise_total"] == 3 and one["m_crit_total"] == 3
    assert got[2]["m_has_contrast"] == 1 and got[3]["m_has_contrast"] == 0
    assert len(lexicon.mention_columns()) == 3 * len(set(fixed.MENTIONS.values())) + 3


def test_shape_statistics(spark):
    df = spark.createDataFrame([("Çok güçlü ve başarılı.  Ancak eksik. Düşük!",)], "t string")
    row = df.select(*[e.alias(n) for n, e in lexicon.shape_columns("t").items()]).first()
    assert row["text_word_count"] == 7 and row["text_sentence_count"] == 3
    assert row["text_pos_hits"] == 2 and row["text_neg_hits"] == 2 and row["text_contrast_hits"] == 1
    assert row["text_sentiment_balance"] == 0 and row["text_char_len"] == 43


def test_char_grams_of_short_words(spark):
    df = spark.createDataFrame([("a bcd",)], "t string")
    got = df.select(X.char_grams("t", 3, 5).alias("g")).first()["g"]
    assert sorted(got) == sorted([" a ", " bc", "bcd", "cd ", " bcd", "bcd ", " bcd "])


def test_word_grams(spark):
    df = spark.createDataFrame([("Güçlü a şık, kod_1!",)], "t string").select(X.word_tokens("t").alias("w"))
    assert df.first()["w"] == ["güçlü", "şık", "kod_1"]
    got = df.select(X.grams("w", 1, 3).alias("g")).first()["g"]
    assert got == ["güçlü", "şık", "kod_1", "güçlü şık", "şık kod_1", "güçlü şık kod_1"]


def test_tfidf_by_hand(spark):
    docs = [(1, "aa bb aa"), (2, "bb cc"), (3, "")]
    df = spark.createDataFrame(docs, "id long, t string")
    block = tfidf.Block("w", "word", 1, 1, 10, 1)
    made = tfidf.fit_vectoriser(df, "id", "t", [block])
    idf = lambda n: math.log(4 / (1 + n)) + 1
    a, b = (1 + math.log(2)) * idf(1), idf(2)
    norm = math.hypot(a, b)
    got = {(r["id"], r["term_id"]): r["weight"] for r in made.long(df, "id", "t").collect()}
    assert abs(got[(1, 0)] - a / norm) < 1e-12 and abs(got[(1, 1)] - b / norm) < 1e-12
    assert {k[0] for k in got} == {1, 2}
    vectors = {r["id"]: r["features"] for r in made.vectors(df, "id", "t").collect()}
    assert vectors[3].numNonzeros() == 0 and abs(vectors[1].norm(2) - 1) < 1e-12


def test_vocabulary_limits(spark):
    df = spark.createDataFrame([(i, "xx yy" if i % 2 else "xx zz") for i in range(6)] + [(9, "rare")],
                               "id long, t string")
    made = tfidf.fit_vectoriser(df, "id", "t", [tfidf.Block("w", "word", 1, 1, 2, 2)])
    assert [r["term"] for r in made.terms().orderBy("term_id").collect()] == ["xx", "yy"]


def test_svd_and_pca(spark):
    import numpy as np
    from foldwise.operators import reduce
    rng = np.random.RandomState(0)
    x = rng.normal(size=(60, 6)) * [5, 3, 1, 1, 1, 1]
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)],
                               "id long, e array<double>")
    p = reduce.fit_pca(df, "e", 2).transform(df).orderBy("id").toPandas()
    c = x - x.mean(axis=0)
    _, _, vt = np.linalg.svd(c, full_matrices=False)
    assert np.allclose(np.abs(p[["emb_pca_0", "emb_pca_1"]].to_numpy()), np.abs(c @ vt[:2].T), atol=1e-8)
    from pyspark.ml.functions import array_to_vector
    basis = reduce.fit_svd(df.select(array_to_vector("e").alias("features")), dims=2)
    cells = df.select("id", F.expr("transform(e, (v, k) -> struct(k as i, v as w))").alias("cells"))
    got = basis.transform(cells, "id", "s").orderBy("id").toPandas()[["s0", "s1"]].to_numpy()
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(np.abs(got), np.abs(x @ vt[:2].T), atol=1e-8)
    assert np.allclose(basis.singular_values, s[:2])
