"""The most frequent terms against plain counting, with samples and slots too small to be of help."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foldwise.operators import grams, tfidf, topterms, words


def texts(n=400, words_=900):
    rng = np.random.default_rng(5)
    return [(i, " ".join(f"w{min(int(z), words_)}" for z in rng.zipf(1.3, rng.integers(0, 30)))) for i in range(n)]


@pytest.mark.parametrize("sample,slots,top,min_df", [
    (10_000, 1 << 22, 25, 3), (40, 1 << 22, 25, 1), (40, 1 << 22, 25, 3), (3, 64, 25, 3), (40, 1, 25, 1), (40, 1 << 22, 5000, 2)])
def test_equal_to_plain_counting(spark, monkeypatch, sample, slots, top, min_df):
    monkeypatch.setattr(topterms, "SAMPLE_ROWS", sample)
    monkeypatch.setattr(topterms, "SLOTS", slots)
    rows = texts()
    df = spark.createDataFrame(rows, "id long, t string").repartition(4)
    block = tfidf.Block("word", "word", 1, 1, top, min_df)
    got = topterms.top_terms(df, "id", lambda r: block.occurrences(r, "id", "t"), top, min_df)
    total, in_rows = Counter(), Counter()
    for _, t in rows:
        total.update(t.split())
        in_rows.update(set(t.split()))
    want = sorted(((-c, w) for w, c in total.items() if in_rows[w] >= min_df))[:top]
    assert sorted((-r["total"], r["term"], r["df"]) for r in got.collect()) == [(c, w, in_rows[w]) for c, w in want]


def test_late_terms_are_found(spark, monkeypatch):
    """A term that no sampled row holds is among the most frequent ones."""
    monkeypatch.setattr(topterms, "SAMPLE_ROWS", 20)
    drawn = F.pmod(F.xxhash64(F.lit("candidates"), "id"), F.lit(10)) == 0
    df = spark.range(200).withColumn("t", F.when(drawn, F.lit("seen")).otherwise(F.lit("unseen late unseen")))
    n_drawn = df.where(drawn).count()
    got = topterms.top_terms(df, "id", lambda rows: words.occurrences(rows, "t").select("term", F.lit(1).alias("tf"), F.lit(1).alias("df")), 2).orderBy(F.desc("total"))
    assert 0 < n_drawn < 100 and [r["term"] for r in got.collect()] == ["unseen", "late"]


def test_empty_table(spark, monkeypatch):
    df = spark.createDataFrame([], "id long, t string")
    assert words.frequent_terms(df, "t", 5).count() == 0
    monkeypatch.setattr(topterms, "SAMPLE_ROWS", 1)
    assert words.frequent_terms(spark.createDataFrame([(1, None), (2, ""), (3, "-")], df.schema), "t", 5).count() == 0


def plain_counts(rows, low, high):
    """Occurrences of each run of words, and the rows that have it."""
    total, in_rows = Counter(), Counter()
    for tokens in rows:
        own = Counter(" ".join(tokens[i:i + n]) for n in range(low, high + 1) for i in range(len(tokens or []) - n + 1))
        total.update(own)
        in_rows.update(own.keys())
    return {term: (n, in_rows[term]) for term, n in total.items()}


@pytest.mark.parametrize("low,high", [(1, 1), (1, 2), (2, 2), (1, 3), (2, 4), (3, 3)])
@pytest.mark.parametrize("chunk", [1, 50, 1 << 20])
def test_runs_of_words_by_chunks(monkeypatch, low, high, chunk):
    """Null, empty, short and long rows in any chunks; each chunk gives a run once."""
    monkeypatch.setattr(grams, "CHUNK_WORDS", chunk)
    rng = np.random.default_rng(2)
    rows = [None, [], ["a"], ["é", "a", "é", "a", "é"], None, ["a"] * 300, []] + [[f"w{w}" for w in rng.zipf(1.4, n) % 50] for n in rng.integers(0, 60, 80)]
    batches = [pa.record_batch({"tokens": pa.array(part, pa.list_(pa.string()))}).slice(1) for part in ([None, *rows[:30]], [["not", "read"], *rows[30:]])]
    made = [r for batch in grams._chunks(low, high)(iter(batches)) for r in batch.to_pylist()]
    found = Counter(), Counter()
    for r in made:
        found[0][r["term"]] += r["tf"]
        found[1][r["term"]] += r["df"]
    want = plain_counts([r or [] for r in rows], low, high)
    assert {t: (n, found[1][t]) for t, n in found[0].items()} == want
    if chunk > 50:
        assert len(made) == len(want)


def test_a_chunk_hands_on_each_run_once(spark):
    """What is handed on grows with the different runs, not with their occurrences."""
    df = spark.createDataFrame([(i, "one two one two " * 50) for i in range(300)], "id long, t string").coalesce(1)
    made = tfidf.Block("word", "word", 1, 2, 100, 1).occurrences(df, "id", "t").collect()
    assert sorted((r["term"], r["tf"], r["df"]) for r in made) == [
        ("one", 30_000, 300), ("one two", 30_000, 300), ("two", 30_000, 300), ("two one", 29_700, 300)]
