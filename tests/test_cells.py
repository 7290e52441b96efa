"""Term weights by chunks of texts against those of the plan that sums by id, and character runs by chunks against those by id."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from foldwise.operators import grams, tfidf

TEXTS = ["the cat sat on the mat", "the cat, the CAT and a cat", None, "", "aaaa aaaa a", "çok güzel  bir\tgün çok güzel", "x y z", "on the mat the cat sat", "!!"]
BLOCKS = [tfidf.Block("word", "word", 1, 3, 40, 1), tfidf.Block("char", "char", 3, 5, 60, 2)]


def frame(spark, ids):
    return spark.createDataFrame([(i, t) for i, t in zip(ids, TEXTS * (-(-len(ids) // len(TEXTS))))], "id long, text string")


@pytest.mark.parametrize("words", [4, 1 << 18])
def test_weights_are_those_of_the_plan_by_id(spark, monkeypatch, words):
    monkeypatch.setattr(tfidf, "CHAR_WORDS", words)
    df = frame(spark, list(range(27)))
    made = tfidf.fit_vectoriser(df, "id", "text", BLOCKS)
    direct = {r["id"]: r["cells"] for r in made.cells(df, "id", "text").collect()}
    monkeypatch.setattr(tfidf, "ids_unique", lambda df, id_col: (df.count(), False))
    plain = made.cells(df, "id", "text")
    assert made.cells(df, "id", "text").schema == plain.schema
    want = {r["id"]: r["cells"] for r in plain.collect()}
    assert direct.keys() == want.keys() and sum(map(len, want.values())) > 300
    for i, cells in want.items():
        assert [c["i"] for c in direct[i]] == [c["i"] for c in cells]
        assert all(abs(a["w"] - b["w"]) < 1e-12 for a, b in zip(direct[i], cells))


def test_weights_of_unique_ids_need_no_shuffle_of_terms(spark):
    df = frame(spark, list(range(9)))
    made = tfidf.fit_vectoriser(df, "id", "text", BLOCKS)
    plan = made.cells(df, "id", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Aggregate" not in plan and "Join" not in plan


@pytest.mark.parametrize("words", [3, 1 << 18])
def test_character_runs_by_chunks(spark, monkeypatch, words):
    monkeypatch.setattr(grams, "CHAR_WORDS", words)
    df, block = frame(spark, list(range(18))), BLOCKS[1]
    sums = lambda rows: {r["term"]: (r["tf"], r["df"]) for r in rows.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df")).collect()}
    assert sums(block.occurrences(df, "id", "text", unique=True)) == sums(block.occurrences(df, "id", "text"))


def test_texts_that_share_an_id_are_one_text(spark):
    df = frame(spark, [1, 1, 2, None, None, 3, 4, 5, 6])
    made = tfidf.fit_vectoriser(df, "id", "text", BLOCKS)
    got = [r for r in made.cells(df, "id", "text").collect()]
    assert len(got) == 9 and sum(r["id"] is None and not r["cells"] for r in got) == 2
    one = [r["cells"] for r in got if r["id"] == 1]
    assert one[0] == one[1] and len(one[0]) > 10
