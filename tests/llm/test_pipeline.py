"""Stages of the pipeline on each other's results."""

import re

import corpus_pipeline
from foldwise.llm.common import Scratch
from pyspark.sql import functions as F
from tests.oracle import ROOT

SF = f"{ROOT}/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_stages_keep_columns_and_take_effect(spark):
    docs, scratch, kept = spark.read.parquet(f"{SF}/documents.parquet"), Scratch(spark), []
    names = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = scratch.keep(stage(spark, docs, SF), str(i))
        kept.append(docs.collect())
        if i < 4:
            assert docs.columns == names and all(r["n_chars"] == len(r["text"]) for r in kept[-1])
    bad = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 0").collect()}
    first = {r["doc_id"] for r in kept[0]}
    assert len(bad & first) < 0.1 * len(bad) and len(first) > 150
    sets = [frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) for w in (words(r["text"].lower()) for r in kept[1])]
    for i, a in enumerate(sets):
        for b in sets[:i]:
            both = len(a & b)
            assert 100 * both < 80 * (len(a) + len(b) - both) or not a
    seen = set()
    for r in kept[2]:
        for part in r["text"].split("\n"):
            key = " ".join(words(part.lower()))
            assert len(words(part)) < 5 or key not in seen
            seen.add(key)
    total = sum(len(words(r["text"])) for r in kept[2])
    assert abs(sum(len(words(r["text"])) for r in kept[3]) - 1.5 * total) <= 30
    assert {r["doc_id"] for r in kept[3]} <= {r["doc_id"] for r in kept[2]} <= {r["doc_id"] for r in kept[1]} <= first
    sizes = {}
    for r in kept[4]:
        sizes[r["sequence_id"]] = sizes.get(r["sequence_id"], 0) + r["length"]
    assert sum(n != 1024 for n in sizes.values()) <= 10 and all(n & (n - 1) == 0 for n in sizes.values())


def test_empty_and_odd_documents_pass(spark, odd_rows):
    full = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in odd_rows],
                                 "doc_id long, text string, lang string, source string, n_chars long").withColumn("label", F.lit(3))
    for docs in (full.limit(0), full):
        scratch = Scratch(spark)
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = scratch.keep(stage(spark, docs, SF), str(i))
        assert (docs.count() > 0) == (docs is not None and scratch.spark.read.parquet(scratch.path("0")).count() > 0)
