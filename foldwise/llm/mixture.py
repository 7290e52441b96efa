"""Mixing sources to target weights by a low-discrepancy schedule over equal blocks.

Each source is a queue of its documents in a hashed order, cut into blocks of the same number of words. A source's target is its weighted
share of the mix, but at most ``cap`` times its size; what it cannot take is shared again by weight among the others. The schedule runs
through the multiples of the golden ratio modulo 1: each point falls into the interval of one source, whose intervals are as long as the
blocks it needs, so that every stretch of the schedule has the sources in proportion. The r-th slot of a source takes its r-th block, going
round its queue again after the last one; the last slot takes only what is left of the target. Points past a source's need are not used.

Null sources are a source of their own, the last. Null and empty texts have size 0 and take nothing. Ties of the hashed order are broken
by the text; rows alike in everything are interchangeable. Very long texts span blocks. An empty table gives an empty result. The
same rows give the same mix, however they are partitioned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import WORD, Scratch, fresh, only, pieces, short_batches, sums_before
from foldwise.operators.ranks import sorted_codes

BLOCK = 1024  # words
GOLDEN = (5 ** 0.5 - 1) / 2
ENOUGH = 2.75  # an interval of length x is met once in every 2.62 / x successive points
STRETCH = 1 << 16  # slots that are counted together


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _targets(sizes: DataFrame, weights: tuple[float, ...], share: float, cap: float, scratch: Scratch) -> DataFrame:
    """``source, source_size, idx, target``: shares by weight, filled up to the caps."""
    named = sizes.where("source is not null")
    codes = sorted_codes(named, "source", "idx").withColumnRenamed("source", "s")
    n = named.count()
    sizes = sizes.join(codes, F.col("source") == F.col("s"), "left").drop("s").withColumn("idx", F.coalesce("idx", F.lit(n)).cast("long"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("idx") % len(weights) + 1).cast("int"))
    sizes = scratch.keep(sizes.withColumn("weight", weight), "sources")
    whole = sizes.agg(F.sum("source_size")).first()[0] or 0
    level, most = 0.0, F.col("source_size") * F.lit(float(cap))
    while True:  # each round at least one more source is full, usually many
        full = most <= F.col("weight") * F.lit(level)
        row = sizes.agg(F.sum(F.when(full, F.col("source_size"))).alias("full"), F.sum(F.when(~full, F.col("weight"))).alias("w")).first()
        if not row["w"]:
            break
        higher = (share * whole - cap * (row["full"] or 0)) / row["w"]
        if higher <= level:
            break
        level = higher
    return sizes.withColumn("target", F.least(most, F.col("weight") * F.lit(level))).drop("weight")


def _needs(targets: DataFrame) -> DataFrame:
    """Words and slots that each source takes: whole rounds of its queue, and the rest of the last one."""
    words = F.floor("target").cast("long")
    size = F.col("source_size")
    rounds = F.when(size > 0, F.floor(words / size)).otherwise(0).cast("long")
    blocks = F.ceil(size / F.lit(BLOCK)).cast("long")
    return (targets.withColumn("rounds", rounds).withColumn("rest", words - F.col("rounds") * size).withColumn("blocks", blocks)
            .withColumn("slots", F.col("rounds") * blocks + F.ceil(F.col("rest") / F.lit(BLOCK)).cast("long")))


def schedule(needs: DataFrame, scratch: Scratch) -> DataFrame:
    """The used slots: ``k`` (their order), idx, round and block."""
    spark = needs.sparkSession
    placed = sums_before(needs.select("idx", "slots", "blocks", F.floor(F.col("idx") / 4096).alias("part")),
                         [], "part", ["idx"], "slots", "low")
    placed = scratch.keep(placed.where("slots > 0").withColumn("high", F.col("low") + F.col("slots")), "intervals")
    row = placed.agg(F.max("high").alias("slots"), F.count("*").alias("n")).first()
    total, bins = row["slots"] or 0, max(1024, 4 * row["n"])
    point = F.col("k") * F.lit(GOLDEN)
    points = (spark.range(int(total * ENOUGH) + (total > 0)).select((F.col("id") + 1).alias("k"))
              .withColumn("x", (point - F.floor(point)) * F.lit(float(total)))
              .withColumn("bin", F.floor(F.col("x") / F.lit(float(max(total, 1))) * bins)))
    edge = lambda c: F.floor(F.col(c) / F.lit(float(max(total, 1))) * bins)
    intervals = placed.select("idx", "slots", "blocks", "low", "high", F.explode(F.sequence(edge("low"), edge("high"))).alias("b"))
    hits = points.join(intervals, (F.col("bin") == F.col("b")) & (F.col("x") >= F.col("low")) & (F.col("x") < F.col("high"))).select(
        "k", "idx", "slots", "blocks", F.floor(F.col("k") / STRETCH).alias("part"), F.lit(1).cast("long").alias("one"))
    ranked = sums_before(scratch.keep(hits, "hits"), ["idx"], "part", ["k"], "one", "rank").where("rank < slots")
    return ranked.select("k", "idx", F.floor(F.col("rank") / F.col("blocks")).cast("long").alias("round"),
                         (F.col("rank") % F.col("blocks")).alias("block"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``docs(doc_id, text, source)`` as ``doc_id, text_hash, size, source_size, target, taken, first_slot, n_slots``: words the mix takes
    of each document, the first point of the schedule that takes any (null if none does), and how many do."""
    scratch = Scratch(docs.sparkSession)
    rows = only(docs, doc_id="doc_id", text="text", source="source")
    sized = scratch.keep(rows.select(
        "doc_id", "source", word_count("text").alias("size"), F.xxhash64("text").alias("text_hash"),
        F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":mix"))).alias("hash"),
        F.monotonically_increasing_id().alias("uid")), "sized")
    targets = _targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap, scratch)
    needs = scratch.keep(_needs(targets), "needs")
    slots = scratch.keep(schedule(needs, scratch), "slots")
    of = needs.select(F.col("source").alias("s"), "idx", "source_size", "target", "rounds", "rest")
    queued = sized.join(of, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("part", F.substring("hash", 1, 3))
    queued = scratch.keep(sums_before(queued, ["idx"], "part", ["hash", "text_hash", "uid"], "size", "at"), "queued")
    last = F.col("at") + F.col("size")
    parts = (queued.where("size > 0").withColumn("block", F.explode(F.sequence(
        F.floor(F.col("at") / BLOCK), F.floor((last - 1) / BLOCK))))
        .select("uid", "idx", "block", "rounds", "rest", F.greatest("at", F.col("block") * BLOCK).alias("from"),
                F.least(last, (F.col("block") + 1) * BLOCK).alias("to")))
    met = parts.join(slots.select(F.col("idx").alias("i"), F.col("block").alias("b"), "round", "k"),
                     (F.col("idx") == F.col("i")) & (F.col("block") == F.col("b")))
    words = F.when(F.col("round") < F.col("rounds"), F.col("to") - F.col("from")).otherwise(
        F.greatest(F.lit(0), F.least("to", "rest") - F.col("from")))
    met = met.select(F.col("uid").alias("u"), "k", words.alias("words")).where("words > 0")
    taken = met.groupBy("u").agg(F.sum("words").alias("taken"), F.min("k").alias("first_slot"), F.count("*").alias("n_slots"))
    return queued.join(taken, F.col("uid") == F.col("u"), "left").select(
        "doc_id", "text_hash", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        F.col("first_slot").cast("long").alias("first_slot"), F.coalesce("n_slots", F.lit(0)).cast("long").alias("n_slots"))


def _cut(size_column: str, taken_column: str):
    """Each text as often as it is taken whole, and its beginning for what is left."""
    word = re.compile(WORD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            names = [n for n in batch.schema.names if n not in (size_column, taken_column)]
            at, texts = [], []
            for i, (text, size, taken) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("text", size_column, taken_column)))):
                whole, rest = divmod(taken, size) if size else (1, 0)  # texts without words stay as they are
                at += [i] * (whole + (rest > 0))
                texts += [text] * whole
                if rest:
                    for n, found in enumerate(word.finditer(text), 1):
                        if n == rest:
                            texts.append(text[:found.end()])
                            break
            out = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if n == "text" else out.column(n) for n in names], names)
    return run


def apply(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``docs`` as the mix takes them: repeated where a document is taken more than once, cut where it is taken in part."""
    d, h, size, taken, copies = fresh(docs, "_d", "_h", "_size", "_taken", "_copies")
    scratch = Scratch(docs.sparkSession)
    found = scratch.keep(mix(docs, weights, share, cap).groupBy("doc_id", "text_hash", "size").agg(
        F.sum("taken").alias("taken"), F.count("*").alias("copies")).select(
        F.col("doc_id").alias(d), F.col("text_hash").alias(h), F.col("size").alias(size), F.col("taken").alias(taken),
        F.col("copies").alias(copies)), "taken")
    met = F.col("doc_id").eqNullSafe(F.col(d)) & F.xxhash64("text").eqNullSafe(F.col(h))
    ready = docs.join(found.where(F.col(copies) == 1), met).drop(d, h, copies)
    if not found.where(F.col(copies) > 1).isEmpty():
        ready = ready.unionByName(_shared(docs.join(found.where(F.col(copies) > 1), met), docs.columns, d, h, size, taken, copies, scratch))
    return short_batches(ready).mapInArrow(_cut(size, taken), docs.schema)


def _shared(alike: DataFrame, names: list[str], d: str, h: str, size: str, taken: str, copies: str, scratch: Scratch) -> DataFrame:
    """Rows alike in doc_id and text share what is taken of them: equal parts, and a word more for the first ones of what is left over."""
    numbered = scratch.keep(alike.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(d).alias("doc"), F.col(h).alias("hash"), F.col(size).alias("size"),
        F.col(taken).alias("taken"), F.col(copies).alias("copies"), F.monotonically_increasing_id().alias("uid")), "alike")
    stretched = numbered.withColumn("part", F.shiftright("uid", 16))
    placed = sums_before(stretched.withColumn("one", F.lit(1).cast("long")), ["doc", "hash"], "part", ["uid"], "one", "copy")
    part = F.floor(F.col("taken") / F.col("copies")) + (F.col("copy") < F.col("taken") % F.col("copies")).cast("long")
    return placed.select("row.*", F.col("size").alias(size), part.cast("long").alias(taken))
