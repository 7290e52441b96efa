"""Token ids as shards of raw payload with a minimal perfect hash index over the document keys.

A folder holds two Parquet tables. ``shards`` has one row per shard, in ascending key order: ``shard``, ``payload``
(the ids of its documents one after the other, little-endian unsigned, ``width`` bytes each, uncompressed) and ``counts`` (ids of
each document, unsigned 32 bits). ``index`` has one row per bucket of keys: the perfect hash, and by slot a stored
fingerprint, the shard, the document's place in it, and first id and number of ids there. A key leads to its bucket by a
remainder, to its slot by the hash, and from there to its bytes: constant work, whatever the size of the collection.

Keys are (doc_id, copy): rows that share a doc_id are copies 0, 1, ... in stored order; null ids are keys too and come
first. Null and empty texts have only the end id. An empty table gives empty tables. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foldwise.llm import phash
from foldwise.llm.common import mix64, only, partitions, pieces, short_batches
from foldwise.llm.tokens import ENCODED, WordEncoder

SHARD = "part int, seq int, shard long, width int, n_ids long, n_docs long, payload binary, counts binary, keys binary"
SHARD_BYTES = 4 << 20  # a shard is closed at the first document that passes this
BUCKET_KEYS = 1 << 15  # keys of an index bucket, on average, at most
INDEX = "bucket long, n long, slots binary, marks binary, shards binary, rows binary, firsts binary, counts binary"


def key_hash(doc_id: np.ndarray, known: np.ndarray, copy: np.ndarray) -> np.ndarray:
    base = np.where(known, mix64(doc_id.astype(np.int64).view(np.uint64)), np.uint64(0x6E756C6C6E756C6C))
    return mix64(base ^ mix64(copy.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) * (copy > 0))


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.int64())
    return column.fill_null(0).to_numpy(zero_copy_only=False), column.is_valid().to_numpy(zero_copy_only=False)


def _copies(doc_id: np.ndarray, known: np.ndarray, last: tuple | None) -> tuple[np.ndarray, tuple | None]:
    """How many rows of the same id stand directly before each row; ``last`` carries the run over batches."""
    n = len(doc_id)
    new = np.ones(n, bool)
    new[1:] = (doc_id[1:] != doc_id[:-1]) | (known[1:] != known[:-1])
    at = np.arange(n)
    copy = at - np.maximum.accumulate(np.where(new, at, 0))
    if n and last and (doc_id[0], known[0]) == last[:2]:
        run = n if new.sum() == 1 else int(np.flatnonzero(new)[1])
        copy[:run] += last[2] + 1
    return copy, (doc_id[-1], known[-1], int(copy[-1])) if n else last


def _sharded(path: str, spaces: str, end_id: int, width: int):
    kind = np.dtype(f"<u{width}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, last, words = TaskContext.get().partitionId(), 0, None, WordEncoder(path, spaces)
        payload, counts, keys, size = [], [], [], 0

        def close():
            c = np.concatenate(counts).astype("<u4")
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                "shard": [part << 32 | seq], "width": pa.array([width], pa.int32()),
                "n_ids": [size // width], "n_docs": [len(c)], "payload": [b"".join(payload)],
                "counts": [c.tobytes()], "keys": [np.concatenate(keys).tobytes()]})

        for batch in pieces(batches, limit=ENCODED):
            texts = batch.column("text").fill_null("").to_pylist()
            ids, n = words.encode(texts)
            ends = np.cumsum(n)
            full = np.empty(len(ids) + len(n), kind)
            stop = ends + np.arange(len(n))
            body = np.ones(len(full), bool)
            body[stop] = False
            full[body], full[stop] = ids, end_id
            copy, last = _copies(*_ids(batch.column("doc_id")), last)
            payload.append(full.tobytes())
            counts.append(n + 1)
            keys.append(key_hash(*_ids(batch.column("doc_id")), copy))
            size += full.nbytes
            if size >= SHARD_BYTES:
                yield close()
                payload, counts, keys, size, seq = [], [], [], 0, seq + 1
        if counts:
            yield close()
        words.keep()
    return run


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document of a shard, for the index."""
    for batch in batches:
        for shard, counts, keys in zip(*(batch.column(c).to_pylist() for c in ("shard", "counts", "keys"))):
            n, k = np.frombuffer(counts, "<u4").astype(np.int64), np.frombuffer(keys, np.uint64)
            yield pa.RecordBatch.from_pydict({
                "key": k.view(np.int64), "shard": np.full(len(n), shard), "row": np.arange(len(n)),
                "first": np.cumsum(n) - n, "n": n})


def _index(table: pa.Table) -> pa.Table:
    """A bucket of the index from its entries."""
    keys = table["key"].to_numpy().view(np.uint64)
    blob = phash.build(keys)
    slot = phash.Slots(blob).find(keys)

    def by_slot(values, kind):
        out = np.empty(len(keys), kind)
        out[slot] = values
        return out.tobytes()

    get = lambda c: table[c].to_numpy()
    return pa.table({"bucket": table["bucket"][:1], "n": pa.array([len(keys)], pa.int64()), "slots": [blob],
                     "marks": [by_slot(phash.fingerprints(keys), "<u4")],
                     "shards": [by_slot(get("shard"), "<i8")], "rows": [by_slot(get("row"), "<i8")],
                     "firsts": [by_slot(get("first"), "<i8")], "counts": [by_slot(get("n"), "<i8")]})


def write(docs: DataFrame, folder: str, tokenizer: str, spaces: str, end_id: int, width: int) -> None:
    """Encode ``docs(doc_id, text)`` and write shards and index to ``folder``."""
    spark = docs.sparkSession
    n = partitions(spark)
    (short_batches(only(docs, doc_id="doc_id", text="text")).repartitionByRange(n, F.col("doc_id").asc_nulls_first())
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first())
     .mapInArrow(_sharded(tokenizer, spaces, end_id, width), SHARD)
     .write.option("compression", "none").parquet(f"{folder}/shards"))
    shards = spark.read.parquet(f"{folder}/shards")
    n_docs = shards.agg(F.sum("n_docs")).first()[0] or 0
    buckets = -(-n_docs // BUCKET_KEYS) or 1
    (shards.select("shard", "counts", "keys")
     .mapInArrow(_entries, "key long, shard long, row long, first long, n long")
     .withColumn("bucket", F.pmod("key", F.lit(buckets)))
     .groupBy("bucket").applyInArrow(_index, INDEX)
     .withColumn("buckets", F.lit(buckets)).write.parquet(f"{folder}/index"))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key = key_hash(*_ids(batch.column("doc_id")), batch.column("copy").to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key.view(np.int64))], ["doc_id", "copy", "key"])


def _found(keys: pa.Table, index: pa.Table) -> pa.Table:
    schema = pa.schema([("doc_id", pa.int64()), ("copy", pa.int64()), ("shard", pa.int64()), ("row", pa.int64()),
                        ("first", pa.int64()), ("n_tokens", pa.int64())])
    if not keys.num_rows or not index.num_rows:
        return schema.empty_table()
    entry = index.slice(0, 1).to_pylist()[0]
    key = keys["key"].to_numpy().view(np.uint64)
    slot = phash.Slots(entry["slots"]).find(key)
    ok = (slot >= 0) & (np.frombuffer(entry["marks"], "<u4")[slot] == phash.fingerprints(key))
    at = slot[ok]
    columns = [np.frombuffer(entry[c], "<i8")[at] for c in ("shards", "rows", "firsts", "counts")]
    return pa.Table.from_arrays([*keys.select(["doc_id", "copy"]).filter(pa.array(ok)).combine_chunks().columns,
                                 *map(pa.array, columns)], schema=schema)


def find(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """Where the documents of ``keys(doc_id, copy)`` lie: shard, row, first id there and n_tokens."""
    index = spark.read.parquet(f"{folder}/index")
    head = index.select("buckets").first()
    keys = (keys.select(F.col("doc_id").cast("long"), F.col("copy").cast("long"))
            .mapInArrow(_hashed, "doc_id long, copy long, key long")
            .withColumn("bucket", F.pmod("key", F.lit(head[0] if head else 1))))
    return keys.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(
        _found, "doc_id long, copy long, shard long, row long, first long, n_tokens long")


def _sliced(wanted: pa.Table, shards: pa.Table) -> pa.Table:
    schema = pa.schema([("doc_id", pa.int64()), ("copy", pa.int64()), ("ids", pa.list_(pa.int64()))])
    if not wanted.num_rows or not shards.num_rows:
        return schema.empty_table()
    row = shards.slice(0, 1).to_pylist()[0]
    ids = np.frombuffer(row["payload"], f"<u{row['width']}")
    lists = [ids[a:a + n] for a, n in zip(wanted["first"].to_pylist(), wanted["n_tokens"].to_pylist())]
    return pa.Table.from_arrays([*wanted.select(["doc_id", "copy"]).combine_chunks().columns,
                                 pa.array(lists, pa.list_(pa.int64()))], schema=schema)


def fetch(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """The ids of the documents of ``keys(doc_id, copy)``, by keyed access."""
    shards = spark.read.parquet(f"{folder}/shards").select("shard", "width", "payload")
    return find(spark, folder, keys).groupBy("shard").cogroup(shards.groupBy("shard")).applyInArrow(
        _sliced, "doc_id long, copy long, ids array<long>")


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, width, payload, counts in zip(*(batch.column(c).to_pylist()
                                                   for c in ("shard", "width", "payload", "counts"))):
            n = np.frombuffer(counts, "<u4").astype(np.int64)
            data = memoryview(np.frombuffer(payload, f"<u{width}").astype("<u4")).cast("B")
            ends = np.cumsum(n)
            sums = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip((ends - n).tolist(), ends.tolist())]
            yield pa.RecordBatch.from_pydict({"s": np.full(len(n), shard), "r": np.arange(len(n)),
                                              "ids_crc32": np.array(sums, np.int64)})


def checksums(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """Per key its global start, n_tokens and the checksum of its ids, all read back from the files."""
    shards = spark.read.parquet(f"{folder}/shards")
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select(F.col("part").alias("p"), (F.sum("n").over(
        Window.partitionBy(F.lit(0)).orderBy("part")) - F.col("n")).alias("of_part"))
    bases = (shards.select("shard", "part", "n_ids", F.sum("n_ids").over(
        Window.partitionBy("part").orderBy("seq")).alias("to")).join(parts, F.col("part") == F.col("p"))
        .select("shard", (F.col("of_part") + F.col("to") - F.col("n_ids")).alias("base")))
    sums = shards.select("shard", "width", "payload", "counts").mapInArrow(_summed, "s long, r long, ids_crc32 long")
    found = find(spark, folder, keys)
    return (found.join(sums, (found["shard"] == sums["s"]) & (found["row"] == sums["r"])).join(bases, "shard")
            .select("doc_id", "copy", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"))
