"""Mixture-controlled packing of documents into fixed token windows.

Every source is a queue of its documents in a hashed order. Deficit round-robin serves the queues for every window: each
source earns its target share of the window's tokens, is served what its credit is worth, and carries the rest to the next window, so
that a source is never more than about a run of 64 tokens from its share. Windows are filled without gaps, so padding is left to
the end of the last one, and that remainder is laid out in windows whose sizes are powers of two, which need none.

The work is divided along the stream: block b holds of every source the tokens between the same two fractions of its
queue, so a block has the shares of the whole. A source's credit at the start of a block is the fraction of a token
that its queue position was rounded by, as at the end of the block before; windows run on across blocks.

Null ids and sources are kept (null is a source of its own); null and empty texts have only the end id; repeated rows
are packed each. An empty table gives no pieces. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import Scratch, only, pieces, short_batches, sums_before
from foldwise.llm.tokens import ENCODED, WordEncoder

BLOCK_TOKENS = 1 << 20  # tokens that one task lays out at a time
RUN = 64  # a source is served at least so many tokens at once, unless its queue or the window ends
STRETCHES = 1024  # hash ranges per source for running sums


def _encoded(path: str, spaces: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordEncoder(path, spaces)
        for batch in pieces(batches, limit=ENCODED):
            ids, n = words.encode(batch.column("text").fill_null("").to_pylist())
            kind = "<u2" if not len(ids) or max(int(ids.max()), end_id) < 1 << 16 else "<u4"
            ends, end = np.cumsum(n), np.array([end_id], kind).tobytes()
            ids = ids.astype(kind)
            data, width = memoryview(ids).cast("B"), ids.itemsize
            rows = [bytes(data[width * a:width * b]) + end for a, b in zip((ends - n).tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), batch.column("doc_id").cast(pa.int64()), batch.column("source").cast(pa.string()),
                 pa.array(n + 1, pa.int64()), pa.array([width] * len(n), pa.int32()), pa.array(rows, pa.binary())],
                ["uid", "doc_id", "source", "n", "width", "ids"])
        words.keep()
    return run


def _serve(tokens: np.ndarray, credit: np.ndarray, window: int, begun: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Deficit round-robin over queues of so many tokens, window by window: the runs as (queue, tokens), in order.

    For every window, the first of which has ``begun`` tokens already, each source earns its share of the room and is served what its credit is worth in
    whole tokens, if that is a run of ``RUN`` or more; the rest is carried to the next window. Room that fractions leave goes to the largest credits.
    """
    left, deficit, total = tokens.copy(), credit.astype(float).copy(), int(tokens.sum())
    share = tokens / max(total, 1)
    least = np.minimum(RUN, np.maximum(left, 1))
    queues, runs, at = [], [], begun
    while total:
        room = min(window - at % window, total)
        deficit += share * room
        n = np.minimum(np.floor(deficit).astype(np.int64), left)
        n[n < np.minimum(least, left)] = 0
        over = int(n.sum()) - room
        while over > 0:  # credit from before is worth more than the window has room for
            q = int(np.argmax(n))
            cut = min(over, int(n[q]))
            n[q] -= cut
            over -= cut
        while over < 0:  # the largest credits take what is left of the room, in runs
            free = left - n
            order = np.argsort(n - deficit, kind="stable")
            order = order[free[order] > 0]
            give = np.minimum(free[order], np.maximum(1, RUN - n[order]))
            sums = np.cumsum(give)
            k = min(int(np.searchsorted(sums, -over)) + 1, len(order))
            give[k - 1] -= max(0, int(sums[k - 1]) + over)
            n[order[:k]] += give[:k]
            over += int(give[:k].sum())
        deficit -= n
        left -= n
        at += room
        total -= room
        some = np.flatnonzero(n)
        queues.append(some)
        runs.append(n[some])
    return np.concatenate(queues or [np.empty(0, np.int64)]), np.concatenate(runs or [np.empty(0, np.int64)])


def _laid_out(window: int):
    schema = pa.schema([("uid", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                        ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by([("queue", "ascending"), ("at", "ascending"), ("uid", "ascending")])
        get = lambda c: block[c].to_numpy()
        uid, start, length, base, total = (get(c) for c in ("uid", "start", "length", "base", "total"))
        _, queue = np.unique(get("queue"), return_inverse=True)
        tokens = np.bincount(queue, weights=length).astype(np.int64)
        credit = np.zeros(len(tokens))
        credit[queue] = get("credit")
        queues, runs = _serve(tokens, credit, window, int(base[0]) % window)
        # queues lie one behind the other on an axis of this block's tokens; runs map it to the served stream
        queue_at = np.cumsum(tokens) - tokens
        order = np.argsort(queues, kind="stable")
        run_axis = np.empty(len(runs), np.int64)
        by_queue = runs[order]
        run_axis[order] = np.cumsum(by_queue) - by_queue
        run_out = np.cumsum(runs) - runs
        on_axis = np.argsort(run_axis, kind="stable")
        doc_axis = np.cumsum(length) - length
        of_run = on_axis[np.searchsorted(run_axis[on_axis], doc_axis, "right") - 1]
        doc_out = run_out[of_run] + doc_axis - run_axis[of_run]
        first, n, all_ = int(base[0]), int(length.sum()), int(total[0])
        whole = all_ // window * window
        edges = np.arange(-(-first // window) * window, min(first + n, whole) + 1, window)
        tail, at = [], whole
        for bit in reversed(range(window.bit_length())):
            if (all_ - whole) >> bit & 1:
                tail.append(at)
                at += 1 << bit
        tails = np.array(tail, np.int64)
        windows = np.concatenate([edges, tails]) - first
        cuts = np.unique(np.concatenate([run_out, doc_out, windows[(windows >= 0) & (windows < n)]]))
        lengths = np.diff(cuts, append=n)
        of = np.searchsorted(run_out, cuts, "right") - 1
        axis = run_axis[of] + cuts - run_out[of]
        doc = np.searchsorted(doc_axis, axis, "right") - 1
        place = cuts + first
        last = np.searchsorted(tails, place, "right") - 1
        in_tail = last >= 0
        sequence = np.where(in_tail, whole // window + last, place // window)
        begins = np.where(in_tail, tails[last] if len(tails) else 0, place // window * window)
        return pa.table([uid[doc], start[doc] + axis - doc_axis[doc], lengths, sequence, place - begins], schema=schema)
    return run


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = batch.column("parts")
        each = np.diff(parts.offsets.to_numpy())
        flat = parts.flatten()
        place = {c: flat.field(c).to_numpy(zero_copy_only=False) for c in ("start", "length", "sequence_id", "offset")}
        starts, ends = (4 * place["start"]).tolist(), (4 * (place["start"] + place["length"])).tolist()
        sums, at = [], 0
        for width, ids, n in zip(batch.column("width").to_pylist(), batch.column("ids"), each.tolist()):
            data = memoryview(np.frombuffer(ids.as_buffer(), f"<u{width}").astype("<u4")).cast("B")
            sums += [zlib.crc32(data[a:z]) for a, z in zip(starts[at:at + n], ends[at:at + n])]
            at += n
        doc = pa.array(np.repeat(np.arange(batch.num_rows), each))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(doc), pa.array(place["start"]), pa.array(place["length"]), pa.array(sums, pa.int64()),
             batch.column("n").take(doc), pa.array(place["sequence_id"]), pa.array(place["offset"])],
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])


def pack(docs: DataFrame, tokenizer: str, spaces: str, end_id: int, window: int = 1024) -> DataFrame:
    """Pieces of ``docs(doc_id, text, source)``: which tokens of which document stand where in which window."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    rows = (only(docs, doc_id="doc_id", text="text", source="source")
            .withColumn("uid", F.monotonically_increasing_id()))
    encoded = scratch.keep(short_batches(rows).mapInArrow(
        _encoded(tokenizer, spaces, end_id),
        "uid long, doc_id long, source string, n long, width int, ids binary"), "ids", "snappy")
    docs = encoded.select("uid", "source", "n", F.xxhash64("doc_id", "n").alias("hash"))
    sizes = docs.groupBy("source").agg(F.sum("n").alias("size")).withColumn("queue", F.xxhash64("source"))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    if not total:
        return spark.createDataFrame([], "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                         "sequence_id long, offset long")
    blocks = -(-total // BLOCK_TOKENS)
    docs = docs.withColumn("stretch", F.shiftright("hash", 54)).withColumn("queue", F.xxhash64("source"))
    placed = sums_before(docs.drop("source"), ["queue"], "stretch", ["hash", "uid"], "n", "at")
    placed = placed.join(sizes.select("queue", "size"), "queue")

    def edge(b):
        return F.ceil(F.col("size") * (b / F.lit(float(blocks)))).cast("long")

    def block_of(i):
        """The block whose edges enclose token i; the division may miss by one."""
        b = F.floor(i / F.col("size") * F.lit(float(blocks)))
        return F.when(edge(b) > i, b - 1).when(edge(b + 1) <= i, b + 1).otherwise(b).cast("long")

    parts = (placed.withColumn("block", F.explode(F.sequence(
        block_of(F.col("at")), block_of(F.col("at") + F.col("n") - 1))))
        .withColumn("from", F.greatest("at", edge(F.col("block"))))
        .withColumn("to", F.least(F.col("at") + F.col("n"), edge(F.col("block") + 1)))
        .where("to > from")
        .select("block", "queue", F.col("from").alias("at"), "uid", (F.col("from") - F.col("at")).alias("start"),
                (F.col("to") - F.col("from")).alias("length"),
                (F.col("size") * (F.col("block") / F.lit(float(blocks))) - edge(F.col("block")) + 1).alias("credit")))
    parts = scratch.keep(parts, "parts")
    stretch = F.floor(F.col("block") / 4096)
    bases = sums_before(parts.groupBy("block").agg(F.sum("length").alias("tokens")).withColumn("stretch", stretch),
                        [], "stretch", ["block"], "tokens", "base").select(F.col("block").alias("b"), "base")
    laid = (parts.join(bases, F.col("block") == F.col("b")).drop("b").withColumn("total", F.lit(total))
            .groupBy("block").applyInArrow(
                _laid_out(window), "uid long, start long, length long, sequence_id long, offset long"))
    by_doc = laid.groupBy("uid").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("parts"))
    return encoded.select("uid", "doc_id", "n", "width", "ids").join(by_doc, "uid").drop("uid").mapInArrow(
        _checked, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
