"""Passages of fifty words or more that repeat: whole texts, paragraphs, and runs of words anywhere inside them.

Units of a text of at least fifty words are the whole of it, its paragraphs of at least fifty words, and windows of thirty words that begin at
places its own words choose: where the hash of a five-word shingle is the smallest of twenty successive ones. Two texts that share a
run of fifty words choose the same places inside it, so they share a window, wherever the run stands and whatever is around it.

Units get MinHash values of their five-word shingles, in bands (paragraphs 16 of 4: a pair of similarity 0.8 meets with a chance of
0.9998; windows 2 of 6: equal ones always meet, and a text's own windows, which overlap, hardly ever); whole texts have their digest. Equal
paragraphs are one class; paragraphs of different classes that meet are verified by exact Jaccard similarity, and linked ones form
components. Windows that meet are verified word by word: all runs of fifty words around them are compared by 96-bit digests, and
neighbouring runs that repeat become one span. So a passage counts from fifty equal words on, a paragraph from similarity 0.8 on.

Of equal or linked units the first stays, by doc_id and place. Texts that repeat another one word by word are reported as such and are not
compared again. Words are those of :mod:`foldwise.llm.words`. Null, empty and shorter texts have no units. Null ids come last in the
order. Rows alike in doc_id and text are one place. Very long texts are taken whole. An empty table gives an empty result. Other columns
are not read. Equality of words, shingles and runs is that of 64- to 128-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm import runs, shared
from foldwise.llm.common import Scratch, mix64, only, pieces, ragged, short_batches, utf8
from foldwise.llm.passages import paragraphs, sequence_digests
from foldwise.llm.runs import RUN
from foldwise.llm.units import clusters, linked
from foldwise.llm.words import distinct, shingles, word_hashes

SHINGLE, WINDOW, CHOICE = 5, 30, 20  # words of a shingle and a window; a window begins in any so many successive shingles
PARAGRAPH, PASSAGE, TEXT = 0, 1, 2
BANDS = {PARAGRAPH: (16, 4), PASSAGE: (2, 6)}
CHUNK_BYTES = 4 << 20
_DOC = np.dtype([("doc_id", np.int64), ("known", np.int64), ("text", np.int64)])
_PART = np.dtype([("doc", np.uint32), ("kind", np.uint32), ("start", np.uint32), ("n", np.uint32), ("one", np.uint64), ("two", np.uint64)])
_PLACE = np.dtype([("doc", np.uint32), ("start", np.uint32), ("cls", np.uint32)])
_UNIT = "uid long, doc_id long, text_hash long, kind long, start long, n_words long, one long, two long, keys binary, windows binary"


def chosen(hashes: np.ndarray) -> np.ndarray:
    """The last smallest of each ``CHOICE`` successive hashes: a place that only these words decide."""
    n = len(hashes) - CHOICE + 1
    if n <= 0:
        return np.empty(0, np.int64)
    least, have = np.arange(len(hashes)), 1
    while 2 * have <= CHOICE:
        a, b = least[:-have], least[have:]
        least, have = np.where(hashes[b] <= hashes[a], b, a), 2 * have
    a, b = least[:n], least[CHOICE - have:CHOICE - have + n]
    return np.unique(np.where(hashes[b] <= hashes[a], b, a))


def band_keys(values: np.ndarray, begins: np.ndarray, sizes: np.ndarray, kind: int) -> np.ndarray:
    """The band hashes of units, one row each, from the shingles of whole texts and where those of each unit lie."""
    bands, rows = BANDS[kind]
    out = np.empty((len(begins), bands), np.uint64)
    edges = np.stack([begins, begins + sizes], axis=1).ravel()
    values = np.append(values, np.uint64(0))  # units may end with the last shingle
    for band in range(bands):
        key = np.full(len(begins), kind << 32 | band, np.uint64)
        for k in range(rows):
            salt = mix64(np.array([(kind << 16) + band * rows + k + 1], np.uint64))[0]
            hashed = (values ^ salt) * (salt | np.uint64(1))
            hashed ^= hashed >> np.uint64(32)
            key = mix64(key ^ np.minimum.reduceat(hashed * np.uint64(0xD6E8FEB86659FD93), edges)[::2])
        out[:, band] = key
    return out


def _long_texts(data: np.ndarray, offsets: np.ndarray):
    """Texts of fifty words or more: their rows, the hashes of their words and shingles, how many words each has, and their
    paragraphs of fifty words or more as (text, first word, words)."""
    hashes, starts, counts = word_hashes(data, offsets)
    rows = np.flatnonzero(counts >= RUN)
    first = np.cumsum(counts) - counts
    own = hashes[ragged(first[rows], counts[rows])]
    edges, row, _ = paragraphs(data, offsets)
    at = np.searchsorted(starts, edges)  # the words that begin in each paragraph
    some = np.flatnonzero(np.diff(at) >= RUN)
    parts = np.searchsorted(rows, row[some]), at[some] - first[row[some]], np.diff(at)[some]
    return rows, own, shingles(own, counts[rows], SHINGLE)[0], counts[rows], parts


def _sent(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, docs, parts, places, keys, size = TaskContext.get().partitionId() << 40, [], [], [], [], 0

        def chunk():
            part, place = np.concatenate(parts), np.concatenate([p for p, *_ in places])
            digest = np.stack([np.concatenate([d for _, d, _ in places]), np.concatenate([d for *_, d in places])])
            _, first, cls = np.unique(digest, axis=1, return_index=True, return_inverse=True)
            place["cls"] = cls.ravel()
            _, first_part = np.unique(part[["kind", "one", "two"]], return_index=True)
            sizes = np.zeros(len(part) + len(place), np.int64)
            sizes[first_part] = np.where(part["kind"][first_part] == TEXT, 1, BANDS[PARAGRAPH][0])
            sizes[len(part) + first] = BANDS[PASSAGE][0]
            own = [np.concatenate([k[i] for k in keys]) for i in range(3)]
            texts, paras = part["kind"] == TEXT, part["kind"] == PARAGRAPH
            banded = [np.empty(0, np.uint64)] * len(part)
            for at, row in zip(np.flatnonzero(texts).tolist(), own[0]):
                banded[at] = row
            for at, row in zip(np.flatnonzero(paras).tolist(), own[1]):
                banded[at] = row
            sent = [banded[i] for i in np.sort(first_part).tolist()] + [own[2][np.sort(first)].ravel()]
            doc = np.concatenate(docs)
            note = np.array([len(doc), len(part)], np.int64).tobytes() + doc.tobytes() + part.tobytes() + place.tobytes()
            return shared.send(base, sizes, np.concatenate(sent), bits, note)

        for batch in pieces(batches):
            ids = batch.column("doc_id").cast(pa.int64())
            data, offsets = utf8(batch.column("text"))
            size += len(data)
            rows, words, grams, counts, (para_of, para_at, para_n) = _long_texts(data, offsets)
            if len(rows):
                before = sum(map(len, docs))
                doc = np.empty(len(rows), _DOC)
                for name, column in (("doc_id", ids.fill_null(0)), ("known", ids.is_valid()), ("text", batch.column("text_hash"))):
                    doc[name] = column.to_numpy(zero_copy_only=False)[rows]
                docs.append(doc)
                word_at = np.cumsum(counts) - counts
                gram_at = word_at - (SHINGLE - 1) * np.arange(len(rows))
                part = np.empty(len(rows) + len(para_of), _PART)
                part["doc"] = before + np.concatenate([np.arange(len(rows)), para_of])
                part["kind"] = np.repeat([TEXT, PARAGRAPH], [len(rows), len(para_of)])
                part["start"], part["n"] = np.concatenate([counts * 0, para_at]), np.concatenate([counts, para_n])
                begin = np.concatenate([word_at, word_at[para_of] + para_at])
                part["one"], part["two"] = sequence_digests(words[ragged(begin, part["n"].astype(np.int64))], part["n"].astype(np.int64))
                parts.append(part)
                own = [chosen(grams[g:g + n - SHINGLE + 1]) for g, n in zip(gram_at.tolist(), counts.tolist())]
                own = [p[p + WINDOW <= n] for p, n in zip(own, counts.tolist())]
                of, start = np.repeat(np.arange(len(rows)), [len(p) for p in own]), np.concatenate(own)
                place = np.zeros(len(of), _PLACE)
                place["doc"], place["start"] = before + of, start
                one, two = (runs._rolled(mix64(words ^ np.uint64(salt)), WINDOW)[word_at[of] + start] for salt in (0x1B873593, 0x2C1B3C6D))
                places.append((place, one, two))
                keys.append((mix64(part["one"][:len(rows)] ^ np.uint64(TEXT))[:, None],
                             band_keys(grams, gram_at[para_of] + para_at, para_n - SHINGLE + 1, PARAGRAPH) if len(para_of) else np.empty((0, BANDS[PARAGRAPH][0]), np.uint64),
                             band_keys(grams, gram_at[of] + start, np.full(len(of), WINDOW - SHINGLE + 1), PASSAGE)))
            if size >= CHUNK_BYTES and docs:
                yield chunk()
                base, docs, parts, places, keys, size = base + sum(map(len, parts)), [], [], [], [], 0
        if docs:
            yield chunk()
    return run


def _met(chunk: pa.Table) -> pa.Table:
    """The texts and paragraphs of a chunk that share a key or stand in it twice, and by text its windows of that kind."""
    note, owner, token, _ = shared.gathered(chunk)
    n_docs, n_parts = np.frombuffer(note, np.int64, 2).tolist()
    doc = np.frombuffer(note, _DOC, n_docs, 16)
    part = np.frombuffer(note, _PART, n_parts, 16 + doc.nbytes)
    place = np.frombuffer(note, _PLACE, -1, 16 + doc.nbytes + part.nbytes)
    ends = np.cumsum(np.bincount(owner, minlength=n_parts + len(place)))
    begins = np.concatenate([[0], ends[:-1]])
    hit = ends > begins

    def wanted(cls: np.ndarray, hit: np.ndarray) -> np.ndarray:
        times = np.bincount(cls)
        some = times > 1
        some[cls[hit]] = True
        return np.flatnonzero(some[cls])

    at = wanted(np.unique(part[["kind", "one", "two"]], return_inverse=True)[1].ravel(), hit[:n_parts])
    keys = [token[a:z].tobytes() if z > a else None for a, z in zip(begins[at].tolist(), ends[at].tolist())]
    few = wanted(place["cls"].astype(np.int64), hit[n_parts:]) if len(place) else np.empty(0, np.int64)
    of, first = np.unique(place["doc"][few], return_index=True)
    starts = [place["start"][few][a:z].astype(np.int64).tobytes() for a, z in zip(first.tolist(), [*first[1:].tolist(), len(few)])]
    owners = np.concatenate([part["doc"][at], of]).astype(np.int64)
    numbers = lambda name: pa.array(np.concatenate([part[name][at].astype(np.int64), np.zeros(len(of), np.int64)]))
    return pa.table({
        "uid": np.concatenate([chunk["base"][0].as_py() + at, np.full(len(of), -1)]), "doc_id": pa.array(doc["doc_id"][owners], mask=doc["known"][owners] == 0),
        "text_hash": doc["text"][owners], "kind": np.concatenate([part["kind"][at].astype(np.int64), np.full(len(of), PASSAGE)]),
        "start": numbers("start"), "n_words": numbers("n"), "one": pa.array(np.concatenate([part["one"][at].view(np.int64), of * 0]).astype(np.int64)),
        "two": pa.array(np.concatenate([part["two"][at].view(np.int64), of * 0]).astype(np.int64)),
        "keys": pa.array(keys + [None] * len(of), pa.binary()), "windows": pa.array([None] * len(at) + starts, pa.binary())})


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingle sets of the wanted units of each text."""
    for batch in pieces(batches):
        hashes, _, counts = word_hashes(*utf8(batch.column("text")))
        first = np.cumsum(counts) - counts
        wanted = [(first[r] + w["start"], w["n_words"], w["uid"], w["keys"]) for r, ws in enumerate(batch.column("wanted").to_pylist()) for w in ws]
        if not wanted:
            continue
        begin, n = (np.array(c, np.int64) for c in list(zip(*wanted))[:2])
        values, sizes = distinct(*shingles(hashes[ragged(begin, n)], n, SHINGLE))
        ends = np.cumsum(sizes)
        yield pa.RecordBatch.from_pydict({
            "uid": pa.array([w[2] for w in wanted], pa.int64()), "n": pa.array(sizes, pa.int64()), "keys": pa.array([w[3] for w in wanted], pa.binary()),
            "tokens": pa.array([values[z - s:z].tobytes() for z, s in zip(ends.tolist(), sizes.tolist())], pa.binary())})


def _around(bits: int):
    """For every chunk of texts: the runs that hold a candidate window, as packets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, places, found, size = TaskContext.get().partitionId() << 40, [], [], 0
        for batch in pieces(batches):
            size += utf8(batch.column("text"))[1][-1]
            rows, hashes, begins, ends = runs._long(batch)
            one, two = runs.digests(hashes)
            at_doc = sum(len(p) for p in places)
            places.append(runs._places(batch, rows))
            windows = batch.column("windows").to_pylist()  # where they begin
            for k, (r, a, z) in enumerate(zip(rows.tolist(), begins.tolist(), ends.tolist())):
                first = np.frombuffer(windows[r], np.int64)
                low = np.maximum(first - (RUN - WINDOW), 0)
                at = np.unique(ragged(low, np.maximum(np.minimum(first, z - a - RUN) - low + 1, 0)))
                if len(at):
                    found.append((one[a + at], two[a + at], np.full(len(at), at_doc + k), at))
            if size >= CHUNK_BYTES and found:
                yield runs.packed(base, places, found, bits)
                base, places, found, size = base + 1, [], [], 0
        if found:
            yield runs.packed(base, places, found, bits)
    return run


def _same(table: DataFrame, doc: str, text: str):
    return table["doc_id"].eqNullSafe(F.col(doc)) & (table["text_hash"] == F.col(text))


def repeated(docs: DataFrame, percent: int = 80) -> DataFrame:
    """Every place of ``docs(doc_id, text)`` that repeats another or is repeated: ``kind`` (text, paragraph, passage), ``doc_id``,
    ``first_word`` (from 0) and ``n_words``, which place stays (``kept_doc_id``, ``kept_word``), and whether this one goes (``removed``).

    A place that stays has one row for a text or a paragraph, and one for every kept beginning of a passage, of fifty words.
    """
    scratch = Scratch(docs.sparkSession)
    rows = only(docs, doc_id="doc_id", text="text").withColumn("text_hash", F.xxhash64("text"))
    letters = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = shared.bucket_bits(letters // 14)
    packets = short_batches(rows).mapInArrow(_sent(bits), shared.PACKET)
    found = scratch.keep(shared.answers(packets, bits).groupBy("base").applyInArrow(_met, _UNIT), "units")
    scratch.settle()
    units = found.where(f"kind <> {PASSAGE}").drop("windows")
    order = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id"), F.col("start"), F.col("text_hash"))
    classes = scratch.keep(units.groupBy("kind", "one", "two").agg(
        F.coalesce(F.min(F.when(F.col("keys").isNotNull(), F.col("uid"))), F.min("uid")).alias("rep"), F.min(order).alias("head"), F.max(order).alias("last")), "classes")
    reps = scratch.keep(units.where(f"keys is not null and kind = {PARAGRAPH}").join(
        classes.select("rep"), F.col("uid") == F.col("rep"), "left_semi").select("uid", "doc_id", "text_hash", "start", "n_words", "keys"), "reps")
    labels = clusters(reps, scratch, "substrings")
    wanted = (reps.join(labels.select(F.col("uid").alias("u")), F.col("uid") == F.col("u"), "left_semi").groupBy("doc_id", "text_hash")
              .agg(F.collect_list(F.struct("start", "n_words", "uid", "keys")).alias("wanted")).withColumnsRenamed({"doc_id": "d", "text_hash": "h"}))
    texts = rows.join(wanted, _same(rows, "d", "h")).select("text", "wanted")
    items = scratch.keep(short_batches(texts).mapInArrow(_shingled, "uid long, n long, keys binary, tokens binary").dropDuplicates(["uid"]), "items")
    of = linked(labels, items, scratch, "substrings", percent, ordered=False)
    grouped = scratch.keep(classes.join(of, F.col("rep") == F.col("node"), "left").select(
        "kind", "one", "two", "head", "last", F.coalesce("root", "rep").alias("component")), "grouped")
    ends = grouped.groupBy("component").agg(F.min("head").alias("first"), F.max("last").alias("last")).where("first <> last").select(
        F.col("component").alias("c"), F.col("first"))
    repeats = grouped.select("kind", "one", "two", "component").join(ends, F.col("component") == F.col("c")).select(
        F.col("kind").alias("k"), F.col("one").alias("c1"), F.col("two").alias("c2"), "first")
    placed = scratch.keep(units.drop("keys", "uid").join(
        repeats, (F.col("kind") == F.col("k")) & (F.col("one") == F.col("c1")) & (F.col("two") == F.col("c2")))
        .drop("k", "c1", "c2", "one", "two"), "placed")
    whole = placed.select(
        F.when(F.col("kind") == TEXT, "text").otherwise("paragraph").alias("kind"), "doc_id", F.col("start").alias("first_word"), "n_words",
        F.col("first.doc_id").alias("kept_doc_id"), F.col("first.start").alias("kept_word"),
        (~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("start") == F.col("first.start"))
           & (F.col("text_hash") == F.col("first.text_hash")))).alias("removed"))
    copies = placed.where(f"kind = {TEXT}").where(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash")))).select(
        F.col("doc_id").alias("d"), F.col("text_hash").alias("h")).distinct()
    windows = found.where(f"kind = {PASSAGE}").select("doc_id", "text_hash", "windows")
    # rows alike in id and text are one place, with one list of windows
    windows = scratch.keep(windows.join(copies, _same(windows, "d", "h"), "left_anti").groupBy("doc_id", "text_hash").agg(
        F.max("windows").alias("windows")).withColumnsRenamed({"doc_id": "d", "text_hash": "h"}), "windows")
    scratch.drop("units", "classes", "reps", "items", "grouped")  # what follows reads placed and windows
    scratch.settle()
    many = (windows.agg(F.sum(F.octet_length("windows"))).first()[0] or 0) // 8
    run_bits = shared.bucket_bits(many * CHOICE // 2)
    compared = short_batches(rows.join(windows, _same(rows, "d", "h")).drop("d", "h")).mapInArrow(_around(run_bits), runs.PACKETS)
    spans = runs.spans(compared, scratch)
    scratch.drop("windows")
    gone = spans.distinct().select(F.lit("passage").alias("kind"), "doc_id", "first_word", "n_words", "kept_doc_id", "kept_word", F.lit(True).alias("removed"))
    kept = spans.select("kept_doc_id", "kept_word").distinct().select(
        F.lit("passage").alias("kind"), F.col("kept_doc_id").alias("doc_id"), F.col("kept_word").alias("first_word"), F.lit(RUN).cast("long").alias("n_words"),
        "kept_doc_id", "kept_word", F.lit(False).alias("removed"))
    return whole.distinct().unionByName(gone).unionByName(kept)
