"""Passages that repeat word for word, wherever they stand in a text.

A passage is a run of fifty words, across line feeds and whatever separates them. Of equal passages the first stays, by doc_id,
text and position; every word of the others goes, and only those. A passage that overlaps the first one in the same text stays.

A passage is named by the smallest hash among its runs of 25 words, so equal passages have the same name. Smallest hashes are small
numbers, of which most would go to the first of the buckets, so names are scattered once more. Only names travel, about one in thirteen
words; passages whose name stands elsewhere too are compared by 96-bit digests of all their words. A task sends a passage once for a
chunk of texts, however many of them hold it.

Words are those of :mod:`foldwise.llm.words`. Null, empty and shorter texts have no passages. Null ids come last in the order. Rows alike
in doc_id and text are copies of each other and keep or lose the same. Very long texts are taken whole. An empty table gives an
empty result. Other columns are not read, and :func:`remove` hands them on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm import shared
from foldwise.llm.common import Scratch, fresh, mix64, only, pieces, ragged, short_batches, utf8
from foldwise.llm.words import INVERSE, MULTIPLIER, word_hashes

RUN, GRAM = 50, 25  # words of a passage and of the runs that name it
CHUNK_BYTES, BATCH_ROWS = 4 << 20, 1 << 16
PASSAGES = 1 << 18  # passages that one bucket compares, on average, at most; they take 200 bytes each there
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_PLACE = np.dtype([("missing", np.int64), ("doc_id", np.int64), ("text", np.int64)])
_ENTRY = np.dtype([("one", np.uint64), ("two", np.uint32), ("cls", np.uint32), ("doc", np.uint32), ("at", np.uint32)])
_HALVES = ("doc", "at")
_STRETCH = np.dtype([("doc", np.int64), ("at", np.int64), ("n", np.int64)])
_HEAD = np.dtype([("cls", np.uint32), ("missing", np.int64), ("doc_id", np.int64), ("text", np.int64), ("at", np.int64)])
_SPAN = "doc_id long, text_hash long, first_word long, n_words long, kept_doc_id long, kept_word long"


def _rolled(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` successive words."""
    n = len(hashes)
    if n < size:
        return np.empty(0, np.uint64)
    powers, back = np.full(n, MULTIPLIER), np.full(n, INVERSE)
    powers[0] = back[0] = 1
    np.multiply.accumulate(powers, out=powers)
    np.multiply.accumulate(back, out=back)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * powers, out=sums[1:])
    return mix64((sums[size:] - sums[:-size]) * back[:n - size + 1])


def _names(grams: np.ndarray) -> np.ndarray:
    """The smallest of each ``RUN - GRAM + 1`` successive hashes."""
    width, have = RUN - GRAM + 1, 1
    least = grams
    while 2 * have <= width:
        least, have = np.minimum(least[:-have], least[have:]), 2 * have
    return np.minimum(least[:len(least) - (width - have)], least[width - have:]) if width > have else least


def _long(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows with a passage, the hashes of their words, and where the words of each begin and end."""
    hashes, _, counts = word_hashes(*utf8(batch.column("text")))
    ends = np.cumsum(counts)
    rows = np.flatnonzero(counts >= RUN)
    return rows, hashes, (ends - counts)[rows], ends[rows]


def _places(batch: pa.RecordBatch, rows: np.ndarray) -> np.ndarray:
    ids = batch.column("doc_id").cast(pa.int64())
    out = np.empty(len(rows), _PLACE)
    for name, column in (("missing", ids.is_null()), ("doc_id", ids.fill_null(0)), ("text", batch.column("text_hash"))):
        out[name] = column.to_numpy(zero_copy_only=False)[rows]
    return out


def _sent(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, places, keys, size = TaskContext.get().partitionId() << 40, [], [], 0

        def chunk():
            return shared.send(base, np.array([len(k) for k in keys]), np.concatenate(keys), bits, np.concatenate(places).tobytes())

        for batch in pieces(batches):
            size += utf8(batch.column("text"))[1][-1]
            rows, hashes, begins, ends = _long(batch)
            grams = _rolled(hashes, GRAM)
            places.append(_places(batch, rows))
            for a, z in zip(begins.tolist(), ends.tolist()):
                own = grams[a:z - GRAM + 1]
                names = np.unique(_names(own))
                at = np.searchsorted(names, own)
                at[at == len(names)] = 0
                times = np.bincount(at[names[at] == own], minlength=len(names))
                keys.append(np.repeat(mix64(names), np.minimum(times, 2)))  # a name that stands twice in one text is shared, too
            if size >= CHUNK_BYTES and keys:
                yield chunk()
                base, places, keys, size = base + len(keys), [], [], 0
        if keys:
            yield chunk()
    return run


def _named(chunk: pa.Table) -> pa.Table:
    """The shared names of each text of a chunk that has any."""
    note, owner, token, _ = shared.gathered(chunk)
    place = np.frombuffer(note, _PLACE)
    ends = np.cumsum(np.bincount(owner, minlength=len(place)))
    begins = np.concatenate([[0], ends[:-1]])
    some = np.flatnonzero(ends > begins)
    names = [np.unique(token[a:z]).tobytes() for a, z in zip(begins[some].tolist(), ends[some].tolist())]
    return pa.table({"doc_id": pa.array(place["doc_id"][some], mask=place["missing"][some] == 1),
                     "text_hash": place["text"][some], "names": pa.array(names, pa.binary())})


_PACKET = pa.schema([("bucket", pa.int64()), ("base", pa.int64()), ("places", pa.binary()), ("data", pa.binary())])


def _halves(values: np.ndarray) -> bytes:
    """Numbers of 32 bits, low halves and then high ones: those are mostly zero and take no room once compressed."""
    return (values & np.uint32(0xFFFF)).astype(np.uint16).tobytes() + (values >> np.uint32(16)).astype(np.uint16).tobytes()


def _joined(data: memoryview, n: int) -> np.ndarray:
    low, high = np.frombuffer(data, np.uint16, n), np.frombuffer(data, np.uint16, n, 2 * n)
    return low.astype(np.uint32) | high.astype(np.uint32) << np.uint32(16)


def _entries_out(entries: np.ndarray) -> bytes:
    """Entries whose classes follow each other, field by field."""
    head = np.array([len(entries), entries["cls"][0]], np.int64).tobytes()
    return b"".join([head, entries["one"].tobytes(), entries["two"].tobytes(), *[_halves(entries[c]) for c in _HALVES]])


def _entries_in(data: bytes) -> np.ndarray:
    n, first = np.frombuffer(data, np.int64, 2).tolist()
    out = np.empty(n, _ENTRY)
    out["one"], out["two"] = np.frombuffer(data, np.uint64, n, 16), np.frombuffer(data, np.uint32, n, 16 + 8 * n)
    out["cls"] = first + np.arange(n)
    for i, name in enumerate(_HALVES):
        out[name] = _joined(memoryview(data)[16 + 12 * n + 4 * n * i:], n)
    return out


def packed(base: int, places: list[np.ndarray], found: list[tuple], bits: int) -> pa.RecordBatch:
    """The packets of a chunk: its runs (digests, text of the chunk, first word), and each different one, with its first place, to a bucket."""
    place = np.concatenate(places)
    one, two, doc, at = (np.concatenate(c) for c in zip(*found))
    two = two.astype(np.uint32)
    rank = np.unique(place, return_inverse=True)[1]
    order = np.lexsort((at, rank[doc], two, one))
    opens = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + 1)]))
    own = np.empty(len(opens), _STRETCH)
    own["doc"], own["at"], own["n"] = doc[opens], at[opens], np.diff(opens, append=len(at))
    one, two, doc, at = one[order], two[order], doc[order], at[order]
    new = np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])])
    cls = np.empty(len(at), np.uint32)
    cls[order] = np.cumsum(new) - 1
    entries = np.empty(int(new.sum()), _ENTRY)
    for name, values in (("one", one), ("two", two), ("doc", doc), ("at", at)):
        entries[name] = values[new]
    entries["cls"] = np.arange(len(entries))
    # the classes of a chunk are in the order of their digests, so buckets are stretches of them
    bucket = (entries["one"] >> np.uint64(64 - bits)).astype(np.int64)
    cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])).tolist()
    rows = [(-1 - base % 8191, base, place.tobytes(), np.int64(len(own)).tobytes() + own.tobytes() + _halves(cls))]
    for a, z in zip(cut, [*cut[1:], len(bucket)]):
        here, docs = entries[a:z].copy(), np.unique(entries["doc"][a:z])
        here["doc"] = np.searchsorted(docs, here["doc"])
        rows.append((int(bucket[a]), base, place[docs].tobytes(), _entries_out(here)))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PACKET.types)], schema=_PACKET)


def digests(hashes: np.ndarray) -> list[np.ndarray]:
    """Two digests of every run."""
    return [_rolled(mix64(hashes ^ np.uint64(salt)), RUN) for salt in (0x51ED2701, 0x2545F491)]


def _compared(name_bits: int, bits: int):
    """For every chunk of texts: their passages of shared names, as packets."""
    drop = np.uint64(max(0, 16 - name_bits))  # names have come back cut

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, places, found, size = TaskContext.get().partitionId() << 40, [], [], 0
        for batch in pieces(batches):
            size += utf8(batch.column("text"))[1][-1]
            rows, hashes, begins, ends = _long(batch)
            grams = _rolled(hashes, GRAM)
            one, two = digests(hashes)
            at_doc = sum(len(p) for p in places)
            places.append(_places(batch, rows))
            known = batch.column("names").to_pylist()
            for k, (r, a, z) in enumerate(zip(rows.tolist(), begins.tolist(), ends.tolist())):
                own = mix64(_names(grams[a:z - GRAM + 1])) >> drop << drop
                names = np.frombuffer(known[r], np.uint64)
                at = np.searchsorted(names, own)
                at[at == len(names)] = 0
                at = np.flatnonzero(names[at] == own)
                if len(at):
                    found.append((one[a + at], two[a + at], np.full(len(at), at_doc + k), at))
            if size >= CHUNK_BYTES and found:
                yield packed(base, places, found, bits)
                base, places, found, size = base + 1, [], [], 0
        if found:
            yield packed(base, places, found, bits)
    return run


_ANSWER = pa.schema([("base", pa.int64()), ("places", pa.binary()), ("data", pa.binary())])


def _first(packets: pa.Table) -> pa.Table:
    """To each chunk: the first place of every passage that stands somewhere before it."""
    if packets["bucket"][0].as_py() < 0:
        return packets.select(_ANSWER.names).cast(_ANSWER)
    bases = packets["base"].to_numpy()
    entries = [_entries_in(d) for d in packets["data"].to_pylist()]
    base = np.repeat(bases, [len(e) for e in entries])
    place = np.concatenate([np.frombuffer(p, _PLACE)[e["doc"]] for p, e in zip(packets["places"].to_pylist(), entries)])
    entry = np.concatenate(entries)
    order = np.lexsort((entry["at"], place["text"], place["doc_id"], place["missing"], entry["two"], entry["one"]))
    base, place, entry = base[order], place[order], entry[order]
    new = np.concatenate([[True], (entry["one"][1:] != entry["one"][:-1]) | (entry["two"][1:] != entry["two"][:-1])])
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = np.flatnonzero((place != place[head]) | (entry["at"] != entry["at"][head]))
    out = np.empty(len(later), _HEAD)
    out["cls"], out["at"] = entry["cls"][later], entry["at"][head[later]]
    for name in _PLACE.names:
        out[name] = place[name][head[later]]
    by = np.argsort(base[later], kind="stable")
    to, cut = np.unique(base[later][by], return_index=True)
    data = [out[by][a:z].tobytes() for a, z in zip(cut.tolist(), [*cut[1:].tolist(), len(by)])]
    return pa.table([pa.array(to, pa.int64()), pa.nulls(len(to), pa.binary()), pa.array(data, pa.binary())], schema=_ANSWER)


def _spans(chunk: pa.Table) -> pa.Table:
    """The stretches of words that go from each text of a chunk."""
    parts = list(zip(chunk["places"].to_pylist(), chunk["data"].to_pylist()))
    place, note = next((np.frombuffer(p, _PLACE), d) for p, d in parts if p is not None)
    heads = np.concatenate([np.empty(0, _HEAD), *[np.frombuffer(d, _HEAD) for p, d in parts if p is None]])
    n = int(np.frombuffer(note, np.int64, 1)[0])
    own = np.frombuffer(note, _STRETCH, n, 8)
    cls = _joined(memoryview(note)[8 + n * _STRETCH.itemsize:], int(own["n"].sum()))
    doc, at = np.repeat(own["doc"], own["n"]), ragged(own["at"], own["n"])
    order = np.lexsort((at, np.unique(place, return_inverse=True)[1][doc], cls))
    new = order[np.flatnonzero(np.diff(cls[order].astype(np.int64), prepend=-1))]  # where each class comes first in the chunk
    first = np.empty(len(new), _HEAD)
    first["at"] = at[new]
    for name in _PLACE.names:
        first[name] = place[name][doc[new]]
    for name in ("at", *_PLACE.names):
        first[name][heads["cls"]] = heads[name]
    first, mine = first[cls], place[doc]
    same = (mine["missing"] == first["missing"]) & (mine["doc_id"] == first["doc_id"]) & (mine["text"] == first["text"])
    goes = np.flatnonzero(~same | (at >= first["at"] + RUN))  # by text and position
    doc, at, first = doc[goes], at[goes], first[goes]
    opens = np.ones(len(goes), bool)
    opens[1:] = (doc[1:] != doc[:-1]) | (at[1:] > at[:-1] + RUN)
    closes = np.ones(len(goes), bool)
    closes[:-1] = opens[1:]
    of, head = place[doc[opens]], first[opens]
    return pa.table({
        "doc_id": pa.array(of["doc_id"], mask=of["missing"] == 1), "text_hash": of["text"], "first_word": at[opens],
        "n_words": at[closes] + RUN - at[opens], "kept_doc_id": pa.array(head["doc_id"], mask=head["missing"] == 1),
        "kept_word": head["at"]})


def _found(docs: DataFrame) -> DataFrame:
    scratch = Scratch(docs.sparkSession)
    rows = only(docs, doc_id="doc_id", text="text").withColumn("text_hash", F.xxhash64("text"))
    letters = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    name_bits = shared.bucket_bits(letters // 80)
    packets = short_batches(rows).mapInArrow(_sent(name_bits), shared.PACKET)
    named = scratch.keep(shared.answers(packets, name_bits).groupBy("base").applyInArrow(
        _named, "doc_id long, text_hash long, names binary"), "names")
    bits = shared.bucket_bits(shared.BUCKET_KEYS // PASSAGES * 2 * (named.agg(F.sum(F.octet_length("names"))).first()[0] or 0))
    wanted = named.groupBy("doc_id", "text_hash").agg(F.max("names").alias("names")).select(
        F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "names")
    texts = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))).drop("d", "h")
    return spans(short_batches(texts).mapInArrow(_compared(name_bits, bits), PACKETS), scratch)


PACKETS = "bucket long, base long, places binary, data binary"


def spans(packets: DataFrame, scratch: Scratch) -> DataFrame:
    """The stretches that go, from the packets of all chunks."""
    answers = packets.groupBy("bucket").applyInArrow(_first, "base long, places binary, data binary")
    return scratch.keep(answers.groupBy("base").applyInArrow(_spans, _SPAN), "spans")


def repeated(docs: DataFrame) -> DataFrame:
    """Every stretch of words of ``docs(doc_id, text)`` that repeats passages which stand before: its first word (from 0), its length,
    and where the first of its passages is kept."""
    return _found(docs).drop("text_hash")


def cut(text: str, spans: list[tuple[int, int]]) -> str | None:
    """``text`` without the words of the spans (first word, number, in order); lines stay apart. None if no word is left."""
    data = text.encode()
    words = [m.span() for m in _WORD.finditer(data)]
    out, at, left = [], 0, len(words)
    for first, n in spans:
        last, left = first + n, left - n
        begin, end = words[first][0], words[last - 1][1]
        after = words[last][0] if last < len(words) else len(data)
        if first and (last == len(words) or b"\n" in data[end:after]):
            begin = words[first - 1][1]  # the separator behind stays
        else:
            end = after
        out.append(data[at:begin])
        at = end
    return b"".join([*out, data[at:]]).decode() if left else None


def remove(docs: DataFrame) -> DataFrame:
    """``docs`` with each text rid of the passages that stand before; texts left without any word go."""
    d, h, lost = fresh(docs, "_d", "_h", "_gone")
    gone = (_found(docs).select("doc_id", "text_hash", "first_word", "n_words").distinct().groupBy("doc_id", "text_hash")
            .agg(F.sort_array(F.collect_list(F.struct("first_word", "n_words"))).alias(lost))
            .select(F.col("doc_id").alias(d), F.col("text_hash").alias(h), lost))
    edited = docs.join(gone, F.col("doc_id").eqNullSafe(F.col(d)) & (F.xxhash64("text") == F.col(h)), "left")
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(batch.num_columns - 1)
            texts = batch.column(place).to_pylist()
            stays = np.ones(batch.num_rows, bool)
            for i in np.flatnonzero(spans.is_valid().to_numpy(zero_copy_only=False)).tolist():
                texts[i] = cut(texts[i], [(s["first_word"], s["n_words"]) for s in spans[i].as_py()])
                stays[i] = texts[i] is not None
            columns = batch.columns[:-1]
            columns[place] = pa.array(texts, batch.column(place).type)
            yield pa.RecordBatch.from_arrays(columns, docs_names).filter(pa.array(stays))

    docs_names = docs.columns
    return short_batches(edited.drop(d, h)).mapInArrow(run, docs.schema)
