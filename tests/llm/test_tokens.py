"""Token ids, shards and packing against the tokenizers library itself."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.llm import packing, phash, tokenfiles
from foldwise.llm.common import Scratch
from foldwise.llm.queries import vocabulary
from foldwise.llm.tokens import WordEncoder

KINDS = [("word_bpe_49k.json", "dropped"), ("byte_bpe_50k.json", "joined")]


def plain(name, texts):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(vocabulary(name))
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("name,spaces", KINDS)
def test_words_give_the_ids_of_whole_texts(name, spaces, odd_rows, some_texts, spark):
    texts = [t or "" for _, t in odd_rows + some_texts]
    texts += ["a\n b", "a \n b", "a\n \nb", "a \nb", " ", "  ", "\n", " a", "a ", "a\t b　 c", "x  y", "x  y", "\x1c a \x1cb", "\x85 a"]
    texts += [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    encoder = WordEncoder(vocabulary(name), spaces, limit=50)
    for part in (texts[:40], texts[40:], texts[:10]):
        ids, counts = encoder.encode(part)
        ends = np.cumsum(counts)
        assert [ids[z - n:z].tolist() for z, n in zip(ends, counts)] == plain(name, part)


@pytest.mark.parametrize("name,spaces", KINDS)
def test_words_around_line_feeds_are_learned_once(name, spaces):
    texts = ["ab cd.\nÄb cd.\nab", "cd.\nab Öß!? cd.\nÄb", "Öß!?\n\nab", "ab\ncd \nab"]
    encoder = WordEncoder(vocabulary(name), spaces)
    ids, counts = encoder.encode(texts[:2])
    learned = {*encoder.first, *encoder.later} - {*encoder.frequent.get("words", [])}
    assert not [w for w in learned if "\n" in w and w != "\n"]
    more, n = encoder.encode(texts[2:])
    ends = np.cumsum([*counts, *n])
    ids = np.concatenate([ids, more])
    assert [ids[z - k:z].tolist() for z, k in zip(ends, [*counts, *n])] == plain(name, texts)


def test_perfect_hash_has_a_slot_for_each_key():
    keys = np.unique(np.random.default_rng(3).integers(0, 2**63, 5000, dtype=np.int64)).view(np.uint64)
    for n in (0, 1, 2, 63, 5000):
        part = keys[:n]
        slots = phash.Slots(phash.build(part)).find(part)
        assert sorted(slots.tolist()) == list(range(n))
    with pytest.raises(ValueError):
        phash.build(np.array([7, 7], np.uint64))


def test_token_files_round_trip(frame, odd_rows, some_texts, spark, monkeypatch):
    monkeypatch.setattr(tokenfiles, "SHARD_BYTES", 2000)
    rows = odd_rows + [(100 + i, t) for i, t in some_texts]
    folder = Scratch(spark).root
    docs = frame(rows).withColumn("shard", F.lit("clash")).withColumn("payload", F.lit(1))
    tokenfiles.write(docs, folder, vocabulary("word_bpe_49k.json"), "dropped", end_id=1, width=2)
    ids = plain("word_bpe_49k.json", [t for _, t in rows])
    want = {}
    for (i, _), e in zip(rows, ids):
        want.setdefault(i, []).append([*e, 1])
    keys = spark.createDataFrame([(i, c) for i, v in want.items() for c in range(len(v))] + [(999_999, 0)], "doc_id long, copy long")
    got = {}
    for r in tokenfiles.fetch(spark, folder, keys).collect():
        got.setdefault(r["doc_id"], []).append(list(r["ids"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    sums = tokenfiles.checksums(spark, folder, keys).orderBy("start").collect()
    assert [r["doc_id"] for r in sums][:2] == [None, None]
    assert [r["start"] for r in sums] == np.cumsum([0, *[r["n_tokens"] for r in sums]])[:-1].tolist()
    for r in sums:
        assert r["ids_crc32"] in {zlib.crc32(np.array(e, "<u4").tobytes()) for e in want[r["doc_id"]]}


def test_token_files_of_nothing(frame, spark):
    folder = Scratch(spark).root
    tokenfiles.write(frame([]), folder, vocabulary("word_bpe_49k.json"), "dropped", end_id=1, width=2)
    keys = spark.createDataFrame([(1, 0)], "doc_id long, copy long")
    assert tokenfiles.checksums(spark, folder, keys).count() == 0


def packed(docs, rows):
    """Checks that pieces cut every document's ids without gap, and windows too."""
    pieces = packing.pack(docs, vocabulary("byte_bpe_50k.json"), "joined", end_id=0).collect()
    total = sum(len(e) + 1 for e in plain("byte_bpe_50k.json", [r[1] for r in rows]))
    assert sum(p["length"] for p in pieces) == total and all(p["length"] > 0 for p in pieces)
    windows = {}
    for p in pieces:
        windows.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    sizes = []
    for spans in windows.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        sizes.append(at)
    assert all(s <= 1024 and (s == 1024 or s & (s - 1) == 0) for s in sizes)
    assert sorted(windows) == list(range(len(windows)))
    return pieces


def test_packing_places_every_token_once(frame, odd_rows, some_texts, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_TOKENS", 3000)
    rows = [(i, t, [None, "a", "b"][n % 3] if n % 7 else "a") for n, (i, t) in enumerate(odd_rows + [(100 + i, t) for i, t in some_texts])]
    docs = frame(rows, "doc_id long, text string, source string").withColumn("uid", F.lit("clash")).withColumn("ids", F.lit(0))
    pieces = packed(docs, rows)
    ids = {i: [*e, 0] for (i, *_), e in zip(rows, plain("byte_bpe_50k.json", [r[1] for r in rows])) if i is not None and i != 8}
    spans = {}
    for p in pieces:
        if p["doc_id"] in ids:
            part = ids[p["doc_id"]][p["start"]:p["start"] + p["length"]]
            assert zlib.crc32(np.array(part, "<u4").tobytes()) == p["ids_crc32"] and p["doc_tokens"] == len(ids[p["doc_id"]])
            spans.setdefault(p["doc_id"], []).append((p["start"], p["length"]))
    for i, e in ids.items():
        at = 0
        for start, length in sorted(spans.get(i, [])):
            assert start == at
            at += length
        assert at == len(e)


def test_packing_of_nothing(frame):
    assert packed(frame([], "doc_id long, text string, source string"), []) == []


def test_windows_hold_the_sources_in_proportion():
    for tokens, credit, begun in (([40_000, 20_000, 1000], [0, 0, 0], 0), ([5_000] * 20, [0.5] * 20, 700), ([60_000, *[300] * 40], [1.0] * 41, 3), ([7], [0], 1020)):
        tokens = np.array(tokens)
        queues, runs = packing._serve(tokens, np.array(credit), 1024, begun)
        assert [int(runs[queues == q].sum()) for q in range(len(tokens))] == tokens.tolist()
        share, at, done, own = tokens / tokens.sum(), begun, np.zeros(len(tokens)), np.zeros(len(tokens))
        for q, n in zip(queues.tolist(), runs.tolist()):
            assert at // 1024 == (at + n - 1) // 1024  # a run lies in one window
            own[q] += n
            at += n
            if at % 1024 == 0 or at - begun == tokens.sum():
                done += own
                # never further from the target than a run and what was carried
                assert np.abs(done - (at - begun) * share).max() <= packing.RUN + 2 + len(tokens) * 0.5
                if (at - begun) >= 2048 and at % 1024 == 0:
                    assert np.abs(own - 1024 * share).max() <= 2 * packing.RUN + 4 + len(tokens) * 0.5
                own[:] = 0
