"""Learned operators by held-out accuracy, counts, digests and searches against brute force."""

import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.llm import digest, language, mixture, quality, tokencount, topk
from foldwise.llm.queries import QUERIES, vocabulary
from tests.oracle import ROOT

SF = f"{ROOT}/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_quality_on_held_out_labels(spark, documents):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = QUERIES["op1_quality_classifier"](spark, SF).collect()
    assert len(rows) == documents.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    auc = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.9 and sum((s >= 0.5) == bool(y) for s, y in held) / len(held) > 0.95


def test_quality_of_odd_rows(frame, odd_rows, spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    model = quality.fit(documents, labels)
    docs = frame(odd_rows).withColumn("score", F.lit("clash"))
    rows = quality.score(docs, model).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r["quality_score"] <= 1 for r in rows)
    by_text = {}
    for r in rows:
        by_text.setdefault(r["text"] or "", set()).add(r["quality_score"])
    assert all(len(v) == 1 for v in by_text.values())
    assert quality.score(frame([]), model).count() == 0


def test_quality_against_a_loop(spark, documents):
    """Scores and curve again, a text at a time, from the two dictionaries."""
    import zstandard
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    model = quality.fit(documents, labels)
    packers = []
    for content in (model.good, model.bad):
        known = zstandard.ZstdCompressionDict(content)
        packers.append(zstandard.ZstdCompressor(level=3, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False))

    def difference(text):
        data, saved = (text or "").encode(), 0
        for a in range(0, len(data), 512):
            good, bad = (len(p.compress(data[a:a + 512])) - len(p.compress(b"")) for p in packers)
            saved += bad - good
        return saved / (len(data) + 32)

    def chance(text):
        return 1 / (1 + math.exp(-(model.weights[0] + model.weights[1] * (difference(text) - model.mean[0]) / model.scale[0])))

    for r in quality.score(documents.where("doc_id % 7 = 0"), model).collect():
        assert abs(chance(r["text"]) - r["quality_score"]) < 1e-9
    rows = documents.join(labels, "doc_id").where(F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == 1).collect()
    xs = [difference(r["text"]) for r in rows]
    assert len(model.weights) == 2 and abs(model.mean[0] - sum(xs) / len(xs)) < 1e-9
    gaps = [r["label"] - chance(r["text"]) for r in rows]  # of the best curve: gradients are nought
    assert abs(sum(gaps)) < 1e-4
    assert abs(sum(g * (x - model.mean[0]) / model.scale[0] for g, x in zip(gaps, xs)) - 0.05 * model.weights[1]) < 1e-4


def test_dictionaries_learn_from_all_places_of_a_text(frame, spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "_dictionary", lambda parts: seen.append(parts) or b"")
    texts = [(i, "".join(f"{i:04d}:{k:06d} " for k in range(5000))) for i in range(40)]  # 60 KB each
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, label int")
    quality.fit(frame(texts), labels)
    assert any(b":004999 " in p for p in seen[0]) and any(b":004999 " in p for p in seen[1])
    whole = sum(len(p) for parts in seen for p in parts)
    seen.clear()
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 200_000)
    quality.fit(frame(texts).repartition(3), labels)
    for parts in seen:
        places = [int(p[5:11]) if p[4:5] == b":" else int(p.split(b":")[1][:6]) for p in parts]
        assert 100_000 < sum(map(len, parts)) < 300_000 and min(places) < 1500 and max(places) > 3500
    assert whole % 60_000 == 0 and whole > 600_000


@pytest.mark.parametrize("rows,constant", [([], 0.5), ([(5, 1), (6, 1)], 1.0), ([(5, None), (77, 0)], 0.5)])
def test_quality_without_both_labels(frame, odd_rows, spark, rows, constant):
    model = quality.fit(frame(odd_rows), spark.createDataFrame(rows, "doc_id long, label int"))
    assert {r["quality_score"] for r in quality.score(frame(odd_rows), model).collect()} == {constant}


def test_language_on_held_out_documents(spark, documents):
    lang = {r["doc_id"]: r["lang"] for r in documents.collect()}
    rows = QUERIES["op2_language_id"](spark, SF).collect()
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]
    assert len(rows) == len(lang) and sum(held) / len(held) > 0.97 and all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_rows(frame, odd_rows, documents):
    model = language.fit(documents)
    rows = language.predict(frame(odd_rows).withColumn("lang", F.lit("clash")), model).collect()
    for r in rows:
        letter = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letter) and (letter or r["score"] == 0)
    assert len(rows) == len(odd_rows) and language.predict(frame([]), model).count() == 0


def test_language_with_nothing_to_learn(frame, odd_rows):
    model = language.fit(frame([(1, "abc", None), (2, None, "en")], "doc_id long, text string, lang string"))
    assert {r["lang_pred"] for r in language.predict(frame(odd_rows), model).collect()} == {"und"}


def test_language_counts_equal_a_loop():
    import pyarrow as pa
    texts = ["Abc de", "", "é1", None, "x"]
    got = language.counts(pa.array(texts))
    for row, text in zip(got, texts):
        kinds = language.BYTE_CLASS[np.frombuffer((text or "").encode(), np.uint8)].tolist()
        want = sum((a, b) != (32, 32) for a, b in zip(kinds, kinds[1:]))
        want += sum((a, b) != (32, 32) and (b, c) != (32, 32) for a, b, c in zip(kinds, kinds[1:], kinds[2:]))
        assert row.sum() == want


def test_entropy_levels_equal_a_loop():
    rng = random.Random(2)
    for n in (0, 10, digest.WINDOW, 70, 3000):
        data = bytes(rng.choice(b"aab c\xc3") for _ in range(n))
        want = []
        for i in range(n - digest.WINDOW + 1):
            window = data[i:i + digest.WINDOW]
            total = sum(round(c * math.log2(c) * (1 << digest.FRACTION)) for c in (window.count(b) for b in set(window)))
            want.append((digest._MOST - total) * (digest.LEVELS - 1) // digest._MOST)
        assert digest.levels(np.frombuffer(data, np.uint8)).tolist() == want


def test_features_equal_a_loop(some_texts):
    """Each text alone and in a batch has the features that a direct reading of the rule gives."""
    import pyarrow as pa

    from foldwise.llm.common import utf8
    texts = [t for _, t in some_texts[:12]] + ["", "short", "a" * 40, "b" * 300]
    rank = np.random.default_rng(1).permutation(digest.LEVELS)
    data, offsets = utf8(pa.array(texts))
    hashed, counts = digest.features(data, offsets, rank)
    ends = np.cumsum(counts)
    w, s = digest.WINDOW, digest.STRETCH
    for i, text in enumerate(texts):
        own = np.frombuffer(text.encode(), np.uint8)
        n = len(own) - w + 1
        if n <= 0:
            spans = [(0, len(own))] if len(own) else []
        else:
            order = rank[digest.levels(own)]
            runs = max(n - s + 1, 1)
            wins = [0] * n
            for r in range(runs):
                part = order[r:r + s]
                wins[r + int(part.argmin())] += 1
            chosen = [p for p in range(n) if wins[p] >= min(digest.WINS, runs)] or [int(np.argmax(wins))]
            spans = [(p, p + w) for p in chosen]
        want = list(dict.fromkeys(digest._hashes(own, np.array([a]), np.array([b]))[0] for a, b in spans))
        assert hashed[ends[i] - counts[i]:ends[i]].tolist() == want


def test_digests_of_odd_rows(frame, odd_rows, some_texts):
    rows = [(i, t) for i, t in odd_rows if i not in (8,)] + [(100 + i, t) for i, t in some_texts]
    docs = frame(rows).withColumn("bucket", F.lit("clash")).withColumn("closing", F.lit(True))
    found = digest.compare(docs.repartition(6)).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    order[-2:] = sorted(order[-2:], key=lambda r: r[1] or "")  # the two null ids, by text
    by_id = {}
    for k, (i, t) in enumerate(order):
        text, following = t or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 3
        by_id[i, text] = (len(text), hashlib.sha256((text[:len(text) - cut] + following[:cut]).encode()).hexdigest())
    got = {(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found}
    assert len(found) == len(rows) and got == {(i, *v) for (i, _), v in by_id.items()}
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in found)
    prints = {}
    for r in found:
        prints.setdefault(r["doc_id"], r["fingerprint"])
    assert prints[5] == prints[6] != prints[7] and prints[1] == prints[2] == ""


def test_digest_of_one_or_no_document(frame):
    row, = digest.compare(frame([(1, "only one text of some length")])).collect()
    assert row["near_next"] == 1.0 and digest.compare(frame([])).count() == 0


def test_likeness_of_changed_texts(spark):
    rows = QUERIES["op5_document_fingerprints"](spark, f"{ROOT}/sf0.001").collect()
    long = [r for r in rows if r["n_chars"] > 400]
    assert np.median([r["near_edited"] for r in long]) > 0.4 and np.mean([r["near_next"] for r in long]) < 0.05


@pytest.mark.parametrize("high", [300, 1 << 29])
def test_top_k_equals_all_products(spark, high, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 4)
    monkeypatch.setattr(topk, "RANGE", 32)
    monkeypatch.setattr(topk, "QUERIES", 8)
    rng = random.Random(high)
    rows = [(i, [rng.randint(-high, high) for _ in range(rng.choice([5, 5, 6]))]) for i in range(150)]
    rows += [(150 + i, rows[i][1]) for i in range(20)] + [(200, None), (201, []), (None, [1, 2])]
    vectors = spark.createDataFrame(rows, "id long, v array<long>").withColumn("part", F.lit("clash"))
    queries = vectors.where("id % 10 = 0")
    known = {i: v for i, v in rows if i is not None and v is not None}
    want = []
    for q in known:
        if q % 10 == 0:
            scored = sorted((-sum(a * b for a, b in zip(known[q], v)), i) for i, v in known.items() if i != q)
            want += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:5], 1)]
    assert sorted(map(tuple, topk.top_k(queries, vectors, 5).collect())) == sorted(want)
    assert len(topk.top_k(queries.where("id = 0"), vectors.where("id < 4"), 5).collect()) == 3
    assert topk.top_k(queries.where("id < 0"), vectors, 5).count() == 0
    assert topk.top_k(queries, vectors.where("id < 0"), 5).count() == 0


def test_integers_skip_unusable_vectors(spark):
    rows = [([0.5, -0.501],), (None,), ([1.0, None],), ([float("nan")],), ([float("inf")],), ([],), ([3e38],)]
    got = [r[0] for r in spark.createDataFrame(rows, "x array<float>").select(topk.integers("x", 256.0)).collect()]
    assert got == [[128, -129], None, None, None, None, [], [1 << 62]]


def best_split(word, scores, byte):
    """Best score and fewest tokens by trying every way."""
    best = {0: (0.0, 0)}
    for end in range(1, len(word) + 1):
        ways = [(best[end - 1][0] + len(word[end - 1].encode()) * byte, -best[end - 1][1] - len(word[end - 1].encode()))]
        ways += [(best[start][0] + scores[word[start:end]], -best[start][1] - 1) for start in range(end) if word[start:end] in scores]
        score, tokens = max(ways)
        best[end] = (score, -tokens)
    return best[len(word)][1]


def test_token_counts_equal_every_way(frame, odd_rows, some_texts, monkeypatch):
    path = vocabulary("piece_bpe_32k.model")
    rows = [(i, t) for i, t in odd_rows if i not in (13, 14, 16)] + [(100 + i, t) for i, t in some_texts]
    scores = tokencount.sentencepiece_scores(path)
    byte = min(scores.values()) - tokencount.BYTE_PENALTY
    docs = frame(rows).withColumn("n_tokens", F.lit("clash"))
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_tokens"]) for r in tokencount.counts(docs, path).collect())
    want = []
    for i, t in rows:
        found = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        want.append((str(i), len(found), sum(best_split(tokencount.MARK + w, scores, byte) for w in found)))
    assert got == sorted(want)
    assert tokencount.counts(frame([]), path).count() == 0


def test_mixture_reaches_targets(frame, odd_rows, some_texts, monkeypatch):
    monkeypatch.setattr(mixture, "BLOCK", 16)
    rows = [(i, t, ["a", "b", "Z", None, "é"][min(n % 9, 4)]) for n, (i, t) in enumerate(odd_rows + [(100 + i, t) for i, t in some_texts])]
    docs = frame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash")).withColumn("target", F.lit(0))
    found = mixture.mix(docs.repartition(3)).collect()
    again = mixture.mix(docs.repartition(7)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again)) and len(found) == len(rows)
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, full = {}, set()
    while True:  # share by weight, stop at the cap, share the excess again
        rest = 1.5 * sum(size.values()) - sum(2 * size[s] for s in full)
        open_ = sum(weight[s] for s in names if s not in full)
        target = {s: 2.0 * size[s] if s in full else rest * weight[s] / open_ for s in names}
        over = {s for s in names if target[s] > 2 * size[s]}
        if not over:
            break
        full |= over
    taken = {}
    for r in found:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source_size"], round(r["target"], 6)] = taken.get((r["source_size"], round(r["target"], 6)), 0) + r["taken"]
    assert taken == {(size[s], round(target[s], 6)): math.floor(target[s]) for s in names}
    assert mixture.mix(frame([], "doc_id long, text string, source string")).count() == 0


def test_mixture_applied_has_the_words_taken(frame, some_texts):
    rows = [(i, t, "ab"[i % 3 == 0]) for i, t in some_texts] + [(900, "", "a"), (901, None, "b")]
    docs = frame(rows, "doc_id long, text string, source string")
    taken = {r["doc_id"]: r["taken"] for r in mixture.mix(docs).collect()}
    out, got = mixture.apply(docs), {}
    assert out.columns == docs.columns
    texts = {i: t for i, t, _ in rows}
    for r in out.collect():
        assert r["text"] == texts[r["doc_id"]] or texts[r["doc_id"]].startswith(r["text"])
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len((r["text"] or "").split())
    assert {i: got.get(i, 0) for i in taken} == taken and {900, 901} <= set(got)


def test_copies_share_what_is_taken(frame):
    rows = [(1, " ".join("abcdefg"), "x", "one")] * 5 + [(None, " ".join("hijkl"), "x", "two")] * 3 + [(2, "m n o", "y", "three"), (3, None, "y", "four")]
    docs = frame(rows, "doc_id long, text string, source string, _total string")
    taken = {}
    for r in mixture.mix(docs).collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["taken"]
    got = {}
    for r in mixture.apply(docs).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len((r["text"] or "").split())
        assert r["_total"] == {1: "one", None: "two", 2: "three", 3: "four"}[r["doc_id"]]
    assert got == taken and taken[1] % 5 + taken[None] % 3  # something is left over


def test_schedule_mixes_evenly(spark, frame):
    rows = [(i, "w " * 5000, "a" if i < 6 else "b") for i in range(9)]
    from foldwise.llm.common import Scratch
    scratch = Scratch(spark)
    docs = frame(rows, "doc_id long, text string, source string")
    sizes = docs.groupBy("source").agg(F.sum(mixture.word_count("text")).alias("source_size"))
    needs = scratch.keep(mixture._needs(mixture._targets(sizes, (5, 2, 1), 1.5, 2.0, scratch)), "needs")
    slots = [r["idx"] for r in mixture.schedule(needs, scratch).orderBy("k").collect()]
    share = slots.count(0) / len(slots)
    for n in range(1, len(slots)):
        assert abs(slots[:n].count(0) - n * share) < 3


def test_top_k_with_repeated_ids(spark):
    rows = [(1, [1]), (1, [9]), (2, [5]), (50, [1]), (50, [3])]
    df = spark.createDataFrame(rows, "id long, v array<long>")
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(df.where("id % 50 = 0"), df, 2).collect()]
    assert sorted(got) == [(50, 1, 1, 9), (50, 1, 1, 27), (50, 2, 2, 5), (50, 2, 2, 15)]


def test_the_schedule_decides_the_slots(frame, some_texts, monkeypatch):
    """First slots and their number follow the golden-ratio points, and change with them."""
    monkeypatch.setattr(mixture, "BLOCK", 16)
    docs = frame([(i, t, "abc"[i % 3]) for i, t in some_texts], "doc_id long, text string, source string")
    found = {r["doc_id"]: (r["taken"], r["first_slot"], r["n_slots"]) for r in mixture.mix(docs).collect()}
    assert all((slot is None) == (taken == 0) == (n == 0) for taken, slot, n in found.values())
    firsts = [(slot, "abc"[i % 3]) for i, (_, slot, _) in found.items() if slot is not None]
    third = sorted(firsts)[:len(firsts) // 3]
    assert {s for _, s in third} == set("abc")  # sources take turns from the start
    monkeypatch.setattr(mixture, "GOLDEN", 2 ** 0.5 - 1)
    other = {r["doc_id"]: (r["taken"], r["first_slot"], r["n_slots"]) for r in mixture.mix(docs).collect()}
    assert {i: v[0] for i, v in other.items()} == {i: v[0] for i, v in found.items()} and other != found


def test_sql_of_this_package(spark):
    from foldwise.llm.queries import SQL
    from tests.oracle import compare, connect
    con = connect(f"{ROOT}/sf0.001")
    assert isinstance(con, duckdb.DuckDBPyConnection)
    for name, sql in SQL.items():
        assert compare(spark, con, f"{ROOT}/sf0.001", name, QUERIES[name], sql) is None
