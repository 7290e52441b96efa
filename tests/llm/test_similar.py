"""Linked documents and paragraphs against all pairs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from foldwise.llm import components, jaccard, passages, runs, shared, units
from foldwise.llm.common import Scratch


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingled(w):
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def linked(sets, percent=80):
    """The root of each set, by position, from all pairs."""
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(sets))]


def expected(rows):
    sets = [shingled(words(t)) for _, t in rows]
    roots = linked(sets)
    out = []
    for (i, _), s, r in zip(rows, sets, roots):
        ids = [rows[k][0] for k, q in enumerate(roots) if q == r and rows[k][0] is not None]
        out.append((i, len(s), (min(ids) if ids else None) if s else i))
    return sorted(out, key=str)


def got(docs):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.join(docs).collect()), key=str)


def test_join_equals_all_pairs(frame, odd_rows, some_texts):
    rows = odd_rows + [(100 + i, t) for i, t in some_texts]
    docs = frame(rows).withColumn("uid", F.lit("clash")).withColumn("n", F.lit(1)).withColumn("text_hash", F.lit(2))
    assert got(docs.repartition(5)) == expected(rows)


def test_join_with_frequent_keys_and_cut_clusters(frame, some_texts, monkeypatch):
    """Low limits make keys frequent and cut clusters into blocks, without any change of the result."""
    monkeypatch.setattr(shared, "FREQUENT", 3)
    monkeypatch.setattr(units, "UNIT_ITEMS", 4)
    monkeypatch.setattr(components, "PART_EDGES", 20)
    monkeypatch.setattr(jaccard, "CHUNK_ROWS", 16)
    assert got(frame(some_texts).repartition(3)) == expected(some_texts)


def test_links_are_counted(frame, some_texts, monkeypatch):
    rows = some_texts + [(1000 + i, t) for i, t in some_texts[:20]] + [(2000, None), (2001, "")]
    sets = [shingled(words(t)) for _, t in rows]
    want = {i: sum(1 for k, b in enumerate(sets) if k != n and a and 100 * len(a & b) >= 80 * len(a | b)) for n, ((i, _), a) in enumerate(zip(rows, sets))}
    assert max(want.values()) > 3
    for limit in (2048, 4):
        monkeypatch.setattr(units, "UNIT_ITEMS", limit)
        assert {r["doc_id"]: r["n_links"] for r in jaccard.join(frame(rows).repartition(3)).collect()} == want


NAMES = ["_d", "_h", "_hash", "_linked", "_copy", "_gone", "_kept", "_size", "_taken", "_letter", "_score", "text_hash", "uid", "label"]


def test_columns_are_handed_on_whatever_their_names(frame, some_texts):
    from foldwise.llm import mixture, quality
    rows = [(i, t, "ab"[i % 2]) for i, t in some_texts[:40]]
    docs = frame(rows, "doc_id long, text string, source string")
    for n, name in enumerate(NAMES):
        docs = docs.withColumn(name, F.col("doc_id") * 100 + n)
    model = quality.Model(b"", b"", None, None, None, 0.5)
    for made in (jaccard.first_of_each(docs), passages.remove(docs), runs.remove(docs), mixture.apply(docs), quality.score(docs, model, "_q").drop("_q")):
        found = made.collect()
        assert made.columns == docs.columns and len(found) > 5
        for r in found:
            assert [r[name] for name in NAMES] == [r["doc_id"] * 100 + n for n in range(len(NAMES))]
    again = quality.score(docs, model, "_h")
    assert {r["_h"] for r in again.collect()} == {0.5} and sorted(again.columns) == sorted(docs.columns)


def test_join_of_nothing(frame):
    assert got(frame([])) == [] and jaccard.first_of_each(frame([])).count() == 0


def test_one_of_each_component_stays(frame, odd_rows, some_texts):
    rows = odd_rows + [(100 + i, t) for i, t in some_texts]
    docs = frame(rows).withColumn("lang", F.lit("x"))
    kept = jaccard.first_of_each(docs)
    assert kept.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in kept.collect()]
    roots = linked([shingled(words(t)) for _, t in rows])
    with_words = [k for k, (_, t) in enumerate(rows) if words(t)]
    assert len([1 for _, t in kept if words(t)]) == len({roots[k] for k in with_words})
    assert len([1 for _, t in kept if not words(t)]) == len(rows) - len(with_words)


def test_components_equal_a_walk(spark, monkeypatch):
    monkeypatch.setattr(components, "PART_EDGES", 7)
    edges = [(i, i + 1) for i in range(0, 60) if i % 13] + [(70, 5), (200, 100), (100, 150), (3, 3)]
    rows = components.components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark), "walk").collect()
    nodes = sorted({n for e in edges if e[0] != e[1] for n in e})
    place = {n: k for k, n in enumerate(nodes)}
    sets = [frozenset([("node", n)] + [tuple(sorted(e)) for e in edges if n in e]) for n in nodes]
    roots = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a != b and roots[a] != roots[b]:
                roots[a] = roots[b] = min(roots[a], roots[b])
                changed = True
    assert {r["node"]: r["root"] for r in rows} == roots and len(rows) == len(place) == len(sets)
    assert components.components(spark.createDataFrame([], "a long, b long"), Scratch(spark), "none").count() == 0


@pytest.fixture(scope="module")
def paragraphed(some_texts, odd_rows):
    texts = [t for _, t in some_texts]
    rows = [(i, "\n".join(texts[(7 * i + 3 * k) % len(texts)] for k in range(1 + i % 5))) for i in range(60)]
    return rows + [(1000 + n if i is not None else None, t) for n, (i, t) in enumerate(odd_rows)]


def all_paragraphs(rows):
    found = [(i is None, i, p, part) for i, t in rows for p, part in enumerate((t or "").split("\n")) if len(words(part)) >= 5]
    return sorted(found, key=lambda f: (f[0], f[1] or 0, f[2]))


def test_paragraphs_equal_all_pairs(frame, paragraphed, monkeypatch):
    monkeypatch.setattr(shared, "FREQUENT", 3)
    found = all_paragraphs(paragraphed)
    roots = linked([shingled(words(f[3])) for f in found])
    want = []
    for k, (_, i, p, part) in enumerate(found):
        n = roots.count(roots[k])
        if n > 1:
            want.append((i, p, len(words(part)), n, found[roots[k]][1], found[roots[k]][2], roots[k] != k))
    docs = frame(paragraphed).withColumn("paragraph", F.lit("clash")).withColumn("keys", F.lit(0))
    rows = passages.repeated(docs.repartition(4)).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)


def test_removal_leaves_first_paragraphs(frame, paragraphed):
    found = all_paragraphs(paragraphed)
    roots = linked([shingled(words(f[3])) for f in found])
    gone = {(f[1], f[2]) for k, f in enumerate(found) if roots[k] != k}
    want = []
    for i, t in paragraphed:
        parts = (t or "").split("\n")
        left = [p for n, p in enumerate(parts) if (i, n) not in gone]
        if t is None or len(left) == len(parts):
            want.append((i, t))
        elif any(words(p) for p in left):
            want.append((i, "\n".join(left)))
    docs = frame(paragraphed).withColumn("lang", F.lit("x"))
    rows = passages.remove(docs)
    assert rows.columns == docs.columns
    assert sorted([(r["doc_id"], r["text"]) for r in rows.collect()], key=str) == sorted(want, key=str)


def test_paragraphs_of_nothing(frame):
    assert passages.repeated(frame([])).count() == 0 and passages.remove(frame([(1, None), (2, "")])).count() == 2


def all_runs(rows, size=50):
    """Words that go from each row: those of every run that stands before, but not over its first place."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    split = [words(t) for _, t in rows]
    first, gone = {}, {k: set() for k in order}
    for k in order:
        for a in range(len(split[k]) - size + 1):
            at = first.setdefault(tuple(split[k][a:a + size]), (k, a))
            if at[0] != k or a >= at[1] + size:
                gone[k].update(range(a, a + size))
    return gone


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(3)
    new = lambda n: ["".join(rng.choices("etaoinsr", k=rng.randint(3, 8))) for _ in range(n)]
    part, other, third = new(57), new(50), new(80)
    inside = lambda p: " ".join(new(40) + p + new(43))
    rows = [(i, inside(part)) for i in (3, 1, 2)]  # in the middle of longer paragraphs
    rows += [(4, "\n".join(" ".join(other[k:k + 7]) for k in range(0, 50, 7))), (5, "Ahead\n" + " ".join(new(30) + other).upper() + "\nbehind")]
    rows += [(6, inside(third)), (7, inside(third[:49])), (8, inside(third[10:70]))]  # 49 words are too few
    rows += [(9, " ".join(third + new(5) + third)), (10, " ".join(["a", "b"] * 90)), (None, " ".join(third)), (11, " ".join(new(60)))]
    return rows


def test_passages_equal_all_runs(frame, planted, odd_rows, monkeypatch):
    monkeypatch.setattr(shared, "FREQUENT", 3)
    odd = [r for r in odd_rows if r[0] not in (8, 13, 14)]
    for rows in (planted, planted + [(None if i is None else 100 + i, t) for i, t in odd]):
        found = runs.repeated(frame(rows).withColumn("names", F.lit(0)).repartition(5)).collect()
        got = sorted(((r["doc_id"], r["first_word"] + k) for r in found for k in range(r["n_words"])), key=str)
        assert got == sorted(((rows[k][0], a) for k, g in all_runs(rows).items() for a in g), key=str)
        split = {i: words(t) for i, t in rows if i is not None}
        for r in found:
            own = split[r["doc_id"]] if r["doc_id"] is not None else words(planted[-2][1])
            assert own[r["first_word"]:][:50] == split[r["kept_doc_id"]][r["kept_word"]:][:50]


def test_removal_takes_passages_out_of_paragraphs(frame, planted):
    docs = frame(planted).withColumn("lang", F.lit("x"))
    kept = runs.remove(passages.remove(docs))
    assert kept.columns == docs.columns
    kept = {r["doc_id"]: r["text"] for r in kept.collect()}
    gone = all_runs(planted)
    for k, (i, t) in enumerate(planted):
        left = [w for n, w in enumerate(words(t)) if n not in gone[k]]
        assert words(kept.get(i)) == left and (i in kept) == bool(left)
    assert kept[5].startswith("Ahead\n") and kept[5].endswith("\nbehind") and kept[11] == planted[-1][1]


def test_passages_of_nothing(frame):
    assert runs.repeated(frame([])).count() == 0 and runs.remove(frame([(1, None), (2, "")])).count() == 2


def test_names_of_passages_fill_all_buckets(frame):
    rng = random.Random(8)
    rows = [(i, " ".join("".join(rng.choices("etaoinsr", k=6)) for _ in range(3_000))) for i in range(20)]
    sent = frame(rows).withColumn("text_hash", F.xxhash64("text")).repartition(2).mapInArrow(runs._sent(4), shared.PACKET)
    sizes = [r["n"] for r in sent.where("bucket >= 0").groupBy("bucket").agg((F.sum(F.octet_length("low")) / 2).alias("n")).collect()]
    assert len(sizes) == 16 and sum(sizes) > 4_000 and max(sizes) < sum(sizes) / 8
