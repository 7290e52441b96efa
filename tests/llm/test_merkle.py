"""The manifest against a tree built by plain loops."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from foldwise.llm import merkle
from foldwise.llm.common import Scratch

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def climb(tree, at, node):
    proof = ""
    for nodes in tree[:-1]:
        run = nodes[at // 8 * 8:at // 8 * 8 + 8]
        proof += "".join(run[:at % 8] + run[at % 8 + 1:])
        run[at % 8] = node
        node, at = h(*run), at // 8
    return node, proof


def brute(rows):
    order = lambda v: (v is not None, v)
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {g: sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in langs}
    built = {g: levels([leaf(r) for r in trees[g]]) for g in langs}
    top = levels([built[g][-1][0] for g in langs]) if langs else [[None]]
    out = []
    for place, g in enumerate(langs):
        for at, r in enumerate(trees[g]):
            offered = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                offered = leaf((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))
            sub, proof = climb(built[g], at, offered)
            root, more = climb(top, place, sub)
            out.append((r[0], leaf(r), built[g][-1][0], top[-1][0], h(proof + more), root, root == top[-1][0]))
    return sorted(out, key=str)


def check(spark, rows, scratch=None):
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("g", F.lit("clash")).withColumn("pos", F.lit(1)).withColumn("digest", F.lit("x"))
    got = merkle.Manifest(merkle.documents(spark, docs), scratch or Scratch(spark)).check()
    return sorted(map(tuple, got.select("key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def rows_of(n, rng, langs):
    return [(i, rng.choice(["a", None, "ü"]), rng.choice(langs), rng.choice([None, i]), rng.choice([None, "", "lower", f"Upper É {i}"])) for i in range(n)]


@pytest.mark.parametrize("n,langs", [(0, ["a"]), (1, ["a"]), (9, [None]), (70, ["a", "b", None, ""]), (1300, ["en", "en", "en", "de"]),
                                     (60, [f"l{i}" for i in range(40)])])
def test_trees(spark, n, langs):
    rows = rows_of(n, random.Random(n), langs)
    assert check(spark, rows) == brute(rows)


def test_more_passes_and_groups_than_a_run(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RUN_LEVELS", 1)
    monkeypatch.setattr(merkle, "RUN", 8)
    rows = rows_of(700, random.Random(4), ["a"] * 30 + [f"l{i}" for i in range(100)])
    assert check(spark, rows) == brute(rows)


def test_repeated_and_null_ids(spark):
    rows = [(5, "s", "en", 1, "Twice")] * 20 + [(None, None, None, None, None)] * 9 + [(None, "s", "en", 2, "No id")] * 3 + [(5, "s", "en", 1, "other")]
    assert check(spark, rows) == brute(rows)


def test_alteration_is_found(spark):
    rows = [(i, "s", "en", 1, "Text" if i % 2 else "text") for i in range(100)]
    for key, *_, verified in check(spark, rows):
        assert verified == (not (key % 2 and zlib.crc32(str(key).encode()) % 3 == 0))


def test_states_resume():
    children = [h(str(i)).encode() for i in range(8)]
    parent = merkle.Parent(children)
    for slot in range(8):
        for _ in range(2):  # the copies stay as they are
            assert parent.fold(slot, b"x" * 64).decode() == h(*(c.decode() if i != slot else "x" * 64 for i, c in enumerate(children)))
            assert parent.fold(slot, children[slot]) == parent.digest
