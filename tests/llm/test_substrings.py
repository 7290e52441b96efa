"""Repeated passages against brute force: whatever stands twice for fifty words is found, and nothing else is."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.llm import shared, substrings

rng = random.Random(21)


def words(n):
    return ["".join(rng.choices("abcdefghijkl", k=rng.randint(2, 7))) for _ in range(n)]


def collection():
    passage, other, short = words(50), words(57), words(49)
    texts = []
    for i in range(6):  # in the middle of long paragraphs, with other line breaks, in other case
        body = words(40) + passage + words(70)
        texts.append(" ".join(body) if i % 2 else "\n".join([" ".join(body[:60]), " ".join(body[60:]).upper()]))
    for i in range(4):
        texts.append(" ".join(words(rng.randint(0, 90)) + other + words(rng.randint(0, 90))))
    texts += [" ".join(words(30) + short + words(30)) for _ in range(4)]  # one word too few
    whole = " ".join(words(120))
    texts += [whole] * 3 + [whole.upper().replace(" ", "\n")]
    near = words(80)
    for i in range(4):  # paragraphs that are nearly the same: a word apart
        mine = list(near)
        if i:
            mine[20 * i + 5] = f"w{i}"  # links with the first only; the others hang together by it
        texts.append(" ".join(words(20)) + "\n" + " ".join(mine) + "\n" + " ".join(words(30)))
    line = " ".join(words(9))
    texts += ["\n".join([line, " ".join(words(60)), line]) for _ in range(5)]  # a common short line
    twice = words(55)
    texts.append(" ".join(words(10) + twice + words(15) + twice + words(10)))  # within one text
    texts += [" ".join(["same"] * 300), None, "", "  \n ", "one two"]
    return texts


def lowered(text):
    return [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()]


def brute_places(texts):
    """Words of each text that belong to a run of fifty that stands elsewhere, too, or in the same text without overlap."""
    places = {}
    for i, t in enumerate(texts):
        ws = lowered(t)
        for a in range(len(ws) - 49):
            places.setdefault(tuple(ws[a:a + 50]), []).append((i, a))
    out = {}
    for found in places.values():
        if any(d != found[0][0] or a >= found[0][1] + 50 for d, a in found):
            for d, a in found:
                out.setdefault(d, set()).update(range(a, a + 50))
    return out


@pytest.fixture(scope="module")
def found(spark):
    texts = collection()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("kind", F.lit("clash")).withColumn("start", F.lit(1))
    return texts, substrings.repeated(df.repartition(5)).collect()


def test_documents_and_words(found):
    texts, rows = found
    want = brute_places(texts)
    near = {i for i, t in enumerate(texts) if t and t.count("\n") == 2 and len(lowered(t)) == 130}
    assert {r["doc_id"] for r in rows} == set(want) | near
    for i in want:
        covered = set()
        for r in rows:
            if r["doc_id"] == i and r["kind"] != "paragraph":
                covered.update(range(r["first_word"], r["first_word"] + r["n_words"]))
        assert covered <= want[i]
        if not any(r["doc_id"] == i and not r["removed"] for r in rows):
            assert covered == want[i]


def test_what_goes_stands_before(found):
    texts, rows = found
    for r in rows:
        own, kept = lowered(texts[r["doc_id"]]), lowered(texts[r["kept_doc_id"]])
        if r["kind"] != "paragraph":
            assert own[r["first_word"]:r["first_word"] + 50] == kept[r["kept_word"]:r["kept_word"] + 50]
        if r["removed"]:
            assert (r["kept_doc_id"], r["kept_word"]) < (r["doc_id"], r["first_word"])
        else:
            assert (r["kept_doc_id"], r["kept_word"]) == (r["doc_id"], r["first_word"])


def test_near_paragraphs_form_one_component(found):
    texts, rows = found
    near = [i for i, t in enumerate(texts) if t and t.count("\n") == 2 and len(lowered(t)) == 130]
    parts = [r for r in rows if r["kind"] == "paragraph" and r["doc_id"] in near]
    assert {r["doc_id"] for r in parts} == set(near) and {r["kept_doc_id"] for r in parts} == {near[0]}
    assert sum(not r["removed"] for r in parts) == 1


def test_chosen_places_depend_on_the_words_alone():
    values = np.random.default_rng(4).integers(0, 1 << 62, 400).astype(np.uint64)
    whole = set(substrings.chosen(values).tolist())
    assert len(whole) < 400 * 0.15 and max(np.diff(sorted(whole))) <= substrings.CHOICE
    for a in (0, 17, 200):
        inner = {int(p) + a for p in substrings.chosen(values[a:a + 46])}
        assert inner <= whole and min(inner) - a < substrings.CHOICE  # a run of fifty words has one of its own


def test_same_however_rows_are_dealt(found, spark, monkeypatch):
    texts, rows = found
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 500)
    monkeypatch.setattr(shared, "FREQUENT", 3)
    again = substrings.repeated(spark.createDataFrame(list(enumerate(texts))[::-1], "doc_id long, text string").repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_null_and_repeated_ids(spark):
    text = " ".join(words(70))
    rows = [(None, text), (None, text), (3, "x " + text), (3, "x " + text), (5, text)]
    got = substrings.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["kind"], r["doc_id"], r["removed"]) for r in got if r["kind"] == "text"} == {("text", None, True), ("text", 5, False)}
    assert any(r["kind"] == "passage" and r["doc_id"] == 5 and r["kept_doc_id"] == 3 and r["removed"] for r in got)
    assert substrings.repeated(spark.createDataFrame([], "doc_id long, text string")).count() == 0
