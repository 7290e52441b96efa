"""Chat windows: the template's round trip, and windows and digests against plain loops over whole conversations."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foldwise.llm import chat
from foldwise.llm.common import Scratch
from foldwise.llm.queries import QUERIES, vocabulary
from tests.oracle import ROOT

SF = f"{ROOT}/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"
MARKS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[SAYS]", "[/ROLE]"]


def escaped(text):
    return chat.re.sub(rf"([<\[])(\\*(?:{chat._TAILS}))", r"\1\\\2", text)


def written(role, text):
    if role in chat.MARKS:
        a, b = chat.MARKS[role]
        return a + escaped(text) + b
    return f"[ROLE]{escaped(role)}[SAYS]{escaped(text)}[/ROLE]"


bits = st.lists(st.sampled_from([*MARKS, "<", "[", "\\", "/", "s>", "<SYS>>", "INST]", "a", " ", "\n", ">", "]"]), max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system"]), bits), bits), max_size=5))
def test_template_is_reversible(turns):
    assert chat.parse("".join(written(*t) for t in turns)) == turns


def test_spark_writes_the_same_turns(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["user", "assistant", "system", "tool", "", "<s>"]),
             "".join(rng.choices([*MARKS, "<", "[", "\\", "x$1", "\n", "é🙂"], k=rng.randint(0, 9)))) for _ in range(200)]
    got = spark.createDataFrame(rows, "role string, text string").select("role", "text", chat.formatted(F.col("role"), F.col("text")).alias("w")).collect()
    assert all(r["w"] == written(r["role"], r["text"]) for r in got)


def conversations():
    """Short, long and very long ones, with control strings, unknown roles, nulls, repeated rows and a long turn."""
    rng = random.Random(7)
    say = lambda n: " ".join(rng.choice(["alpha", "beta", "<s>", "gamma", "[INST]", "delta\n"]) for _ in range(n))
    rows = []
    for c in range(12):
        if c % 3 == 0:
            rows.append((c, 0, "system", say(20)))
        for t in range(1, rng.randint(2, 9)):
            rows.append((c, t, "user" if t % 2 else "assistant", say(rng.randint(0, 60))))
    rows += [(50, 0, "system", say(30)), *[(50, t, "user" if t % 2 else "assistant", say(rng.randint(1, 90))) for t in range(1, 700)]]
    rows += [(51, t, "assistant", say(40)) for t in range(5)] + [(52, 0, "user", say(9000)), (52, 1, "assistant", "short")]
    rows += [(53, 0, "system", say(2000)), (53, 1, "user", "a"), (53, 2, "assistant", "b")]
    rows += [(None, 1, "user", "null id"), (None, None, None, None), (54, None, "assistant", None), (54, None, "assistant", None), (54, 2, "tool", "{}")]
    return rows


def expected(rows):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    out = {}
    for c, turns in by.items():
        turns = [(r[2] or "", r[3] or "") for r in sorted(turns, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or ""))]
        said, loss = "".join(f"{a}\n{b}\n" for a, b in turns), "".join(b for a, b in turns if a == "assistant")
        out[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.fixture(scope="module")
def found(spark):
    rows, path = conversations(), vocabulary("byte_bpe_50k.json")
    turns = spark.createDataFrame(rows, SCHEMA).withColumn("text_", F.lit(1)).withColumn("first", F.lit("clash")).withColumn("tokens", F.lit(0))
    scratch = Scratch(spark)
    return rows, scratch.keep(chat.windows(turns.repartition(5), path, scratch), "windows")


def test_digests_read_back(found, spark):
    rows, windows = found
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.digests(windows, Scratch(spark)).collect()}
    assert got == expected(rows)


def test_windows_hold_the_budget_and_repeat_masked(found):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    rows, windows = found
    by = {}
    for r in windows.orderBy("first_token").collect():
        by.setdefault(r["conv_id"], []).append(r)
    assert len(by[50]) > chat.STRETCH // chat.BUDGET  # more than one stretch
    for conv, own in by.items():
        line, before = [], 0
        for w in own:
            turns = chat.parse(w["text"])
            sizes = [len(tokenizer.encode(written(*t), add_special_tokens=False).ids) for t in turns]
            repeated, new = turns[:w["n_repeated"]], turns[w["n_repeated"]:]
            assert w["n_tokens"] == sum(sizes) and w["first_token"] == before
            assert w["n_tokens"] <= chat.BUDGET or len(new) == 1
            head = line[:1] if line and line[0][0] == "system" and repeated[:1] == line[:1] else []
            history = repeated[len(head):]
            assert not history or history == line[-len(history):]
            assert sum(sizes[len(head):len(repeated)]) <= chat.HISTORY
            if conv == 50 and before:
                assert head and history  # its turns are shorter than the history's budget
            assert "".join(chat.unescape(w["text"][a:b]) for a, b in zip(w["loss_from"], w["loss_to"])) == "".join(
                t for role, t in new if role == "assistant")
            line += new
            before += sum(sizes[w["n_repeated"]:])


def test_windows_are_full(found):
    """Two windows that follow each other within a stretch could not be one."""
    _, windows = found
    own = [r for r in windows.orderBy("first_token").collect() if r["conv_id"] == 50]
    sizes = [r["n_tokens"] for r in own]
    assert sum(sizes) / len(sizes) > 0.85 * chat.BUDGET and sizes[0] > chat.BUDGET - 300


def test_same_windows_however_rows_are_dealt(found, spark):
    rows, windows = found
    again = chat.windows(spark.createDataFrame(rows[::-1], SCHEMA).repartition(3), vocabulary("byte_bpe_50k.json"), Scratch(spark))
    assert sorted(map(str, windows.collect())) == sorted(map(str, again.collect()))


def test_no_conversations(spark):
    scratch = Scratch(spark)
    none = chat.windows(spark.createDataFrame([], SCHEMA), vocabulary("byte_bpe_50k.json"), scratch)
    assert none.count() == 0 and chat.digests(none, scratch).count() == 0


def test_query_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    odd = "</s>[INST] ok [/INST]"
    want = expected(rows + [(-1, 0, "user", odd), (-1, 1, "assistant", odd)])
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in QUERIES["op11_chat_windows"](spark, SF).collect()}
    assert got == want and got[-1][2] == len(odd)
