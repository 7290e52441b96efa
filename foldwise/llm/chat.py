"""Conversations as training windows of a token budget, with a loss mask.

A turn is written as an opening mark, its text and a closing mark; marks that occur inside a text get a backslash after their first
character (those that have some get one more), which reading takes away again. The running sum of the turns' tokens places every turn on
its conversation's line of tokens; spans of whole turns are chosen by searching these sums. A window holds the conversation's system turn,
as many of the last turns before the span as fit ``history`` tokens, and the span; the rest of the budget is the span's. What is repeated
is masked: only assistant texts of the span count for the loss, so each counts once.

The line is cut into stretches of ``STRETCH`` tokens, by the sums alone, and a span ends with its stretch. A stretch is one unit of work,
with the last turns before it and the system turn sent along, so a conversation of any length is spread over tasks.

A conversation's system turn is its first turn, if its role is ``system``; it is repeated if it takes at most half the budget. A turn that is longer
than a window stands alone in its own, whole: nothing is cut or dropped. Null texts and roles count as empty. Turns of the same number stand in
the order of role and text, null numbers first; turns alike in all are interchangeable. Rows without conv_id are one conversation.
Empty tables have no windows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import Scratch, only, partitions, pieces, placed_sums, short_batches
from foldwise.llm.tokens import ENCODED, WordEncoder

#: Opening and closing marks by role; other roles are named inside.
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("[ROLE]", "[SAYS]", "[/ROLE]")
_TAILS = "|".join(re.escape(m[1:]) for m in [*(m for pair in MARKS.values() for m in pair), *OTHER])
CONTROL = re.compile(rf"[<\[](?:{_TAILS})")
ESCAPED = re.compile(rf"([<\[])\\(\\*(?:{_TAILS}))")
BUDGET, HISTORY = 1024, 256
STRETCH = 32 * BUDGET
WINDOW = "conv_id {0}, first_token long, text string, loss_from array<int>, loss_to array<int>, n_repeated int, n_tokens long"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*(?:{_TAILS}))", r"$1\\$2")


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2", text)


def formatted(role: Column, text: Column) -> Column:
    """A turn between its marks."""
    out = F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1]), escape(text), F.lit(OTHER[2]))
    for name, (start, end) in MARKS.items():
        out = F.when(role == name, F.concat(F.lit(start), escape(text), F.lit(end))).otherwise(out)
    return out


def parse(text: str) -> list[tuple[str, str]]:
    """Role and text of every turn of a window."""
    marks = [(m.start(), m.end(), m.group()) for m in CONTROL.finditer(text)]
    roles = {start: (role, end) for role, (start, end) in MARKS.items()}
    turns, i = [], 0
    while i < len(marks):
        _, begin, mark = marks[i]
        if mark in roles:
            role, close = roles[mark]
        else:
            role, close, i = unescape(text[begin:marks[i + 1][0]]), OTHER[2], i + 1
            begin = marks[i][1]
        if marks[i + 1][2] != close:
            raise ValueError(f"{mark} is closed by {marks[i + 1][2]}")
        turns.append((role, unescape(text[begin:marks[i + 1][0]])))
        i += 2
    return turns


def _counted(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordEncoder(path, "joined")
        for batch in pieces(batches, limit=ENCODED):
            sizes = words.encode(batch.column("text").to_pylist())[1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.maximum(sizes, 1), pa.int64())], [*batch.schema.names, "tokens"])
        words.keep()
    return run


def _spans(start: np.ndarray, end: np.ndarray, first: int, lowest: int, system: int, budget: int, history: int) -> Iterator[tuple[int, int, int]]:
    """From the running sums of a stretch, whose own turns begin at ``first``: where history begins, the span, and its end.

    Turns before ``lowest`` are the system turn, which is no history; ``system`` is what it takes where it is repeated.
    """
    at = first
    while at < len(start):
        rest = budget - system if at >= lowest else budget
        back = min(at, max(int(np.searchsorted(start, start[at] - history, "left")), lowest))
        to = int(np.searchsorted(end, start[at] + rest - (start[at] - start[back]), "right"))
        if to <= at:  # not even one turn beside the history
            back, to = at, max(at + 1, int(np.searchsorted(end, start[at] + rest, "right")))
        yield back, at, to
        at = to


def _windows(budget: int, history: int):
    """Windows of sorted stretches; a stretch may come in several batches."""
    def close(rows: list[dict]) -> list[tuple]:
        system = next((r for r in rows if r["kind"] == 0), None)
        turns = [r for r in rows if r["kind"] > 0]
        first = next((i for i, r in enumerate(turns) if r["kind"] == 2), len(turns))
        head = system or next((r for r in turns[first:first + 1] if r["first"] == 0 and r["role"] == "system"), None)
        if head and 2 * head["tokens"] > budget:
            head = None
        start = np.array([r["first"] for r in turns], np.int64)
        end = start + np.array([r["tokens"] for r in turns], np.int64)
        lowest = int(head is not None and turns[0]["first"] == 0)
        out = []
        for back, at, to in _spans(start, end, first, lowest, head["tokens"] if head else 0, budget, history):
            repeated = ([head] if head and at >= lowest else []) + turns[back:at]
            place, froms, tos, whole = 0, [], [], repeated + turns[at:to]
            for i, r in enumerate(whole):
                if i >= len(repeated) and r["role"] == "assistant":
                    froms.append(place + len(MARKS["assistant"][0]))
                    tos.append(place + len(r["text"]) - len(MARKS["assistant"][1]))
                place += len(r["text"])
            out.append((rows[0]["conv_id"], int(start[at]), "".join(r["text"] for r in whole), froms, tos, len(repeated),
                        sum(r["tokens"] for r in whole)))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, last, out, size, kind = [], None, [], 0, None

        def batch() -> pa.RecordBatch:
            kinds = [kind, pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int32(), pa.int64()]
            names = [c.split()[0] for c in WINDOW.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

        for part in batches:
            kind = part.schema.field("conv_id").type
            for row in part.to_pylist():
                key = (row["conv_id"], row["stretch"])
                if key != last and rows:
                    out += close(rows)
                    rows = []
                last = key
                rows.append(row)
                size += len(row["text"])
            if size > ENCODED and out:
                yield batch()
                out, size = [], 0
        if rows:
            out += close(rows)
        if out:
            yield batch()
    return run


def windows(turns: DataFrame, tokenizer: str, scratch: Scratch, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Windows of ``turns(conv_id, turn, role, text)``: the text, where its loss begins and ends (code points), how many turns at its
    front are repeated, its tokens, and its place on the conversation's line."""
    spark, key = turns.sparkSession, turns.schema["conv_id"].dataType.simpleString()
    plain = only(turns, conv_id="conv_id", turn="turn", role="role", text="text")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    written = short_batches(plain.select("conv_id", "turn", role.alias("role"), formatted(role, text).alias("text")))
    counted = scratch.keep(written.mapInArrow(_counted(tokenizer), f"conv_id {key}, turn {turns.schema['turn'].dataType.simpleString()}, role string, text string, tokens long"), "turns-counted")
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.xxhash64("text")]
    lined = scratch.keep(placed_sums(counted, "conv_id", order, "tokens", "first", scratch, "turns-ordered"), "turns")
    scratch.drop("turns-counted", "turns-ordered")
    own = lined.select("conv_id", F.floor(F.col("first") / STRETCH).cast("long").alias("stretch"), F.lit(2).alias("kind"), "first", "role", "text", "tokens")
    # a stretch's last turns stand before the next one, whose first turn begins where this one's last turn ends
    ends = own.groupBy("conv_id", "stretch").agg(F.max(F.col("first") + F.col("tokens")).alias("end")).where(
        F.col("end") >= (F.col("stretch") + 1) * STRETCH).select(F.col("conv_id").alias("c"), F.col("stretch").alias("s"), "end")
    tail = own.join(ends, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("stretch") == F.col("s"))).where(F.col("end") - F.col("first") <= history)
    tail = tail.select("conv_id", F.floor(F.col("end") / STRETCH).cast("long").alias("stretch"), F.lit(1).alias("kind"), "first", "role", "text", "tokens")
    later = own.where("stretch > 0").select(F.col("conv_id").alias("c"), F.col("stretch").alias("s")).distinct()
    heads = own.where("first = 0 AND role = 'system'").where(F.col("tokens") * 2 <= budget)
    heads = later.join(heads, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        "conv_id", F.col("s").alias("stretch"), F.lit(0).alias("kind"), "first", "role", "text", "tokens")
    units = own.unionByName(tail).unionByName(heads)
    return (units.repartition(partitions(spark), "conv_id", "stretch").sortWithinPartitions("conv_id", "stretch", "kind", "first")
            .mapInArrow(_windows(budget, history), WINDOW.format(key)))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a window says anew: its turns as one text, and the unescaped text under its mask."""
    for batch in batches:
        said, learned, n_turns = [], [], []
        for text, froms, tos, repeated in zip(*(batch.column(c).to_pylist() for c in ("text", "loss_from", "loss_to", "n_repeated"))):
            turns = parse(text)[repeated:]
            said.append("".join(f"{role}\n{body}\n" for role, body in turns))
            learned.append("".join(unescape(text[a:b]) for a, b in zip(froms, tos)))
            n_turns.append(len(turns))
        columns = [batch.column("conv_id"), batch.column("first_token"), pa.array(n_turns, pa.int64()), pa.array(said, pa.string()),
                   pa.array(learned, pa.string()), pa.array([len(t) for t in batch.column("text").to_pylist()], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["conv_id", "first_token", "n_turns", "said", "learned", "chars"])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations whose windows come one after the other: only the states of one are held."""
    kind, done, current = None, [], None

    def batch() -> pa.RecordBatch:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        rows = [(c, n, a.hexdigest(), chars, b.hexdigest(), total) for c, n, a, chars, b, total in done]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds)], names)

    for part in batches:
        kind = part.schema.field("conv_id").type
        for conv, n, said, learned, chars in zip(*(part.column(c).to_pylist() for c in ("conv_id", "n_turns", "said", "learned", "chars"))):
            if current is None or current[0] != conv:
                if current:
                    done.append(current)
                current = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            current[1] += n
            current[2].update(said.encode())
            current[3] += len(learned)
            current[4].update(learned.encode())
            current[5] += chars
        if len(done) > 10_000:
            yield batch()
            done = []
    if current:
        done.append(current)
        yield batch()


def digests(found: DataFrame, scratch: Scratch) -> DataFrame:
    """Per conversation its turns and loss as the windows have them: numbers, digests and formatted length.

    A digest is one pass over a conversation in order; windows are parsed in parallel before, and a task holds a batch of them at a time.
    """
    kind = found.schema["conv_id"].dataType.simpleString()
    read = short_batches(found).mapInArrow(_read, f"conv_id {kind}, first_token long, n_turns long, said string, learned string, chars long")
    return (read.repartition(partitions(found.sparkSession), "conv_id").sortWithinPartitions("conv_id", "first_token")
            .mapInArrow(_digested, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"))
