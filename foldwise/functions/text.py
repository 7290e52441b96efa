"""Text expressions: counts, splits and n-grams."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from foldwise.functions.rows import col

WORD = r"(?U)\b\w\w+\b"
SPACE = r"(?U)\s+"


def char_count(text: str | Column) -> Column:
    return F.char_length(col(text))


def spaced_words(text: str | Column) -> Column:
    """Words between white space."""
    return F.filter(F.split(col(text), SPACE), lambda w: w != "")


def word_count(text: str | Column) -> Column:
    return F.size(spaced_words(text))


def occurrences(text: str | Column, needle: str) -> Column:
    """Non-overlapping occurrences of a literal, inside words too."""
    text = col(text)
    rest = F.char_length(F.replace(text, F.lit(needle), F.lit("")))
    return ((F.char_length(text) - rest) / F.lit(len(needle))).cast("int")


def any_occurrences(text: str | Column, needles: Sequence[str]) -> Column:
    return reduce(add, [occurrences(text, n) for n in needles])


def split_once(text: str | Column, markers: Sequence[str]) -> tuple[Column, Column, Column]:
    """(before, after, found) around the first marker."""
    parts = F.split(col(text), "(?:" + "|".join(markers) + ")", 2)
    found = F.size(parts) > 1
    return parts[0], F.when(found, parts[1]).otherwise(F.lit("")), found


def word_tokens(text: str | Column) -> Column:
    """Lower-case tokens of at least two letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(col(text)), F.lit(WORD), F.lit(0))


def grams(tokens: str, low: int, high: int) -> Column:
    """All runs of low..high tokens, joined by a blank.

    ``tokens`` must be a column of its own: an expression here would be worked
    out again for every run.
    """
    tokens = F.col(tokens)

    def of(n: int) -> Column:
        if n == 1:
            return tokens
        starts = F.slice(tokens, 1, F.greatest(F.size(tokens) - (n - 1), F.lit(0)))
        return F.transform(starts, lambda w, i: F.concat_ws(
            " ", w, *[F.get(tokens, i + j) for j in range(1, n)]))
    return F.flatten(F.array(*[of(n) for n in range(low, high + 1)]))


def pad(word: Column) -> Column:
    return F.concat(F.lit(" "), word, F.lit(" "))


def word_grams(word: Column, low: int, high: int) -> Column:
    """Character runs of one padded word; a word too short for a run gives itself
    once and no longer runs."""
    size = F.char_length(word)
    lengths = F.filter(F.array(*[F.lit(n) for n in range(low, high + 1)]),
                       lambda n: (n == low) | (size >= n))
    return F.flatten(F.transform(lengths, lambda n: F.transform(
        F.sequence(F.lit(1), F.greatest(size - n + 1, F.lit(1))),
        lambda i: F.substr(word, i, n))))


def char_grams(text: str | Column, low: int, high: int) -> Column:
    """Character runs inside the blank-padded words of a text."""
    padded = F.transform(spaced_words(F.lower(col(text))), pad)
    return F.flatten(F.transform(padded, lambda w: word_grams(w, low, high)))
