"""N-grams of texts, counted by chunks of texts where they lie.

Words of a chunk get numbers, runs of words get numbers made of those; sorted with their rows, equal runs stand together. A chunk gives each of
its different runs once, so what a task hands on is smaller than its occurrences. Equality is that of the words themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame

CHUNK_WORDS = 1 << 20
CHAR_WORDS = 1 << 18  # every word has several runs of characters
BATCH_ROWS = 1 << 17
_COUNTS = pa.schema([("term", pa.string()), ("tf", pa.int64()), ("df", pa.int64())])


def counted(df: DataFrame, tokens: Column, low: int, high: int) -> DataFrame:
    """``(term, tf, df)`` rows whose sums by term are the occurrences of each run of ``low`` to ``high`` tokens, joined by a blank, and
    the rows of ``df`` that have it. ``tokens`` is an array of strings without nulls, null counts as empty."""
    return df.select(tokens.alias("tokens")).mapInArrow(_chunks(low, high), "term string, tf long, df long")


def counted_chars(df: DataFrame, words: Column, low: int, high: int) -> DataFrame:
    """The same for runs of ``low`` to ``high`` characters inside the blank-padded ``words`` of a row, as
    :func:`foldwise.functions.text.word_grams` cuts them."""
    return df.select(words.alias("tokens")).mapInArrow(_chunks(low, high, _counted_chars, CHAR_WORDS), "term string, tf long, df long")


def _chunks(low: int, high: int, work: Callable[..., Iterator[pa.RecordBatch]] | None = None, most: int | None = None
            ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    most, work = most or CHUNK_WORDS, work or _counted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words = [], 0
        for batch in batches:
            rows = batch.column(0)
            ends = np.concatenate([[0], np.cumsum(_sizes(rows))])
            at = 0
            while at < len(rows):
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + most - words, "right")) - 1)
                held.append(rows.slice(at, to - at))
                words, at = words + int(ends[to] - ends[at]), to
                if words >= most:
                    yield from work(held, low, high)
                    held, words = [], 0
        if words:
            yield from work(held, low, high)
    return run


def _sizes(rows: pa.Array) -> np.ndarray:
    return pc.list_value_length(rows).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _counted(held: list[pa.Array], low: int, high: int) -> Iterator[pa.RecordBatch]:
    """The different runs of a chunk, of one length after the other."""
    sizes = np.concatenate([_sizes(rows) for rows in held])
    encoded = pa.concat_arrays([rows.flatten() for rows in held]).dictionary_encode()
    words, spelled = encoded.indices.to_numpy().astype(np.int64), encoded.dictionary
    sizes = sizes[sizes > 0]
    row = np.repeat(np.arange(len(sizes)), sizes)
    bits = len(sizes).bit_length()
    at, runs, terms = np.arange(len(words)), words, spelled  # a run's place, and which of the terms it is
    for n in range(1, high + 1):
        plain = True
        if n > 1:  # runs one word longer, as far as they stay inside their rows
            inside = np.flatnonzero(at < len(words) - (n - 1))
            inside = inside[row[at[inside]] == row[at[inside] + (n - 1)]]
            at, runs = at[inside], runs[inside] * len(spelled) + words[at[inside] + (n - 1)]
            if not len(at):
                return
            plain = n < high or (len(terms) * len(spelled)).bit_length() + bits > 62
            if plain:
                keys, runs = np.unique(runs, return_inverse=True)
                terms = _spelled(terms, spelled, keys)
        if n < low:
            continue
        pairs = np.sort(runs << bits | row[at])
        first = np.concatenate([[True], pairs[1:] != pairs[:-1]])
        pairs >>= bits
        edges = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
        of = terms if plain else _spelled(terms, spelled, pairs[edges])
        made = pa.RecordBatch.from_arrays([of, pa.array(np.diff(edges, append=len(pairs)), pa.int64()),
                                           pa.array(np.add.reduceat(first, edges, dtype=np.int64), pa.int64())], schema=_COUNTS)
        for start in range(0, made.num_rows, BATCH_ROWS):
            yield made.slice(start, BATCH_ROWS)


def _spelled(known: pa.Array, words: pa.Array, runs: np.ndarray) -> pa.Array:
    """Runs of a known run and one word more."""
    before, last = np.divmod(runs, len(words))
    return pc.binary_join_element_wise(known.take(pa.array(before)), words.take(pa.array(last)), " ")


def cut(word: str, low: int, high: int) -> list[str]:
    """Runs of characters of one word between blanks; a word too short for a run gives itself once and no longer runs."""
    word = f" {word} "
    size = len(word)
    return [word[i:i + n] for n in range(low, high + 1) if n == low or size >= n for i in range(max(size - n + 1, 1))]


def repeated(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``start`` to ``start + size`` of every entry, one after the other."""
    ends = sizes.cumsum()
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def word_pairs(sizes: np.ndarray, words: np.ndarray, different: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, word and number of times for every different word of a row."""
    keys, times = np.unique(np.repeat(np.arange(len(sizes)), sizes) * different + words, return_counts=True)
    return *np.divmod(keys, max(different, 1)), times


def _counted_chars(held: list[pa.Array], low: int, high: int) -> Iterator[pa.RecordBatch]:
    sizes = np.concatenate([_sizes(rows) for rows in held])
    encoded = pa.concat_arrays([rows.flatten() for rows in held]).dictionary_encode()
    row, word, times = word_pairs(sizes, encoded.indices.to_numpy().astype(np.int64), len(encoded.dictionary))
    runs = [cut(w, low, high) for w in encoded.dictionary.to_pylist()]
    n = np.array([len(found) for found in runs], dtype=np.int64)
    spelled = pa.array([g for found in runs for g in found], pa.string()).dictionary_encode()
    of, terms = spelled.indices.to_numpy().astype(np.int64), spelled.dictionary
    gram = of[repeated((n.cumsum() - n)[word], n[word])]
    tf = np.bincount(gram, np.repeat(times, n[word]), len(terms)).astype(np.int64)
    seen = np.sort(gram * len(sizes) + np.repeat(row, n[word]))
    seen = seen[np.concatenate([[True], seen[1:] != seen[:-1]])] if len(seen) else seen
    made = pa.RecordBatch.from_arrays([terms, pa.array(tf), pa.array(np.bincount(seen // len(sizes), minlength=len(terms)))], schema=_COUNTS)
    for start in range(0, made.num_rows, BATCH_ROWS):
        yield made.slice(start, BATCH_ROWS)


# ------------------------------------------------------------------ known terms
class KnownWords:
    """Finds the listed runs of words: ``(row, term)`` of every occurrence. ``terms`` are joined by a blank, their places are their numbers."""

    def __init__(self, terms: Sequence[str]):
        split = [t.split(" ") for t in terms]
        self.words = sorted({w for t in split for w in t})
        at = {w: i for i, w in enumerate(self.words)}
        states, self.steps, width = {(w,): i for w, i in at.items()}, [], max(len(self.words), 1)
        self.terms = [self._of(split, states, 1)]
        for n in range(2, max(map(len, split), default=0) + 1):
            keys = {t[:n]: states[t[:n - 1]] * width + at[t[n - 1]] for t in map(tuple, split) if len(t) >= n}
            order = sorted(keys, key=keys.get)
            self.steps.append(np.array([keys[t] for t in order], dtype=np.int64))
            states = {t: i for i, t in enumerate(order)}
            self.terms.append(self._of(split, states, n))

    @staticmethod
    def _of(split: list[list[str]], states: dict, n: int) -> np.ndarray:
        out = np.full(len(states), -1, dtype=np.int64)
        for i, t in enumerate(split):
            if len(t) == n:
                out[states[tuple(t)]] = i
        return out

    def find(self, sizes: np.ndarray, tokens: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        encoded = tokens.dictionary_encode()
        known = pc.index_in(encoded.dictionary, value_set=pa.array(self.words, pa.string())).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        words, row = known[encoded.indices.to_numpy()], np.repeat(np.arange(len(sizes)), sizes)
        at = np.flatnonzero(words >= 0)
        state, rows, terms = words[at], [], []
        for n, of in enumerate(self.terms, 1):
            if n > 1:
                inside = np.flatnonzero(at < len(words) - (n - 1))
                inside = inside[(row[at[inside]] == row[at[inside] + (n - 1)]) & (words[at[inside] + (n - 1)] >= 0)]
                at, keys = at[inside], state[inside] * len(self.words) + words[at[inside] + (n - 1)]
                place = np.minimum(np.searchsorted(self.steps[n - 2], keys), len(self.steps[n - 2]) - 1)
                hit = self.steps[n - 2][place] == keys
                at, state = at[hit], place[hit]
            found = of[state]
            rows.append(row[at][found >= 0])
            terms.append(found[found >= 0])
        rows = np.concatenate(rows)
        return rows, np.concatenate(terms), np.ones(len(rows), dtype=np.int64)


class KnownChars:
    """The same for runs of characters inside blank-padded words; a run that stands in a word several times comes as often."""

    def __init__(self, terms: Sequence[str], low: int, high: int):
        self.at, self.low, self.high = {t: i for i, t in enumerate(terms)}, low, high

    def find(self, sizes: np.ndarray, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        encoded = words.dictionary_encode()
        row, word, times = word_pairs(sizes, encoded.indices.to_numpy().astype(np.int64), len(encoded.dictionary))
        at = self.at
        runs = [[at[g] for g in cut(w, self.low, self.high) if g in at] for w in encoded.dictionary.to_pylist()]
        n = np.array([len(found) for found in runs], dtype=np.int64)
        of = np.array([g for found in runs for g in found], dtype=np.int64)
        return np.repeat(row, n[word]), of[repeated((n.cumsum() - n)[word], n[word])], np.repeat(times, n[word])
