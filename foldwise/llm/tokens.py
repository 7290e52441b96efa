"""Token ids of whole texts by a public tokenizer, in tasks."""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np

from foldwise.llm.common import ragged, worker_state


#: Letters that stay as they are under composition and have a lower case of one letter, and ASCII marks after them.
MARKED = re.compile("( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+)([!-/:-@\\[-`{-~]*)")
#: The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from 256 on.
ENCODED = 2 << 20  # bytes of text that are encoded at a time
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTES = {b: chr(b) for b in _SHOWN} | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in set(_SHOWN))}
_SPELLED = {b: c for b, c in BYTES.items() if b != 0x0A}  # for many words at once, a line each


class _Codes(dict):
    """Word to code; unknown words get the next code and wait to be encoded."""

    def __init__(self, owner: WordEncoder, prefix: str):
        self.owner, self.prefix = owner, prefix

    def __missing__(self, word: str) -> int:
        if self.prefix and (not word or word[0].isspace()):
            self.owner.odd = True  # several white space characters in a row: not cut at spaces
            return 0
        code = self[word] = self.owner.n_codes
        self.owner.n_codes += 1
        self.owner.waiting.append(self.prefix + word)
        return code


class _Ids:
    """Ids of numbered words in one array that grows by doubling."""

    def __init__(self):
        self.flat, self.start, self.length = np.empty(1 << 16, np.uint32), np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)
        self.used = 0

    def put(self, codes: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while len(codes) and codes[-1] >= len(self.start):
            self.start = np.concatenate([self.start, np.empty_like(self.start)])
            self.length = np.concatenate([self.length, np.empty_like(self.length)])
        self.flat[self.used:self.used + len(ids)] = ids
        self.start[codes] = self.used + np.cumsum(lengths) - lengths
        self.length[codes] = lengths
        self.used += len(ids)

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.length[codes]
        return self.flat[ragged(self.start[codes], lengths)], lengths


class WordEncoder:
    """Encodes each distinct word once and puts texts together from the words' ids.

    A byte-level vocabulary (``spaces="joined"``) ties one space to the word after it, and cuts before every space
    that stands between other characters; a vocabulary with word ends (``spaces="dropped"``) forgets white space.
    So both give the same ids for the parts between spaces as for the whole text. Texts where that does not hold
    (runs of white space in the first kind) are encoded whole. At most about ``limit`` words are remembered during a task; those
    that came up more than once, ``kept`` at most, are known to the worker's next tasks from the start.
    """

    def __init__(self, path: str, spaces: str, limit: int = 1_000_000, kept: int = 250_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = worker_state(f"tokenizer {path}", lambda: Tokenizer.from_file(path))
        self.joined, self.limit, self.kept = spaces == "joined", limit, kept
        self.frequent = worker_state(f"frequent words {path} {spaces}", dict)
        special = [(t.content, i) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special]
        self.mark, self.mark_id = special[-1] if special else ("", -1)
        self.model = self.tokenizer.model
        self.bytewise = self._spelled("Abc") and self._spelled("é")
        self.lowers = not self.joined and self._plain("ABC Qz") == self._plain("abc qz")
        self._clear()

    def _spelled(self, word: str) -> bool:
        """Does the model, given a word's bytes as characters, say what the whole tokenizer says?"""
        forms = (word, word.lower())
        return any([t.id for t in self.model.tokenize(f.encode().decode("latin-1").translate(BYTES))] == self._plain(word) for f in forms)

    def _clear(self) -> None:
        self.first, self.later = _Codes(self, ""), _Codes(self, " " if self.joined else "")
        self.n_codes, self.waiting, self.odd = 0, [], False
        self.words, self.marks, self.seen = _Ids(), {}, np.zeros(1 << 14, np.int64)
        if self.frequent:
            known, ids, sizes = (self.frequent[k] for k in ("words", "ids", "sizes"))
            self.later.update(zip(known, range(len(known))))
            self.n_codes = len(known)
            self.seen = np.zeros(max(len(known), 1 << 14), np.int64)
            self.words.put(np.arange(len(known)), ids, sizes)

    def keep(self) -> None:
        """Leave the words that came up again to later tasks, the most frequent ones if there are too many."""
        words, codes = list(self.later), np.fromiter(self.later.values(), np.int64, len(self.later))
        times = self.seen[codes] if self.seen.any() else codes * 0
        chosen = np.flatnonzero(times > 1)
        if not len(chosen):
            return
        if len(chosen) > self.kept:
            chosen = chosen[np.argsort(-times[chosen], kind="stable")[:self.kept]]
        ids, sizes = self.words.of(codes[chosen])
        self.frequent.update(words=[words[i] for i in chosen], ids=ids.copy(), sizes=sizes.copy())

    def _plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _letters(self, run: str) -> list[int]:
        """Ids of a run of letters, with or without a space before it: one pre-token, which the model takes as it is."""
        if self.lowers:
            run = run.lower()
        if not run.isascii():
            run = run.encode().decode("latin-1").translate(BYTES)
        elif run[0] == " ":
            run = BYTES[0x20] + run[1:]
        return [t.id for t in self.model.tokenize(run)]

    def _fast(self, unit: str) -> list[int] | None:
        """Ids of letters and the ASCII marks after them, which the tokenizer keeps apart; None for anything else."""
        found = MARKED.fullmatch(unit) if self.bytewise else None
        if found is None:
            return None
        letters, marks = found.groups()
        if not marks:
            return self._letters(letters)
        if marks not in self.marks:
            self.marks[marks] = self._plain(marks)
        return self._letters(letters) + self.marks[marks]

    def _spelled_units(self, units: list[str]) -> tuple[list[str], list[str]]:
        """Every unit's letters as the model takes them, and the marks after them; no letters if it is anything else, or ASCII letters alone."""
        runs, tails = [""] * len(units), [""] * len(units)
        if not self.bytewise:
            return runs, tails
        match = MARKED.fullmatch
        for n, unit in enumerate(units):
            if (not unit.isascii() or not unit[-1:].isalpha()) and (found := match(unit)):
                runs[n], tails[n] = found.groups()
        # spelled all at once; a space before the letters stands for itself, as no other is left in them
        shown = "\n".join(runs)
        shown = (shown.lower() if self.lowers else shown).encode().decode("latin-1").translate(_SPELLED)
        return shown.split("\n"), tails

    def _cut(self, text: str) -> list[str]:
        """The text cut at its line feeds, if all stand alone between other characters: words of their own to the tokenizer."""
        lines = text.split("\n")
        if len(lines) == 1 or any([not p or p[-1].isspace() or p[0].isspace() and n for n, p in enumerate(lines)]):
            return [text]
        return lines

    def _lines(self, unit: str) -> list[str]:
        """The unit cut in the same way, with the line feeds where they count."""
        lines = self._cut(unit)
        if len(lines) == 1 or not self.joined:
            return lines
        return [p for line in lines for p in (line, "\n")][:-1]

    def _learn(self) -> None:
        """Give every waiting word its ids."""
        units, self.waiting = self.waiting, []
        space, take, marks = BYTES[0x20] if self.joined else "", self.model.tokenize, self.marks
        for mark in ".,":
            marks.setdefault(mark, self._plain(mark))
        spelled, tails = self._spelled_units(units)
        ids, sizes, rest = [], [], []  # numbers and a few lists only: many small lists would keep the garbage collector busy
        for n, unit in enumerate(units):  # the usual words: ASCII letters, perhaps a full stop or comma after them
            spaced = self.joined and unit[:1] == " "
            word = unit[1:] if spaced else unit
            at = len(ids)
            tail = word[-1:] if word[-1:] in marks else ""
            run = word[:-1] if tail else word
            if self.bytewise and run.isascii() and run.isalpha():
                ids += [t.id for t in take((space if spaced else "") + (run.lower() if self.lowers else run))]
                if tail:
                    ids += marks[tail]
            elif spelled[n]:
                ids += [t.id for t in take(spelled[n])]
                tail = tails[n]
                if tail:
                    if tail not in marks:
                        marks[tail] = self._plain(tail)
                    ids += marks[tail]
            else:
                rest.append(n)
            sizes.append(len(ids) - at)
        first = self.n_codes - len(units)
        self.words.put(first + np.arange(len(units)), np.array(ids, np.uint32), np.array(sizes, np.int64))
        if rest:
            lines = [self._lines(units[n]) for n in rest]
            parts = {part: self._fast(part) for cut in lines for part in cut}
            slow = [part for part, own in parts.items() if own is None]
            parts |= zip(slow, self._slow(slow))
            found = [[i for part in cut for i in parts[part]] for cut in lines]
            self.words.put(first + np.array(rest), np.array(list(chain.from_iterable(found)), np.uint32),
                           np.array([len(f) for f in found], np.int64))

    def _slow(self, parts: list[str]) -> list[list[int]]:
        """Ids of parts by the whole tokenizer, many at a time with a special token between them."""
        out = []
        for at in range(0, len(parts), 2000):
            some = parts[at:at + 2000]
            joined = self.mark.join(some)
            if self.mark and joined.count("<|") == len(some) - 1:
                out.append([])
                for i in self._plain(joined):
                    if i == self.mark_id:
                        out.append([])
                    else:
                        out[-1].append(i)
            else:
                out += [self._plain(p) for p in some]
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has."""
        if self.n_codes > self.limit:
            self.keep()
            self._clear()
        codes, words, whole = [], [], {}
        for i, text in enumerate(texts):
            at = len(codes)
            for n, line in enumerate(self._cut(text)):
                parts = line.split(" ")
                if n and self.joined:
                    codes.append(self.first["\n"])
                codes.append(self.first[parts[0]])
                codes.extend(map(self.later.__getitem__, parts[1:]))
            if self.odd:
                del codes[at:]
                whole[i], self.odd = np.array(self._plain(text), np.uint32), False
            words.append(len(codes) - at)
        if self.waiting:
            self._learn()
        codes, words = np.array(codes, np.int64), np.array(words, np.int64)
        if self.n_codes > len(self.seen):
            self.seen = np.concatenate([self.seen, np.zeros(max(self.n_codes, len(self.seen)), np.int64)])
        self.seen[:self.n_codes] += np.bincount(codes, minlength=self.n_codes)[:self.n_codes]
        ids, lengths = self.words.of(codes)
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(words)]
        counts = np.diff(ends, prepend=0)
        if whole:
            out = np.split(ids, ends[:-1])
            for i, own in whole.items():
                out[i], counts[i] = own, len(own)
            ids = np.concatenate(out)
        return ids, counts
