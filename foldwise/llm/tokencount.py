"""Token counts of texts under a unigram model, without making the tokens.

A text's pre-tokens are its words, each with the mark of a word's beginning. The distinct pre-tokens of a batch are put in order, which
makes neighbours share their path in the trie of their characters: the best score and its number of tokens at a trie node are
computed once, from the nodes above it, and every pre-token below continues from there. The count at a pre-token's last node
is stored; texts add up the counts of their words. Of equally good ways the one with fewer tokens counts.

Characters that no piece covers cost a token per UTF-8 byte. Null and empty texts, and those without a word, have no tokens. Repeated
rows are counted each; very long texts and words are taken whole. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from foldwise.llm.common import only, pieces, short_batches, worker_state

MARK = "▁"
REMEMBERED = 1_000_000  # words whose counts a worker keeps, about
BYTE_PENALTY = 5.0  # how much less likely a fallback byte is than the least likely piece


class Unigram:
    """Scores of pieces, and the counts of all words seen."""

    def __init__(self, scores: dict[str, float]):
        self.scores, self.longest = scores, max(map(len, scores), default=1)
        self.byte = min(scores.values(), default=0.0) - BYTE_PENALTY
        self.counts: dict[str, int] = {}

    def learn(self, words: Iterable[str]) -> None:
        """Count pre-tokens along the trie: ``best[d]`` and ``least[d]`` belong to the first d characters of the last one."""
        score, byte, longest = self.scores.get, self.byte, self.longest
        best, least, last = [0.0], [0], ""
        for word in sorted(words):
            text = MARK + word
            depth, most = 0, min(len(text), len(last))
            while depth < most and text[depth] == last[depth]:
                depth += 1
            del best[depth + 1:], least[depth + 1:]
            for end in range(depth + 1, len(text) + 1):
                width = len(text[end - 1].encode("utf-8", "surrogatepass"))
                high, few = best[end - 1] + width * byte, least[end - 1] + width
                for start in range(max(0, end - longest), end):
                    own = score(text[start:end])
                    if own is not None:
                        value = best[start] + own
                        if value > high or value == high and least[start] + 1 < few:
                            high, few = value, least[start] + 1
                best.append(high)
                least.append(few)
            self.counts[word] = least[-1]
            last = text

    def count(self, texts: list[str]) -> tuple[list[int], list[int]]:
        """Words and tokens of each text."""
        if len(self.counts) > REMEMBERED:
            self.counts.clear()
        split = []
        for text in texts:
            for gap in "\t\n\v\f\r":
                text = text.replace(gap, " ")
            split.append(text.split(" "))
        new = set().union(*split) - self.counts.keys() - {""}
        self.learn(new)
        self.counts[""] = 0
        get = self.counts.__getitem__
        return [len(words) - words.count("") for words in split], [sum(map(get, words)) for words in split]


def zipf_scores(pieces_in_order: Iterable[str]) -> dict[str, float]:
    """Log probabilities of pieces that are listed from the most frequent on, by Zipf's law."""
    pieces_in_order = list(dict.fromkeys(pieces_in_order))
    whole = math.log(sum(1 / r for r in range(1, len(pieces_in_order) + 1))) if pieces_in_order else 0.0
    return {piece: -math.log(rank) - whole for rank, piece in enumerate(pieces_in_order, 1)}


def sentencepiece_scores(path: str) -> dict[str, float]:
    """The pieces of a vocabulary file, single characters included, without control and byte pieces, by rank."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size())
           if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return zipf_scores(model.id_to_piece(i) for i in ids)


def counts(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_words, n_tokens`` of ``docs(doc_id, text)`` for the vocabulary at ``path``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_state(f"unigram {path}", lambda: Unigram(sentencepiece_scores(path)))
        for batch in pieces(batches):
            words, tokens = model.count(batch.column("text").fill_null("").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                ["doc_id", "n_words", "n_tokens"])
    return short_batches(only(docs, doc_id="doc_id", text="text")).mapInArrow(run, "doc_id long, n_words long, n_tokens long")
