"""TF-IDF in long form: sublinear counts, smoothed idf, unit rows.

The vocabulary is counted where the texts lie, rare terms by hashed slots
(``topterms``). For the weights, texts are hash-partitioned by row id; listed
terms are found and weighed by chunks of texts (``grams``). Texts that share an
id are counted, weighed and collected inside that partitioning.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from foldwise import fixed
from foldwise.functions import text as X
from foldwise.operators.grams import CHAR_WORDS, KnownChars, KnownWords, counted, counted_chars
from foldwise.operators.topterms import top_terms
from foldwise.scratch import fitted, written


CELLS = "array<struct<i:int,w:double>>"


@dataclass(frozen=True)
class Block:
    """One kind of n-grams and its vocabulary limits."""

    name: str
    kind: str
    low: int
    high: int
    max_features: int
    min_df: int

    def counts(self, df: DataFrame, id_col: str, text: str) -> DataFrame:
        """``(id, term, tf)`` of texts that are partitioned by ``id_col``."""
        filled = F.coalesce(F.col(text), F.lit(""))
        if self.kind == "char":  # runs stay inside words: cut each distinct word of a text once
            words = (df.select(id_col, F.explode(X.spaced_words(F.lower(filled))).alias("w"))
                     .groupBy(id_col, "w").agg(F.count(F.lit(1)).alias("c"))
                     .select(id_col, X.pad(F.col("w")).alias("w"), "c"))
            terms = words.select(id_col, "c", F.explode(X.word_grams(F.col("w"), self.low, self.high)).alias("term"))
            return terms.groupBy(id_col, "term").agg(F.sum("c").alias("tf"))
        tokens = df.select(id_col, X.word_tokens(filled).alias("__t"))
        terms = tokens.select(id_col, F.explode(X.grams("__t", self.low, self.high)).alias("term"))
        return terms.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))

    def tokens(self, text: str) -> Column:
        """What n-grams are made of: the words of a text, null counts as empty."""
        filled = F.coalesce(F.col(text), F.lit(""))
        return X.spaced_words(F.lower(filled)) if self.kind == "char" else X.word_tokens(filled)

    def occurrences(self, df: DataFrame, id_col: str, text: str, unique: bool = False) -> DataFrame:
        """``(term, tf, df)`` whose sums by term are its occurrences and its rows, counted by chunks of texts; runs of characters of texts
        that share an id are those of one row, unless ids are ``unique``."""
        if self.kind != "char":
            return counted(df, self.tokens(text), self.low, self.high)
        if unique:
            return counted_chars(df.select(id_col, text).repartition(id_col), self.tokens(text), self.low, self.high)
        return term_counts(df, id_col, text, self).select("term", "tf", F.lit(1).alias("df"))

    def known(self, terms: Sequence[str]) -> KnownWords | KnownChars:
        return KnownChars(terms, self.low, self.high) if self.kind == "char" else KnownWords(terms)


WORDS = Block("word", "word", *fixed.WORD_GRAMS, fixed.WORD_MAX_FEATURES, fixed.WORD_MIN_DF)
CHARS = Block("char", "char", *fixed.CHAR_GRAMS, fixed.CHAR_MAX_FEATURES, fixed.CHAR_MIN_DF)
PROFILE_WORDS = Block("word", "word", *fixed.PROFILE_GRAMS, fixed.PROFILE_MAX_FEATURES,
                      fixed.WORD_MIN_DF)


def term_counts(df: DataFrame, id_col: str, text: str, block: Block) -> DataFrame:
    """``(id, term, tf)``."""
    return block.counts(df.select(id_col, text).repartition(id_col), id_col, text)


def ids_unique(df: DataFrame, id_col: str) -> tuple[int, bool]:
    """Number of rows, and whether every row has an id of its own."""
    n, known, different = df.agg(F.count(F.lit(1)), F.count(id_col), F.count_distinct(F.col(id_col))).first()
    return n, n == known == different


def vocabulary(df: DataFrame, id_col: str, text: str, block: Block, n_rows: int, unique: bool = False) -> DataFrame:
    """The most frequent terms that occur in enough rows, numbered in term order."""
    totals = top_terms(df, id_col, lambda rows: block.occurrences(rows, id_col, text, unique),
                       block.max_features, block.min_df, n_rows)
    ids = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("term"))  # max_features rows
    return totals.select("term", (ids - 1).alias("term_id"), "df",
                         (F.log(F.lit(1.0 + n_rows) / (1 + F.col("df"))) + 1).alias("idf"))


@dataclass
class Vectoriser:
    """Vocabularies of one or more blocks, fitted on the training texts."""

    blocks: Sequence[Block]
    tables: Sequence[DataFrame]
    sizes: Sequence[int]

    @property
    def width(self) -> int:
        return sum(self.sizes)

    def cells(self, df: DataFrame, id_col: str, text: str) -> DataFrame:
        """One row per text: its term ids and unit-length weights per block, stacked.

        Texts with ids of their own are weighed by chunks where they lie; texts that share an id are one text, its terms are summed first.
        """
        if ids_unique(df, id_col)[1]:
            tokens = [b.tokens(text).alias(f"t{i}") for i, b in enumerate(self.blocks)]
            schema = StructType([df.schema[id_col], *df.limit(0).select(F.array().cast(CELLS).alias("cells")).schema])
            return df.select(id_col, text).repartition(id_col).select(id_col, *tokens).mapInArrow(self._weigher(), schema)
        parts, offset = [], 0
        for block, table, size in zip(self.blocks, self.tables, self.sizes):
            known = term_counts(df, id_col, text, block).join(
                table.select("term", "term_id", "idf"), "term")
            weight = (1 + F.log(F.col("tf").cast("double"))) * F.col("idf")
            weighted = known.select(id_col, (F.col("term_id") + offset).alias("i"), weight.alias("w"))
            rows = weighted.groupBy(id_col).agg(
                F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"),
                F.collect_list(F.struct("i", "w")).alias("c"))
            parts.append(rows.select(id_col, F.transform("c", lambda x: F.struct(
                x["i"].alias("i"), (x["w"] / F.col("norm")).alias("w"))).alias(f"c_{block.name}")))
            offset += size
        out = df.select(id_col).repartition(id_col)
        empty = F.array().cast(CELLS)
        for part in parts:
            out = out.join(part, id_col, "left")
        cells = F.concat(*[F.coalesce(F.col(f"c_{b.name}"), empty) for b in self.blocks])
        return out.select(id_col, F.array_sort(cells).alias("cells"))

    def _weigher(self) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """``(id, tokens of each block)`` to ``(id, cells)``. The terms reach the driver and every task: each block bounds their number."""
        listed = [table.orderBy("term_id").select("term", "idf").toPandas() for table in self.tables]
        known = [block.known(t["term"].tolist()) for block, t in zip(self.blocks, listed)]
        idf, offsets = [t["idf"].to_numpy(float) for t in listed], np.cumsum([0, *self.sizes])

        def weighed(batch: pa.RecordBatch) -> pa.RecordBatch:
            parts = []
            for b, find in enumerate(known):
                lists, terms = batch.column(b + 1), max(len(idf[b]), 1)
                row, term, times = find.find(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten())
                keys, of = np.unique(row * terms + term, return_inverse=True)
                row, term = np.divmod(keys, terms)
                w = (1 + np.log(np.bincount(of, times, len(keys)))) * idf[b][term]
                norm = np.sqrt(np.bincount(row, w * w, batch.num_rows))
                parts.append((row, term + offsets[b], w / norm[row]))
            row, term, w = (np.concatenate(c) for c in zip(*parts))
            order = row.argsort(kind="stable")  # blocks follow each other inside a row
            cells = pa.StructArray.from_arrays([pa.array(term[order], pa.int32()), pa.array(w[order])], ["i", "w"])
            ends = np.r_[0, np.bincount(row, minlength=batch.num_rows).cumsum()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), cells)],
                                              [batch.schema.names[0], "cells"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                words = sum(pc.list_value_length(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[1:])
                ends, at = np.r_[0, np.cumsum(words)], 0
                while at < batch.num_rows:
                    to = max(at + 1, int(np.searchsorted(ends, ends[at] + CHAR_WORDS, "right")) - 1)
                    yield weighed(batch.slice(at, to - at))
                    at = to
        return run

    def long(self, df: DataFrame, id_col: str, text: str) -> DataFrame:
        """``(id, term_id, weight)``."""
        return (self.cells(df, id_col, text).select(id_col, F.explode("cells").alias("c"))
                .select(id_col, F.col("c.i").alias("term_id"), F.col("c.w").alias("weight")))

    def vectors(self, df: DataFrame, id_col: str, text: str, out: str = "features") -> DataFrame:
        """Sparse ML vectors, one per text."""
        return to_vectors(self.cells(df, id_col, text), self.width, out)

    def terms(self) -> DataFrame:
        parts, offset = [], 0
        for block, table, size in zip(self.blocks, self.tables, self.sizes):
            parts.append(table.select(F.lit(block.name).alias("block"), "term",
                                      (F.col("term_id") + offset).alias("term_id"), "df", "idf"))
            offset += size
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


def fit_vectoriser(df: DataFrame, id_col: str, text: str,
                   blocks: Sequence[Block] = (WORDS, CHARS)) -> Vectoriser:
    n, unique = ids_unique(df, id_col)
    tables = []
    for block in blocks:
        tables.append(fitted(vocabulary(df, id_col, text, block, n, unique)))
    return Vectoriser(list(blocks), tables, [t.count() for t in tables])


def to_vectors(cells: DataFrame, width: int, out: str = "features") -> DataFrame:
    """Sparse ML vectors, stored once: the learners read them many times.

    The cells are written in the storage layout of a sparse vector and read
    back as vectors, so no row passes through Python.
    """
    keep = [f for f in cells.schema if f.name != "cells"]
    stored = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(width).alias("size"),
                      F.col("cells.i").alias("indices"), F.col("cells.w").alias("values"))
    schema = StructType([*keep, StructField(out, VectorUDT())])
    return written(cells.select(*[f.name for f in keep], stored.alias(out)), schema)
