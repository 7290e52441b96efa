"""Frequent words, and words of high against low rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.functions import text as X
from foldwise.operators.grams import counted
from foldwise.operators.topterms import top_terms


def occurrences(df: DataFrame, text: str, low: int = 1, high: int = 1, keep: Sequence[str] = (),
                stop: Sequence[str] = ()) -> DataFrame:
    """One row per n-gram occurrence; stop words leave before runs are formed."""
    made = df.select(*keep, _tokens(text, stop).alias("__t"))
    return made.select(*keep, F.explode(X.grams("__t", low, high)).alias("term"))


def _tokens(text: str, stop: Sequence[str]) -> Column:
    tokens = X.word_tokens(F.coalesce(F.col(text), F.lit("")))
    return F.filter(tokens, lambda w: ~w.isin(list(stop))) if stop else tokens


def frequent_terms(df: DataFrame, text: str, top: int, low: int = 1, high: int = 1,
                   stop: Sequence[str] = ()) -> DataFrame:
    made = top_terms(df, text, lambda rows: counted(rows, _tokens(text, stop), low, high).select("term", "tf", F.col("tf").alias("df")), top)
    return made.select("term", F.col("df").alias("n")).orderBy(F.col("n").desc(), "term")


def contrast_terms(df: DataFrame, text: str, high_side: Column, min_count: int = 5,
                   stop: Sequence[str] = ()) -> DataFrame:
    """Smoothed log-odds of every word on the high side against the low side."""
    sided = df.where(high_side.isNotNull()).withColumn("__h", high_side.cast("int"))
    counts = (occurrences(sided, text, keep=["__h"], stop=stop).groupBy("term")
              .agg(F.sum("__h").alias("n_high"), F.sum(1 - F.col("__h")).alias("n_low")))
    totals = counts.agg(F.sum("n_high").alias("h"), F.sum("n_low").alias("l")).first()
    odds = lambda c, t: F.log((F.col(c) + 0.5) / (F.lit(float(t or 0)) - F.col(c) + 0.5))
    return (counts.where(F.col("n_high") + F.col("n_low") >= min_count)
            .withColumn("log_odds", odds("n_high", totals["h"]) - odds("n_low", totals["l"])))
