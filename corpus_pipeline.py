"""From raw documents to packed windows, each stage on all that its predecessor kept.

Null and empty texts pass the filters as their operators define; the last two stages give them no words and an end token. Columns that
``documents`` has besides doc_id, text and source go along unread; n_chars follows the text. Empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.llm import jaccard, mixture, packing, passages, quality, runs
from foldwise.llm.common import Scratch, fresh, table
from foldwise.llm.queries import quality_model, vocabulary


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), "n_chars"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier rejects go."""
    name = fresh(docs, "_score")[0]
    scored = quality.score(docs, quality_model(docs, spark, sf_dir), name)
    return scored.where(F.col(name) >= 0.5).drop(name)


def keep_first_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group that shares four fifths of its shingles."""
    return jaccard.first_of_each(docs)


def remove_repeated_paragraphs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Paragraphs that repeat an earlier one go, then passages that do wherever they stand, and documents of which nothing is left."""
    return _measured(runs.remove(Scratch(spark).keep(passages.remove(docs), "paragraphs-removed")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target proportions: documents are repeated or cut as the schedule takes them."""
    return _measured(mixture.apply(docs))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of what is left in windows of 1024."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), "joined", end_id=0)


STAGES = [("quality classifier", keep_good), ("n-gram Jaccard join", keep_first_of_similar),
          ("substring dedup", remove_repeated_paragraphs), ("mixing sources", mix_sources), ("packing", pack_windows)]
#: The first stage scores by trained models, which SQL cannot express; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs
