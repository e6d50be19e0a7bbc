"""The training-text pipeline: stages applied to ``documents`` one after the other.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next one's ``docs``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.llm import decontaminate, jaccard, lines, packing, quality
from tidemart.llm.common import saved, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go, and documents of which nothing is left; ``n_chars`` follows the text."""
    left = lines.drop_repeated_chunks(docs)
    emptied = (F.col("n_removed_lines") > 0) & ~F.col("text").rlike(r"\S")
    left = left.filter(~emptied)
    n_chars = F.when(F.col("n_removed_lines") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return left.withColumn("n_chars", n_chars).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays."""
    return jaccard.first_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences, with their ids."""
    return packing.pack(docs)


STAGES = [("quality classifier", quality_classifier), ("line dedup", line_dedup), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", decontamination), ("packing", packed)]

# The classifier's regression, the links and the tiles have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = docs if k == len(STAGES) - 1 else saved(docs)
    return docs
