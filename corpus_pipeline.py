"""Documents to training sequences: quality, repeated lines, near copies, benchmarks, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns the columns of
documents; the last returns pieces of sequences. Null and empty texts pass every filter that they
give no reason to fail: they have a quality score like others, no lines, no shingles and no words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lastword.llm import decontaminate, frames, jaccard, lines, packing, quality


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores at or above its threshold."""
    return quality.keep_good(docs, frames.table(spark, sf_dir, "labels"))


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that match an earlier one; documents of which nothing is left go."""
    return lines.without_repeats(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies."""
    return jaccard.keep_one(docs)


def no_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    return decontaminate.drop_contaminated(docs, frames.table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their places in as few sequences as possible."""
    return packing.pack(docs)


STAGES = [("quality", good_quality), ("lines", fresh_lines), ("near_copies", no_near_copies),
          ("benchmarks", no_benchmarks), ("packing", sequences)]
ORACLE_SQL = None  # tokenisers, learned rules and similarity joins are beyond SQL; tests hold brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents of a table folder, each written and read again."""
    docs = frames.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = frames.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
