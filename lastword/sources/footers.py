"""The tail of a stored log from the statistics in its Parquet footers, without reading a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def pushing(spark: SparkSession) -> SparkSession:
    """A session of its own in which min, max and count of whole files are answered by their footers.
    The caller's options stay as they are."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def highest(spark: SparkSession, folder: str, column: str) -> DataFrame:
    """One row `highest`: the largest value of an integer column, null when the folder holds no rows."""
    return pushing(spark).read.parquet(folder).agg(F.max(column).alias("highest"))


def resume_cursor(spark: SparkSession, folder: str) -> int:
    """Highest committed sequence of a stored records log, -1 when it is empty."""
    top = highest(spark, folder, "source_seq").first()["highest"]
    return -1 if top is None else top
