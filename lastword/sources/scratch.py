"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, the one set on the context, or else the warehouse:
    all of them are seen by the driver and by every executor."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    set_by_hand = spark.sparkContext._jsc.sc().getCheckpointDir()
    return named or (set_by_hand.get() if set_by_hand.isDefined() else spark.conf.get("spark.sql.warehouse.dir"))


def cut(rows: DataFrame, name: str) -> DataFrame:
    """`rows` as a written table: what reads it several times computes it once, and a lost executor
    takes nothing of it along. Ends the lineage."""
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
