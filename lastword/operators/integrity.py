"""Reconciliation of what was published, stored and served."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lastword import settings as S


def identities(log: DataFrame) -> DataFrame:
    """One row per event id with its copies and the range of source events it stands for."""
    origin = F.struct("source", "source_seq")
    return log.groupBy("event_id").agg(F.count(F.lit(1)).alias("copies"),
                                       F.min(origin).alias("first_origin"),
                                       F.max(origin).alias("last_origin"))


def identity_collisions(log: DataFrame) -> DataFrame:
    """Event ids that cover more than one source event. There must be none."""
    return (identities(log).filter(F.col("first_origin") < F.col("last_origin"))
            .select("event_id", "copies"))


def stored_counts(log: DataFrame) -> DataFrame:
    """One row: stored rows, distinct identities, redelivered rows, identity collisions."""
    return identities(log).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("stored"),
        F.count(F.lit(1)).alias("distinct_ids"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("redelivered"),
        F.count_if(F.col("first_origin") < F.col("last_origin")).alias("collisions"))


def stored_vs_published(log: DataFrame, counters: DataFrame, restart_offset: int) -> DataFrame:
    """One row: the log holds at least what was published, and grew past the restart cursor."""
    none = F.lit(None).cast("bigint")
    before = F.max(F.when(F.col("offset") < restart_offset, F.col("source_seq")))
    stored = log.agg(F.count(F.lit(1)).alias("stored"),
                     F.coalesce(before, F.lit(-1).cast("bigint")).alias("committed_before"),
                     F.coalesce(F.max("source_seq"), F.lit(-1).cast("bigint"))
                     .alias("committed_after")).withColumn("published", none)
    published = counters.select("published", none.alias("stored"), none.alias("committed_before"),
                                none.alias("committed_after"))
    both = stored.unionByName(published).agg(*[F.max(c).alias(c) for c in stored.columns])
    return both.select("published", "stored", (F.col("stored") >= F.col("published")).alias(
        "complete"), "committed_before", "committed_after",
        (F.col("committed_after") > F.col("committed_before")).alias("progressed"))


def topic_sample(log: DataFrame, entity_type: str = S.POST, first: int = S.TOPIC_SAMPLE,
                 keep: int = S.SERVED_SAMPLE) -> DataFrame:
    """The first `keep` rows of one type among the first `first` rows of the log (two top-k)."""
    head = log.orderBy("offset").limit(first)
    return head.filter(F.col("entity_type") == entity_type).orderBy("offset").limit(keep)


def preview(quarantined: DataFrame, chars: int = S.PREVIEW_CHARS) -> DataFrame:
    """Quarantined messages with their text cut for display; the stored text stays whole."""
    return quarantined.withColumn("preview", F.substring("raw", 1, chars))
