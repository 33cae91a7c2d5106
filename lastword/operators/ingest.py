"""Raw messages to records, quarantine rows, counters and the resume cursor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lastword import model
from lastword.functions import keys, messages


def judge(feed: DataFrame) -> DataFrame:
    """Feed rows plus `seq`, `kind`, the event fields and `reason`: one parse, no row lost."""
    return messages.mapped(messages.parsed(feed))


def records(judged: DataFrame) -> DataFrame:
    """Valid events as log rows. Identity messages change no record and are left out."""
    valid = judged.filter(F.col("reason").isNull() & (F.col("kind") != messages.IDENTITY))
    kind, ident = F.col("entity_type"), F.col("entity_id")
    rows = valid.select("offset", keys.row_key(kind, ident).alias("row_key"),
                        keys.owner(kind, ident).alias("did"), *model.EVENT_FIELDS)
    return messages.closed(rows)


def quarantine(judged: DataFrame) -> DataFrame:
    """Malformed messages, whole, under the digest of their text."""
    return judged.filter(F.col("reason").isNotNull()).select(
        F.sha2(F.col("raw"), 256).alias("key"), "raw", "reason", "received_at")


COUNTED = ("received", "received_bytes", "published", "identity_skipped", "quarantined")


def counter_columns(cursor: int = -1) -> list[Column]:
    """Aggregates over judged rows: what was received and where it went, and the cursor after it.

    A quarantined or skipped message with a readable sequence still moves the cursor.
    """
    bad = F.col("reason").isNotNull()
    identity = ~bad & (F.col("kind") == messages.IDENTITY)
    return [
        F.count(F.lit(1)).alias("received"),
        F.coalesce(F.sum(F.octet_length("raw").cast("bigint")), F.lit(0)).alias("received_bytes"),
        F.count_if(~bad & ~F.coalesce(identity, F.lit(False))).alias("published"),
        F.count_if(identity).alias("identity_skipped"),
        F.count_if(bad).alias("quarantined"),
        F.greatest(F.lit(cursor).cast("bigint"),
                   F.coalesce(F.max("seq"), F.lit(-1))).alias("cursor")]


def counters(judged: DataFrame, cursor: int = -1) -> DataFrame:
    """One row: the counters of a batch and the cursor after it."""
    return judged.agg(*counter_columns(cursor))


def resume_cursor(log: DataFrame) -> DataFrame:
    """Highest committed sequence of the records log, -1 when it is empty."""
    return log.agg(F.coalesce(F.max("source_seq"), F.lit(-1).cast("bigint")).alias("cursor"))


def resumable(messages_: DataFrame, cursor: int, collections: list[str]) -> DataFrame:
    """What a reconnect at `cursor` delivers: the cursor is inclusive, a negative one means live
    data only and filters nothing; the collection filter concerns commits alone."""
    wanted = (F.col("kind") != "commit") | F.col("collection").isin(*collections)
    return messages_.filter(wanted if cursor < 0 else (F.col("seq") >= cursor) & wanted)
