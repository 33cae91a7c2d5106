"""Schemas of the raw feed, the contract event and the tables derived from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

EVENT = T.StructType([
    T.StructField("schema_version", T.StringType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("source_seq", T.LongType()),
    T.StructField("entity_type", T.StringType()),
    T.StructField("entity_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("revision", T.StringType()),
    T.StructField("event_time", T.StringType()),
    T.StructField("received_at", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("subject", T.StringType()),
])
EVENT_FIELDS = EVENT.fieldNames()

# Raw message text with its receive instant; `offset` is the arrival order and is unique.
FEED = T.StructType([
    T.StructField("offset", T.LongType()),
    T.StructField("raw", T.StringType()),
    T.StructField("received_at", T.StringType()),
])

RECORDS_LOG = T.StructType(
    [T.StructField("offset", T.LongType()),
     T.StructField("row_key", T.StringType()),
     T.StructField("did", T.StringType())] + EVENT.fields)
LOG_FIELDS = RECORDS_LOG.fieldNames()

# Arrival over several partitions of a topic: offsets repeat there, the three together do not.
ARRIVAL = ("arrived_ms", "partition", "offset")


def order_of(columns: Sequence[str]) -> tuple[str, ...]:
    """The columns that say in which order rows with these columns arrived."""
    return ARRIVAL if set(ARRIVAL) <= set(columns) else ("offset",)

QUARANTINE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("raw", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("received_at", T.StringType()),
])

# Bookkeeping row of one committed ingest batch.
COMMIT = T.StructType([
    T.StructField("batch", T.LongType()),
    T.StructField("cursor", T.LongType()),
    T.StructField("received", T.LongType()),
    T.StructField("received_bytes", T.LongType()),
    T.StructField("published", T.LongType()),
    T.StructField("identity_skipped", T.LongType()),
    T.StructField("quarantined", T.LongType()),
    T.StructField("run", T.StringType()), T.StructField("run_batch", T.LongType())])
