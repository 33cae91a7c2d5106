"""Fixed values of the record-state contract, and the session settings the engine needs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Wire constants, patterns and limits of the contract.
SCHEMA_VERSION = "record-state.v1"
SOURCE = "bluesky.jetstream.v2"
POST = "app.bsky.feed.post"
LIKE = "app.bsky.feed.like"
REPOST = "app.bsky.feed.repost"
COLLECTIONS = (POST, LIKE, REPOST)
ACCOUNT = "account"
SYNC = "sync"
OPERATIONS = ("create", "update", "delete")
DID_PATTERN = "did:[a-z]+:[a-zA-Z0-9._:%-]{1,2048}"
RECORD_KEY_PATTERN = "[a-zA-Z0-9._:~-]{1,512}"
TID_PATTERN = "[2-7a-j][2-7a-z]{12}"
EVENT_ID_PATTERN = "[0-9a-f]{64}"
SEQ_DIGITS = 20
ACTIVITY_PREFIX = "~act#"
ACTIVITY_DIGITS = 14
ACTIVITY_HORIZON_MS = 99_999_999_999_999
ACTIVITY_WINDOW_MS = 60 * 60 * 1000
ACTIVITY_ID_CHARS = 12
DEFAULT_LIMIT = 50
MAX_LIMIT = 200
STATE_TTL_MS = 3 * 24 * 60 * 60 * 1000
LOG_RETENTION_MS = 3 * 24 * 60 * 60 * 1000
TRACE_CANDIDATES = 10
TOPIC_SAMPLE = 300
SERVED_SAMPLE = 20
PREVIEW_CHARS = 160

# Scale knobs, all ours. One window group never holds more than CHUNK_ROWS rows, and one
# account never lands in fewer than ACCOUNT_SALTS shuffle buckets.
CHUNK_ROWS = 1 << 20
SLOT_MS = 60_000  # the same for an order that starts with a time: a group holds what a key gets in a slot
ACCOUNT_SALTS = 16
STATE_BUCKETS = 256


def configure(spark: SparkSession) -> SparkSession:
    """Sets the few session options whose defaults would change a result or hurt a skewed plan."""
    for name, value in {
        "spark.sql.session.timeZone": "UTC",
        # A repeated JSON field keeps its last value instead of failing the message.
        "spark.sql.variant.allowDuplicateKeys": "true",
        # Generated methods above this size are never compiled by the JVM; smaller pieces are.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def stateful_conf() -> dict[str, str]:
    """Options for the keyed-state queries: disk state, incremental checkpoints, no idle batches."""
    return {
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    }
