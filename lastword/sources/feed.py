"""Where raw messages and log lines come from, batch or streaming, and the capture sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lastword import model, settings as S
from lastword.functions import contract, keys


def landing(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Streaming feed from JSON files of (offset, raw, received_at), a bounded batch at a time."""
    reader = S.configure(spark).readStream.schema(model.FEED)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(folder)


def kafka_options(servers: str, topic: str, max_rows: int | None = None) -> dict[str, str]:
    """Records topic from its beginning, committed transactions only. A batch takes all there is
    unless `max_rows` bounds it; a bound must be above the feed's rate times a batch's seconds."""
    bound = {"maxOffsetsPerTrigger": str(max_rows)} if max_rows else {}
    return {"kafka.bootstrap.servers": servers, "subscribe": topic,
            "startingOffsets": "earliest", "kafka.isolation.level": "read_committed", **bound}


def kafka_feed(spark: SparkSession, servers: str, topic: str,
               max_rows: int | None = None) -> DataFrame:
    """Raw feed rows from a Kafka topic (needs the Kafka connector on the class path), with the
    columns of their arrival."""
    stream = S.configure(spark).readStream.format("kafka").options(
        **kafka_options(servers, topic, max_rows)).load()
    stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return stream.select(*arrival(), F.col("value").cast("string").alias("raw"),
                         stamp.alias("received_at"))


def arrival() -> list[Column]:
    """Where a Kafka row stands in a topic of several partitions: time, partition, offset."""
    return [F.unix_millis("timestamp").alias("arrived_ms"), F.col("partition"), F.col("offset")]


def kafka_lines(spark: SparkSession, servers: str, topic: str,
                max_rows: int | None = None) -> DataFrame:
    """Contract lines of the records topic."""
    stream = S.configure(spark).readStream.format("kafka").options(
        **kafka_options(servers, topic, max_rows)).load()
    return stream.select(*arrival(), F.col("value").cast("string").alias("value"))


def log_lines(lines: DataFrame) -> DataFrame:
    """Log rows from contract lines. A line that is no valid event fails the job: on this side of
    the topic nothing malformed may exist. Arrival columns stay where the lines have them."""
    parsed = contract.parse_lines(lines, "value")
    kind, ident = F.col("entity_type"), F.col("entity_id")
    fail = F.raise_error(F.concat(F.lit("invalid record line: "), F.col("reason")))
    checked = F.when(F.col("reason").isNotNull(), fail.cast("string")).otherwise(
        keys.row_key(kind, ident))
    return parsed.select(*model.order_of(lines.columns), checked.alias("row_key"),
                         keys.owner(kind, ident).alias("did"), *model.EVENT_FIELDS)


def kafka_records(log: DataFrame) -> DataFrame:
    """Log rows as Kafka records: row key and contract line, all in one partition's order."""
    return log.select(F.col("row_key").alias("key"), contract.event_json().alias("value"))


def kafka_quarantine(rows: DataFrame) -> DataFrame:
    """Quarantine rows as Kafka records: digest, whole message, the reason in a header."""
    header = F.struct(F.lit("reason").alias("key"), F.encode("reason", "UTF-8").alias("value"))
    return rows.select("key", F.col("raw").alias("value"), F.array(header).alias("headers"))


def write_capture(capture: DataFrame, folder: str) -> None:
    """Body-free capture as gzipped newline-delimited JSON."""
    capture.write.mode("overwrite").option("compression", "gzip").json(folder)
