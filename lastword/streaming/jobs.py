"""The two streaming jobs: feed to log, and log to accepted updates."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from lastword.functions.instants import floor_div
from lastword import model, settings as S
from lastword.operators import accounts, activity as act, ingest as ing
from lastword.operators.newest import newest
from lastword.sources.tables import Store
from lastword.streaming.newest import updates

INTERVAL = "0 seconds"  # the next batch starts when the last one ends, so no rate is capped
HOUR_MS = 3_600_000
_PURGES = T.StructType([T.StructField("did", T.StringType()),
                        T.StructField("purge_seq", T.LongType())])
_ENTRIES = T.StructType([T.StructField("activity_key", T.StringType()),
                         T.StructField("received_ms", T.LongType()),
                         T.StructField("row_key", T.StringType()),
                         T.StructField("hour", T.LongType())])


def publish(store: Store, feed: DataFrame, batch: int, run: str = "main") -> None:
    """One ingest batch: records and quarantine first, the commit row with the cursor last.

    Any failure raises before the commit row exists, so the batch stays invisible and its replay
    overwrites what was written. The cursor moves only with the commit. Batch numbers belong to a
    run, which is one checkpoint: only a batch that the same run has committed is skipped, and a
    renewed checkpoint, which counts from 0 again, appends to what other runs have left.
    """
    done, cursor = store.last_commit()
    last_run, run_batch = store.last_run()
    if last_run == run and batch <= run_batch:
        return
    number = done + 1
    judged = ing.judge(feed).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        store.write_batch("records", ing.records(judged), number)
        store.write_batch("quarantine", ing.quarantine(judged), number)
        row = ing.counters(judged, cursor).withColumns(
            {"run": F.lit(run), "run_batch": F.lit(batch).cast("bigint")})
        store.commit(row.select(*model.COMMIT.fieldNames()[1:]), number)
    finally:
        judged.unpersist()


def route(store: Store, accepted: DataFrame, run: str, batch: int) -> None:
    """One batch of accepted updates to its three tables, each a folder that a replay overwrites.

    Purging events raise the account's boundary, every event but a resync leaves a state row and an
    activity entry. The batch is read once. A commit row comes last: readers see all three tables
    of a batch or none, and a batch that is committed is not written again.
    """
    if store.routed(run, batch):
        return
    rows = accepted.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        store.write_run("purges", accounts.purge_boundary(rows), run, batch)
        store.write_run("accepted", rows.filter(F.col("entity_type") != S.SYNC), run, batch)
        hour = floor_div(F.col("received_ms"), HOUR_MS)
        entries = act.activity_rows(rows).withColumn("hour", hour)
        store.write_run("activity", entries.sortWithinPartitions("hour"), run, batch)
        store.commit_run(run, batch)
    finally:
        rows.unpersist()


def _start(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, name: str,
           once: bool) -> StreamingQuery:
    writer = (stream.writeStream.queryName(name).option("checkpointLocation", checkpoint)
              .outputMode("update").foreachBatch(work))
    return (writer.trigger(availableNow=True) if once
            else writer.trigger(processingTime=INTERVAL)).start()


def run_id(store: Store, checkpoint: str) -> str:
    """The id that Spark gave the query of a checkpoint; a renewed checkpoint has another."""
    return json.loads(store.spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def start_ingest(store: Store, feed: DataFrame, once: bool = False) -> StreamingQuery:
    """Feed to records and quarantine. The checkpoint lives in the store and names the run."""
    place = store.path("_checkpoints/ingest")
    return _start(feed, lambda rows, batch: publish(store, rows, batch, run_id(store, place)),
                  place, "ingest", once)


def start_current_state(store: Store, log: DataFrame, run: str = "main", once: bool = False,
                        initial: DataFrame | None = None) -> StreamingQuery:
    """Log to accepted updates. A job with another source is another run; it takes the saved state
    of the old one as `initial`. Needs the options of `settings.stateful_conf`."""
    place = run_checkpoint(store, run)
    return _start(updates(log, initial),
                  lambda rows, batch: route(store, rows, f"{run}-{run_id(store, place)}", batch),
                  place, f"current-state-{run}", once)


def run_checkpoint(store: Store, run: str) -> str:
    return store.path(f"_checkpoints/current-state/{run}")


def served_state(store: Store) -> DataFrame:
    """What the routed tables serve: newest accepted row per key, behind purges and status."""
    rows = store.read_runs("accepted", model.RECORDS_LOG).drop("batch")
    purges = (store.read_runs("purges", _PURGES).groupBy("did")
              .agg(F.max("purge_seq").alias("purge_seq")))
    return accounts.visible(newest(rows), accounts.guards(accounts.account_status(rows), purges))


def recent_entries(store: Store, as_of_ms: int, limit: int = S.DEFAULT_LIMIT,
                   window_ms: int = S.ACTIVITY_WINDOW_MS) -> DataFrame:
    """Newest entries of the stored activity index. Files are sorted by hour, so the hour bound
    reaches the scan and skips what is older."""
    first_hour = (as_of_ms - window_ms) // HOUR_MS
    rows = store.read_runs("activity", _ENTRIES).filter(F.col("hour") >= first_hour)
    entries = act.latest_write(rows.withColumnRenamed("batch", "offset")).drop("offset")
    return act.recent(entries, as_of_ms, limit, window_ms)
