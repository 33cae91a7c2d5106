"""Recent activity: which rows were touched, newest first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from lastword import settings as S
from lastword.functions import keys
from lastword.functions.instants import instant_millis
from lastword.operators.newest import accepted

ENTRY = "activity_key string, received_ms bigint, row_key string"
AHEAD = 4  # candidates looked at for each entry asked for, at first
MOST_CANDIDATES = 3_200  # beyond so many, all candidates of the window are judged at once


def activity_rows(accepted_log: DataFrame) -> DataFrame:
    """One index row per accepted event; resyncs leave none. A repeated write replaces its row."""
    rows = (accepted_log.filter(F.col("entity_type") != S.SYNC)
            .select(keys.activity_key(F.col("received_at"), F.col("event_id"))
                    .alias("activity_key"),
                    instant_millis(F.col("received_at")).alias("received_ms"),
                    "row_key", "offset"))
    return latest_write(rows).drop("offset")


def latest_write(rows: DataFrame) -> DataFrame:
    last = F.max_by(F.struct("received_ms", "row_key", "offset"), "offset")
    return (rows.groupBy("activity_key").agg(last.alias("_w"))
            .select("activity_key", "_w.received_ms", "_w.row_key", "_w.offset"))


def in_window(received_ms: Column, as_of_ms: int, window_ms: int = S.ACTIVITY_WINDOW_MS) -> Column:
    """Closed lower bound only: an entry from the future counts as recent."""
    return received_ms >= F.lit(as_of_ms - window_ms)


def recent(index: DataFrame, as_of_ms: int, limit: int = S.DEFAULT_LIMIT,
           window_ms: int = S.ACTIVITY_WINDOW_MS) -> DataFrame:
    """The newest `limit` index rows of the window (a top-k, at most 200 rows)."""
    return (index.filter(in_window(F.col("received_ms"), as_of_ms, window_ms))
            .orderBy("activity_key").limit(clamped(limit)))


def clamped(limit: int) -> int:
    return min(max(limit, 1), S.MAX_LIMIT)


def candidates(log: DataFrame, as_of_ms: int, window_ms: int) -> DataFrame:
    """Log rows of the window that become index rows if they were accepted."""
    received = instant_millis(F.col("received_at"))
    return (log.filter((F.col("entity_type") != S.SYNC) & in_window(received, as_of_ms, window_ms))
            .select(keys.activity_key(F.col("received_at"), F.col("event_id")).alias("activity_key"),
                    received.alias("received_ms"), "row_key", "revision", "offset"))


def window_index(log: DataFrame, as_of_ms: int, window_ms: int = S.ACTIVITY_WINDOW_MS) -> DataFrame:
    """All index rows of the window. Only rows of keys that were touched in it are judged: the time
    filter comes first, a semi-join brings the earlier rows of those keys."""
    touched = candidates(log, as_of_ms, window_ms).select("row_key").distinct()
    index = activity_rows(accepted(log.join(touched, "row_key", "left_semi")))
    return index.filter(in_window(F.col("received_ms"), as_of_ms, window_ms))


def accepted_among(log: DataFrame, rows: list[Row]) -> list[Row]:
    """Those of a few log rows that were newer than everything that had arrived for their keys.

    Every row of their keys counts for the next of them that arrived after it, so the log is reduced to one
    maximum per given row before anything is shuffled, however hot a key is.
    """
    places: dict[str, list[int]] = {}
    for row in rows:
        places.setdefault(row["row_key"], []).append(row["offset"])
    table = log.sparkSession.createDataFrame(
        [(key, sorted(found)) for key, found in places.items()], "row_key string, places array<bigint>")
    later = F.filter("places", lambda place: place > F.col("offset"))
    earlier = (log.select("row_key", "offset", "revision").join(F.broadcast(table), "row_key")
               .select("row_key", F.try_element_at(later, F.lit(1)).alias("upto"), "revision")
               .filter(F.col("upto").isNotNull())
               .groupBy("row_key", "upto").agg(F.max("revision").alias("highest")))
    highest = {(r["row_key"], r["upto"]): r["highest"] for r in earlier.collect()}  # one per given row at most
    out, stored = [], {}
    for row in sorted(rows, key=lambda r: r["offset"]):
        key = row["row_key"]
        known = [x for x in (stored.get(key), highest.get((key, row["offset"]))) if x is not None]
        stored[key] = max(known, default=None)
        if stored[key] is None or row["revision"] > stored[key]:
            out.append(row)
    return out


def newest_entries(log: DataFrame, as_of_ms: int, limit: int = S.DEFAULT_LIMIT,
                   window_ms: int = S.ACTIVITY_WINDOW_MS) -> DataFrame:
    """The newest `limit` index rows of the window, from the log alone.

    Candidates first: the newest few log rows of the window are a top-k; only those are judged. Not all
    of them may have been accepted, so more are taken until there are enough, and beyond
    MOST_CANDIDATES the whole window is judged at once.
    """
    wanted, take = clamped(limit), AHEAD * clamped(limit)
    while take <= MOST_CANDIDATES:
        rows = candidates(log, as_of_ms, window_ms).orderBy("activity_key", "offset").limit(take).collect()
        entries = {r["activity_key"]: r for r in accepted_among(log, rows)} if rows else {}
        if len(rows) == take:  # further writes of the last key may be among the rows not taken
            entries.pop(rows[-1]["activity_key"], None)
        if len(rows) < take or len(entries) >= wanted:
            found = [(key, entries[key]["received_ms"], entries[key]["row_key"])
                     for key in sorted(entries)[:wanted]]
            return log.sparkSession.createDataFrame(found, ENTRY)
        take *= AHEAD
    return recent(window_index(log, as_of_ms, window_ms), as_of_ms, wanted, window_ms)


def touched_keys(entries: DataFrame) -> DataFrame:
    """Distinct row keys of at most 200 index rows in index order, `position` from 1.

    `latest_event_ms` is the receive time of the first index row, hidden later or not.
    """
    every = Window.partitionBy()
    keyed = (entries.withColumn("latest_event_ms", F.max("received_ms").over(every))
             .groupBy("row_key")
             .agg(F.min("activity_key").alias("activity_key"),
                  F.max("latest_event_ms").alias("latest_event_ms")))
    order = Window.orderBy("activity_key")
    return keyed.select("row_key", F.row_number().over(order).cast("bigint").alias("position"),
                        "latest_event_ms")


def summary(records: DataFrame) -> DataFrame:
    """Count per type of at most 200 answered records, in display order."""
    return (records.groupBy("entity_type")
            .agg(F.count(F.lit(1)).alias("records"), F.min("position").alias("first_position"))
            .orderBy(F.desc("records"), "first_position"))
