"""Keyed state over the records stream: emit an event only when it is newer than the last emitted."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import islice

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructField, StructType

from lastword import model, settings as S

STATE_NAME = "latest_revision"
BLOCK = 4_096  # rows of a key that are looked at together
_STATE = StructType([StructField("revision", StringType())])


def above_all_earlier(rows: list[Row], order: Sequence[str], stored: str | None) -> list[Row]:
    """The rows above `stored` and above every row before them in arrival order."""
    out = []
    for row in sorted(rows, key=lambda r: [r[name] for name in order]):
        if stored is None or row["revision"] > stored:  # code points order like UTF-8 bytes
            stored = row["revision"]
            out.append(row)
    return out


class PreserveNewest(StatefulProcessor):
    """Holds the last emitted revision of one row key for three days after it was emitted.

    A key that expires only loses its filter: readers take the maximum again, so an old revision
    that passes afterwards cannot become current.
    """

    def __init__(self, ttl_ms: int = S.STATE_TTL_MS, order: Sequence[str] = ("offset",)):
        self.ttl_ms = ttl_ms
        self.order = tuple(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState(STATE_NAME, _STATE, ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # Rows of a key come in no promised order, and a batch may hold any number of them. A row that
        # is passed by an earlier one in its block is passed by it in the whole batch, and what is above
        # all before it in the whole batch is so in its block: only such rows are kept.
        stored = self.latest.get()[0] if self.latest.exists() else None
        kept: list[Row] = []
        while block := list(islice(rows, BLOCK)):
            kept = above_all_earlier(kept + above_all_earlier(block, self.order, stored), self.order, stored)
        if kept:
            self.latest.update((kept[-1]["revision"],))
        yield from kept

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.latest.update((initialState["revision"],))

    def close(self) -> None:
        pass


def updates(log: DataFrame, initial: DataFrame | None = None,
            ttl_ms: int = S.STATE_TTL_MS) -> DataFrame:
    """Accepted events of a streaming log, keyed by row key. Late data is judged by revision, never
    by time, so there is no watermark. Rows of a batch arrive in the order of `offset`, or in the
    composite order of a log that has the arrival columns of a partitioned topic."""
    order = model.order_of(log.columns)
    shape = StructType([f for f in log.schema if f.name in order and f.name != "offset"] + model.RECORDS_LOG.fields)
    grouped = log.select(*shape.fieldNames()).groupBy("row_key")
    start = initial.groupBy("row_key") if initial is not None else None
    return grouped.transformWithState(PreserveNewest(ttl_ms, order), shape, "Update",
                                      "ProcessingTime", initialState=start)


def saved_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Keyed state of a stopped query, as the initial state of one with another source."""
    saved = (spark.read.format("statestore").option("stateVarName", STATE_NAME).load(checkpoint))
    return saved.selectExpr("key.row_key AS row_key", "value.value.revision AS revision")
