"""Newest revision per record, as one row per key and as the log of accepted events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lastword import model
from lastword.operators.scan import running_max_before


def newer(revision: Column, stored: Column) -> Column:
    """A revision replaces a stored one only when it is strictly greater in byte order."""
    return stored.isNull() | (revision > stored)


def accepted(log: DataFrame, chunk_rows: int | None = None, slot_ms: int | None = None) -> DataFrame:
    """Rows that were newer than everything that had arrived for their key.

    A log with the arrival columns of a partitioned topic is judged in their composite order.
    """
    judged = running_max_before(log, ["row_key"], model.order_of(log.columns), "revision", "_stored",
                                chunk_rows, slot_ms)
    return judged.filter(newer(F.col("revision"), F.col("_stored"))).drop("_stored")


def newest(log: DataFrame, key: str = "row_key") -> DataFrame:
    """One row per key: the highest revision, the first arrival among equal ones.

    `max_by` combines before the shuffle, so a hot key costs one row per input task.
    """
    rest = [name for name in log.columns if name != key]
    first = [-F.col(name) for name in model.order_of(log.columns)]
    best = F.max_by(F.struct(*rest), F.struct(F.col("revision"), *first))
    return (log.groupBy(key).agg(best.alias("_row"))
            .select(key, *[F.col(f"_row.{name}").alias(name) for name in rest])
            .select(*log.columns))


def first_arrivals(rows: DataFrame, keys: list[str], order: str | Sequence[str] = "offset") -> DataFrame:
    """One row per key, the earliest in arrival order."""
    rest = [name for name in rows.columns if name not in keys]
    place = order if isinstance(order, str) else F.struct(*order)
    return (rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), place).alias("_row"))
            .select(*keys, *[F.col(f"_row.{name}").alias(name) for name in rest])
            .select(*rows.columns))
