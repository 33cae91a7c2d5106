"""Running maximum per key in arrival order, without ever gathering a key in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lastword.functions.instants import floor_div
from lastword import settings as S

NOT_TOTAL = "arrival order is not total: two rows of a key have the same place in it"


def chunk_of(order: Sequence[str], chunk_rows: int | None, slot_ms: int | None) -> Column:
    """The chunk of a row: a range of a single order, or a slot of time of a composite one."""
    if len(order) == 1:
        return floor_div(F.col(order[0]), chunk_rows or S.CHUNK_ROWS)
    return floor_div(F.col(order[0]), slot_ms or S.SLOT_MS)


def running_max_before(rows: DataFrame, keys: list[str], order: str | Sequence[str], value: str,
                       out: str, chunk_rows: int | None = None,
                       slot_ms: int | None = None) -> DataFrame:
    """Adds `out`: the largest `value` among earlier rows of the same key, null for the first.

    `order` is a unique non-negative integer, or several integer columns of which the first is a
    time in ms and which together are unique per key. Rows are windowed per (key, chunk), so a window
    group holds at most `chunk_rows` rows, or what a key gets in `slot_ms`, however hot its key is.
    What earlier chunks hold is one pre-aggregated maximum per (key, chunk); their running maximum
    enters each chunk as one extra row that sorts first. Rows and carry rows share a single shuffle
    and a single sort.

    A composite order that two rows of a key share fails the query: neighbours of the sort are
    compared, so the test costs no further shuffle.
    """
    places = [order] if isinstance(order, str) else list(order)
    tagged = rows.withColumn("_chunk", chunk_of(places, chunk_rows, slot_ms))
    earlier = (Window.partitionBy(*keys).orderBy("_chunk")
               .rowsBetween(Window.unboundedPreceding, -1))
    carry = (tagged.groupBy(*keys, "_chunk").agg(F.max(value).alias("_top"))
             .select(*keys, "_chunk", F.max("_top").over(earlier).alias("_value"))
             .filter(F.col("_value").isNotNull())
             .withColumn("_carry", F.lit(True)))
    together = (tagged.withColumn("_value", F.col(value)).withColumn("_carry", F.lit(False))
                .unionByName(carry, allowMissingColumns=True))
    sorted_ = Window.partitionBy(*keys, "_chunk").orderBy(F.col("_carry").desc(), *places)
    before = sorted_.rowsBetween(Window.unboundedPreceding, -1)
    scanned = together.withColumn(out, F.max("_value").over(before))
    real = ~F.col("_carry")
    if len(places) > 1:
        place = F.struct(F.col("_carry"), *places)
        scanned = scanned.withColumn("_tie", F.lag(place).over(sorted_).eqNullSafe(place))
        real = real & ~F.when(F.col("_tie"), F.raise_error(F.lit(NOT_TOTAL)).cast("boolean")).otherwise(False)
    return scanned.filter(real).drop("_chunk", "_value", "_carry", "_tie")


def seen_before(rows: DataFrame, keys: list[str], order: str, out: str,
                chunk_rows: int | None = None) -> DataFrame:
    """Adds `out`: true when an earlier row has the same key."""
    marked = running_max_before(rows, keys, order, order, "_seen", chunk_rows)
    return marked.withColumn(out, F.col("_seen").isNotNull()).drop("_seen")
