"""Exact order statistics by radix selection, without gathering a group's values in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, FloatType

from lastword import settings as S
from lastword.sources.scratch import cut

DIGIT = 16  # bits that one level looks at: a group has at most 65,536 cells there
BUCKETS = 1 << 16  # groups are dealt to so many buckets to see which of them may be large
_FRACTION = 2.0 ** 52
_LEAST_NORMAL = 2.0 ** -1022
_INFINITE = 0x7FF << 52


def ordered_bits(value: Column) -> Column:
    """A bigint that orders doubles as Spark does: the bits of the size, negative for values below zero.

    Both zeros are 0 and NaN is above all. Powers of two divide exactly, so no bit is lost.
    """
    size = F.abs(value.cast("double"))
    guess = F.floor(F.log2(size))
    # The logarithm may be off by one next to a power of two.
    exponent = (F.when(F.pow(F.lit(2.0), guess) > size, guess - 1)
                .when(F.pow(F.lit(2.0), guess + 1) <= size, guess + 1).otherwise(guess))
    fraction = ((size / F.pow(F.lit(2.0), exponent) - 1) * _FRACTION).cast("bigint")
    bits = (F.when(F.isnan(size), F.lit(_INFINITE + 1))
            .when(size == float("inf"), F.lit(_INFINITE))
            .when(size >= _LEAST_NORMAL, (exponent + 1023).cast("bigint") * F.lit(1 << 52) + fraction)
            .otherwise((size * 2.0 ** 537 * 2.0 ** 537).cast("bigint")))
    return F.when((value < 0) & ~F.isnan(size), -bits).otherwise(bits)


def _counted(rows: DataFrame, value: str, groups: list[str]) -> DataFrame:
    """Distinct values of each group with their counts, under a key of 64 bits that keeps their order."""
    real = isinstance(rows.schema[value].dataType, (DoubleType, FloatType))
    key = ordered_bits(F.col(value)) if real else F.col(value).cast("bigint")
    return (rows.filter(F.col(value).isNotNull()).select(*groups, key.alias("_k"), F.col(value).alias("_v"))
            .groupBy(*groups, "_k").agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_v")))


def order_statistics(rows: DataFrame, value: str, picks: dict[str, Callable[[Column], Column]],
                     groups: Sequence[str] = (), sorted_rows: int | None = None) -> DataFrame:
    """One row per group: `n` and, per pick, the value at a zero-based index computed from `n`.

    Groups are dealt to BUCKETS buckets by their hash. A group in a bucket of at most `sorted_rows` rows
    has no more itself: its values are sorted where they meet, after one shuffle. Groups of fuller
    buckets, and a whole table without groups, take the radix selection, which gathers no group.
    """
    groups, limit = list(groups), sorted_rows or S.CHUNK_ROWS
    held = rows.filter(F.col(value).isNotNull()).select(*groups, value)
    if not groups:
        return _by_radix(held, value, picks, groups)
    tagged = held.withColumn("_bucket", F.pmod(F.xxhash64(*groups), F.lit(BUCKETS)))
    full = cut(tagged.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
               .select("_bucket"), "full")
    if full.isEmpty():
        return _by_sort(held, value, picks, groups)
    large = tagged.join(full, "_bucket", "left_semi").drop("_bucket")
    small = tagged.join(full, "_bucket", "left_anti").drop("_bucket")
    return _by_sort(small, value, picks, groups).unionByName(_by_radix(large, value, picks, groups))


def _by_sort(rows: DataFrame, value: str, picks: dict[str, Callable[[Column], Column]],
             groups: list[str]) -> DataFrame:
    """The picks of groups of bounded size. The shuffle of the windows serves the last grouping too."""
    whole = Window.partitionBy(*groups)
    ranked = (rows.withColumn("_at", F.row_number().over(whole.orderBy(value)) - 1)
              .withColumn("n", F.count(F.lit(1)).over(whole)))
    return ranked.groupBy(*groups).agg(
        F.max("n").alias("n"),
        *[F.max(F.when(F.col("_at") == index(F.col("n")).cast("bigint"), F.col(value))).alias(name)
          for name, index in picks.items()])


def _by_radix(rows: DataFrame, value: str, picks: dict[str, Callable[[Column], Column]],
              groups: list[str]) -> DataFrame:
    """The picks of groups of any size.

    1. Equal values collapse to (key, count) before the shuffle, so a value that fills a third of the
       rows is one row. The result is written once; every level reads it.
    2. A level counts the next DIGIT bits of the keys below each wanted prefix. At most 65,536 cells of
       a pick are scanned for the one that holds its index, whatever the values are.
    3. How many levels there are follows from the widest group's range of keys: one for 65,536 values in
       a row, four for all doubles. The last level's cells are single values.
    """
    counted = cut(_counted(rows, value, groups), "counts")
    span = (counted.groupBy(*groups).agg(F.min("_k").alias("_low"), F.max("_k").alias("_high"))
            .agg(F.max(F.length(F.bin(F.col("_low").bitwiseXOR(F.col("_high"))))).alias("bits")).first())
    bits = span["bits"] or 1
    names = F.array(*[F.lit(name) for name in picks])
    whole = Window.partitionBy(*groups, "pick")
    upto = whole.orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wanted, above = None, None
    for shift in [*range(bits - DIGIT, 0, -DIGIT), 0]:
        cell = F.shiftright("_k", shift)
        if wanted is None:
            cells = (counted.groupBy(*groups, cell.alias("_cell"))
                     .agg(F.sum("_c").alias("_c"), F.min("_v").alias("_v"))
                     .withColumn("pick", F.explode(names))
                     .withColumn("n", F.sum("_c").over(whole)))
            at = F.coalesce(*[F.when(F.col("pick") == name, index(F.col("n")).cast("bigint"))
                              for name, index in picks.items()])
            cells = cells.withColumn("at", at)
        else:
            few = F.broadcast(wanted) if not groups else wanted  # one row per pick
            cells = (counted.withColumn("_above", F.shiftright("_k", above)).join(few, [*groups, "_above"])
                     .groupBy(*groups, "pick", "n", "at", cell.alias("_cell"))
                     .agg(F.sum("_c").alias("_c"), F.min("_v").alias("_v")))
        end = F.sum("_c").over(upto)
        found = (cells.withColumn("_end", end)
                 .filter((F.col("at") < F.col("_end")) & (F.col("at") >= F.col("_end") - F.col("_c"))))
        # Counted from the start of the cell from here on.
        wanted = found.select(*groups, "pick", "n", (F.col("at") - F.col("_end") + F.col("_c")).alias("at"),
                              F.col("_cell").alias("_above"), "_v")
        if shift:
            wanted = wanted.drop("_v")
        above = shift
    return wanted.groupBy(*groups).agg(
        F.max("n").alias("n"),
        *[F.max(F.when(F.col("pick") == name, F.col("_v"))).alias(name) for name in picks])


def index_pick(q: float) -> Callable[[Column], Column]:
    """Percentile by index: min(n - 1, floor(q * n))."""
    return lambda n: F.least(n - 1, F.floor(F.lit(q) * n)).cast("bigint")


def low_pick(q: float) -> Callable[[Column], Column]:
    """Lower neighbour of the interpolated percentile position q * (n - 1)."""
    return lambda n: F.floor(F.lit(q) * (n - 1)).cast("bigint")


def high_pick(q: float) -> Callable[[Column], Column]:
    return lambda n: F.ceil(F.lit(q) * (n - 1)).cast("bigint")


def interpolated(q: float, low: Column, high: Column, n: Column) -> Column:
    share = F.lit(q) * (n - 1)
    return low + (high - low) * (share - F.floor(share))


def middle(low: Column, high: Column) -> Column:
    """Median from its two neighbours."""
    return (low + high) / F.lit(2.0)
