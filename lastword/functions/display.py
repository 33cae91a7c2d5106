"""Argument and display helpers of the read queries."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from lastword import settings as S

# Display labels of the entity types.
LABELS = {S.LIKE: "like", S.POST: "post", S.REPOST: "repost", S.ACCOUNT: "account"}


def clamp_limit(raw: Column) -> Column:
    """Text of a 32-bit integer clamped to 1..200, anything else 50."""
    number = F.when(raw.rlike(r"\A[+-]?[0-9]+\z"), raw.try_cast("int"))
    clamped = F.greatest(F.lit(1), F.least(F.lit(S.MAX_LIMIT), number))
    return F.when(number.isNull(), F.lit(S.DEFAULT_LIMIT)).otherwise(clamped)


def limit_argument(raw: str | int | None) -> int:
    """The same rule for a caller's argument."""
    if raw is None or not re.fullmatch(r"[+-]?[0-9]+", str(raw)):
        return S.DEFAULT_LIMIT
    number = int(raw)
    if not -2**31 <= number < 2**31:
        return S.DEFAULT_LIMIT
    return max(1, min(S.MAX_LIMIT, number))


def type_label(entity_type: Column) -> Column:
    names = F.create_map(*[F.lit(text) for pair in LABELS.items() for text in pair])
    return F.coalesce(F.try_element_at(names, entity_type), entity_type)


def age_text(millis: Column) -> Column:
    """Age of a whole number of milliseconds: `ms`, seconds with one digit, or minutes."""
    seconds = F.floor(millis / 1000)
    clock = F.concat(F.floor(seconds / 60).cast("string"), F.lit(" min "),
                     F.lpad((seconds % 60).cast("string"), 2, "0"), F.lit(" s"))
    # A half tenth rounds by the binary value of the quotient, which scaling by 2^52 keeps exact.
    scale = 2**52
    binary = (millis / 1000 * scale).cast("decimal(20,0)") * F.lit(1000).cast("decimal(4,0)")
    exact = millis.cast("decimal(10,0)") * F.lit(scale).cast("decimal(16,0)")
    rest = millis % 100
    up = (rest > 50) | ((rest == 50) & (binary >= exact))
    tenths = F.floor(millis / 100) + up.cast("int")
    decimal = F.concat(F.floor(tenths / 10).cast("string"), F.lit("."),
                       (tenths % 10).cast("string"), F.lit(" s"))
    return (F.when(millis < 0, F.lit("0 ms"))
            .when(millis < 1000, F.concat(millis.cast("string"), F.lit(" ms")))
            .when(millis < 60_000, decimal).otherwise(clock))
