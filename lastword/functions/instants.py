"""ISO-8601 instants kept as text: Spark timestamps stop at microseconds, instants do not."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The common print is checked with one pattern and cut by position; other spellings of an instant
# (lower case, offsets) take the slower way through capture groups.
_PLAIN = r"\A\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d{0,9})?Z\z"
_SHAPE = (r"\A(\d{4}-\d{2}-\d{2})[Tt](\d{2}:\d{2}:\d{2})(?:\.(\d{0,9}))?"
          r"([Zz]|[+-]\d{2}:\d{2}(?::\d{2})?)\z")


def _part(text: Column, group: int) -> Column:
    return F.regexp_extract(text, _SHAPE, group)


def _shift_seconds(zone: Column) -> Column:
    def digits(start: int) -> Column:
        return F.coalesce(F.substring(zone, start, 2).try_cast("int"), F.lit(0))

    seconds = digits(2) * 3600 + digits(5) * 60 + digits(8)
    return (F.when(F.upper(zone) == "Z", F.lit(0))
            .when(F.startswith(zone, F.lit("-")), -seconds).otherwise(seconds))


def _shifted(text: Column) -> Column:
    """UTC time to the second of an instant in any spelling; null when the text is none."""
    time = _part(text, 2)
    end_of_day = (time == "24:00:00") & ~_part(text, 3).rlike("[1-9]")
    read = F.when(end_of_day, F.lit("00:00:00")).when(time == "23:59:60", F.lit("23:59:59")).otherwise(time)
    clock = F.concat(_part(text, 1), F.lit("T"), read, F.lit("Z")).try_cast("timestamp")
    shift = _shift_seconds(_part(text, 4))
    day = F.when(end_of_day, F.lit(86_400)).otherwise(F.lit(0))
    moved = F.timestamp_seconds(F.unix_seconds(clock) + day - shift)
    return F.when(text.rlike(_SHAPE) & (F.abs(shift) <= 18 * 3600), moved)


def _plain(text: Column) -> Column:
    return text.rlike(_PLAIN) & text.try_cast("timestamp").isNotNull()


def is_instant(text: Column) -> Column:
    return F.when(_plain(text), F.lit(True)).otherwise(
        F.coalesce(_shifted(text).isNotNull(), F.lit(False)))


def _trimmed(nanos: Column) -> Column:
    """`.` and 3, 6 or 9 digits of a nine-digit fraction, or nothing when it is zero."""
    return (F.when(nanos == "000000000", F.lit(""))
            .when(F.endswith(nanos, F.lit("000000")), F.concat(F.lit("."), F.substring(nanos, 1, 3)))
            .when(F.endswith(nanos, F.lit("000")), F.concat(F.lit("."), F.substring(nanos, 1, 6)))
            .otherwise(F.concat(F.lit("."), nanos)))


def normal_instant(text: Column) -> Column:
    """The same instant in canonical UTC print, null when the text cannot be parsed."""
    digits = F.rtrim(F.substring(text, 21, 10), F.lit("Z"))
    plain = F.concat(F.substring(text, 1, 19), _trimmed(F.rpad(digits, 9, "0")), F.lit("Z"))
    clock = F.replace(_shifted(text).cast("string"), F.lit(" "), F.lit("T"))
    spelled = F.concat(clock, _trimmed(F.rpad(_part(text, 3), 9, "0")), F.lit("Z"))
    return F.when(_plain(text), plain).otherwise(spelled)


def instant_micros(text: Column) -> Column:
    """Microseconds since 1970, the nanosecond digits cut off; null when the text is no instant."""
    rest = F.rpad(_part(text, 3), 6, "0").substr(1, 6).cast("bigint")
    spelled = F.unix_seconds(_shifted(text)) * 1_000_000 + rest
    return F.when(_plain(text), F.unix_micros(text.try_cast("timestamp"))).otherwise(spelled)


def floor_div(value: Column, by: int) -> Column:
    """Integer division towards minus infinity; exact for all 64-bit values."""
    return F.call_function("div", value - F.pmod(value, F.lit(by)), F.lit(by).cast("bigint"))


def instant_millis(text: Column) -> Column:
    """Milliseconds since 1970 of an instant in any spelling, null when the text is none."""
    return floor_div(instant_micros(text), 1000)


def micros_text(micros: Column) -> Column:
    """Canonical print of a microsecond count (the session runs in UTC)."""
    clock = F.substring(F.timestamp_micros(micros).cast("string"), 1, 19)
    nanos = F.rpad(F.lpad(F.pmod(micros, F.lit(1_000_000)).cast("string"), 6, "0"), 9, "0")
    return F.concat(F.replace(clock, F.lit(" "), F.lit("T")), _trimmed(nanos), F.lit("Z"))
