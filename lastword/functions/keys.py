"""Row keys, account keys and the newest-first activity key."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lastword import settings as S
from lastword.functions.instants import instant_millis


def padded(seq: Column) -> Column:
    """Fixed width, so text order is numeric order."""
    return F.lpad(seq.cast("string"), S.SEQ_DIGITS, "0")


def escape(part: Column) -> Column:
    return F.replace(F.replace(part, F.lit("%"), F.lit("%25")), F.lit("#"), F.lit("%23"))


def unescape(part: Column) -> Column:
    return F.replace(F.replace(part, F.lit("%23"), F.lit("#")), F.lit("%25"), F.lit("%"))


def row_key(entity_type: Column, entity_id: Column) -> Column:
    """Escaped type and id around exactly one raw `#`."""
    return F.concat(escape(entity_type), F.lit("#"), escape(entity_id))


def key_type(key: Column) -> Column:
    return unescape(F.substring_index(key, "#", 1))


def key_id(key: Column) -> Column:
    return unescape(F.substr(key, F.locate("#", key) + 1))


def account_key(did: Column) -> Column:
    return row_key(F.lit(S.ACCOUNT), did)


def did_of(entity_id: Column) -> Column:
    """Account of a record id: the text before the first `/`, empty when there is none."""
    return F.when(F.contains(entity_id, F.lit("/")),
                  F.substring_index(entity_id, "/", 1)).otherwise(F.lit(""))


def owner(entity_type: Column, entity_id: Column) -> Column:
    """Account that a row belongs to: markers carry the DID as their whole id."""
    return F.when(entity_type.isin(S.ACCOUNT, S.SYNC), entity_id).otherwise(did_of(entity_id))


def activity_key(received_at: Column, event_id: Column) -> Column:
    """Complement of the receive time, so ascending key order is newest first. Raises without one:
    a null key would merge unrelated events."""
    known = F.coalesce(instant_millis(received_at), F.raise_error(
        F.concat(F.lit("no activity key without a receive time: "), F.coalesce(received_at, F.lit("null"))))
        .cast("bigint"))
    left = F.lit(S.ACTIVITY_HORIZON_MS) - known
    return F.concat(F.lit(S.ACTIVITY_PREFIX),
                    F.lpad(left.cast("string"), S.ACTIVITY_DIGITS, "0"),
                    F.lit("#"), F.substring(event_id, 1, S.ACTIVITY_ID_CHARS))


def activity_millis(key: Column) -> Column:
    digits = F.substring(key, len(S.ACTIVITY_PREFIX) + 1, S.ACTIVITY_DIGITS)
    return F.lit(S.ACTIVITY_HORIZON_MS) - digits.cast("bigint")


def bucket(key: Column, buckets: int = S.STATE_BUCKETS) -> Column:
    """Directory bucket of a row key in the stored tables."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
