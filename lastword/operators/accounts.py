"""Account status, purge boundaries, and what they hide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lastword import settings as S
from lastword.operators.newest import accepted, newest


def purges(entity_type: Column, state: Column) -> Column:
    """A resync, or the deletion of an account."""
    return (entity_type == S.SYNC) | ((entity_type == S.ACCOUNT) & (state == "deleted"))


def purge_events(log: DataFrame) -> DataFrame:
    return log.filter(purges(F.col("entity_type"), F.col("state")))


def purge_markers(log: DataFrame, chunk_rows: int | None = None) -> DataFrame:
    """Highest purging sequence per account, from accepted events only.

    Acceptance is judged per key, so the log can be narrowed to marker rows before the shuffle.
    """
    markers = (log.filter(F.col("entity_type").isin(S.ACCOUNT, S.SYNC))
               .select("row_key", "offset", "did", "entity_type", "state", "revision",
                       "source_seq"))
    return purge_boundary(accepted(markers, chunk_rows))


def purge_boundary(accepted_log: DataFrame) -> DataFrame:
    return (purge_events(accepted_log).groupBy("did")
            .agg(F.max("source_seq").alias("purge_seq")))


def account_status(log: DataFrame) -> DataFrame:
    """Newest status per account."""
    rows = (log.filter(F.col("entity_type") == S.ACCOUNT)
            .select("row_key", "offset", "did", "revision", "state"))
    return newest(rows).select("did", "state")


def guards(status: DataFrame, markers: DataFrame) -> DataFrame:
    """One row per account that hides something: its inactive state, its purge boundary, or both."""
    inactive = (status.filter(F.col("state") != "active")
                .select("did", F.lit(True).alias("inactive"),
                        F.lit(None).cast("bigint").alias("purge_seq")))
    purged = markers.select("did", F.lit(False).alias("inactive"), "purge_seq")
    return (inactive.unionByName(purged).groupBy("did")
            .agg(F.bool_or("inactive").alias("inactive"),
                 F.max("purge_seq").alias("purge_seq")))


def _salted(rows: DataFrame, accounts: DataFrame, salts: int | None):
    """Both sides of a join on the account, with a salt beside the did.

    One account may own a third of all records, so its records are spread over `salts` buckets by
    their own key, and every account row (one per did, few narrow columns) is repeated once per
    bucket. Below the broadcast threshold, which adaptive execution checks against the size it has
    measured, no record is shuffled at all.
    """
    count = salts or S.ACCOUNT_SALTS
    left = rows.withColumn("_salt", F.pmod(F.xxhash64("row_key"), F.lit(count)).cast("int"))
    right = accounts.select(
        F.col("did").alias("_did"), *[c for c in accounts.columns if c != "did"],
        F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("_bucket"))
    return left, right, (F.col("did") == F.col("_did")) & (F.col("_salt") == F.col("_bucket"))


def salted_join(rows: DataFrame, accounts: DataFrame, salts: int | None = None) -> DataFrame:
    """Rows with the columns of their account."""
    left, right, match = _salted(rows, accounts, salts)
    return left.join(right, match).drop("_salt", "_did", "_bucket")


def _without(rows: DataFrame, accounts: DataFrame, hit: Column, salts: int | None) -> DataFrame:
    """Rows that no row of `accounts` hits: an anti join on the account."""
    left, right, match = _salted(rows, accounts, salts)
    return left.join(right, match & hit, "left_anti").drop("_salt")


def judged_records(current: DataFrame, account_guards: DataFrame, salts: int | None = None
                   ) -> DataFrame:
    """Records with `purged` and `hidden`, both what a reader's account rules say about them."""
    records = current.filter(F.col("entity_type").isin(*S.COLLECTIONS))
    left, right, match = _salted(records, account_guards, salts)
    purged = F.coalesce(F.col("source_seq") <= F.col("purge_seq"), F.lit(False))
    return (left.join(right, match, "left")
            .withColumn("purged", purged)
            .withColumn("hidden", purged | F.coalesce(F.col("inactive"), F.lit(False)))
            .drop("_salt", "_did", "_bucket", "inactive", "purge_seq"))


def unpurged(current: DataFrame, markers: DataFrame, salts: int | None = None) -> DataFrame:
    """Current rows after physical purge: records at or below their account's boundary are gone."""
    hit = (F.col("entity_type").isin(*S.COLLECTIONS)
           & (F.col("source_seq") <= F.col("purge_seq")))
    return _without(current, markers, hit, salts)


def visible(current: DataFrame, account_guards: DataFrame, salts: int | None = None) -> DataFrame:
    """Current rows a reader may see. Account rows are always served, resyncs never."""
    hit = (F.col("entity_type").isin(*S.COLLECTIONS)
           & (F.col("inactive") | F.coalesce(F.col("source_seq") <= F.col("purge_seq"),
                                             F.lit(False))))
    return _without(current.filter(F.col("entity_type") != S.SYNC), account_guards, hit, salts)


def guards_of(log: DataFrame, chunk_rows: int | None = None) -> DataFrame:
    """`guards` of a whole log in one pass over its marker rows.

    Accepted rows of a key only rise in revision, so the newest status is the one of the highest
    accepted revision.
    """
    markers = (log.filter(F.col("entity_type").isin(S.ACCOUNT, S.SYNC))
               .select("row_key", "offset", "did", "entity_type", "state", "revision",
                       "source_seq"))
    status = F.col("entity_type") == S.ACCOUNT
    state = F.max_by(F.when(status, F.col("state")), F.when(status, F.col("revision")))
    boundary = F.max(F.when(purges(F.col("entity_type"), F.col("state")), F.col("source_seq")))
    per_account = (accepted(markers, chunk_rows).groupBy("did")
                   .agg(state.alias("_state"), boundary.alias("purge_seq")))
    inactive = F.coalesce(F.col("_state") != "active", F.lit(False))
    return (per_account.select("did", inactive.alias("inactive"), "purge_seq")
            .filter(F.col("inactive") | F.col("purge_seq").isNotNull()))
