"""Feed profile: what a sample of the raw feed holds, as counts, rates and lags.

Two aggregations read the feed. `by_minute` keeps one row per (minute, kind); `unique_commits`
keeps the first arrival of every commit identity. Everything else is computed from those two, so
parts of one report share their shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lastword.functions import contract, instants, messages
from lastword.operators.newest import first_arrivals
from lastword.operators.quantiles import index_pick, high_pick, low_pick, middle, order_statistics
from lastword.operators.scan import running_max_before, seen_before

RECORD = ["did", "collection", "rkey"]
IDENTITY = RECORD + ["rev", "operation"]
MINUTE_US = 60_000_000


def observed(feed: DataFrame) -> DataFrame:
    """Body-free view of the raw feed. The profile is lenient: it asks for presence, not validity."""
    raw = F.col("raw")
    # Nothing may follow the message: inside an array and inside an object it stays one value. The read
    # inside an object is that for the fields, and all fields are taken out of it at once.
    alone = F.json_array_length(F.concat(F.lit("["), raw, F.lit("]"))) == 1
    inside = F.try_parse_json(F.concat(F.lit('{"w":'), raw, F.lit("}")))
    names = ("$type", "seq", "time", *IDENTITY)
    shape = ", ".join(f"`{name}`: string" for name in names)
    parsed = feed.withColumn("_p", F.try_variant_get(F.when(alone, inside), "$.w.payload", f"struct<{shape}>"))
    session = F.col("session") if "session" in feed.columns else F.lit(1)
    read = parsed.select(
        "offset", session.alias("session"), F.octet_length("raw").alias("bytes"),
        instants.instant_micros(F.col("received_at")).alias("received_us"),
        F.col("_p.`$type`").alias("type_text"),
        *[F.col(f"_p.{name}").alias(name) for name in names[1:]])
    complete = F.col("seq").isNotNull()
    for name in IDENTITY:
        complete = complete & F.col(name).isNotNull()
    return contract.sealed(read.withColumns({
        "kind": messages.last_kind_of(F.col("type_text")),
        "commit": F.coalesce(F.endswith("type_text", F.lit("#commit")), F.lit(False)),
        "complete": complete,
        "event_us": instants.instant_micros(F.col("time"))})).drop("type_text", "time")


def by_minute(seen: DataFrame) -> DataFrame:
    """One row per receive minute and kind: messages, bytes, and messages that could not be read."""
    minute = instants.floor_div(F.col("received_us"), MINUTE_US)
    unread = F.col("kind").isNull() | (F.col("commit") & ~F.col("complete"))
    return (seen.groupBy(minute.alias("minute"), "kind")
            .agg(F.count(F.lit(1)).alias("messages"),
                 F.sum(F.col("bytes").cast("bigint")).alias("bytes"),
                 F.count_if(unread).alias("unread"),
                 F.count_if(F.col("commit") & F.col("complete")).alias("commits")))


def commits(seen: DataFrame) -> DataFrame:
    return (seen.filter(F.col("commit") & F.col("complete"))
            .select("offset", "session", "seq", "received_us", "event_us", *IDENTITY))


def unique_commits(seen: DataFrame) -> DataFrame:
    """First arrival of each commit identity; later ones are redeliveries."""
    return first_arrivals(commits(seen), IDENTITY)


def redelivery_flags(seen: DataFrame, chunk_rows: int | None = None) -> DataFrame:
    return seen_before(commits(seen), IDENTITY, "offset", "redelivered", chunk_rows)


def kind_counts(minutes: DataFrame) -> DataFrame:
    return (minutes.filter(F.col("kind").isNotNull()).groupBy("kind")
            .agg(F.sum("messages").alias("messages")))


def operation_mix(unique: DataFrame) -> DataFrame:
    return unique.groupBy("collection", "operation").agg(F.count(F.lit(1)).alias("commits"))


def totals(minutes: DataFrame) -> DataFrame:
    """One row over everything received. A sample without messages has 0 bytes per message."""
    messages_, bytes_ = F.coalesce(F.sum("messages"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))
    return minutes.agg(
        messages_.alias("messages"), bytes_.alias("bytes"),
        F.coalesce(F.sum("unread"), F.lit(0)).alias("unread"),
        F.coalesce(F.sum("commits"), F.lit(0)).alias("commits"),
    ).withColumn("bytes_per_message", F.when(F.col("messages") == 0, F.lit(0.0))
                 .otherwise(F.col("bytes") / F.col("messages")))


def unique_totals(unique: DataFrame) -> DataFrame:
    """One row: unique commits, and those among them whose time cannot be read.

    Such a commit has been counted everywhere else by then, but counts as a parse failure too.
    """
    return unique.agg(F.count(F.lit(1)).alias("unique_commits"),
                      F.count_if(F.col("event_us").isNull()).alias("bad_times"))


def commit_counts(minutes: DataFrame, unique: DataFrame) -> DataFrame:
    """One row: unique commits, redelivered ones, parse failures."""
    zero = F.lit(0).cast("bigint")
    left = totals(minutes).select("commits", "unread", zero.alias("unique_commits"),
                                  zero.alias("bad_times"))
    right = unique_totals(unique).select(zero.alias("commits"), zero.alias("unread"),
                                         "unique_commits", "bad_times")
    both = left.unionByName(right).agg(*[F.sum(c).alias(c) for c in left.columns])
    return both.select("unique_commits",
                       (F.col("commits") - F.col("unique_commits")).alias("redelivered"),
                       (F.col("unread") + F.col("bad_times")).alias("parse_failures"))


def minute_rates(minutes: DataFrame) -> DataFrame:
    """Messages and bytes per second over full minutes: min, median, p95. One row per measure.

    The first and the last minute are cut off by the sample and are dropped.
    """
    per = minutes.groupBy("minute").agg(F.sum("messages").alias("messages"),
                                        F.sum("bytes").alias("bytes"))
    ends = minutes.agg(F.min("minute").alias("first"), F.max("minute").alias("last")).first()
    full = per.filter((F.col("minute") > F.lit(ends["first"])) & (F.col("minute") < F.lit(ends["last"])))
    measures = full.select(F.explode(F.array(
        F.struct(F.lit("messages").alias("measure"), F.col("messages").alias("amount")),
        F.struct(F.lit("bytes").alias("measure"), F.col("bytes").alias("amount"))))
        .alias("_m")).select("_m.*")
    picks = {"least": lambda n: F.lit(0).cast("bigint"), "low": low_pick(0.5),
             "high": high_pick(0.5), "p95": index_pick(0.95)}
    stats = order_statistics(measures, "amount", picks, ["measure"])
    return stats.select("measure", F.col("n").alias("full_minutes"),
                        (F.col("least") / 60.0).alias("min_per_second"),
                        (middle(F.col("low"), F.col("high")) / 60.0).alias("median_per_second"),
                        (F.col("p95") / 60.0).alias("p95_per_second"))


def lags(unique: DataFrame) -> DataFrame:
    return (unique.filter(F.col("event_us").isNotNull())
            .select((F.col("received_us") - F.col("event_us")).alias("lag_us")))


def source_lag(unique: DataFrame) -> DataFrame:
    """Seconds from source time to receipt over unique commits: median, p95, max."""
    picks = {"low": low_pick(0.5), "high": high_pick(0.5), "p95": index_pick(0.95),
             "largest": lambda n: n - 1}
    stats = order_statistics(lags(unique), "lag_us", picks)
    return stats.select(F.col("n").alias("commits"),
                        (middle(F.col("low"), F.col("high")) / 1e6).alias("median_s"),
                        (F.col("p95") / 1e6).alias("p95_s"), (F.col("largest") / 1e6).alias("max_s"))


def lag_percentiles(unique: DataFrame, shares: list[float]) -> DataFrame:
    """Index percentiles of the lag, one row per share."""
    picks = {f"p{i}": index_pick(q) for i, q in enumerate(shares)}
    stats = order_statistics(lags(unique), "lag_us", picks)
    return stats.select(F.explode(F.array(*[
        F.struct(F.lit(q).alias("share"), F.col(f"p{i}").alias("lag_us"))
        for i, q in enumerate(shares)])).alias("_s")).select("_s.*")


def record_histories(unique: DataFrame) -> DataFrame:
    """Per record: operations seen, whether one was a create, and the last in arrival order."""
    return unique.groupBy(*RECORD).agg(
        F.count(F.lit(1)).alias("operations"),
        F.bool_or(F.col("operation") == "create").alias("created"),
        F.max_by("operation", "offset").alias("last_operation"))


def several_ops(unique: DataFrame) -> DataFrame:
    """One row: records with several operations, and records created and finally deleted."""
    return record_histories(unique).agg(
        F.count_if(F.col("operations") > 1).alias("records_with_several_ops"),
        F.count_if(F.col("created") & (F.col("last_operation") == "delete"))
        .alias("created_then_deleted"))


def rev_regressions(unique: DataFrame, chunk_rows: int | None = None) -> DataFrame:
    """Unique commits whose revision is not above every earlier one of their record."""
    judged = running_max_before(unique, RECORD, "offset", "rev", "highest_before", chunk_rows)
    return judged.filter(F.col("rev") <= F.col("highest_before"))


def resume_check(seen: DataFrame, unique: DataFrame) -> DataFrame:
    """One row: the cursor the first session ended on, the first commit sequence of the second,
    and whether they are the same, that is, whether the cursor is inclusive."""
    ended = unique.filter((F.col("session") == 1) & F.col("event_us").isNotNull()).agg(
        F.max_by("seq", "offset").alias("cursor")).select(
        "cursor", F.lit(None).cast("string").alias("first_seq"))
    began = seen.filter(F.col("commit") & (F.col("session") == 2) & F.col("seq").isNotNull()).agg(
        F.min_by("seq", "offset").alias("first_seq")).select(
        F.lit(None).cast("string").alias("cursor"), "first_seq")
    both = ended.unionByName(began).agg(F.max("cursor").alias("cursor"),
                                        F.max("first_seq").alias("first_seq"))
    return both.select(F.col("cursor").try_cast("bigint").alias("cursor"),
                       F.col("first_seq").try_cast("bigint").alias("first_seq_after_resume"),
                       F.coalesce(F.col("cursor") == F.col("first_seq"), F.lit(False))
                       .alias("cursor_is_inclusive"))


def capture(seen: DataFrame) -> DataFrame:
    """Unique readable commits without bodies, for the ndjson capture."""
    return (unique_commits(seen).filter(F.col("event_us").isNotNull())
            .select(F.col("seq").try_cast("bigint").alias("seq"),
                    instants.micros_text(F.col("event_us")).alias("time"),
                    "did", "collection", "rkey", "rev", "operation"))
