"""The queries a reader runs. Every function takes and returns DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lastword import model, settings as S
from lastword.functions import contract, keys
from lastword.functions.display import limit_argument
from lastword.functions.instants import instant_millis
from lastword.operators import accounts, activity as act, ingest as ing, integrity, profile, reconcile
from lastword.operators.newest import accepted, newest
from lastword.sources.scratch import cut


def _argument(name: str, value: str | None) -> str:
    if not isinstance(value, str) or not value.strip():
        raise ValueError(f"{name} must be one non-blank text")
    return value


def visible_state(log: DataFrame) -> DataFrame:
    """Every record a reader may see, in its newest revision."""
    rows = log.filter(F.col("entity_type") != S.SYNC)
    return accounts.visible(newest(rows), accounts.guards_of(log))


def _visible_among(log: DataFrame, wanted: list[str]) -> DataFrame:
    """`visible_state` of at most 200 row keys, which reach the scans as literals."""
    rows = log.filter(F.col("row_key").isin(wanted) & (F.col("entity_type") != S.SYNC))
    dids = sorted({_owner(key) for key in wanted})
    markers = log.filter(F.col("entity_type").isin(S.ACCOUNT, S.SYNC) & F.col("did").isin(dids))
    return accounts.visible(newest(rows), accounts.guards_of(markers))


def _owner(key: str) -> str:
    """Account of a row key, by the rule of `keys.owner`."""
    kind, ident = (part.replace("%23", "#").replace("%25", "%") for part in key.split("#", 1))
    if kind in (S.ACCOUNT, S.SYNC):
        return ident
    return ident.split("/", 1)[0] if "/" in ident else ""


def current_state(log: DataFrame, entity_type: str, entity_id: str) -> DataFrame:
    """The visible event of one entity: one row or none. Deleted records are returned as such."""
    kind, ident = _argument("entity_type", entity_type), _argument("entity_id", entity_id)
    mine = (F.col("entity_type") == kind) & (F.col("entity_id") == ident)
    rows = newest(log.filter(mine & (F.col("entity_type") != S.SYNC)))
    if kind not in S.COLLECTIONS:
        return rows.select(*model.EVENT_FIELDS)
    did = ident.split("/", 1)[0] if "/" in ident else ""
    markers = log.filter(F.col("entity_type").isin(S.ACCOUNT, S.SYNC) & (F.col("did") == did))
    return accounts.visible(rows, accounts.guards_of(markers)).select(*model.EVENT_FIELDS)


def activity_index(log: DataFrame) -> DataFrame:
    return act.activity_rows(accepted(log))


def _touched(log: DataFrame, index: DataFrame | None, as_of_ms: int, limit: str | int | None,
             window_ms: int) -> DataFrame:
    """The touched keys as a local table: a finished top-k of at most 200 rows, so that the reads
    of their rows are point reads."""
    entries = (act.newest_entries(log, as_of_ms, limit_argument(limit), window_ms) if index is None
               else act.recent(index, as_of_ms, limit_argument(limit), window_ms))
    found = act.touched_keys(entries)
    return log.sparkSession.createDataFrame(found.collect(), found.schema)


def activity(log: DataFrame, as_of_ms: int, limit: str | int | None = None,
             window_ms: int = S.ACTIVITY_WINDOW_MS, index: DataFrame | None = None) -> DataFrame:
    """Records touched most recently, newest first, as each reads now.

    The limit applies to index rows, before they are made distinct and hidden ones leave, so fewer
    rows than the limit are correct. `index` is the stored index; without one the newest candidates
    of the log are judged.
    """
    touched = _touched(log, index, as_of_ms, limit, window_ms)
    wanted = [row["row_key"] for row in touched.collect()]
    shown = _visible_among(log, wanted).join(F.broadcast(touched), "row_key")
    return (shown.select("position", "latest_event_ms", *model.EVENT_FIELDS)
            .orderBy("position"))


def activity_answer(log: DataFrame, as_of_ms: int, limit: str | int | None = None,
                    window_ms: int = S.ACTIVITY_WINDOW_MS, index: DataFrame | None = None
                    ) -> DataFrame:
    """One row: observed_ms, latest_event_ms (null without entries), records in order."""
    touched = _touched(log, index, as_of_ms, limit, window_ms)
    wanted = [row["row_key"] for row in touched.collect()]
    event = F.struct(*model.EVENT_FIELDS)
    shown = _visible_among(log, wanted).select("row_key", event.alias("event"))
    listed = touched.join(F.broadcast(shown), "row_key", "left")
    pair = F.when(F.col("event").isNotNull(), F.struct("position", "event"))
    ordered = F.array_sort(F.collect_list(pair))  # at most 200
    return listed.agg(F.max("latest_event_ms").alias("latest_event_ms"),
                      F.transform(ordered, lambda p: p["event"]).alias("records")).select(
        F.lit(as_of_ms).cast("bigint").alias("observed_ms"), "latest_event_ms", "records")


def activity_summary(log: DataFrame, as_of_ms: int, limit: str | int | None = None,
                     window_ms: int = S.ACTIVITY_WINDOW_MS) -> DataFrame:
    return act.summary(activity(log, as_of_ms, limit, window_ms))


def activity_ages(log: DataFrame, as_of_ms: int, limit: str | int | None = None,
                  window_ms: int = S.ACTIVITY_WINDOW_MS) -> DataFrame:
    """One row: records shown, types shown, age of the newest index entry and of the newest source
    time among the records."""
    shown = activity(log, as_of_ms, limit, window_ms)
    newest_ms = F.max(instant_millis(F.col("event_time")))
    return shown.agg(F.count(F.lit(1)).alias("shown"),
                     F.count_distinct("entity_type").alias("types"),
                     (F.lit(as_of_ms) - F.max("latest_event_ms")).alias("index_age_ms"),
                     (F.lit(as_of_ms) - newest_ms).alias("source_age_ms"))


def account_records(log: DataFrame, did: str) -> DataFrame:
    """Row keys of one account's records, all three collections in one scan."""
    mine = F.col("entity_type").isin(*S.COLLECTIONS) & (F.col("did") == _argument("did", did))
    return log.filter(mine).select("row_key").distinct()


def point_rows(log: DataFrame, entity_type: str, entity_id: str) -> DataFrame:
    """The stored rows behind one lookup: the entity's and, for a record, its account's."""
    wanted = [keys_of(entity_type, entity_id)]
    if entity_type in S.COLLECTIONS:
        wanted.append(keys_of(S.ACCOUNT, entity_id.split("/", 1)[0] if "/" in entity_id else ""))
    return newest(log.filter(F.col("row_key").isin(*wanted)))


def keys_of(entity_type: str, entity_id: str) -> str:
    """Row key of an argument, by the rule of `keys.row_key`."""
    parts = (part.replace("%", "%25").replace("#", "%23") for part in (entity_type, entity_id))
    return "#".join(parts)


def ingest(feed: DataFrame, cursor: int = -1) -> dict[str, DataFrame]:
    """records, quarantine and counters of a batch of raw messages."""
    judged = ing.judge(feed)
    return {"records": ing.records(judged), "quarantine": ing.quarantine(judged),
            "counters": ing.counters(judged, cursor)}


def served_sample(log: DataFrame) -> DataFrame:
    """One row: how many of the first sampled posts are visible."""
    sample = [row["row_key"] for row in integrity.topic_sample(log).select("row_key").collect()]
    shown = _visible_among(log, sample).select("row_key")
    asked = log.sparkSession.createDataFrame([(key,) for key in sample], "row_key string")
    return asked.join(shown, "row_key", "left_semi").agg(F.count(F.lit(1)).alias("served"))


def reconcile_rows(log: DataFrame, snapshot: DataFrame, entity_type: str = S.LIKE,
                   limit: int | None = None) -> DataFrame:
    """Stored records of one type against the source's snapshot; with a limit the first keys."""
    current = newest(log.filter(F.col("entity_type") == entity_type)
                     .select("row_key", "offset", "did", "entity_type", "entity_id", "revision",
                             "source_seq", "state", "subject"))
    stored = accounts.judged_records(current, accounts.guards_of(log)).filter(~F.col("purged"))
    wanted = reconcile.candidates(stored, f"{entity_type}#", limit)
    ours = wanted.select("entity_id", "state", "subject", (~F.col("hidden")).alias("served"))
    return reconcile.compare_stored(ours, snapshot)


def reconcile_verdict(log: DataFrame, snapshot: DataFrame) -> DataFrame:
    return reconcile.verdict(reconcile_rows(log, snapshot, limit=S.TRACE_CANDIDATES))


def _metrics(prefix: str, one_row: DataFrame) -> DataFrame:
    """One row of numbers as (metric, value) rows."""
    pairs = F.array(*[F.struct(F.lit(prefix + name).alias("metric"),
                               F.col(name).cast("double").alias("value"))
                      for name in one_row.columns])
    return one_row.select(F.explode(pairs).alias("_m")).select("_m.metric", "_m.value")


def feed_profile(feed: DataFrame) -> DataFrame:
    """The sample report of a raw feed as (metric, value) rows.

    The body-free view of the feed is written once, so every text is read once however many parts ask
    for it; so are the two aggregations that most parts start from.
    """
    seen = cut(profile.observed(feed), "seen")
    minutes, unique = cut(profile.by_minute(seen), "minutes"), cut(profile.unique_commits(seen), "unique")
    kinds = profile.kind_counts(minutes).select(
        F.concat(F.lit("message_kinds."), "kind").alias("metric"),
        F.col("messages").cast("double").alias("value"))
    mix = profile.operation_mix(unique).select(
        F.concat(F.lit("operation_mix."), "collection", F.lit(" "), "operation").alias("metric"),
        F.col("commits").cast("double").alias("value"))
    rates = profile.minute_rates(minutes)
    spread = rates.select(F.explode(F.array(*[
        F.struct(F.concat("measure", F.lit("_per_second."), F.lit(short)).alias("metric"),
                 F.col(name).cast("double").alias("value"))
        for short, name in (("min", "min_per_second"), ("median", "median_per_second"),
                            ("p95", "p95_per_second"), ("full_minutes", "full_minutes"))])
    ).alias("_m")).select("_m.metric", "_m.value")
    regressions = profile.rev_regressions(unique).agg(F.count(F.lit(1)).alias("rev_regressions"))
    resume = profile.resume_check(seen, unique)
    parts = [
        kinds, mix, spread,
        _metrics("", profile.totals(minutes).select("bytes_per_message")),
        _metrics("", profile.commit_counts(minutes, unique)),
        _metrics("source_lag_seconds.", profile.source_lag(unique).select(
            F.col("median_s").alias("median"), F.col("p95_s").alias("p95"),
            F.col("max_s").alias("max"))),
        _metrics("", profile.several_ops(unique)), _metrics("", regressions),
        _metrics("resume.", resume.withColumn("cursor_is_inclusive",
                                              F.col("cursor_is_inclusive").cast("int"))),
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def integrity_report(log: DataFrame, counters: DataFrame) -> DataFrame:
    """The end-to-end check of a stored log against what ingest counted, as (metric, value) rows."""
    parts = [_metrics("", integrity.stored_counts(log)),
             _metrics("", counters.select("published", "quarantined")),
             _metrics("", served_sample(log)), _metrics("resume_", ing.resume_cursor(log))]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def event_lines(log: DataFrame) -> DataFrame:
    """Log rows in the form the records topic carries: key and contract JSON."""
    return log.select(F.col("row_key").alias("key"), contract.event_json().alias("value"))
