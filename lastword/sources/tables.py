"""Stored tables: batch folders made visible by a commit row, and bucketed state generations.

    <root>/records/batch=<id>/       log rows of one ingest batch
    <root>/quarantine/batch=<id>/    its malformed messages
    <root>/commits/batch=<id>/       one row, written last: the batch exists from here on
    <root>/state/<gen>/bucket=<b>/   newest row or tombstone per key
    <root>/pointers/gen=<gen>/       which generation each bucket is in, written last

A batch that is written again overwrites its own folders. Readers look only at committed batches
and at generations a pointer names, so a crash in between leaves nothing visible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lastword import model, settings as S
from lastword.functions import contract
from lastword.functions.instants import instant_millis
from lastword.functions.keys import bucket
from lastword.operators import accounts
from lastword.operators.newest import newest

_TOMBSTONE = T.StructType(model.RECORDS_LOG.fields
                          + [T.StructField("purged", T.BooleanType()),
                             T.StructField("bucket", T.IntegerType())])
_POINTER = T.StructType([T.StructField("bucket", T.IntegerType()),
                         T.StructField("home", T.LongType()),
                         T.StructField("upto", T.LongType()),
                         T.StructField("gen", T.LongType())])


def _filesystem(spark: SparkSession, path: str):
    """Hadoop file system of a path: local, HDFS or object store alike."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _filesystem(spark, path)
    return files.exists(place)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the partition folders of a table."""
    files, place = _filesystem(spark, path)
    if not files.exists(place):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(place)
                  if status.isDirectory() and "=" in status.getPath().getName())


def drop(spark: SparkSession, path: str) -> None:
    files, place = _filesystem(spark, path)
    files.delete(place, True)


class Store:
    """The tables below one shared root folder."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = S.STATE_BUCKETS):
        self.spark, self.root, self.buckets = S.configure(spark), root.rstrip("/"), buckets

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _empty(self, schema: T.StructType) -> DataFrame:
        return self.spark.createDataFrame([], schema)

    def _read(self, table: str, schema: T.StructType) -> DataFrame:
        if not folders(self.spark, self.path(table)):
            return self._empty(schema)
        return self.spark.read.schema(schema).parquet(self.path(table))

    # Batches

    def write_batch(self, table: str, rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path(table)}/batch={batch}")

    def write_run(self, table: str, rows: DataFrame, run: str, batch: int) -> None:
        """A folder per batch of one named run; another run of the job never overwrites it."""
        rows.write.mode("overwrite").parquet(f"{self.path(table)}/run={run}/batch={batch}")

    def read_runs(self, table: str, schema: T.StructType) -> DataFrame:
        """Rows of the batches that have a commit row."""
        names = [T.StructField("run", T.StringType()), T.StructField("batch", T.LongType())]
        done = self._read("routed", T.StructType([T.StructField("done", T.BooleanType()), *names]))
        rows = self._read(table, T.StructType(schema.fields + names))
        return rows.join(done.select("run", "batch"), ["run", "batch"], "left_semi").drop("run")

    def commit_run(self, run: str, batch: int) -> None:
        self.write_run("routed", self.spark.range(1).select(F.lit(True).alias("done")), run, batch)

    def routed(self, run: str, batch: int) -> bool:
        return exists(self.spark, f"{self.path('routed')}/run={run}/batch={batch}/_SUCCESS")

    def commit(self, row: DataFrame, batch: int) -> None:
        self.write_batch("commits", row.coalesce(1), batch)

    def commits(self) -> DataFrame:
        return self._read("commits", model.COMMIT)

    def _finished(self, table: str) -> int:
        """Highest number of the folders of a table whose write came to its end, -1 for none. It
        looks at names alone, so it costs the same however much the folders hold."""
        numbers = sorted((int(name.split("=")[1]) for name in folders(self.spark, self.path(table))),
                         reverse=True)
        kind = "gen" if table == "pointers" else "batch"
        return next((n for n in numbers if exists(
            self.spark, f"{self.path(table)}/{kind}={n}/_SUCCESS")), -1)

    def last_commit(self) -> tuple[int, int]:
        """(batch, cursor) of the newest commit, (-1, -1) when there is none."""
        batch = self._finished("commits")
        if batch < 0:
            return -1, -1
        row = self.spark.read.parquet(f"{self.path('commits')}/batch={batch}").first()
        return batch, row["cursor"]

    def last_run(self) -> tuple[str | None, int]:
        """The run of the newest commit and its batch number in that run."""
        batch = self._finished("commits")
        if batch < 0:
            return None, -1
        plain = T.StructType(model.COMMIT.fields[1:])
        row = self.spark.read.schema(plain).parquet(f"{self.path('commits')}/batch={batch}").first()
        return row["run"], -1 if row["run_batch"] is None else row["run_batch"]

    def _committed(self, table: str, schema: T.StructType, after: int = -1) -> DataFrame:
        """Rows of committed batches. Batches commit in order, so one bound selects them, and it
        prunes folders."""
        last = self.last_commit()[0]
        full = T.StructType(schema.fields + [T.StructField("batch", T.LongType())])
        rows = self._read(table, full)
        return rows.filter((F.col("batch") <= last) & (F.col("batch") > after))

    def records(self, after: int = -1) -> DataFrame:
        return self._committed("records", model.RECORDS_LOG, after).drop("batch")

    def quarantine(self) -> DataFrame:
        """Malformed messages; a restart may have repeated some, the key makes them one."""
        rows = self._committed("quarantine", model.QUARANTINE).drop("batch")
        rest = F.min(F.struct("received_at", "raw", "reason")).alias("_q")
        return (rows.groupBy("key").agg(rest)
                .select("key", "_q.raw", "_q.reason", "_q.received_at"))

    def resume_cursor(self) -> int:
        """Highest sequence the records log has committed, -1 when it holds none."""
        return self.records().agg(F.coalesce(F.max("source_seq"), F.lit(-1)).alias("c")).first()["c"]

    # State generations

    def pointers(self) -> DataFrame:
        return self._read("pointers", _POINTER)

    def generation(self) -> tuple[int, int, dict[int, int]]:
        """(generation, last batch it covers, home generation of each bucket)."""
        gen = self._finished("pointers")
        if gen < 0:
            return -1, -1, {}
        rows = self.pointers().filter(F.col("gen") == gen).collect()  # one row per bucket
        return gen, max(r["upto"] for r in rows), {r["bucket"]: r["home"] for r in rows}

    def state_rows(self, only: list[int] | None = None) -> DataFrame:
        """Compacted rows, tombstones included, of all buckets or of some."""
        _, _, homes = self.generation()
        parts = [f"{self.path('state')}/{home}/bucket={b}" for b, home in sorted(homes.items())
                 if only is None or b in only]
        if not parts:
            return self._empty(_TOMBSTONE)
        plain = T.StructType(_TOMBSTONE.fields[:-1])
        rows = self.spark.read.schema(plain).parquet(*parts)
        return rows.withColumn("bucket", bucket(F.col("row_key"), self.buckets))

    def state_log(self, only: list[int] | None = None) -> DataFrame:
        """A log with the same newest rows as the whole history: compacted rows, then every batch
        since. Purged keys keep a tombstone with their revision, so an older revision that comes
        back late stays old."""
        upto = self.generation()[1]
        compacted = self.state_rows(only)
        fresh = self.records(after=upto)
        if only is not None:
            fresh = fresh.filter(bucket(F.col("row_key"), self.buckets).isin(only))
        return compacted.select(*model.LOG_FIELDS, "purged").unionByName(
            fresh.select(*model.LOG_FIELDS).withColumn("purged", F.lit(False)))

    def current(self, only: list[int] | None = None) -> DataFrame:
        """Newest row per key; tombstones have served their purpose by then."""
        return newest(self.state_log(only)).filter(~F.col("purged")).drop("purged")

    def guards(self) -> DataFrame:
        """Hiding accounts. Markers are compacted beside the state, in `markers/<gen>`."""
        return accounts.guards(accounts.account_status(self.current()), self.purge_markers())

    def purge_markers(self, did: str | None = None, only: list[int] | None = None) -> DataFrame:
        """Of all accounts, or of one, whose markers are in the buckets `only`."""
        gen, upto, _ = self.generation()
        fresh = accounts.purge_markers(self.marker_log(upto, did, only))
        if gen < 0:
            return fresh
        old = self.spark.read.parquet(f"{self.path('markers')}/{gen}")
        if did is not None:
            old = old.filter(F.col("did") == did)
        return old.unionByName(fresh).groupBy("did").agg(F.max("purge_seq").alias("purge_seq"))

    def marker_log(self, after: int, did: str | None = None,
                   only: list[int] | None = None) -> DataFrame:
        """Marker rows since a batch, behind the newest compacted row of their key, so acceptance
        is judged against everything that came before."""
        kinds = F.col("entity_type").isin(S.ACCOUNT, S.SYNC)
        if did is not None:
            kinds &= F.col("did") == did
        before = (self.state_rows(only).filter(kinds).select(*model.LOG_FIELDS))
        return before.unionByName(self.records(after).filter(kinds).select(*model.LOG_FIELDS))

    def visible(self) -> DataFrame:
        return accounts.visible(self.current(), self.guards())

    def lookup(self, entity_type: str, entity_id: str) -> DataFrame:
        """Point lookup: reads the buckets of the entity and of its account, nothing else."""
        from lastword.plans.queries import current_state, keys_of
        did = entity_id.split("/", 1)[0] if "/" in entity_id else ""
        keys = [keys_of(entity_type, entity_id), keys_of(S.ACCOUNT, did), keys_of(S.SYNC, did)]
        values = ", ".join("'" + key.replace("\\", "\\\\").replace("'", "\\'") + "'" for key in keys)
        places = self.spark.sql(f"SELECT explode(array({values})) AS k").select(
            bucket(F.col("k"), self.buckets).alias("b"))
        only = [row["b"] for row in places.collect()]  # three literals
        seen = current_state(self.current(only), entity_type, entity_id)
        if entity_type not in S.COLLECTIONS:
            return seen
        mine = self.purge_markers(did, only)
        owned = seen.withColumn("did", F.lit(did)).withColumn(
            "row_key", F.lit(keys[0]))
        return accounts.unpurged(owned, mine).select(*model.EVENT_FIELDS)

    def compact(self) -> int:
        """Folds committed batches into the state and returns the new generation.

        Only buckets that received rows are rewritten. Records at or below their account's purge
        boundary shrink to a tombstone of key and revision.
        """
        gen, upto, homes = self.generation()
        last = self.last_commit()[0]
        if last <= upto:
            return gen
        fresh = self.records(after=upto)
        touched = sorted(r["b"] for r in fresh.select(
            bucket(F.col("row_key"), self.buckets).alias("b")).distinct().collect())  # bucket numbers
        new = gen + 1
        markers = self.purge_markers()
        markers.write.mode("overwrite").parquet(f"{self.path('markers')}/{new}")
        markers = self.spark.read.parquet(f"{self.path('markers')}/{new}")
        rows = newest(self.state_log(touched))
        alive = accounts.unpurged(rows.filter(~F.col("purged")), markers)
        gone = accounts.salted_join(
            rows.filter(~F.col("purged") & contract.is_collection(F.col("entity_type"))),
            markers).filter(F.col("source_seq") <= F.col("purge_seq"))
        keep = ("offset", "row_key", "did", "source_seq", "entity_type", "revision")
        dead = gone.select(*[F.col(c) if c in keep else F.lit(None).cast("string").alias(c)
                             for c in model.LOG_FIELDS], F.lit(True).alias("purged"))
        old = rows.filter(F.col("purged"))
        out = alive.unionByName(dead).unionByName(old).withColumn(
            "bucket", bucket(F.col("row_key"), self.buckets))
        # Rebalancing splits a large bucket by size and keeps a small one whole; the order inside a
        # file lets a point read skip row groups.
        (out.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", "row_key")
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path('state')}/{new}"))
        homes.update({b: new for b in touched})
        pointer = self.spark.createDataFrame([(b, h, last) for b, h in sorted(homes.items())],
                                             "bucket int, home bigint, upto bigint")
        pointer.coalesce(1).write.mode("overwrite").parquet(f"{self.path('pointers')}/gen={new}")
        return new

    def expire(self, now_ms: int, keep_ms: int = S.LOG_RETENTION_MS) -> list[str]:
        """Drops committed batch folders whose newest row is older than the retention and that the
        state has absorbed. Returns what was dropped."""
        upto = self.generation()[1]
        full = T.StructType(model.RECORDS_LOG.fields + [T.StructField("batch", T.LongType())])
        ages = self._read("records", full).filter(F.col("batch") <= upto).groupBy("batch").agg(
            F.max(instant_millis(F.col("received_at"))).alias("newest"))
        old = [r["batch"] for r in ages.filter(F.col("newest") < now_ms - keep_ms)
               .select("batch").collect()]  # batch numbers
        for batch in old:
            drop(self.spark, f"{self.path('records')}/batch={batch}")
        return [f"batch={batch}" for batch in sorted(old)]
