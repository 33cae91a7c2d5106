"""Exact top-k search by inner product over an impact-ordered index, score at a time.

Rows of the index are blocks of vectors. In a block every dimension has its vectors sorted by value
and cut into segments, whose bound is their quantised impact. For a query, segments of all dimensions are
processed by descending impact (the query's weight times the segment's bound, above the least that
the dimension can add); scores grow segment by segment. It stops only when it is proven that
few vectors can still be among the k best; those are rescored exactly. Vectors with components too
large for sums of 64 bits have blocks of their own, and are scored by floats with a bound of their error,
then exactly in integers of any size.

Candidate blocks and query blocks meet in a grid join of equal keys, so neither is broadcast.

Edge cases: vectors that are null, empty, or hold null or non-finite components take no part; a score
beyond 64 bits counts at its place but is shown as null, since the column is a bigint; vectors of different length never meet; null ids take no part; repeated rows are searched and
are candidates each, and only a query's own row is left out of its list; ties go to the smaller vec_id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lastword.llm import frames

SCALE, K, EVERY = 1024, 10, 100
BLOCK, QUERY_BLOCK = 8192, 512
SEGMENT, SEGMENTS = 64, 32  # postings of a segment at least; segments of a dimension at most
FEW = 64  # possible members at which rescoring is cheaper than more segments
ROUNDS = 24  # proofs are tried after each of so many shares of the segments
LIMIT = 1 << 24  # vectors with larger components go to blocks of their own


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and vector of every row that takes part, and a written number of the row: an id may stand in
    several rows."""
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v"))
            .where(F.col("vec_id").isNotNull() & (F.size("v") > 0) & fine))
    if not isinstance(vectors.schema[vector].dataType.elementType, T.FloatType):
        rows = rows.withColumn("v", F.col("v").cast("array<double>"))
    return frames.written(rows.withColumn("row", F.monotonically_increasing_id()), "topk-rows")


def packed(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of at most `size` vectors of equal length: block, dims, wide, rows, ids and values as bytes.

    Values are integer components of 32 bits, but in wide blocks, of vectors with components of LIMIT or
    more, the given components as doubles.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists, rows_ = batch.column(0).to_numpy(), batch.column(1), batch.column(2).to_numpy()
            width = np.diff(lists.offsets.to_numpy())
            values = lists.flatten().to_numpy().astype(np.float64)
            begin = np.concatenate([[0], np.cumsum(width)])
            large = np.logical_or.reduceat(np.abs(values) >= LIMIT // SCALE, begin[:-1]) if len(width) else width
            for dims, wide in np.unique(np.stack([width, large]), axis=1).T.tolist():
                mine = np.flatnonzero((width == dims) & (large == wide))
                table = values[begin[mine][:, None] + np.arange(dims)]
                if not wide:
                    table = np.floor(table * SCALE).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(rows_[mine[0]])]), pa.array([dims], pa.int32()), pa.array([bool(wide)]),
                     pa.array([rows_[mine].tobytes()]), pa.array([ids[mine].tobytes()]), pa.array([table.tobytes()])],
                    ["block", "dims", "wide", "rows", "ids", "values"])

    frames.small_batches(rows.sparkSession, size)
    return rows.select("vec_id", "v", "row").mapInArrow(
        run, "block bigint, dims int, wide boolean, rows binary, ids binary, values binary")


class Index:
    """Segments of one block: postings of each dimension by value, cut into runs of equal length."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, values: np.ndarray):
        self.rows, self.ids, self.values = rows, ids, values
        self.n, self.dims = values.shape
        step = max(SEGMENT, -(-self.n // SEGMENTS))
        cuts = np.arange(0, self.n, step)
        post = np.argsort(values, axis=0, kind="stable").T
        ranked = np.take_along_axis(values.T, post, 1).astype(np.int64)
        self.low, self.high = ranked[:, cuts], ranked[:, np.append(cuts[1:], self.n) - 1]
        padded = np.full((self.dims, len(cuts) * step), self.n, np.int64)  # the last run may be short
        padded[:, :self.n] = post
        self.postings = padded.reshape(-1, step)
        worths = np.zeros(padded.shape)
        worths[:, :self.n] = ranked
        self.worths = worths.reshape(-1, step)

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of all that may be among the k best but the row `own`."""
        weight = query.astype(np.int64)[:, None]
        ends = weight * self.low, weight * self.high
        least = np.minimum(*ends).min(1, keepdims=True)
        gain = (np.maximum(*ends) - least).ravel().astype(np.float64)  # a segment's impact
        order = np.argsort(-gain, kind="stable")
        factor = np.repeat(query.astype(np.float64), len(gain) // self.dims)
        base = np.repeat(least[:, 0].astype(np.float64), len(gain) // self.dims)
        ahead = gain.reshape(self.dims, -1).copy()
        total = np.zeros(self.n + 1)  # what was seen adds above the least of its dimensions
        alive = self.rows != own
        turn = -(-len(order) // ROUNDS)
        for at in range(0, len(order), turn):
            now = order[at:at + turn]
            adds = self.worths[now] * factor[now, None] - base[now, None]
            total += np.bincount(self.postings[now].ravel(), adds.ravel(), self.n + 1)
            ahead.ravel()[now] = 0
            last = at + turn >= len(order)
            if not last and at < len(order) // 3:
                continue  # a proof this early would fail
            # What is unseen of a dimension adds at most the impact of its next segment.
            bound = float(ahead.max(1).sum())
            live = total[:-1][alive]
            bar = np.partition(live, len(live) - k)[len(live) - k] if len(live) > k else -np.inf
            slack = 1e-9 * (abs(bar) + bound + 1) if len(live) > k else 0.0  # sums are rounded
            possible = np.flatnonzero(alive & (total[:-1] + bound + slack >= bar))
            if last or len(possible) <= FEW:
                break
        return self.ids[possible], self.values[possible].astype(np.int64) @ query.astype(np.int64)


def integers(vector: np.ndarray) -> list[int]:
    """The integer components of a row of a block."""
    if vector.dtype == np.int32:
        return vector.tolist()
    return [math.floor(x * SCALE) if abs(x) < 1 << 53 else int(x) * SCALE for x in vector.tolist()]


def floats(table: np.ndarray) -> np.ndarray:
    """The integer components of a block as floats, exact where they are finite."""
    if table.dtype == np.int32:
        return table.astype(np.float64)
    with np.errstate(over="ignore"):
        return np.floor(table * SCALE)


class Wide:
    """Vectors of one block whose scores may not fit into 64 bits."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, values: np.ndarray):
        self.rows, self.ids, self.values = rows, ids, values
        self.near = floats(values)
        self.far = np.abs(self.near)

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, list[int]]:
        """As that of Index."""
        weight = floats(query)
        with np.errstate(over="ignore", invalid="ignore"):
            score = self.near @ weight
            error = self.far @ np.abs(weight) * ((len(weight) + 4) * 2.0 ** -51)  # above that of any order of sums
            low, high = score - error, score + error
        possible = self.rows != own
        live = low[possible]
        if len(live) > k and np.isfinite(low).all() and np.isfinite(high).all():
            possible &= high >= np.partition(live, len(live) - k)[len(live) - k]
        possible = np.flatnonzero(possible)
        asked = integers(query)
        return self.ids[possible], [sum(a * b for a, b in zip(asked, integers(self.values[i]))) for i in possible]


def most(table: np.ndarray) -> int:
    return int(np.abs(table.astype(np.int64)).max())


def fits(queries: np.ndarray, values: np.ndarray) -> bool:
    """Whether every score of the two blocks fits into 64 bits."""
    return (queries.dtype == values.dtype == np.int32
            and queries.shape[1] * most(queries) * most(values) < 1 << 62)


def ordered(score: int) -> tuple[int | None, int, bytes | None]:
    """score, over, exact: a score of more than 64 bits by its sign and number of bytes, and by bytes that
    rise with it among those of one sign and number."""
    if -(1 << 63) <= score < 1 << 63:
        return score, 0, None
    size = (abs(score).bit_length() + 7) // 8
    if score > 0:
        return None, size, score.to_bytes(size, "big")
    return None, -size, ((1 << 8 * size) - 1 + score).to_bytes(size, "big")


def search(queries: DataFrame, candidates: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of each query row but itself.

    Both tables are parts of one result of `usable`: a row has the same number in each.
    """
    spark = queries.sparkSession
    n, asked = candidates.count(), queries.count()
    slots = max(1, -(-n // BLOCK))
    parts = max(1, -(-asked // QUERY_BLOCK))
    index = frames.written(packed(candidates.repartition(slots, "row"), BLOCK), "topk-index")
    asks = packed(queries.repartition(parts, "row"), QUERY_BLOCK)
    rooms = max(1, min(slots, 4096))
    asks = asks.select(F.col("dims"), F.col("wide").alias("query_wide"), F.col("rows").alias("query_rows"),
                       F.col("ids").alias("query_ids"), F.col("values").alias("queries"),
                       F.explode(F.sequence(F.lit(0), F.lit(rooms - 1))).alias("room"),
                       F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int").alias("part"))
    index = index.select("dims", "wide", "rows", "ids", "values",
                         F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
                         F.pmod(F.xxhash64("block"), F.lit(rooms)).cast("int").alias("room"))
    pairs = asks.join(index, ["dims", "room", "part"]).select(
        "dims", "query_wide", "query_rows", "query_ids", "queries", "wide", "rows", "ids", "values")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dims, query_wide, query_rows, query_ids, wanted, wide, rows, ids, values in zip(
                    *(c.to_pylist() for c in batch.columns)):
                table = np.frombuffer(wanted, np.float64 if query_wide else np.int32).reshape(-1, dims)
                values = np.frombuffer(values, np.float64 if wide else np.int32).reshape(-1, dims)
                narrow = fits(table, values)
                of_block = (Index if narrow else Wide)(np.frombuffer(rows, np.int64), np.frombuffer(ids, np.int64), values)
                query_rows, query_ids = np.frombuffer(query_rows, np.int64), np.frombuffer(query_ids, np.int64)
                out: list[tuple[np.ndarray, list]] = []
                for own, query in zip(query_rows.tolist(), table):
                    who, score = of_block.search(query, own, k)
                    if narrow:
                        best = np.lexsort((who, -score))[:k]
                        out.append((who[best], score[best].tolist()))
                    else:
                        best = sorted(range(len(who)), key=lambda i: (-score[i], who[i]))[:k]
                        out.append((who[best], [score[i] for i in best]))
                sizes = [len(who) for who, _ in out]
                score, over, exact = zip(*(ordered(x) for _, found in out for x in found)) if any(sizes) else ((),) * 3
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(query_rows, sizes)), pa.array(np.repeat(query_ids, sizes)),
                     pa.array(np.concatenate([who for who, _ in out])), pa.array(score, pa.int64()),
                     pa.array(over, pa.int32()), pa.array(exact, pa.binary())],
                    ["query_row", "query_id", "vec_id", "score", "over", "exact"])

    frames.small_batches(spark, 8)
    found = frames.written(pairs.mapInArrow(run, "query_row bigint, query_id bigint, vec_id bigint, score bigint, "
                                                 "over int, exact binary"), "topk-found")
    best = Window.partitionBy("query_row").orderBy(F.desc("over"), F.desc("score"), F.desc("exact"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op4_topk(spark: SparkSession, folder: str) -> DataFrame:
    every = usable(frames.table(spark, folder, "embeddings"))
    return search(every.where(F.col("vec_id") % EVERY == 0), every)
