"""How five document filters interact, for every order in which they can be applied.

Each document gets a mask of the filters that it fails. Which of them takes it out in an order depends on
its mask alone, so counts by mask are all that any order needs, and they add up.

Four filters look at one text. The fifth, an identical text under a smaller id, needs the table: a
counting Bloom sketch of all text hashes is built per task in slices, the slices are added up, and a
text one of whose cells holds a single count is unique for certain. Only texts that are not cleared are
shuffled, whole, for the exact smallest id of each. The sketch has CELLS counters a row, rounded up to
a power of two and never more than MOST, so what is broadcast is at most MOST / 8 bytes; where a table
would need more, fewer texts are cleared and more take the exact path, with the same result.

Edge cases: a null text is empty, and empty texts are identical to each other; a null language is the
empty string; a null id counts as larger than any id, so it is a duplicate of any row with an id and of no
row without; rows that repeat an id with the same text fail alike (none is smaller than the other);
texts of any length are hashed and compared whole; ties do not arise; labels of a null id belong to no
document, and of repeated labels one that says 1 decides; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lastword.llm import frames

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
SPACE = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

CELLS, HASHES = 16, 3  # counters a row, counters of one text
LEAST, MOST = 1 << 16, 1 << 30  # counters of a sketch
SLICE = 1 << 16  # counters added up in one group


def own_mask(text: Column) -> Column:
    """The bits of the filters A to D, which a text fails by itself."""
    words = F.array_remove(F.split(text, SPACE), "")
    length = F.char_length(text)
    capitals = length - F.char_length(F.translate(text, CAPITALS, ""))
    fails = [F.size(words) < 200, F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
             capitals * 100 > length * 3, text.rlike(r"[#$%&*|]")]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0)).cast("int")


def cells_of(hashes: np.ndarray, cells: int) -> np.ndarray:
    """HASHES different cells of each 64-bit hash, a power of two of them in all."""
    start = hashes.view(np.uint64)
    stride = (start >> np.uint64(33)) | np.uint64(1)
    return np.stack([(start + np.uint64(k) * stride) & np.uint64(cells - 1) for k in range(HASHES)])


def sketch(hashed: DataFrame, column: str, rows: int) -> np.ndarray:
    """One bit per cell of the counting sketch: whether its count is two or more."""
    cells = min(MOST, max(LEAST, 1 << (max(1, CELLS * rows) - 1).bit_length()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's counts, at most two each, as rows of a slice: its cells and whether they are twos."""
        for batch in batches:
            found, times = np.unique(cells_of(batch.column(0).to_numpy(), cells), return_counts=True)
            slices = (found // np.uint64(SLICE)).astype(np.int64)
            cuts = np.append(np.flatnonzero(np.diff(slices, prepend=-1)), len(slices))
            packed = ((found % np.uint64(SLICE)) << np.uint64(1) | (times > 1).astype(np.uint64)).astype("<u4")
            blobs = [packed[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(slices[cuts[:-1]]), pa.array(blobs, pa.binary())], ["slice", "counts"])

    def add(key: tuple, table: pa.Table) -> pa.Table:
        total = np.zeros(SLICE, np.uint32)
        for blob in table.column("counts").to_pylist():
            packed = np.frombuffer(blob, "<u4")
            total[packed >> 1] += 1 + (packed & 1)
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int64()),
                         "bits": pa.array([np.packbits(total > 1).tobytes()], pa.binary())})

    merged = (hashed.select(column).mapInArrow(count, "slice bigint, counts binary")
              .groupBy("slice").applyInArrow(add, "slice bigint, bits binary"))
    bits = np.zeros(cells // 8, np.uint8)  # MOST / 8 bytes at most
    for row in merged.toLocalIterator():
        at = row["slice"] * (SLICE // 8)
        bits[at:at + SLICE // 8] = np.frombuffer(row["bits"], np.uint8)
    return bits


def possible_repeat(spark: SparkSession, bits: np.ndarray, hashed: Column) -> Column:
    """Whether the sketch leaves it open that a text with this hash stands in the table twice."""
    shared = spark.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def test(hashes: pd.Series) -> pd.Series:
        cells = cells_of(hashes.to_numpy(np.int64), 8 * len(shared.value))
        held = shared.value[cells >> np.uint64(3)] >> (7 - (cells & np.uint64(7))).astype(np.uint8) & 1
        return pd.Series(held.all(axis=0))

    return test(hashed)


def masks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per row: doc_id, part (its language) and mask, a bit for each filter that it fails. Written."""
    spark = docs.sparkSession
    frames.ship(spark)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("text"),
                       F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("part"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    narrow = frames.written(rows.select("doc_id", "part", "hash", own_mask(F.col("text")).alias("mask")), "masks")
    bits = sketch(narrow, "hash", narrow.count())
    unsure = possible_repeat(spark, bits, F.col("hash"))
    first = (rows.select("doc_id", "hash", "text").where(unsure).groupBy("text", "hash")
             .agg(F.min("doc_id").alias("least")).select("least", F.col("hash").alias("of")))
    known = narrow.withColumn("unsure", unsure)
    open_ = known.where("unsure").join(
        first, F.col("doc_id").eqNullSafe(F.col("least")) & (F.col("hash") == F.col("of")), "left")
    copy = F.when(F.col("of").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    return frames.written(
        known.where("NOT unsure").select("doc_id", "part", "mask")
        .unionByName(open_.select("doc_id", "part", (F.col("mask") + copy).alias("mask"))), "flags")


def mask_counts(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n rows, and how many of them are labelled good and toxic."""
    marks = (labels.select(F.col("doc_id").cast("long").alias("id"), (F.col("quality") == 1).cast("int").alias("q"),
                           (F.col("toxic") == 1).cast("int").alias("t")).where("id IS NOT NULL")
             .groupBy("id").agg(F.max("q").alias("q"), F.max("t").alias("t")))
    none = F.lit(0).cast("long")
    marked = (flags.join(marks, F.col("doc_id") == F.col("id")).groupBy("part", "mask")
              .agg(F.sum(F.coalesce("q", none)).alias("good"), F.sum(F.coalesce("t", none)).alias("toxic"))
              .select("part", "mask", none.alias("n"), "good", "toxic"))
    every = flags.groupBy("part", "mask").agg(F.count("*").alias("n")).select(
        "part", "mask", "n", none.alias("good"), none.alias("toxic"))
    return every.unionByName(marked).groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))


def interactions(counts: DataFrame) -> DataFrame:
    """Per part, order and step what the step's filter does, from at most 32 mask counts a part."""
    place = {letter: 1 << k for k, letter in enumerate(FILTERS)}
    steps = F.array(*[
        F.struct(F.lit(order).alias("filter_order"), F.lit(k + 1).alias("step"), F.lit(place[order[k]]).alias("bit"),
                 F.lit(sum(place[x] for x in order[:k])).alias("before"))
        for order in ORDERS for k in range(len(order))])
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("held"))
    rows = parts.select("part", "held", F.explode(steps).alias("s")).select("part", "held", "s.*")

    def fails(row: Column, bits: str) -> Column:
        return row["mask"].bitwiseAND(F.col(bits)) != 0

    def total(of: str, when) -> Column:
        return F.aggregate("held", F.lit(0).cast("long"),
                           lambda sum_, row: sum_ + F.when(when(row), row[of]).otherwise(0))

    def removed(row: Column) -> Column:
        return fails(row, "bit") & ~fails(row, "before")

    # A filter comes first among the k filters that a document fails in 120 / k of the orders.
    share = F.aggregate("held", F.lit(0).cast("long"), lambda sum_, row: sum_ + F.when(
        fails(row, "bit"), row["n"] * F.floor(F.lit(len(ORDERS)) / F.bit_count(row["mask"]))).otherwise(0))
    return rows.select(
        "part", "filter_order", "step",
        total("n", lambda row: ~fails(row, "bit") & ~fails(row, "before")).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", lambda row: fails(row, "bit") & fails(row, "before")).alias("redundant"),
        total("n", lambda row: row["mask"] == F.col("bit")).alias("unique_fails"),
        total("good", removed).alias("good_lost"), total("toxic", removed).alias("toxic_lost"),
        share.alias("shapley"))


def op12_filters(spark: SparkSession, folder: str) -> DataFrame:
    docs = frames.table(spark, folder, "documents")
    return interactions(mask_counts(masks(docs), frames.table(spark, folder, "labels")))


SQL = r"""
WITH body AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
worded AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least
           FROM body),
masked AS (SELECT doc_id, part,
    CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > least OR (doc_id IS NULL AND least IS NOT NULL) THEN 16 ELSE 0 END AS mask
  FROM worded),
marks AS (SELECT doc_id AS id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS q,
    max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS t FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
counts AS (SELECT part, mask, count(*) AS n, sum(coalesce(q, 0)) AS good, sum(coalesce(t, 0)) AS toxic,
    bit_count(mask) AS fails
  FROM masked LEFT JOIN marks ON doc_id = id GROUP BY part, mask),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS l(letter, bit)),
orders AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
    [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
steps AS (SELECT filter_order, step, bits[step] AS bit,
    CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step))
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
  CAST(sum(CASE WHEN mask & (bit | before) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
  CAST(sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
  CAST(sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
  CAST(sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
  CAST(sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
  CAST(sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost,
  CAST(sum(CASE WHEN mask & bit <> 0 THEN n * (120 // fails) ELSE 0 END) AS BIGINT) AS shapley
FROM counts, steps GROUP BY part, filter_order, step
"""
