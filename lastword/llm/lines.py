"""Line dedup: an exact set-similarity join of lines that removes later matches.

A line's tokens are its distinct shingles of five words (all its words, if fewer). A line is removed
if an earlier line of the corpus, in its own document or another, has Jaccard similarity 0.75 or
more with it, whether or not that one is removed itself. Order: doc_id, hash of the text, line. The
join orders tokens by rarity and applies prefix, positional and length filters, then verifies
(see setjoin). In a long posting list an early class is the pivot of later ones; those that it does not
remove are searched among all earlier ones of their lists, in blocks of bounded volume (see listblocks).

Edge cases: lines without words are never removed, nor counted; null and empty texts have no lines;
rows that repeat id and text are one document and get equal results; null ids come first; an empty
table gives no rows; other columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lastword.llm import frames, listblocks, textops
from lastword.llm import setjoin as sj

def between_breaks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the lines of all texts that have any byte."""
    breaks = np.flatnonzero(data == 10)
    low, high = np.sort(np.append(offsets[:-1], breaks + 1)), np.sort(np.append(breaks, offsets[1:]))
    full = low < high
    return low[full], high[full]


def bounds(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Lowered bytes, starts and ends of words; first word of each line with words (and the end), its text, and
    the line's first and last byte."""
    data, offsets = textops.flat(texts)
    data = textops.looked_up(data, textops.LOWER)
    starts, ends, _ = textops.spans(data, offsets, textops.NOT_SPACE)
    low, high = between_breaks(data, offsets)
    first = np.searchsorted(starts, np.append(low, len(data)))
    full = first[1:] > first[:-1]
    low, high = low[full], high[full]
    of = np.searchsorted(offsets, low, "right") - 1
    return data, starts, ends, np.append(first[:-1][full], len(starts)), of, low, high


def lines(texts: pa.Array, places: np.ndarray | None = None,
          wanted: Callable[[np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, the first word and the text of each line with words; only of lines at a wanted place, if asked
    for. A line's place is its text's plus its number."""
    data, starts, ends, first, of, _, _ = bounds(texts)
    if wanted is not None:
        keep = wanted(places[of] + (np.arange(len(of)) - np.searchsorted(of, of)))
        count = np.diff(first)
        mine = np.repeat(keep, count)
        starts, ends, of = starts[mine], ends[mine], of[keep]
        first = np.concatenate([[0], np.cumsum(count[keep])])
    return textops.word_hashes(data, starts, ends), first, of


def verified(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, by their exact overlap."""
    frames.small_batches(pairs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for a, ta, b, tb in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 5))):
                x, y = np.frombuffer(ta, np.uint64), np.frombuffer(tb, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if sj.OF * both >= sj.NEED * (len(x) + len(y) - both):
                    left.append(a)
                    right.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return frames.written(sj.with_both_sets(pairs, members).mapInArrow(frames.lean(run), "a bigint, b bigint"), "links")


def later(links: DataFrame, firsts: DataFrame) -> DataFrame:
    """Of each link the class whose first line comes later."""
    def side(x: str) -> DataFrame:
        return firsts.select(F.col("node").alias(x), F.col("first").alias(f"first_{x}"))

    return (links.join(side("a"), "a").join(side("b"), "b")
            .select(F.when(F.col("first_a") > F.col("first_b"), F.col("a")).otherwise(F.col("b")).alias("node")))


def pivot_pairs(named: DataFrame, gone: DataFrame) -> DataFrame:
    """Each class that is not gone (b) with one earlier class (a): of the earliest of its lists, that of most."""
    pivot = named.groupBy("token").agg(F.min(F.struct("first", "a", "size")).alias("p"))
    common = (named.join(gone, "node", "left_anti").join(pivot, "token")
              .where((F.col("first") > F.col("p.first")) & sj.close(F.col("size"), F.col("p.size")))
              .groupBy(F.col("a").alias("b"), F.col("p.a").alias("a")).agg(F.count("*").alias("n")))
    return common.groupBy("b").agg(F.max(F.struct("n", "a"))["a"].alias("a")).select("a", "b")


def removed_classes(rows: DataFrame, text: str, units: DataFrame, of_class: DataFrame) -> DataFrame:
    """one and two of every class whose first line has an earlier match."""
    gone, firsts = removed_nodes(rows, text, units, of_class)
    return firsts.join(gone, "node", "left_semi").select("one", "two", "first")


def removed_nodes(rows: DataFrame, text: str, units: DataFrame,
                  of_class: DataFrame) -> tuple[DataFrame, DataFrame]:
    classes, tokens = sj.rarity(units)
    met = frames.written(sj.candidates(sj.postings(rows, text, lines, classes, tokens), tokens), "met")
    alive, short, long = sj.surviving(met)
    firsts = frames.written(of_class.withColumn("a", sj.class_column()).join(alive, "a", "left_semi"), "firsts")
    first = F.col("first")
    members = sj.member_sets(rows.withColumn("place", place_of(F.col("__id"), F.col("__hash"))), text, lines,
                             short.select("a").union(short.select("b")).union(long.select("a")),
                             firsts.select("a", (place_of(first["__id"], first["__hash"]) + first["line"]).alias("place")))
    gone = frames.written(later(verified(short, members), firsts).distinct(), "gone")
    if long.isEmpty():
        return gone, firsts
    named = frames.written(long.join(firsts, "a").select("a", "node", "size", "token", "first"), "lists")
    gone = frames.written(gone.union(later(verified(pivot_pairs(named, gone), members), firsts)).distinct(), "gone")
    asked = named.join(gone.withColumn("query", F.lit(False)), "node", "left").withColumn(
        "query", F.coalesce("query", F.lit(True)))
    # Lists without a line that may still have an earlier match are done.
    open_ = asked.where("query").select("token").distinct()
    more = listblocks.matched(asked.join(open_, "token", "left_semi"), members)
    return gone.union(more).distinct(), firsts


def row_key() -> list[Column]:
    return [F.col("doc_id").cast("long").alias("__id"), F.xxhash64("text").alias("__hash")]


def place_of(doc_id: Column, text_hash: Column) -> Column:
    """A number for a text to which its lines' numbers are added; below 2^62, so that no sum overflows."""
    return F.shiftrightunsigned(F.xxhash64(doc_id, text_hash), 2)


def marked(docs: DataFrame) -> DataFrame:
    """__id, __hash and the sorted numbers of the removed lines of every document that has any.

    Numbers count the lines with words from 0.
    """
    rows = docs.select(*row_key(), "text")
    units = sj.described(rows, "text", ["__id", "__hash"], lines, "line")
    every = units.where("part IS NULL AND size > 0").select("__id", "__hash", "line", "one", "two")
    place = F.struct("__id", "__hash", "line")
    of_class = frames.written(every.groupBy("one", "two").agg(F.min(place).alias("first"), F.count("*").alias("n"))
                              .withColumn("node", F.col("one")), "classes")
    gone = removed_classes(rows, "text", units, of_class)
    # Only classes of several lines, or removed as a whole, have lines to remove.
    known = (of_class.where("n > 1").select("one", "two", "first", F.lit(False).alias("gone"))
             .unionByName(gone.withColumn("gone", F.lit(True)))
             .groupBy("one", "two").agg(F.min("first").alias("first"), F.max("gone").alias("gone")))
    return (every.join(known, ["one", "two"]).where(F.col("gone") | (place != F.col("first")))
            .groupBy("__id", "__hash").agg(F.array_sort(F.collect_set("line")).alias("__lines")))


def deduplicated(docs: DataFrame, counts: bool = False) -> DataFrame:
    """docs with their columns and without removed lines; on demand with __n_lines and __n_removed."""
    columns = docs.columns
    drop = frames.written(marked(docs).select(F.col("__id").alias("__i"), F.col("__hash").alias("__h"), "__lines"),
                          "removed-lines")
    keyed = docs.select(*[F.col(f"`{c}`") for c in columns], *row_key())
    # Places are unique there, so no hash table of a part grows with a key; texts need not be sorted.
    drop = drop.hint("shuffle_hash")
    joined = (keyed.join(drop, F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__hash") == F.col("__h")), "left")
              .select(*[F.col(f"`{c}`") for c in columns], "__lines"))
    schema = joined.drop("__lines").schema.add("__n_lines", "long").add("__n_removed", "long")
    at = columns.index("text")
    frames.small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at)
            data, offsets = textops.flat(texts)
            *_, of, low, high = bounds(texts)
            begin = np.searchsorted(of, np.arange(len(texts) + 1))
            out, taken = [], np.zeros(len(texts), np.int64)
            for i, numbers in enumerate(batch.columns[-1].to_pylist()):
                if not numbers:
                    continue
                keep = np.ones(offsets[i + 1] - offsets[i], bool)
                for n in numbers:
                    start, end = low[begin[i] + n] - offsets[i], high[begin[i] + n] - offsets[i]
                    keep[start:end + 1] = False  # the line and its break
                if end == len(keep) and len(keep):  # no break after the last line: take the one before
                    left = np.flatnonzero(keep)
                    if len(left) and data[offsets[i] + left[-1]] == 10:
                        keep[left[-1]] = False
                out.append(data[offsets[i]:offsets[i + 1]][keep].tobytes().decode())
                taken[i] = len(numbers)
            cols = list(batch.columns[:-1])
            if out:
                cols[at] = pc.replace_with_mask(texts, pa.array(taken > 0), pa.array(out, texts.type))
            yield pa.RecordBatch.from_arrays([*cols, pa.array(np.diff(begin)), pa.array(taken)],
                                             [*columns, "__n_lines", "__n_removed"])

    out = joined.mapInArrow(frames.lean(run), schema)
    return out if counts else out.select(*[F.col(f"`{c}`") for c in columns])


@frames.other_columns_aside
def without_repeats(docs: DataFrame) -> DataFrame:
    """docs without removed lines, and without documents that had words in lines but keep none.

    n_chars, where it is a column, follows a changed text.
    """
    out = deduplicated(docs, counts=True).where("__n_lines = 0 OR __n_removed < __n_lines")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("__n_removed") > 0, F.length("text").cast(kind))
                             .otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def op1_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: doc_id, n_lines with words, n_removed, kept_sha256 of what is left of the text."""
    docs = frames.table(spark, folder, "documents").select("doc_id", "text")
    return deduplicated(docs, counts=True).select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
