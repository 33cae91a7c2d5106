"""Benchmark decontamination by a prefix-filtered set join of word windows.

A window is `size` consecutive words of an item (all words of a shorter one). Its tokens are its
shingles of five words (of all its words, if fewer). Containing a window means containing all of its
tokens, so one token is a sufficient prefix: the rarest of the corpus. Documents are probed for
those prefix tokens; a hit fixes where the window would begin, position and length bounds drop
impossible ones, and the words themselves decide.

Nothing of the benchmark is broadcast but bitmaps of BITS bits: a false hit there costs a row, the join
by token is exact. Windows of equal words are one, whatever items hold them.

Edge cases: null and empty texts have no words and no hits; items without words have no windows;
repeated documents get equal rows each; repeated items count once; a null item id counts as an
empty one; empty tables give no rows, or rows without hits; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lastword.llm import frames, textops

SIZE, TOKEN_WORDS = 13, 5
SHARE = 20  # contaminated: at least one word in 20 is hit
BITS = 1 << 23


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = textops.flat(texts)
    data = textops.LOWER[data]
    return data, *textops.spans(data, offsets, textops.ALNUM)


def _spelled(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, low: int, high: int) -> list[str]:
    return [data[starts[i]:ends[i]].tobytes().decode("utf-8", "replace") for i in range(low, high)]


def windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """One row for each distinct window: words and the ids of the items that hold it; and for each of
    its tokens: its hash, its number of words and its place in the window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found, tokens, lengths = [], [], [], []
            data, starts, ends, first = _words(batch.column(1))
            hashes = textops.span_hashes(data, starts, ends)
            for k, item in enumerate(batch.column(0).to_pylist()):
                low, high = int(first[k]), int(first[k + 1])
                if low == high:
                    continue
                words = _spelled(data, starts, ends, low, high)
                span = min(size, len(words))
                step = min(TOKEN_WORDS, span)
                token = textops.shingles(hashes[low:high], np.array([0, high - low]), step)[0]
                for i in range(len(words) - span + 1):
                    ids.append(item)
                    found.append(words[i:i + span])
                    tokens.append(token[i:i + span - step + 1].view(np.int64))
                    lengths.append(step)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(found, pa.list_(pa.string())),
                 pa.array(tokens, pa.list_(pa.int64())), pa.array(lengths, pa.int32())],
                ["item_id", "words", "tokens", "token_words"])

    frames.small_batches(benchmark.sparkSession)
    return (benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
            .mapInArrow(run, "item_id string, words array<string>, tokens array<bigint>, token_words int")
            .groupBy("words").agg(F.collect_set("item_id").alias("items"),
                                  F.first("tokens").alias("tokens"),
                                  F.first("token_words").alias("token_words")))


def bitmap(hashes: DataFrame) -> np.ndarray:
    """One flag for each of BITS values of the column `token`: what reaches the driver are at most
    BITS / 64 numbers."""
    spot = F.pmod(F.col("token"), F.lit(BITS))
    rows = (hashes.select(F.floor(spot / 64).alias("word"), F.pmod(spot, F.lit(64)).cast("int").alias("bit"))
            .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).collect())
    flags = np.zeros(BITS // 64, np.uint64)
    for row in rows:
        flags[row["word"]] = np.uint64(row["bits"] & (2**64 - 1))
    return flags


def _hit(flags: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Where tokens fall on a set flag."""
    spot = tokens & np.uint64(BITS - 1)
    return np.flatnonzero(flags[spot >> np.uint64(6)] >> (spot & np.uint64(63)) & np.uint64(1))


def token_counts(docs: DataFrame, tokens: DataFrame, sizes: list[int]) -> DataFrame:
    """How often each of the given tokens stands in the whole corpus."""
    flags = docs.sparkSession.sparkContext.broadcast(bitmap(tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts, ends, first = _words(batch.column(0))
            hashes = textops.span_hashes(data, starts, ends)
            found = [np.zeros(0, np.uint64)]
            for size in sizes:
                token = textops.shingles(hashes, first, size)[0]
                found.append(token[_hit(flags.value, token)])
            token, count = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(count)],
                                             ["token", "n"])

    counts = docs.select("text").mapInArrow(run, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    return tokens.join(counts, "token", "left").select("token", F.coalesce("n", F.lit(0)).alias("n"))


def probes(docs: DataFrame, prefixes: DataFrame, sizes: list[int], size: int) -> DataFrame:
    """Per document its key, number of words, and the places where a prefix token may stand, each
    with the words around it that a window could reach."""
    flags = docs.sparkSession.sparkContext.broadcast(bitmap(prefixes))
    place = pa.struct([("token", pa.int64()), ("at", pa.int32()), ("from", pa.int32()),
                       ("around", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts, ends, first = _words(batch.column(2))
            hashes = textops.span_hashes(data, starts, ends)
            out: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for step in sizes:
                token, begin = textops.shingles(hashes, first, step)
                hit = _hit(flags.value, token)
                for i, k in zip(hit.tolist(), (np.searchsorted(begin, hit, "right") - 1).tolist()):
                    low, high = int(first[k]), int(first[k + 1])
                    if high - low < step:
                        continue
                    at = i - int(begin[k])
                    left, right = max(0, at - size + step), min(high - low, at + size)
                    out[k].append({"token": int(token[i].view(np.int64)), "at": at, "from": left,
                                   "around": _spelled(data, starts, ends, low + left, low + right)})
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(first)), pa.array(out, pa.list_(place))],
                ["doc_id", "key", "n_words", "places"])

    key = F.md5(F.concat_ws("\n", F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                            F.coalesce("text", F.lit(""))).cast("binary"))
    return docs.select("doc_id", key.alias("key"), "text").mapInArrow(
        run, "doc_id bigint, key string, n_words bigint, "
             "places array<struct<token:bigint,at:int,from:int,around:array<string>>>")


def covered(intervals: F.Column) -> F.Column:
    """Words inside any of the sorted (first, end) pairs."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto"))

    def step(state, x):
        more = F.greatest(x["end"] - F.greatest(x["first"], state["upto"]), F.lit(0))
        return F.struct((state["n"] + more).alias("n"), F.greatest(state["upto"], x["end"]).alias("upto"))

    return F.aggregate(intervals, start, step)["n"]


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated; and the key of
    (doc_id, text), the ids of the items and the hit spans of words."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    window = frames.written(windows(benchmark, size), "windows")
    sizes = sorted(r[0] for r in window.select("token_words").distinct().collect())  # five at most
    tokens = window.select(F.explode("tokens").alias("token")).distinct()
    counts = token_counts(docs, tokens, sizes)
    every = window.select("words", "items", F.posexplode("tokens").alias("place", "token"))
    rarest = frames.written(
        every.join(counts, "token").groupBy("words").agg(
            F.first("items").alias("items"),
            F.min(F.struct("n", "token", "place")).alias("prefix"))
        .select("words", "items", F.col("prefix.token").alias("token"), F.col("prefix.place").alias("place")),
        "prefixes")
    probed = frames.written(probes(docs, rarest.select("token"), sizes, size), "probes")
    places = probed.select("key", F.explode("places").alias("_p")).select("key", "_p.*").distinct()
    begin = F.col("at") - F.col("place")
    inner = begin - F.col("from")
    long = F.size("words")
    hits = (places.join(rarest, "token")
            .where((inner >= 0) & (inner + long <= F.size("around")))
            .where(F.slice("around", inner + 1, long) == F.col("words"))
            .groupBy("key").agg(
                F.array_sort(F.collect_set(F.struct(begin.alias("first"), (begin + long).alias("end")))).alias("spans"),
                F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")))
    out = probed.drop("places").join(hits, "key", "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce(covered(F.col("spans")), F.lit(0).cast("long"))
    return out.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * SHARE >= F.col("n_words"))).alias("contaminated"),
        "key", items.alias("items"), "spans")


@frames.other_columns_aside
def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that are not contaminated, with all their columns."""
    bad = contamination(docs, benchmark).where("contaminated").select("key").distinct()
    key = F.md5(F.concat_ws("\n", F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")),
                            F.coalesce("text", F.lit(""))).cast("binary"))
    return (docs.withColumn("__bad_key", key)
            .join(bad.select(F.col("key").alias("__bad_key")), "__bad_key", "left_anti")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    out = contamination(frames.table(spark, folder, "documents"), frames.table(spark, folder, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 13) AS n,
        array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS words
    FROM b, unnest(range(1, len(w) - least(len(w), 13) + 2)) t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS words
    FROM d, sizes, unnest(range(1, len(w) - n + 2)) t(i) WHERE len(w) >= n),
hits AS (SELECT doc_id, i, dw.n, item FROM dw JOIN bw USING (n, words)),
flags AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM hits, unnest(range(n)) t(j) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items,
        string_agg(DISTINCT item, ',' ORDER BY item) AS list FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(w), 0) AS contaminated
FROM d LEFT JOIN flags USING (doc_id) LEFT JOIN items USING (doc_id)
"""
