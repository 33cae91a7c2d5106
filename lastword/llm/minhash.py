"""MinHash near-duplicates: banded signatures, verification on full sets, components by large and small stars.

A document is its set of distinct word shingles; equal sets are one class. BANDS * ROWS universal hash
functions (multiply, add, upper half of 64 bits) give a class its minima; classes that agree in all minima
of a band share a bucket. With 40 bands of 4 rows a pair of similarity 0.8 shares none with probability
(1 - 0.8^4)^40 < 1e-9. A pair whose signatures agree in fewer than AGREE places is not looked at
further (a link falls below with a probability of about 1e-10); all others are confirmed on the full sets.

Only a bucket of up to SMALL classes gives all its pairs; of a larger one PIVOTS classes meet each other
class. What then still stands apart in a bucket is cut into blocks of bounded volume, and every two blocks meet
in one task that looks at all their pairs across components by signature, confirms them on the full sets and
returns a spanning forest of the links it finds. So no link between components is lost, no
group is held whole, and no pair leaves a task that is not a link.

Edge cases: null and empty texts, and texts without words, have no shingles, link with nothing and are
their own component; texts with fewer words than a shingle are one shingle of all; texts of any length
are used whole; repeated rows share class and component and have the same `kept`; a null id is smallest
only where a component has no other (kept is then false without shingles of another document); ties do
not arise; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lastword.llm import frames, textops
from lastword.llm.components import components

WORDS, NEED, OF = 2, 80, 100  # shingles of two words; similarity of 80 in 100 or more
BANDS, ROWS = 40, 4
MINIMA = BANDS * ROWS
AGREE = 95  # of MINIMA places, each compared by 8 bits; 6.5 standard deviations below 0.8
SMALL, PIVOTS = 8, 3  # classes of a bucket that meet at once; pivots in larger ones
VOLUME = 1 << 17  # tokens of a block
CHUNK = 1 << 13  # tokens hashed at once
SALTS_OF = 256  # members that one copy of a pivot's set is compared with
MOST_BITS = 1 << 30


def universal(seed: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Factors and summands of the hash functions."""
    made = np.random.default_rng(seed)
    return (made.integers(0, 1 << 64, MINIMA, np.uint64) | np.uint64(1)), made.integers(0, 1 << 64, MINIMA, np.uint64)


FACTORS, SUMMANDS = universal()


@dataclass
class Sets:
    """The sorted distinct tokens of the texts of a batch, each text's from begin to begin + size."""

    tokens: np.ndarray
    begin: np.ndarray
    size: np.ndarray

    def of(self, k: int) -> np.ndarray:
        return self.tokens[self.begin[k]:self.begin[k + 1]]


def token_sets(texts: pa.Array) -> Sets:
    data, offsets = textops.flat(texts)
    data = textops.LOWER[data]
    starts, ends, first = textops.spans(data, offsets, textops.NOT_SPACE)
    tokens, begin = textops.shingles(textops.span_hashes(data, starts, ends), first, WORDS)
    owner = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    order = np.lexsort((tokens, owner))
    tokens, owner = tokens[order], owner[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
    size = np.bincount(owner[new], minlength=len(begin) - 1)
    return Sets(tokens[new], np.concatenate([[0], np.cumsum(size)]), size)


def set_hash(found: Sets, salt: int) -> np.ndarray:
    """One 64-bit hash of each whole set, whatever its order."""
    each = textops.mixed(found.tokens ^ np.uint64(salt))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(each, dtype=np.uint64)])
    return textops.mixed(sums[found.begin[1:]] - sums[found.begin[:-1]] + found.size.astype(np.uint64))


def class_keys(found: Sets) -> pa.Array:
    """Two independent hashes of each set, 128 bits in all."""
    both = np.stack([set_hash(found, 0), set_hash(found, 0x2545F4914F6CDD1D)], axis=1)
    return pa.array([x.tobytes() for x in both], pa.binary())


def signatures(found: Sets) -> np.ndarray:
    """MINIMA minima of each set that is not empty, in order; a long set is hashed in chunks."""
    full = np.flatnonzero(found.size)
    out = np.full((len(full), MINIMA), np.iinfo(np.uint32).max, np.uint32)
    short = found.tokens & np.uint64(0xFFFFFFFF)
    at = 0
    while at < len(full):
        low = found.begin[full[at]]
        to = max(at + 1, int(np.searchsorted(found.begin[full], low + CHUNK)))
        begin = found.begin[full[at:to]] - low
        high = found.begin[full[to - 1] + 1]
        for start in range(low, high, CHUNK):  # more than one chunk only for a single long set
            part = short[start:min(high, start + CHUNK)] if to == at + 1 else short[low:high]
            for k in range(MINIMA):
                minima = np.minimum.reduceat((part * FACTORS[k] + SUMMANDS[k]) >> np.uint64(32), begin)
                out[at:to, k] = np.minimum(out[at:to, k], minima.astype(np.uint32))
            if to > at + 1:
                break
        at = to
    return out


def band_keys(minima: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band, different from band to band."""
    total = np.zeros((len(minima), BANDS), np.uint64)
    for k in range(ROWS):
        total = textops.mixed(total * np.uint64(textops.MULT) + minima[:, k::ROWS].astype(np.uint64) + np.uint64(1))
    return textops.mixed(total + np.arange(BANDS, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def described(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, text_hash, size, class, bands and bits (both null without shingles). Written."""
    frames.small_batches(docs.sparkSession)
    schema = "doc_id bigint, text_hash bigint, size bigint, class binary, bands binary, bits binary"
    names = ["doc_id", "text_hash", "size", "class", "bands", "bits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = token_sets(batch.column(2))
            minima = signatures(found)
            keys, bits = band_keys(minima), minima.astype(np.uint8)
            place = np.cumsum(found.size > 0) - 1
            pick = [int(p) if n else None for p, n in zip(place, found.size)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(found.size.astype(np.int64)),
                class_keys(found),
                pa.array([None if p is None else keys[p].tobytes() for p in pick], pa.binary()),
                pa.array([None if p is None else bits[p].tobytes() for p in pick], pa.binary())], names)

    return frames.written(docs.select("doc_id", "text_hash", "text").mapInArrow(run, schema), "minhash")


def bucketed(classes: DataFrame) -> DataFrame:
    """bucket, class, size and bits of every class in a bucket that holds another one; of buckets with
    the same classes one is kept. Written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
            owner = pa.array(np.repeat(np.arange(batch.num_rows), BANDS))
            yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column(0).take(owner)], ["bucket", "class"])

    placed = classes.select("class", "bands").mapInArrow(run, "bucket bigint, class binary")
    shared = (placed.groupBy("bucket").agg(
        F.count("*").alias("held"), F.bit_xor(F.xxhash64("class")).alias("_x"),
        F.bit_xor(F.xxhash64(F.lit(1), "class")).alias("_y")).where("held > 1")
        .groupBy("held", "_x", "_y").agg(F.min("bucket").alias("bucket")).select("bucket", "held"))
    members = placed.join(shared, "bucket")
    return frames.written(members.join(classes.select("class", "size", "bits"), "class"), "buckets")


def lengths_fit(size_a: Column, size_b: Column) -> Column:
    return F.least(size_a, size_b) * OF >= F.greatest(size_a, size_b) * NEED


def agree(a: str, b: str) -> Column:
    """Whether two signatures agree in so many places as a link's do."""
    @F.pandas_udf("boolean")
    def test(left: pd.Series, right: pd.Series) -> pd.Series:
        one, other = (np.frombuffer(b"".join(x), np.uint8).reshape(len(x), MINIMA) for x in (left, right))
        return pd.Series((one == other).sum(axis=1) >= AGREE)

    return test(a, b)


def possible(pairs: DataFrame) -> DataFrame:
    """Of rows a, b with sizes and bits the distinct pairs a, b that length and signature let through."""
    fit = pairs.where(lengths_fit(F.col("size_a"), F.col("size_b"))).where(agree("bits_a", "bits_b"))
    return fit.select("a", "b").distinct()


def side(members: DataFrame, x: str) -> DataFrame:
    return members.select("bucket", F.col("class").alias(x), F.col("size").alias(f"size_{x}"),
                          F.col("bits").alias(f"bits_{x}"))


def small_pairs(members: DataFrame) -> DataFrame:
    """The possible pairs of buckets with at most SMALL classes."""
    few = members.where(F.col("held") <= SMALL)
    return possible(side(few, "a").join(side(few, "b"), "bucket").where("a < b"))


def pivot_pairs(members: DataFrame) -> DataFrame:
    """The possible pairs of a few classes of each larger bucket, the pivots a, with its others.

    Pivots have the least hashes, so buckets with many classes in common mostly agree on them, and a
    class that stands in many such buckets meets few different pivots.
    """
    large = members.where(F.col("held") > SMALL)
    chosen = [F.min_by(F.struct("class", "size", "bits"), F.xxhash64("class", F.lit(turn))).alias(f"p{turn}")
              for turn in range(PIVOTS)]
    one = large.groupBy("bucket").agg(*chosen)
    pivots = frames.written(one.select("bucket", F.explode(F.array_distinct(F.array(
        *[f"p{turn}" for turn in range(PIVOTS)]))).alias("p")).select("bucket", "p.*"), "pivots")
    return possible(side(large, "b").join(side(pivots, "a"), "bucket").where("a <> b"))


def full_sets(docs: DataFrame, rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """class and tokens (sorted, packed) of the wanted classes, and of few others. Written.

    A bitmap of the wanted texts' hashes, 16 bits or more for each and at most MOST_BITS in all, spares most
    other texts the work; what it lets through besides is left behind when pairs are joined by class.
    Copies of a text are dropped before they are shuffled.
    """
    spark = docs.sparkSession
    # One text of each class: classes may have texts that differ in case or spaces.
    texts = frames.written(rows.join(wanted, "class").groupBy("class").agg(F.min("text_hash").alias("text_hash")), "texts")
    bits = min(MOST_BITS, 1 << max(16, (16 * texts.count()).bit_length()))
    spot = F.pmod(F.col("text_hash"), F.lit(bits))
    words = (texts.select(F.floor(spot / 32).alias("word"), F.pmod(spot, F.lit(32)).cast("int").alias("bit"))
             .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")))
    flags = np.zeros(bits // 32, np.uint32)  # MOST_BITS at most
    for row in words.toLocalIterator():
        flags[row["word"]] = row["bits"]
    shared = spark.sparkContext.broadcast(flags)

    @F.pandas_udf("boolean")
    def wanted_text(hashes: pd.Series) -> pd.Series:
        at = hashes.to_numpy(np.int64).view(np.uint64) & np.uint64(bits - 1)
        return pd.Series((shared.value[at >> np.uint64(5)] >> (at & np.uint64(31)).astype(np.uint32) & 1).astype(bool))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = token_sets(batch.column(0))
            yield pa.RecordBatch.from_arrays(
                [class_keys(found), pa.array([found.of(k).tobytes() for k in range(len(found.size))], pa.binary())],
                ["class", "tokens"])

    frames.small_batches(spark)
    held = docs.where(wanted_text("text_hash")).select("text").dropDuplicates(["text"])
    return frames.written(held.mapInArrow(run, "class binary, tokens binary"), "sets")


def similar(one: np.ndarray, other: np.ndarray) -> bool:
    both = len(np.intersect1d(one, other, assume_unique=True))
    return OF * both >= NEED * (len(one) + len(other) - both)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links on their full sets. Written.

    The set of a travels once for up to some SALTS_OF pairs, which follow it in the same sorted part.
    """
    many = frames.written(pairs.groupBy("a").agg(F.count("*").alias("n")).where(F.col("n") > SALTS_OF), "many")
    salts = F.coalesce(F.floor(F.col("n") / SALTS_OF) + 1, F.lit(1))
    keyed = pairs.join(many, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), salts).alias("salt"))
    heads = (keyed.select("a", "salt").distinct().join(sets.select(F.col("class").alias("a"), "tokens"), "a")
             .select("a", "salt", F.lit(None).cast("binary").alias("b"), "tokens"))
    tails = (keyed.select("a", "salt", "b").join(sets.select(F.col("class").alias("b"), "tokens"), "b")
             .select("a", "salt", "b", "tokens"))
    dealt = (heads.unionByName(tails).repartition("a", "salt")
             .sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first()))
    frames.small_batches(pairs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, mine = None, None
        for batch in batches:
            left, right = [], []
            for a, salt, b, blob in zip(*(c.to_pylist() for c in batch.columns)):
                tokens = np.frombuffer(blob, np.uint64)
                if b is None:
                    head, mine = (a, salt), tokens
                elif head == (a, salt) and similar(mine, tokens):
                    left.append(a)
                    right.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], ["a", "b"])

    return frames.written(dealt.mapInArrow(run, "a binary, b binary"), "links")


def apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The classes of buckets that still hold several components, with their component. Written."""
    known = (members.join(labels.withColumnRenamed("node", "class"), "class", "left")
             .withColumn("component", F.coalesce("component", "class")))
    known = frames.written(known, "known")
    several = (known.groupBy("bucket").agg(F.min("component").alias("_l"), F.max("component").alias("_h"))
               .where("_l <> _h").select("bucket"))
    several = frames.written(several, "several")
    return frames.written(known.join(several, "bucket", "left_semi"), "apart")


def forest(component: np.ndarray, size: np.ndarray, bits: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links between rows of different components, so many that all linked components are connected."""
    parent = {c: c for c in component.tolist()}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    out = []
    order = np.argsort(size, kind="stable")
    for at, i in enumerate(order):
        # A partner is at most as large as this row and large enough for a link.
        low = int(np.searchsorted(size[order[:at]], -(-NEED * int(size[i]) // OF)))
        others = order[low:at]
        others = others[component[others] != component[i]]
        if not len(others):
            continue
        others = others[(bits[others] == bits[i]).sum(axis=1) >= AGREE]
        for j in others.tolist():
            one, other = root(int(component[i])), root(int(component[j]))
            if one != other and similar(sets[i], sets[j]):
                parent[one] = other
                out.append((int(i), j))
    return out


def block_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) that connect all components which have a link within a bucket. Written."""
    whole = members.groupBy("bucket").agg((F.floor(F.sum("size") / VOLUME) + 1).alias("blocks"))
    cut = (members.select("bucket", "class", "size", "bits", "component").join(whole, "bucket")
           .withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")))
           .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))
    met = (cut.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
           .select("bucket", "low", "high", "class", "size", "bits", "component")
           .join(sets.select("class", "tokens"), "class"))

    def run(table: pa.Table) -> pa.Table:
        names = table.column("class").to_pylist()
        bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint8).reshape(-1, MINIMA)
        component = np.unique(table.column("component").to_numpy(zero_copy_only=False), return_inverse=True)[1]
        found = forest(component, table.column("size").to_numpy(), bits,
                       [np.frombuffer(x, np.uint64) for x in table.column("tokens").to_pylist()])
        return pa.table({"a": pa.array([names[i] for i, _ in found], pa.binary()),
                         "b": pa.array([names[j] for _, j in found], pa.binary())})

    return frames.written(met.groupBy("bucket", "low", "high").applyInArrow(run, "a binary, b binary"), "links")


def links_of(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """node (a class) and component of all linked classes."""
    classes = frames.written(
        rows.where("size > 0").select("class", "size", "bands", "bits").dropDuplicates(["class"]), "classes")
    members = bucketed(classes)
    pairs = frames.written(small_pairs(members).union(pivot_pairs(members)), "pairs")
    large = members.where(F.col("held") > SMALL)
    wanted = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).union(large.select("class")).distinct()
    sets = full_sets(docs, rows, wanted)
    links = confirmed(pairs, sets)
    labels = components(links)
    left = apart(large, labels)
    if left.isEmpty():
        return labels
    more = block_links(left, sets)
    return labels if more.isEmpty() else components(links.union(more))


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id and kept."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       F.col(text).cast("string").alias("text"))
    rows = described(docs)
    labels = links_of(docs, rows)
    full = rows.where("size > 0")
    least = full.groupBy("class").agg(F.min("doc_id").alias("least"))
    tagged = frames.written(least.join(labels.withColumnRenamed("node", "class"), "class", "left"), "tagged")
    linked = tagged.where("component IS NOT NULL")
    smallest = frames.written(linked.groupBy("component").agg(F.min("least").alias("component_id")), "smallest")
    named = linked.join(smallest, "component").select("class", "component_id").unionByName(
        tagged.where("component IS NULL").select("class", F.col("least").alias("component_id")))
    size = F.col("size").alias("n_shingles")
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept")
    return (full.join(named, "class").select("doc_id", size, "component_id")
            .unionByName(rows.where("size = 0").select("doc_id", size, F.col("doc_id").alias("component_id")))
            .select("doc_id", "n_shingles", "component_id", kept))


def op13_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return join(frames.table(spark, folder, "documents"))
