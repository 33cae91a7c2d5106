"""What the exact set-similarity joins share: sets of shingles, rarity, prefix postings, candidates.

A unit (a document, a line) is its set of distinct shingles. Equal sets are one class. Tokens are
ordered by how frequent a counting sketch of fixed size says they are, rarest first, then by hash: any
order is exact as long as it is one order for all. Two sets of Jaccard similarity t share at least l tokens
within their first n - ceil(t n) + l tokens, so only those are shuffled, packed by ranges of tokens.
With l = 1 + n / 16 the prefix is little longer, and a shared passage alone makes no candidate.

A token with few classes gives its pairs at once. Classes of a longer list are returned as rows,
so that the caller can settle most of them by one pivot before it looks at what is left. Tokens that
the sketch calls heavy never meet in one task here. The sketch never underestimates, so a light
token's list is bounded.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lastword.llm import frames, textops

WORDS, NEED, OF = 5, 75, 100  # shingles of five words; similarity of 75 in 100 or more
COUNTERS, PARTS = 1 << 18, 16
SHARE = 16  # prefixes must share one token more for so many tokens of the set
SHORT = 8  # lists up to this length give all their pairs at once
HEAVY, HEAVY_TIMES = 1000, 4
BUCKET_ENTRIES = 200_000
FLUSH = 600_000
ENTRY = np.dtype([("token", "<u4"), ("class_low", "<u4"), ("class_high", "<u2"), ("size", "<u2"), ("at", "<u2")])
HEAVY_ENTRY = np.dtype([("token", "<u8"), ("class_low", "<u4"), ("class_high", "<u2"), ("size", "<u2")])
MOST = 65535  # sizes and places beyond are unknown to the filters and pass them
CLASS_BITS = 48
PAGE = 1 << 16  # bits of a bitmap that are gathered in one row

Cut = Callable[[pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray]]


def documents(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes; the first word of each unit; the text of each unit. Here a unit is a text."""
    data, offsets = textops.flat(texts)
    data = textops.looked_up(data, textops.LOWER)
    starts, ends, first = textops.spans(data, offsets, textops.NOT_SPACE)
    return textops.word_hashes(data, starts, ends), first, np.arange(len(texts))


@dataclass
class Sets:
    """The distinct tokens of many units in a row, each unit's in the order of `classes`."""

    tokens: np.ndarray  # 58 bits of hash below 6 bits of rarity class
    begin: np.ndarray
    size: np.ndarray
    one: np.ndarray  # two independent 64-bit hashes of the whole set
    two: np.ndarray


def _sorted_by_unit(key: np.ndarray, begin: np.ndarray) -> None:
    """Sorts in place the keys of each 64 units in a row, which hold the unit's last six bits above all others."""
    for low in range(0, len(begin) - 1, 64):
        key[begin[low]:begin[min(low + 64, len(begin) - 1)]].sort()


def sets(words: np.ndarray, first: np.ndarray) -> Sets:
    """The units' sets, with a rarity class of zero everywhere."""
    key, begin = textops.shingles(words, first, WORDS)
    key >>= np.uint64(6)
    units = len(first) - 1
    owner = np.repeat(np.arange(units), np.diff(begin))
    key |= owner.astype(np.uint64) << np.uint64(58)
    _sorted_by_unit(key, begin)
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    token = key[new] & np.uint64((1 << 58) - 1)
    size = np.bincount(owner[new], minlength=units)
    begin = np.concatenate([[0], np.cumsum(size)])

    def total(x: np.ndarray) -> np.ndarray:
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])
        return textops.mixed(sums[begin[1:]] - sums[begin[:-1]] + size.astype(np.uint64))

    return Sets(token, begin, size, total(textops.mixed(token)),
                total(textops.mixed(token ^ np.uint64(0x2545F4914F6CDD1D))))


def rarest_first(found: Sets, fresh: np.ndarray, rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of the units marked `fresh`, by rarity class (then in their upper six bits), then by hash; and the
    first of each of these units, the end added."""
    size = found.size[fresh]
    token = found.tokens[np.repeat(fresh, found.size)]
    begin = np.concatenate([[0], np.cumsum(size)])
    owner = np.repeat(np.arange(len(size)), size)
    rare = rarity[token & np.uint64(COUNTERS - 1)].astype(np.uint64)
    key = (owner.astype(np.uint64) << np.uint64(58)) | (rare << np.uint64(48)) | np.arange(len(token)).astype(np.uint64)
    _sorted_by_unit(key, begin)
    token = token[key & np.uint64((1 << 48) - 1)]
    return token | (key >> np.uint64(48) & np.uint64(63)) << np.uint64(58), begin


def class_id(one: np.ndarray) -> np.ndarray:
    return one & np.uint64((1 << CLASS_BITS) - 1)


def class_column(one: str = "one") -> Column:
    return F.col(one).bitwiseAND(F.lit((1 << CLASS_BITS) - 1))


def described(rows: DataFrame, text: str, keep: list[str], cut: Cut, nth: str | None = None) -> DataFrame:
    """Per unit: the columns `keep` of its row, its number in the row if asked for, size, one and two;
    and rows of the counting sketch, marked by part. Written once."""
    frames.small_batches(rows.sparkSession)
    picked = rows.select(*keep, text)
    schema = StructType([StructField(f.name, f.dataType) for f in picked.drop(text).schema])
    if nth:
        schema = schema.add(nth, "integer")
    for name in ("size", "one", "two"):
        schema = schema.add(name, "long")
    schema = schema.add("part", "integer").add("sketch", "binary")
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        types = None
        for batch in batches:
            words, first, of = cut(batch.columns[-1])
            found = sets(words, first)
            counts += np.bincount((found.tokens & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
            kept = [c.take(pa.array(of)) for c in batch.columns[:-1]]
            types = [c.type for c in batch.columns[:-1]]
            if nth:
                start = np.searchsorted(of, of)
                kept.append(pa.array((np.arange(len(of)) - start).astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(found.size.astype(np.int64)), pa.array(found.one.view(np.int64)),
                 pa.array(found.two.view(np.int64)), pa.nulls(len(of), pa.int32()), pa.nulls(len(of), pa.binary())],
                names)
        if types is not None:
            blobs = [zlib.compress(c.astype("<i8").tobytes(), 1) for c in np.split(counts, PARTS)]
            blank = [pa.nulls(PARTS, t) for t in (*types, *([pa.int32()] if nth else []), *[pa.int64()] * 3)]
            yield pa.RecordBatch.from_arrays(
                [*blank, pa.array(range(PARTS), pa.int32()), pa.array(blobs, pa.binary())], names)

    return frames.written(picked.mapInArrow(frames.lean(run), schema), "sets")


def rarity(described_units: DataFrame) -> tuple[np.ndarray, int]:
    """The rarity class (0 to 62, 63 for heavy) of each counter, and how many tokens there are.

    Tasks' counters are added up in two steps of bounded size; COUNTERS numbers reach the driver.
    """
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, blob in zip(*(c.to_pylist() for c in batch.columns)):
                more = np.frombuffer(zlib.decompress(blob), "<i8")
                total[part] = total[part] + more if part in total else more
        yield pa.RecordBatch.from_arrays(
            [pa.array(total.keys(), pa.int32()),
             pa.array([zlib.compress(x.tobytes(), 1) for x in total.values()], pa.binary())], ["part", "sketch"])

    rows = described_units.where("part IS NOT NULL").select("part", "sketch")
    once = rows.mapInArrow(add, "part int, sketch binary")
    counts = np.zeros(COUNTERS, np.int64).reshape(PARTS, -1)
    for row in once.repartition(PARTS, "part").mapInArrow(add, "part int, sketch binary").collect():
        counts[row["part"]] += np.frombuffer(zlib.decompress(row["sketch"]), "<i8")
    counts = counts.ravel()
    tokens = int(counts.sum())
    classes = np.floor(np.log2(counts + 1)).astype(np.uint8)
    classes[counts >= max(HEAVY, HEAVY_TIMES * tokens // COUNTERS)] = 63
    return classes, tokens


def shared(size):
    """How many tokens two prefixes share at least, by the smaller set's size (array or column)."""
    return F.floor(size / SHARE).cast("long") + 1 if isinstance(size, Column) else size // SHARE + 1


def prefix(size: np.ndarray) -> np.ndarray:
    return np.minimum(size, size - (NEED * size + OF - 1) // OF + shared(size))


def postings(rows: DataFrame, text: str, cut: Cut, classes: np.ndarray, tokens: int) -> DataFrame:
    """Prefix tokens of every class, packed: bucket (below zero for heavy tokens) and entries."""
    frames.small_batches(rows.sparkSession)
    buckets = max(64, tokens // (4 * BUCKET_ENTRIES))
    shared = rows.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        pending: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            token, which, size, at = (np.concatenate(x) for x in zip(*pending))
            pending.clear()
            heavy = token >= np.uint64(63 << 58)
            bucket = (token % np.uint64(buckets)).astype(np.int64)
            bucket[heavy] = -1 - (which[heavy] % np.uint64(256)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bucket, token, which = bucket[order], token[order], which[order]
            size, at = size[order], at[order]
            cuts = np.flatnonzero(np.diff(bucket, prepend=bucket[0] - 1 if len(bucket) else 0))
            names, blobs = [], []
            for low, high in zip(cuts, [*cuts[1:], len(bucket)]):
                part = np.zeros(high - low, ENTRY if bucket[low] >= 0 else HEAVY_ENTRY)
                part["token"] = (token[low:high] // np.uint64(buckets)).astype(np.uint32) \
                    if bucket[low] >= 0 else token[low:high]
                part["class_low"] = (which[low:high] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                part["class_high"] = (which[low:high] >> np.uint64(32)).astype(np.uint16)
                part["size"] = np.minimum(size[low:high], MOST)
                if bucket[low] >= 0:
                    part["at"] = np.minimum(at[low:high], MOST)
                names.append(int(bucket[low]))
                blobs.append(part.tobytes())
            return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(blobs, pa.binary())],
                                              ["bucket", "entries"])

        waiting = 0
        for batch in batches:
            words, first, _ = cut(batch.column(0))
            found = sets(words, first)
            fresh = np.zeros(len(found.size), bool)
            for i, one in enumerate(found.one.tolist()):
                if found.size[i] and one not in seen:
                    seen.add(one)
                    fresh[i] = True
            token, begin = rarest_first(found, fresh, shared.value)
            long = prefix(found.size[fresh])
            total = np.concatenate([[0], np.cumsum(long)])
            at = np.arange(total[-1]) - np.repeat(total[:-1], long)
            pick = at + np.repeat(begin[:-1], long)
            pending.append((token[pick], np.repeat(class_id(found.one[fresh]), long),
                            np.repeat(found.size[fresh], long), at))
            waiting += int(total[-1])
            if waiting >= FLUSH:
                yield flush()
                waiting = 0
        if waiting:
            yield flush()

    return rows.select(text).mapInArrow(frames.lean(run), "bucket bigint, entries binary")


def sorted_entries(token: np.ndarray, which: np.ndarray) -> np.ndarray:
    """np.lexsort((which, token)), in any order where both are equal."""
    if len(token) and 0 <= token.min() and token.max() < 1 << 32:
        key = token.astype(np.uint64) << np.uint64(32) | (which >> CLASS_BITS - 32).astype(np.uint64)
        order = np.argsort(key)
        key = key[order]
        tie = key[1:] == key[:-1]
        if not (tie & (which[order[1:]] != which[order[:-1]])).any():
            return order
    return np.lexsort((which, token))


def possible(size_a, size_b, at_a, at_b) -> np.ndarray:
    """The length filter, and the positional one for a shared token."""
    small, large = np.minimum(size_a, size_b), np.maximum(size_a, size_b)
    most = np.minimum(at_a, at_b) + 1 + np.minimum(size_a - at_a, size_b - at_b) - 1
    fits = (OF * small >= NEED * large) & ((OF + NEED) * most >= NEED * (size_a + size_b))
    return fits | (large >= MOST)


def candidates(packed: DataFrame, tokens: int) -> DataFrame:
    """Three kinds of rows: pairs of classes (a, b, their sizes, and n tokens that they share in short
    lists); members of longer lists (a, size, token); and for each class n of its tokens that stand in
    short lists with others (a, size, n)."""
    buckets = max(64, tokens // (4 * BUCKET_ENTRIES))
    none = np.zeros(0, np.int64)

    def meet(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        blobs = b"".join(table.column("entries").to_pylist())
        one = np.frombuffer(blobs, ENTRY if bucket >= 0 else HEAVY_ENTRY)
        token = one["token"].astype(np.int64)
        which = one["class_low"].astype(np.int64) | one["class_high"].astype(np.int64) << 32
        order = sorted_entries(token, which)
        token, which = token[order], which[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (which[1:] != which[:-1])
        token, which, order = token[new], which[new], order[new]
        size = one["size"].astype(np.int64)[order]
        if bucket < 0:
            return rows_of((which, size, token), none, none)
        at = one["at"].astype(np.int64)[order]
        start = np.flatnonzero(np.diff(token, prepend=-1))
        length = np.diff(np.append(start, len(token)))
        run = np.repeat(length, length)
        long = run > SHORT
        short = (run > 1) & ~long
        token_s, which_s, size_s, at_s = token[short], which[short], size[short], at[short]
        found = [(none,) * 4]
        for d in range(1, SHORT):
            i = np.flatnonzero(token_s[:-d] == token_s[d:]) if len(token_s) > d else none
            i = i[possible(size_s[i], size_s[i + d], at_s[i], at_s[i + d])]
            found.append((which_s[i], which_s[i + d], size_s[i], size_s[i + d]))
        return rows_of((which[long], size[long], token[long] * buckets + bucket), which_s, size_s,
                       *pairs(*(np.concatenate(x) for x in zip(*found))))

    def pairs(a, b, size_a, size_b):
        order = np.lexsort((b, a))
        a, b, size_a, size_b = a[order], b[order], size_a[order], size_b[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        start = np.flatnonzero(new)
        return np.stack([a[start], b[start]]), np.stack([size_a[start], size_b[start]]), np.diff(np.append(start, len(a)))

    def rows_of(lists, which_s, size_s, ab=None, sizes=None, n=None) -> pa.Table:
        which, size, token = lists
        if ab is None or not len(ab):
            ab, sizes, n = np.zeros((2, 0), np.int64), np.zeros((2, 0), np.int64), none
        own, first, times = np.unique(which_s, return_index=True, return_counts=True)
        gap = lambda k: pa.nulls(k, pa.int64())
        return pa.table({
            "a": pa.array(np.concatenate([ab[0], which, own])),
            "size": pa.array(np.concatenate([sizes[0], size, size_s[first]])),
            "b": pa.concat_arrays([pa.array(ab[1]), gap(len(which) + len(own))]),
            "size_b": pa.concat_arrays([pa.array(sizes[1]), gap(len(which) + len(own))]),
            "token": pa.concat_arrays([gap(len(n)), pa.array(token), gap(len(own))]),
            "n": pa.concat_arrays([pa.array(n.astype(np.int64)), gap(len(which)), pa.array(times.astype(np.int64))])})

    return packed.groupBy("bucket").applyInArrow(
        frames.lean_group(meet), "a bigint, size bigint, b bigint, size_b bigint, token bigint, n bigint")


def surviving(met: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classes (a), pairs (a, b) and list members (a, size, token) that may share as many tokens as they
    must.

    A class must share as many as its smallest possible partner asks for; a pair counts what it
    shares in short lists, and at most what the two have in longer ones.
    """
    alive = frames.written(
        met.where("b IS NULL").groupBy("a").agg(
            F.max("size").alias("size"), F.sum(F.coalesce("n", F.lit(1))).alias("n"), F.count("token").alias("long"))
        .where(F.col("n") >= shared(F.floor(F.col("size") * NEED / OF))).select("a", "long"), "alive")
    other = alive.select(F.col("a").alias("b"), F.col("long").alias("long_b"))
    pairs = (met.where("b IS NOT NULL").groupBy("a", "b")
             .agg(F.sum("n").alias("n"), F.max("size").alias("size"), F.max("size_b").alias("size_b"))
             .join(alive, "a").join(other, "b")
             .where(F.col("n") + F.least("long", "long_b") >= shared(F.least("size", "size_b")))
             .select("a", "b"))
    long = met.where("token IS NOT NULL").select("a", "size", "token").join(alive, "a", "left_semi")
    return alive.select("a"), frames.written(pairs, "pairs"), frames.written(long, "lists")


def bitmap(keys: DataFrame) -> np.ndarray:
    """Bits at the whole numbers of a one-column table, modulo their count: 16 or more a key, of 1 to 16 MB."""
    keys = frames.written(keys.toDF("key"), "keys")
    bits = 1 << min(27, max(23, (16 * keys.count()).bit_length()))
    spot = F.pmod(F.col("key"), F.lit(bits))

    def page(table: pa.Table) -> pa.Table:
        flags = np.zeros(PAGE, bool)
        flags[table.column("bit").to_numpy()] = True
        return pa.table({"page": table.column("page").slice(0, 1),
                         "flags": pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())})

    pages = (keys.select(F.floor(spot / PAGE).alias("page"), F.pmod(spot, F.lit(PAGE)).alias("bit"))
             .groupBy("page").applyInArrow(page, "page bigint, flags binary"))
    flags = np.zeros((bits // PAGE, PAGE // 8), np.uint8)
    for row in pages.collect():  # 128 to 2,048 pages
        flags[row["page"]] = np.frombuffer(row["flags"], np.uint8)
    return flags.ravel()


def marked(flags: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the bits of these whole numbers are set."""
    spot = keys.view(np.uint64) & np.uint64(8 * len(flags) - 1)
    return (flags[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def member_sets(rows: DataFrame, text: str, cut: Cut, members: DataFrame, firsts: DataFrame | None = None) -> DataFrame:
    """class, one, two, size and sorted tokens of every class among `members` (column a), written.

    A bitmap of bounded size spares most other classes the shuffle; the join is exact. Where firsts (a, place)
    tells a place at which each class stands, `cut` takes, beside the texts, their places (column `place` of
    rows) and a filter of units by place, and no other unit is hashed.
    """
    wanted = members.select("a").distinct()
    if firsts is None:
        flags = bitmap(wanted)
    else:
        wanted = frames.written(wanted, "wanted")
        flags = bitmap(firsts.join(wanted, "a", "left_semi").select("place"))
    shared, by_place = rows.sparkSession.sparkContext.broadcast(flags), firsts is not None
    frames.small_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            if by_place:
                places = batch.column(1).to_numpy()
                words, first, _ = cut(batch.column(0), places, lambda x: marked(shared.value, x))
            else:
                words, first, _ = cut(batch.column(0))
            found = sets(words, first)
            hit = found.size > 0
            if not by_place:
                hit &= marked(shared.value, class_id(found.one))
            keep = []
            for i in np.flatnonzero(hit).tolist():
                one = int(found.one[i])
                if one not in seen:
                    seen.add(one)
                    keep.append(i)
            blobs = [found.tokens[found.begin[i]:found.begin[i + 1]].tobytes() for i in keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(class_id(found.one[keep]).view(np.int64)), pa.array(found.one[keep].view(np.int64)),
                 pa.array(found.two[keep].view(np.int64)), pa.array(found.size[keep].astype(np.int64)),
                 pa.array(blobs, pa.binary())], ["class", "one", "two", "size", "tokens"])

    texts = rows.select(text, "place") if by_place else rows.select(text)
    every = texts.mapInArrow(frames.lean(run), "class bigint, one bigint, two bigint, size bigint, tokens binary")
    mine = every.join(wanted.withColumnRenamed("a", "class"), "class", "left_semi")
    return frames.written(mine.dropDuplicates(["class", "one", "two"]), "members")


def with_both_sets(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Each pair with both sides' sizes and tokens; a and b become the classes' 64-bit hashes."""
    def side(x: str) -> DataFrame:
        return members.select(F.col("class").alias(x), F.col("one").alias(f"id_{x}"),
                              F.col("size").alias(f"size_{x}"), F.col("tokens").alias(f"tokens_{x}"))

    return pairs.join(side("b"), "b").join(side("a"), "a").select(
        F.col("id_a").alias("a"), "size_a", "tokens_a", F.col("id_b").alias("b"), "size_b", "tokens_b")


def only(members: DataFrame, wanted: DataFrame) -> DataFrame:
    """The members of the wanted classes (column a), and by chance a few others: a bitmap spares the rest the shuffle."""
    shared = members.sparkSession.sparkContext.broadcast(bitmap(wanted.select("a").distinct()))
    frames.small_batches(members.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(marked(shared.value, batch.column(0).to_numpy())))

    return members.select("class", "one", "two", "size", "tokens").mapInArrow(
        frames.lean(run), "class bigint, one bigint, two bigint, size bigint, tokens binary")


def able(lists: DataFrame, members: DataFrame) -> DataFrame:
    """Members (a) of the lists that can still have a link to another component: as many of their tokens
    as a link needs stand in some member of another component. Linear in the members' tokens.

    Tokens travel once, packed by buckets, as 32 bits each beside the runs of their members; two tokens that are
    equal there can only keep a member that need not stay.
    """
    of = lists.select("a", "component").distinct()
    picked = (only(members, of).join(of, F.col("class") == F.col("a")).select("a", "component", "size", "tokens"))
    buckets = max(64, (members.agg(F.sum("size")).first()[0] or 0) // (4 * BUCKET_ENTRIES))  # one number

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, component, size = (batch.column(k).to_numpy() for k in range(3))
            token = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint64)
            bucket = (token % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket.astype(np.uint16) if buckets <= 65536 else bucket, kind="stable")
            bucket, owner = bucket[order], np.repeat(np.arange(len(size)), size)[order]
            token = (token[order] // np.uint64(buckets)).astype(np.uint32)
            run = np.flatnonzero((np.diff(bucket, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0))
            length, owner, home = np.diff(np.append(run, len(token))).astype(np.int64), owner[run], bucket[run]
            cuts = np.flatnonzero(np.diff(home, prepend=-1))
            rows = list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(home)]))
            begin = np.append(run, len(token))
            yield pa.RecordBatch.from_arrays(
                [pa.array(home[cuts], pa.int64()),
                 pa.array([token[begin[i]:begin[j]].tobytes() for i, j in rows], pa.binary()),
                 *[pa.array([x[i:j].tobytes() for i, j in rows], pa.binary())
                   for x in (which[owner], component[owner], length.astype(np.uint32))]],
                ["bucket", "tokens", "which", "component", "length"])

    def count(table: pa.Table) -> pa.Table:
        token, which, component, length = (
            np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
            for name, kind in (("tokens", np.uint32), ("which", np.int64), ("component", np.int64), ("length", np.uint32)))
        order = np.argsort(token)
        of_run = np.repeat(np.arange(len(length)), length)[order]
        start = np.flatnonzero(np.diff(token[order].astype(np.int64), prepend=-1))
        held = component[of_run]
        several = np.minimum.reduceat(held, start) != np.maximum.reduceat(held, start)
        several = np.repeat(several, np.diff(np.append(start, len(token))))
        members_, n = np.unique(which[of_run[several]], return_counts=True)
        return pa.table({"a": pa.array(members_), "n": pa.array(n.astype(np.int64))})

    packed = picked.mapInArrow(
        frames.lean(deal), "bucket bigint, tokens binary, which binary, component binary, length binary")
    counts = (packed.groupBy("bucket").applyInArrow(frames.lean_group(count), "a bigint, n bigint")
              .groupBy("a").agg(F.sum("n").alias("n")))
    sizes = members.groupBy(F.col("class").alias("a")).agg(F.max("size").alias("size"))
    return counts.join(sizes, "a").where(F.col("n") * OF >= F.col("size") * NEED).select("a")


def close(size_a: Column, size_b: Column) -> Column:
    """The length filter on columns."""
    return ((F.least(size_a, size_b) * OF >= F.greatest(size_a, size_b) * NEED)
            | (F.greatest(size_a, size_b) >= MOST))
