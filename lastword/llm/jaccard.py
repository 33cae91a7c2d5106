"""N-gram Jaccard join: exact links between documents by T-occurrence search, and their components.

Prefix postings say which classes of equal sets can meet (see setjoin). A class is then searched among
its candidates: over the candidates' inverted lists of its tokens, a document must occur T times.
DivideSkip merges the short lists with a heap and counts; what reaches T less the number of long
lists is probed in the long ones by binary search.

Long posting lists are shared passages or groups of near copies. Lists take one class as the pivot of
all others. A class stays only while enough of its tokens stand in classes of other components. What
is left is dealt by size into blocks of bounded volume; two blocks whose sizes may link meet in one
task, which searches the inverted lists of their whole sets in the same way and returns no pairs but a
spanning forest of the links between components, so no link between components is lost.

Edge cases: null and empty texts, and texts without words, have no shingles and are their own component;
repeated rows share a class and a component; null ids do not count as the smallest id unless the
component has no other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lastword.llm import frames
from lastword.llm import setjoin as sj
from lastword.llm.components import components

KINDS = 8  # different pivots that the lists of a class take
SALTS_OF = 256  # candidates that one class meets in a task
VOLUME = 2_000_000  # tokens of a block
MU = 0.01  # weight of a list's length in DivideSkip's choice of long lists


def divide_skip(query: np.ndarray, others: list[np.ndarray]) -> list[int]:
    """The places of those sorted token sets that reach the needed similarity with `query`.

    The needed overlap T grows with the other set's size, so lists are merged for the least T of all
    and each document is held against its own at the end.
    """
    sizes = np.array([len(x) for x in others])
    need = -(-sj.NEED * (sizes + len(query)) // (sj.NEED + sj.OF))
    # Inverted lists: for each token of the query the documents that hold it, rising.
    tokens = np.concatenate(others)
    owner = np.repeat(np.arange(len(others)), sizes)
    place = np.searchsorted(query, tokens)
    place[place == len(query)] = 0
    held = query[place] == tokens
    place, owner = place[held], owner[held]
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    cuts = np.flatnonzero(np.diff(place)) + 1
    lists = sorted((x for x in np.split(owner, cuts) if len(x)), key=len)
    least = int(need.min())
    if len(lists) < least:
        return []
    most = len(lists[-1])
    n_long = min(least - 1, int(least / (MU * math.log2(most) + 1))) if most > 1 else 0
    long, short = lists[len(lists) - n_long:], lists[:len(lists) - n_long]
    out, last, count = [], -1, 0

    def settle(doc: int, seen: int) -> None:
        want = int(need[doc])
        if seen < want - len(long):
            return
        for k, one in enumerate(reversed(long)):
            if seen >= want:
                break
            if seen + len(long) - k < want:
                return
            at = int(np.searchsorted(one, doc))
            seen += at < len(one) and one[at] == doc
        if seen >= want:
            out.append(doc)

    for doc in heapq.merge(*(x.tolist() for x in short)):
        if doc == last:
            count += 1
        else:
            if last >= 0:
                settle(last, count)
            last, count = doc, 1
    if last >= 0:
        settle(last, count)
    return out


def linked(pairs: DataFrame, members: DataFrame, few: bool = False) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, by the hashes of the classes' sets.

    The set of a travels once for up to some SALTS_OF candidates, which follow it in the same sorted part and
    are searched together. few: the pairs leave out most members, so that each side is chosen before its shuffle.
    """
    many = frames.written(pairs.groupBy("a").agg(F.count("*").alias("n")).where(F.col("n") > SALTS_OF), "many")
    salts = F.coalesce(F.floor(F.col("n") / SALTS_OF) + 1, F.lit(1))
    keyed = pairs.join(many, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), salts).alias("salt"))
    one_side = [sj.only(members, pairs.select(F.col(x).alias("a"))) if few else members for x in "ab"]
    heads = (keyed.select("a", "salt").distinct()
             .join(one_side[0].select(F.col("class").alias("a"), "one", "tokens"), "a")
             .select("a", "salt", F.lit(False).alias("other"), "one", "tokens"))
    tails = (keyed.join(one_side[1].select(F.col("class").alias("b"), "one", "tokens"), "b")
             .select("a", "salt", F.lit(True).alias("other"), "one", "tokens"))
    dealt = heads.unionByName(tails).repartition("a", "salt").sortWithinPartitions("a", "salt", "other")
    frames.small_batches(pairs.sparkSession, 128)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, 0
        queries, names, others = [], [], []
        left, right = [], []

        def search() -> None:
            for one, query in queries if others else ():
                found = divide_skip(query, others)
                left.extend([one] * len(found))
                right.extend(names[k] for k in found)
            names.clear()
            others.clear()

        def emit() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])
            left.clear()
            right.clear()
            return out

        for batch in batches:
            for a, salt, other, one, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if key != (a, salt):
                    search()
                    key = (a, salt)
                    queries.clear()  # several, if classes share their 48 bits
                    held = 0
                tokens = np.frombuffer(blob, np.uint64)
                if not other:
                    queries.append((one, tokens))
                    continue
                names.append(one)
                others.append(tokens)
                held += len(tokens)
                if held > VOLUME:
                    search()
                    held = 0
            yield emit()
        search()
        yield emit()

    return frames.written(dealt.mapInArrow(frames.lean(run), "a bigint, b bigint"), "links")


def pivot_pairs(lists: DataFrame) -> DataFrame:
    """One member a of each list with all its others b of other components."""
    pivot = lists.groupBy("token").agg(
        F.min_by(F.struct("a", "size", "component"), F.xxhash64("a", F.pmod("token", F.lit(KINDS)))).alias("p"))
    return (lists.join(pivot, "token")
            .where((F.col("a") != F.col("p.a")) & (F.col("component") != F.col("p.component"))
                   & sj.close(F.col("size"), F.col("p.size")))
            .select(F.col("p.a").alias("a"), F.col("a").alias("b")).distinct())


def forest(size: np.ndarray, component: np.ndarray, partner: np.ndarray, tokens: np.ndarray) -> list[tuple[int, int]]:
    """Links between sets of different components, so many that all linked components are connected.

    Sets stand in order of their size, their tokens in a row. Each is searched among the partners before
    it: the short ones of the inverted lists of its tokens are merged and counted, what may still reach
    its T is probed in the long lists by binary search.
    """
    sets = len(size)
    begin = np.concatenate([[0], np.cumsum(size)])
    owner = np.repeat(np.arange(sets, dtype=np.int32), size)
    order = np.argsort(tokens, kind="stable")  # by token, then by set
    sorted_tokens = tokens[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = sorted_tokens[1:] != sorted_tokens[:-1]
    # Lists hold partners only; each token of each set knows its list and the place of the set in it.
    in_list = partner[owner[order]]
    before = np.concatenate([[0], np.cumsum(in_list)])
    list_start = before[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    low, high = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    low[order], high[order] = list_start, before[:-1]
    lists = owner[order][in_list]
    del order, sorted_tokens, fresh, in_list, before, list_start, owner

    parent = {c: c for c in component.tolist()}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    out = []
    for i in range(sets):
        least = -(-sj.NEED * int(size[i]) // sj.OF)  # the least T: a partner is at most as large
        starts, ends = low[begin[i]:begin[i + 1]], high[begin[i]:begin[i + 1]]
        length = ends - starts
        held = length > 0
        starts, ends, length = starts[held], ends[held], length[held]
        if len(length) < least:
            continue
        rank = np.argsort(length, kind="stable")
        starts, ends, length = starts[rank], ends[rank], length[rank]
        most = int(length[-1])
        n_long = min(least - 1, int(least / (MU * math.log2(most) + 1))) if most > 1 else 0
        n_short = len(length) - n_long
        total = np.concatenate([[0], np.cumsum(length[:n_short])])
        spots = np.arange(total[-1]) + np.repeat(starts[:n_short] - total[:-1], length[:n_short])
        count = np.bincount(lists[spots], minlength=i)
        need = -(-sj.NEED * (size[:i] + size[i]) // (sj.NEED + sj.OF))
        mine = root(int(component[i]))
        found = np.flatnonzero((count[:i] >= need - n_long) & (sj.OF * size[:i] >= sj.NEED * size[i]))
        found = np.array([j for j in found.tolist() if root(int(component[j])) != mine], np.int64)
        seen, want = count[found], need[found]
        for k in range(len(length) - 1, n_short - 1, -1):
            alive = seen + (k - n_short + 1) >= want
            found, seen, want = found[alive], seen[alive], want[alive]
            if not len(found):
                break
            one = lists[starts[k]:ends[k]]
            at = np.minimum(np.searchsorted(one, found), len(one) - 1)
            seen = seen + (one[at] == found)
        for j in found[seen >= want].tolist():
            one, other = root(int(component[i])), root(int(component[j]))
            if one != other:
                parent[one] = other
                out.append((i, j))
    return out


def block_links(left: DataFrame, members: DataFrame) -> DataFrame:
    """Links (a, b) that connect all components of the classes `left` (a, component) that have a link. Written.

    Sizes fall into bands by the needed similarity, so a link lies in one band or in two that are neighbours: a
    task searches members of a band and the next one among those of the band.
    """
    band = F.floor(F.log("size") / F.log(F.lit(sj.OF / sj.NEED)))
    light = (members.join(left.withColumnRenamed("a", "class"), "class")
             .select("one", "component", "size", band.alias("band")))
    groups = light.withColumn("group", F.explode(F.array("band", F.col("band") - 1)))
    volume = groups.groupBy("group").agg((F.floor(F.sum("size") / VOLUME) + 1).alias("blocks"),
                                         F.min("band").alias("_low"), F.min("component").alias("_l"),
                                         F.max("component").alias("_h"))
    volume = volume.where("_low = group AND _l <> _h").select("group", "blocks")
    dealt = (groups.join(volume, "group").withColumn("block", F.pmod(F.xxhash64("one"), F.col("blocks")))
             .withColumn("met", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("group", F.least("block", "met").alias("low"), F.greatest("block", "met").alias("high"),
                     "one", "component", "size", (F.col("band") == F.col("group")).alias("partner")))
    met = dealt.join(sj.only(members, left).select("one", "tokens"), "one")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("size")
        names = table.column("one").to_pylist()
        component = np.unique(table.column("component").to_numpy(), return_inverse=True)[1]
        found = forest(table.column("size").to_numpy(), component,
                       table.column("partner").to_numpy(zero_copy_only=False),
                       np.frombuffer(b"".join(table.column("tokens").to_pylist()), np.uint64))
        return pa.table({"a": pa.array([names[i] for i, _ in found], pa.int64()),
                         "b": pa.array([names[j] for _, j in found], pa.int64())})

    return frames.written(met.groupBy("group", "low", "high").applyInArrow(frames.lean_group(run), "a bigint, b bigint"), "links")


def mixed(long: DataFrame, labels: DataFrame, members: DataFrame) -> DataFrame:
    """Lists that still hold more than one component, each member that can have a link to another one
    with its component."""
    known = (long.join(labels.select(sj.class_column("node").alias("a"), "component"), "a", "left")
             .withColumn("component", F.coalesce("component", "a")))
    open_ = (known.groupBy("token").agg(F.min("component").alias("_l"), F.max("component").alias("_h"))
             .where("_l <> _h").select("token"))
    lists = frames.written(known.join(open_, "token", "left_semi"), "lists")
    return frames.written(lists.join(sj.able(lists, members), "a", "left_semi"), "lists")


def links_of(docs: DataFrame, text: str, units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Verified links (a, b) between classes that leave no two linked classes apart, and the labels
    (node, component) of linked classes."""
    classes, tokens = sj.rarity(units)
    met = frames.written(sj.candidates(sj.postings(docs, text, sj.documents, classes, tokens), tokens), "met")
    _, short, long = sj.surviving(met)
    members = sj.member_sets(docs, text, sj.documents,
                             short.select("a").union(short.select("b")).union(long.select("a")))
    links = linked(short, members)
    labels = components(links)
    lists = mixed(long, labels, members)
    if lists.isEmpty():
        return links, labels
    pairs = frames.written(pivot_pairs(lists), "pivot-pairs")
    links = links.union(linked(pairs, members, few=True))
    labels = components(links)
    lists = mixed(lists.select("a", "size", "token"), labels, members)
    more = block_links(lists.select("a", "component").distinct(), members)
    if not more.isEmpty():
        links = links.union(more)
        labels = components(links)
    return links, labels


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, text_hash, class_id (of equal sets) and component (its own
    number, as ids may repeat); the last two are null without shingles."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       F.col(text).alias("text"))
    units = sj.described(docs, "text", ["doc_id", "text_hash"], sj.documents)
    rows = units.where("part IS NULL").select("doc_id", "text_hash", "size", "one", "two")
    _, labels = links_of(docs, "text", units)
    full = rows.where("size > 0")
    of_class = (full.groupBy("one", "two").agg(F.min("doc_id").alias("least"))
                .withColumn("node", F.col("one")))
    tagged = of_class.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = tagged.groupBy("component").agg(F.min("least").alias("component_id"))
    named = tagged.join(smallest, "component").select("one", "two", "component_id", "component")
    size = F.col("size").alias("n_shingles")
    joined = full.join(named, ["one", "two"]).select(
        "doc_id", size, "component_id", "text_hash", F.col("one").alias("class_id"), "component")
    return joined.unionByName(rows.where("size = 0").select(
        "doc_id", size, F.col("doc_id").alias("component_id"), "text_hash",
        F.lit(None).cast("long").alias("class_id"), F.lit(None).cast("long").alias("component")))


@frames.other_columns_aside
def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay when of each component one document stays: that of the smallest id, of the
    smallest hash of the text among several of that id or where none has an id.

    Documents without shingles stay. Of rows that repeat id and text one stays.
    """
    columns = docs.columns
    keyed = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__hash": F.xxhash64("text")})
    key = ["__id", "__hash"]
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    rows = frames.written(join(docs).where("n_shingles > 0").select("component", place.alias("place")).distinct(),
                          "places")
    several = (rows.groupBy("component").agg(F.min("place").alias("first"), F.count("*").alias("n"))
               .where("n > 1").select("component", "first"))
    gone = (rows.join(several, "component").where("NOT place <=> first")
            .select(F.col("place.doc_id").alias("_i"), F.col("place.text_hash").alias("_h")))
    left = keyed.join(gone, F.col("__id").eqNullSafe(F.col("_i")) & (F.col("__hash") == F.col("_h")), "left_anti")
    twice = frames.written(keyed.where("trim(text) <> ''").groupBy(*key).count().where("count > 1")
                           .select(F.col("__id").alias("_i"), F.col("__hash").alias("_h")), "repeated")
    if not twice.isEmpty():
        same = F.col("__id").eqNullSafe(F.col("_i")) & (F.col("__hash") == F.col("_h"))
        left = (left.join(twice, same, "left_anti")
                .unionByName(left.join(twice, same, "left_semi").dropDuplicates(key)))
    return left.select(*[F.col(f"`{c}`") for c in columns])


def op9_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return join(frames.table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")
