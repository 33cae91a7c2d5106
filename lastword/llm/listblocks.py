"""Search of long posting lists in tasks of bounded volume: which sets have a similar one before them.

Posting lists are dealt to buckets by their token, as many as the volume of the sets asks for, so a set
travels at most once per prefix token, and only once while all sets fit one bucket. In a bucket sets lie in bands of size:
a link joins sets of one band or of two that are neighbours. A bucket's band that a hot token has
filled beyond the bound is cut into blocks, and two blocks meet in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastword.llm import frames
from lastword.llm import setjoin as sj

VOLUME = 2_000_000  # tokens of a block
SPOTS = 1 << 19  # places in lists that are looked at together
STEP = 4  # lists in which a partner is looked up before it is judged again
ROW = 16  # what a set weighs beside its tokens
ORDER = ("none", "id", "hash", "line")


def numbered(tokens: np.ndarray) -> np.ndarray:
    """Each token's place among the distinct ones."""
    return np.unique(tokens, return_inverse=True)[1].astype(np.int64)


def earlier(size: np.ndarray, tokens: np.ndarray, query: np.ndarray, partner: np.ndarray) -> np.ndarray:
    """Which sets among `query` are similar to a set among `partner` that stands before them."""
    return searched(size, numbered(tokens), query, partner)


def searched(size: np.ndarray, number: np.ndarray, query: np.ndarray, partner: np.ndarray) -> np.ndarray:
    """What `earlier` returns, from tokens that are numbered already.

    Tokens of all sets lie in a row. Those of a set are ordered by rarity, that is by how
    many partners before it hold them; a link needs one of the n - T + 1 rarest. Partners found there that
    pass the length filter are looked up in the other lists, from the longest, as long as they can reach T. Sets are
    searched many at once.
    """
    sets = len(size)
    owner = np.repeat(np.arange(sets, dtype=np.int32), size)
    mine = partner[owner]
    index = np.sort(number[mine] * sets + owner[mine])
    lists = (index % sets).astype(np.int32)
    # The entries of the sets that ask: their lists' part before them.
    mine = query[owner]
    owner, base = owner[mine], number[mine] * sets
    low, high = (np.searchsorted(index, x).astype(np.int32) for x in (base, base + owner))
    least = -(-sj.NEED * size // sj.OF)
    found = np.zeros(sets, bool)

    def narrowed(keep: np.ndarray) -> None:
        nonlocal owner, base, low, high
        owner, base, low, high = owner[keep], base[keep], low[keep], high[keep]

    narrowed(high > low)
    narrowed((np.bincount(owner, minlength=sets) >= least)[owner])

    def shared(at: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Whether the token of these entries stands in these partners."""
        key = base[at] + other
        spot = np.minimum(np.searchsorted(index, key), len(index) - 1)
        return index[spot] == key

    def wanted(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return -(-sj.NEED * (size[i] + size[j]) // (sj.NEED + sj.OF))

    # Copies have many partners: that which is the first, or the last, of most lists is tried before all.
    for end in (False, True):
        if not len(owner):
            return found
        pair, times = np.unique(owner.astype(np.int64) * sets + lists[high - 1 if end else low], return_counts=True)
        start = np.flatnonzero(np.diff(pair // sets, prepend=-1))
        most = np.repeat(np.maximum.reduceat(times, start), np.diff(np.append(start, len(pair))))
        pair = pair[times == most]
        pair = pair[np.diff(pair // sets, prepend=-1) != 0]
        likely = np.zeros(sets, np.int64)
        likely[pair // sets] = pair % sets
        both = np.bincount(owner[shared(np.arange(len(owner)), likely[owner])], minlength=sets)
        i, j = pair // sets, pair % sets
        found[i] = both[i] >= wanted(i, j)
        narrowed(~found[owner])

    order = np.lexsort((high - low, owner))
    narrowed(order)
    who, start, held = np.unique(owner, return_index=True, return_counts=True)
    rare = held - least[who] + 1
    rank = np.arange(len(owner)) - np.repeat(start, held)
    spots = np.where(rank < np.repeat(rare, held), high - low, 0)
    total = np.concatenate([[0], np.cumsum(spots)])
    cuts = [0]
    while cuts[-1] < len(who):
        bound = np.searchsorted(total, total[start[cuts[-1]]] + SPOTS, "right") - 1
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(start, bound, "right")) - 1 if bound < len(owner) else len(who)))
    for x, y in zip(cuts, cuts[1:]):
        begin, end = start[x], start[y] if y < len(who) else len(owner)
        n = spots[begin:end]
        place = np.arange(total[end] - total[begin]) + np.repeat(low[begin:end] - (total[begin:end] - total[begin]), n)
        nth = np.repeat(np.repeat(np.arange(x, y), held[x:y]), n)
        pair, seen = np.unique(nth * sets + lists[place], return_counts=True)
        nth, j = pair // sets, pair % sets
        del place, pair
        i = who[nth]
        fits = sj.OF * np.minimum(size[i], size[j]) >= sj.NEED * np.maximum(size[i], size[j])
        nth, i, j, seen = nth[fits], i[fits], j[fits], seen[fits]
        want, left = wanted(i, j), held[nth] - rare[nth]
        while len(nth):
            found[i[(seen >= want)]] = True
            alive = (seen < want) & (seen + left >= want)
            alive &= ~found[i]
            nth, i, j, seen, want, left = (z[alive] for z in (nth, i, j, seen, want, left))
            last = start[nth] + rare[nth] + left
            for k in range(1, STEP + 1):
                some = left >= k
                seen[some] += shared(last[some] - k, j[some])
            left = np.maximum(left - STEP, 0)
    return found


def matched(lists: DataFrame, members: DataFrame) -> DataFrame:
    """The nodes marked `query` with a similar one before them in the order of `first`, by exact overlap. Written.

    lists holds node, token, first (a struct of id, hash and line, null ids first) and query; members the sets.
    """
    place = [F.col(f"first.{name}") for name in lists.schema["first"].dataType.names]
    keys = [place[0].isNotNull().cast("int"), F.coalesce(place[0], F.lit(0)), *place[1:]]
    band = F.floor(F.log("size") / F.log(F.lit(sj.OF / sj.NEED)))
    sized = members.select(F.col("one").alias("node"), "size", band.alias("band"))
    entries = lists.drop("size").join(sized, "node")
    weight = F.col("size") + ROW
    volume = entries.select("node", "size").distinct().agg(F.sum(weight)).first()[0] or 0  # one number
    bucket = F.pmod(F.xxhash64("token"), F.lit(volume // VOLUME + 1))
    light = (entries.select(bucket.alias("bucket"), "node", "size", "band", "query",
                            *[k.alias(name) for k, name in zip(keys, ORDER)]).distinct()
             .withColumn("group", F.explode(F.array("band", F.col("band") - 1))))
    groups = (light.groupBy("bucket", "group")
              .agg((F.floor(F.sum(weight) / VOLUME) + 1).alias("blocks"), F.min("band").alias("_low"),
                   F.max("query").alias("_asked"), F.count("*").alias("_n"))
              .where("_low = group AND _asked AND _n > 1").select("bucket", "group", "blocks"))
    dealt = (light.join(groups, ["bucket", "group"])
             .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
             .withColumn("met", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("bucket", "group", F.least("block", "met").alias("low"), F.greatest("block", "met").alias("high"),
                     "block", "node", "size", "query", (F.col("band") == F.col("group")).alias("inner"), *ORDER))
    met = dealt.join(members.select(F.col("one").alias("node"), "tokens"), "node")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(name, "ascending") for name in ORDER])
        size, node = table.column("size").to_numpy(), table.column("node").to_numpy()
        query = table.column("query").to_numpy(zero_copy_only=False)
        inner = table.column("inner").to_numpy(zero_copy_only=False)
        block = table.column("block").to_numpy()
        tokens = numbered(np.frombuffer(b"".join(table.column("tokens").to_pylist()), np.uint64))
        names = np.unique(block).tolist()
        one = table.column("low")[0].as_py() == table.column("high")[0].as_py()
        found = np.zeros(len(size), bool)
        for x, y in [(names[0],) * 2] if one else [(names[0], names[-1]), (names[-1], names[0])]:
            asks, holds = query & (block == x), block == y
            # Two sets of the upper band meet in their own group.
            found |= searched(size, tokens, asks & ~found, holds & inner)
            found |= searched(size, tokens, asks & inner & ~found, holds & ~inner)
        return pa.table({"node": pa.array(node[found], pa.int64())})

    found = met.groupBy("bucket", "group", "low", "high").applyInArrow(frames.lean_group(run), "node bigint")
    return frames.written(found.distinct(), "matched")
