"""Shards by jump consistent hashing, in column expressions only.

Edge cases: a null key hashes as key 0 of its own text checksum, so nulls spread like other keys; null text
has size 1 and checksum 0; repeated rows take the same shard and slots of their own; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lastword.llm import frames

SHARDS = 16
# Fixed value: the multiplier of the published generator, cut into words of 16 bits.
MULTIPLIER = 2862933555777941757
MASK32 = (1 << 32) - 1
PIECES = [(MULTIPLIER >> (16 * i)) & 0xFFFF for i in range(4)]


def next_state(high: Column, low: Column) -> tuple[Column, Column]:
    """state * MULTIPLIER + 1 modulo 2**64 over two 32-bit halves; no step passes 2**63."""
    a, b = low * PIECES[0] + F.lit(1), low * PIECES[1]
    total = a + F.shiftleft(b.bitwiseAND(F.lit(0xFFFF)), 16)
    carry = F.shiftright(total, 32) + F.shiftright(b, 16)

    def by_half(x: Column, first: int, second: int) -> Column:
        return x * first + F.shiftleft((x * second).bitwiseAND(F.lit(0xFFFF)), 16)

    top = (carry + by_half(low, PIECES[2], PIECES[3])
           + by_half(high, PIECES[0], PIECES[1])).bitwiseAND(F.lit(MASK32))
    return top, total.bitwiseAND(F.lit(MASK32))


def jump(key: Column, shards: int) -> tuple[Column, Column]:
    """The shard of key among `shards` and among one more, both from one walk of jumps.

    Every jump lands strictly further on, so the walk has at most shards + 1 steps; with one more
    shard it is the same walk, which is why a key either stays or moves to the added shard.
    """
    start = F.struct(F.shiftrightunsigned(key, 32).bitwiseAND(F.lit(MASK32)).alias("high"),
                     key.bitwiseAND(F.lit(MASK32)).alias("low"),
                     F.lit(0).cast("long").alias("next"),
                     F.lit(-1).cast("long").alias("shard"), F.lit(-1).cast("long").alias("grown"))

    def step(state: Column, _: Column) -> Column:
        at = state["next"]
        high, low = next_state(state["high"], state["low"])
        unit = F.shiftright(high, 1) + 1
        to = F.floor((at + 1).cast("double") * (F.lit(float(1 << 31)) / unit.cast("double")))
        return F.when(at > shards, state).otherwise(F.struct(
            high.alias("high"), low.alias("low"), to.cast("long").alias("next"),
            F.when(at < shards, at).otherwise(state["shard"]).alias("shard"),
            F.when(at <= shards, at).otherwise(state["grown"]).alias("grown")))

    steps = F.sequence(F.lit(0), F.lit(shards + 1))
    out = F.aggregate(steps, start, step)
    return out["shard"].cast("int"), out["grown"].cast("int")


def assign(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """Per row: key, size, text_crc32, law, shard, slot and grown_shard.

    Rows that agree in all of these are one group with a count; slots are running sums of counts,
    cut into hashed parts, so no shard is sorted in one task and no repeated row is a hot group.
    """
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"),
                       (F.octet_length(body) + 1).cast("long").alias("size"),
                       F.crc32(body).alias("text_crc32"))
    groups = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    shard, grown = jump(F.coalesce("doc_id", F.col("text_crc32")), shards)
    groups = (groups.withColumn("_jump", F.struct(shard.alias("shard"), grown.alias("grown_shard")))
              .select("doc_id", "size", "text_crc32", "n", "_jump.*"))
    placed = frames.ranked_counts(groups, ["shard"], ["doc_id", "size", "text_crc32"])
    blocks, slots = frames.numbered(F.col("first"), F.col("n"))
    return (placed.withColumn("_block", blocks).withColumn("slot", slots)
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    F.col("slot").cast("long").alias("slot"), "grown_shard"))


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return assign(frames.table(spark, folder, "documents"))
