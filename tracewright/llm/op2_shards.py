"""Sharding by jump consistent hashing (Lamping and Veach, 2014): stable keys, no ring table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import running_sum, table, utf8_size

#: Multiplier of the linear congruential generator of the algorithm.
MULTIPLIER = 2862933555777941757
SHARDS = 40


def _next_state(key: Column) -> Column:
    """key * MULTIPLIER + 1 modulo 2**64, on signed longs and without overflow.

    Products of a 32-bit and a 16-bit number stay below 2**48; the upper half only matters modulo 2**32.
    """
    low_mask, half = F.lit(0xFFFFFFFF), F.lit(0xFFFF)
    m_low, m_high = MULTIPLIER & 0xFFFFFFFF, MULTIPLIER >> 32
    low, high = key.bitwiseAND(low_mask), F.shiftrightunsigned(key, 32)

    def times(x: Column, m: int) -> tuple[Column, Column]:
        """x * m as low 32 bits and what lies above them, for 32-bit x and m."""
        right, left = x * F.lit(m & 0xFFFF), x * F.lit(m >> 16)
        low_part = right + F.shiftleft(left.bitwiseAND(half), 16)
        return low_part.bitwiseAND(low_mask), F.shiftrightunsigned(low_part, 32) + F.shiftrightunsigned(left, 16)

    product, carry = times(low, m_low)
    product = product + 1
    upper = carry + F.shiftrightunsigned(product, 32) + times(low, m_high)[0] + times(high, m_low)[0]
    return F.shiftleft(upper, 32).bitwiseOR(product.bitwiseAND(low_mask))


def jump_hash(key: Column, shards: int, grown: int | None = None) -> Column:
    """Struct (shard, grown_shard) of a long key: its shards of ``shards`` and of ``grown`` (default: one more).

    Each step jumps to a later shard, so a fold over as many steps as there are shards ends every
    chain. Appending shards moves a key only if its chain jumps into the new ones.
    """
    grown = grown or shards + 1
    begin = F.struct(key.alias("key"), F.lit(0).cast("long").alias("next"), F.lit(0).cast("long").alias("shard"), F.lit(0).cast("long").alias("grown_shard"))

    def step(s: Column, _: Column) -> Column:
        state = _next_state(s["key"])
        ahead = F.floor((s["next"] + 1).cast("double") * (F.lit(2147483648.0) / (F.shiftrightunsigned(state, 33) + 1).cast("double"))).cast("long")
        live = s["next"] < grown
        return F.when(live, F.struct(state.alias("key"), ahead.alias("next"), F.when(s["next"] < shards, s["next"]).otherwise(s["shard"]).alias("shard"), s["next"].alias("grown_shard"))).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(grown)), begin, step, lambda s: F.struct(s["shard"].cast("int").alias("shard"), s["grown_shard"].cast("int").alias("grown_shard")))


def shard(docs: DataFrame, key: str = "doc_id", shards: int = SHARDS) -> DataFrame:
    """Add ``shard``, ``grown_shard`` (with one more shard) and ``slot`` to each row.

    The key and the number of shards alone decide the shard (law ``key``); one more shard takes
    rows only into itself. Keys that are not whole numbers are hashed first; a null key counts as
    0. ``slot`` numbers the rows of a shard from 0 without gaps, in an order that mixes keys and
    rows. Existing columns of these names are replaced. Slots are numbered in blocks of a shard,
    so neither a shard nor the rows of a null or repeated key are one task.
    """
    number = F.col(key).cast("long") if docs.schema[key].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint") else F.xxhash64(key)
    number = F.coalesce(number, F.lit(0).cast("long"))
    rows = docs.drop("shard", "grown_shard", "slot").withColumn("_jump", jump_hash(number, shards))
    rows = rows.select("*", "_jump.shard", "_jump.grown_shard").drop("_jump")
    mixed = F.shiftrightunsigned(F.xxhash64(*(c for c, t in docs.dtypes if "map<" not in t)), 32)
    return running_sum(rows, "shard", F.lit(1).cast("long"), mixed, [F.col(key)], "slot")


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard, slot and grown shard of each document by its doc_id, with the text's size and checksum; null text is empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long"), (utf8_size(F.col("text")) + 16).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law")
    )
    return shard(slim).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
