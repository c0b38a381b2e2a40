"""Shards by jump consistent hashing: a stable key and the number of shards decide.

A key walks from shard to shard by its own pseudo-random jumps and stops at the last one
below the number of shards. No ring or table is kept. One shard more takes only the rows
that land in it, about one in ``shards + 1``; all others stay.

The walk is a linear congruential generator modulo 2**64. Its products are taken in decimals,
since integer products that leave 64 bits are errors in SQL.

A null key counts as 0 and an empty table gives no rows. Rows with equal keys share a shard,
whatever their texts; rows with equal texts but different keys are placed apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.llm.running import running_total, scattered, times_factor, unsigned, whole_part

KEEP = 1 << 33  #: divisor that keeps a state's upper 31 bits, a fixed value of the method
STEPS = 24  #: jumps walked by all rows; the few rows that need more walk on
CELLS = 1 << 16  #: cells of all shards together, each numbered by itself
OVERHEAD = 16  #: bytes of a row beside its text


def jump(first: Column, shards: int) -> Column:
    """Shard of a generator state, from 0 to ``shards - 1``."""
    if shards < 1:
        raise ValueError("there is at least one shard")

    def step(at: Column) -> Column:
        key = times_factor(at["key"], 1)
        drawn = F.lit(float(1 << 31)) / (whole_part(key, KEEP) + 1).cast("double")
        to = F.floor((at["to"] + 1) * drawn).cast("bigint")
        moved = F.struct(key.alias("key"), at["to"].alias("at"), to.alias("to"))
        return F.when(at["to"] < shards, moved).otherwise(at)

    def walk(start: Column, steps: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, lambda at, _: step(at))

    start = F.struct(
        first.cast("decimal(20,0)").alias("key"), F.lit(-1).cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("to")
    )
    near = walk(start, min(STEPS, shards))
    if shards > STEPS:
        near = F.aggregate(  # a let: the walk so far is computed once
            F.array(near),
            start,
            lambda _, at: F.when(at["to"] < shards, walk(at, shards - STEPS)).otherwise(at),
        )
    return near["at"].cast("int")


def with_shard(rows: DataFrame, shards: int, key: str = "doc_id", out: str = "shard") -> DataFrame:
    """``rows`` with their shard. Nothing is shuffled. A column ``out`` that is there is replaced.

    Integer keys are used as they are, keys of other types by a 64-bit hash.
    """
    whole = dict(rows.dtypes)[key] in ("tinyint", "smallint", "int", "bigint")
    return rows.withColumn(out, jump(unsigned(F.col(key) if whole else F.xxhash64(key)), shards))


def sharded(docs: DataFrame, shards: int, text: str = "text") -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the text's bytes and ``OVERHEAD``; a null text has none and the checksum of no
    bytes. ``slot`` numbers the rows of a shard from 0 without gaps, in the order of cell, id,
    checksum and size. Rows equal in all of these are counted before they are numbered, so
    many copies of one row are no burden. ``grown_shard`` is the shard if there were one more.
    """
    body = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    rows = docs.select(
        F.col("doc_id"), (F.octet_length(body) + OVERHEAD).cast("bigint").alias("size"), F.crc32(body).alias("text_crc32")
    )
    counted = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("rows"))
    first = unsigned("doc_id")
    cells = max(1, CELLS // shards)
    placed = counted.select(
        "*",
        jump(first, shards).alias("shard"),
        jump(first, shards + 1).alias("grown_shard"),
        scattered(F.coalesce("doc_id", F.lit(0)).bitwiseXOR(F.col("text_crc32")), cells).alias("cell"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("doc_id", "text_crc32", "size")]
    numbered = running_total(placed, "shard", "cell", order, "rows", "start", "shard-slots")
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        F.explode(F.sequence(F.col("start"), F.col("start") + F.col("rows") - 1)).alias("slot"),
        "grown_shard",
    )
