"""Consistent sharding by a permutation-filled lookup table, DataFrame functions only.

Every shard has its own order of preference over the slots of a prime-sized table, and the shards take turns claiming
their next free slot until none is left. A key goes to the shard that holds its slot. All shards
hold the same number of slots to within one, and losing a shard leaves almost all other keys where they are.

The table depends on the shards' names alone, has ``slots`` rows whatever the data, and is what is broadcast.
Null keys are placed as the empty string; equal keys share a shard; an empty table stays empty. The result has the
input's columns, then ``slot`` and ``shard``, so an input column of such a name must be renamed with ``into``.
"""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm.common import free_names

#: A prime well above 100 times the shards used here.
SLOTS = 65_537


def _number(text: str) -> int:
    return int(md5(text.encode()).hexdigest()[:12], 16)


def fill(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The index of the shard that holds each slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct names, one at least")
    if slots < len(shards) or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime, no less than the shards")
    at = [_number(f"offset:{name}") % slots for name in shards]
    step = [_number(f"step:{name}") % (slots - 1) + 1 for name in shards]
    table, left = [-1] * slots, slots
    while left:
        for k in range(min(len(shards), left)):
            while table[at[k]] >= 0:
                at[k] = (at[k] + step[k]) % slots
            table[at[k]] = k
            left -= 1
    return table


def lookup(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """slot long, shard string: one row per slot."""
    held = F.split(F.lit(",".join(map(str, fill(shards, slots)))), ",")
    names = F.array(*[F.lit(s) for s in shards])
    rows = spark.range(1).select(F.posexplode(held).alias("slot", "k"))
    return rows.select(F.col("slot").cast("long").alias("slot"), F.element_at(names, F.col("k").cast("int") + 1).alias("shard"))


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.pmod(F.conv(F.substring(digest, 1, 12), 16, 10).cast("long"), F.lit(slots))


def place(df: DataFrame, key: str, shards: list[str], slots: int = SLOTS, into: tuple[str, str] = ("slot", "shard")) -> DataFrame:
    """Add the slot and the shard of every row; no shuffle. A name of ``into`` that is taken gets underscores until it is free."""
    slot, shard, held = free_names([*into, "held"], df.columns)
    table = lookup(df.sparkSession, shards, slots).toDF(held, shard)
    keyed = df.withColumn(slot, slot_of(F.col(key), slots))
    return keyed.join(F.broadcast(table), keyed[slot] == table[held], "left").drop(held)


def write_shards(placed: DataFrame, path: str, shard: str = "shard") -> None:
    """One folder per shard. Rows are rebalanced on the shard, so a large one becomes several files."""
    placed.hint("rebalance", shard).write.partitionBy(shard).parquet(path)
