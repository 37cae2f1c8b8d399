"""Sharding by a permutation-filled lookup table (DataFrame and SQL functions only).

Every shard has a preference order over the slots of a prime-sized table: start at an offset and step by a
skip, both hashed from its name. Shards take turns; at its turn a shard claims its next free slot. The full
table maps hash(key) mod size to a shard, so a placement is one array-free lookup in a broadcast table of
`table_size` rows, a bound that does not depend on the data. Removing or adding a shard moves few other slots.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.textwork import named, others, quoted, spare

#: Slots per shard: the share of any two shards differs by at most one slot, about 1 %.
SLOTS_PER_SHARD = 100


def prime_at_least(n: int) -> int:
    n = max(n, 2)
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def _hash(text: Column, salt: str) -> Column:
    """An unsigned 32-bit hash that any SQL engine with md5 can reproduce."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt), text).cast("binary")), 1, 8), 16, 10).cast("bigint")


def _name_hash(name: str, salt: str) -> int:
    return int(hashlib.md5((salt + name).encode()).hexdigest()[:8], 16)


def fill(shards: list[str], size: int) -> list[int]:
    """The shard number of every slot. Only the shards' names enter, so this is planning, not work on data.

    A shard never looks at a slot twice; all shards together look at about size * ln(size) slots.
    """
    at = [_name_hash(x, "offset:") % size for x in shards]
    skip = [_name_hash(x, "skip:") % max(size - 1, 1) + 1 for x in shards]
    slots = [-1] * size
    for turn in range(size):
        i = turn % len(shards)
        slot = at[i]
        while slots[slot] >= 0:
            slot = (slot + skip[i]) % size
        slots[slot] = i
        at[i] = (slot + skip[i]) % size
    return slots


def lookup_table(spark: SparkSession, shards: list[str], table_size: int | None = None) -> DataFrame:
    """(slot, shard): the filled table. shards: distinct names, in turn order; table_size: a prime, at least their number."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct names, at least one")
    size = table_size or prime_at_least(SLOTS_PER_SHARD * len(shards))
    if size != prime_at_least(size) or size < len(shards):
        raise ValueError("table_size must be a prime that is not below the number of shards")
    numbers = F.split(F.lit(",".join(map(str, fill(shards, size)))), ",")
    names = F.from_json(F.lit(json.dumps(shards)), "array<string>")
    # range() keeps the arrays out of constant folding, which would copy them into the plan.
    slots = spark.range(1).select(F.posexplode(F.when(F.col("id") >= 0, numbers)).alias("slot", "shard_no"), F.when(F.col("id") >= 0, names).alias("names"))
    return slots.select("slot", F.element_at("names", F.col("shard_no").cast("int") + 1).alias("shard"))


def place(df: DataFrame, key: str, shards: list[str], table_size: int | None = None, slot: str = "slot", shard: str = "shard") -> DataFrame:
    """df with the columns `slot` and `shard` (replacing columns of those names, in any case).

    The key is of any type and hashed by its string form. A null key is placed as the empty string; equal keys,
    repeated rows included, share a shard, so a hot key loads its one shard by definition. An empty table stays
    empty. The broadcast table has table_size rows, whatever the data.
    """
    size = table_size or prime_at_least(SLOTS_PER_SHARD * len(shards))
    own, at, name = spare("slot"), spare("at"), spare("shard")
    table = lookup_table(df.sparkSession, shards, size).select(F.col("slot").alias(at), F.col("shard").alias(name))
    placed = df.withColumn(own, (_hash(F.coalesce(F.col(quoted(key)).cast("string"), F.lit("")), "key:") % size).cast("int"))
    joined = placed.join(F.broadcast(table), F.col(own) == F.col(at), "left")
    return joined.select(*named(others(df, (slot, shard))), F.col(own).alias(slot), F.col(name).alias(shard))
