"""Placement by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a prime-sized table, given by an
offset and a step from a hash of its name. The shards take turns, and at each turn a shard
claims the slot it likes best among those still free. All shards get the same number of slots,
but for one, and when a shard leaves or joins few other slots change hands. A document's slot is
a hash of its key, so placement is one lookup in a broadcast table of a fixed size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slots of the table; a prime, some hundred times the shards.
SLOTS = 65_537
SHARDS = tuple(f"shard-{n:03d}" for n in range(64))


def _hash(name: str, salt: str) -> int:
    return int(hashlib.md5(f"{salt}:{name}".encode()).hexdigest()[:15], 16)


def lookup_table(shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> list[int]:
    """For each slot the number of the shard that claimed it."""
    if slots < 2 or any(slots % n == 0 for n in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be prime")
    if not 0 < len(set(shards)) == len(shards) <= slots:
        raise ValueError("shards need distinct names, one at least and no more than slots")
    wish = [_hash(name, "offset") % slots for name in shards]
    step = [_hash(name, "step") % (slots - 1) + 1 for name in shards]
    owner = [-1] * slots
    for turn in range(slots):
        shard = turn % len(shards)
        while owner[wish[shard]] >= 0:
            wish[shard] = (wish[shard] + step[shard]) % slots
        owner[wish[shard]] = shard
    return owner


def slot(key: Column, slots: int = SLOTS) -> Column:
    """A key's slot; a NULL key is placed as the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % slots).cast("int")


def _table(spark: SparkSession, shards: Sequence[str], slots: int) -> DataFrame:
    owner = lookup_table(shards, slots)
    held = F.element_at(F.array(*(F.lit(name) for name in shards)), F.col("number") + 1)
    rows = spark.createDataFrame(list(enumerate(owner)), "slot int, number int")
    return rows.select("slot", held.alias("shard"))


def place(
    df: DataFrame, key: str = "doc_id", shards: Sequence[str] = SHARDS, slots: int = SLOTS
) -> DataFrame:
    """`df` with the columns slot and shard (replaced if there are any). Repeated keys share
    their shard; the table has `slots` rows whatever the size of `df`."""
    kept = df.drop("slot", "shard").withColumn("slot", slot(F.col(key), slots))
    return kept.join(F.broadcast(_table(df.sparkSession, shards, slots)), "slot").select(
        *kept.columns, "shard"
    )


def write_shards(placed: DataFrame, path: str, files: int = 4) -> None:
    """One folder per shard, `files` files each: a shard is spread by the hash of its slots."""
    part = F.pmod(F.xxhash64("slot"), F.lit(files))
    placed.repartition(F.col("shard"), part).write.partitionBy("shard").parquet(path)
