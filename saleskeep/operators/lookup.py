"""Joins that stay balanced: measured broadcasts, and salted shuffles beyond them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup is broadcast only when its measured size in memory is at most this. Set
# spark.saleskeep.broadcastBytes to change it.
BROADCAST_BYTES = 128 << 20
# What a row of a broadcast table takes beyond its values: two row headers and a map entry.
ROW_OVERHEAD = 100
# A key with more rows than this is hot. There can be at most (rows / HOT_ROWS) hot keys,
# 50,000 for 10^11 rows, so their list is always small enough to broadcast. Set
# spark.saleskeep.hotRows to change it.
HOT_ROWS = 2_000_000
# Rows of one hot key are spread over this many parts.
SALTS = 512
# Rows are counted per part of this many, by a hash of the key, before any key is counted.
COUNTED_PARTS = 4_096


def _setting(df: DataFrame, name: str, default: int) -> int:
    return int(df.sparkSession.conf.get(f"spark.saleskeep.{name}", str(default)))


def broadcast_size(df: DataFrame) -> int:
    """Bytes the rows take when broadcast, at most; texts count twice, as key and as value."""
    texts = [name for name, kind in df.dtypes if kind == "string"]
    total = F.coalesce(F.sum(sum((F.octet_length(n) for n in texts), F.lit(0))), F.lit(0))
    rows, text_bytes = df.fillna("", texts).agg(F.count("*"), total).first()
    return rows * (ROW_OVERHEAD + 8 * len(df.columns)) + 2 * text_bytes


@dataclass(frozen=True)
class Lookup:
    """A table with one row per key, and whether its measured size allows a broadcast."""

    df: DataFrame
    key: str
    fits: bool

    @classmethod
    def measured(cls, df: DataFrame, key: str, within: DataFrame | None = None) -> Lookup:
        """Measure the table, or a simpler one that is known to be no smaller."""
        size = broadcast_size(df if within is None else within)
        return cls(df, key, size <= _setting(df, "broadcastBytes", BROADCAST_BYTES))


def lookup_join(
    rows: DataFrame,
    lookup: Lookup,
    spread: Sequence[str],
    how: str = "left",
    *,
    weights: DataFrame | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join rows to a lookup on its key, whatever the lookup's size and the key's skew.

    A lookup that fits is broadcast. Otherwise both sides are shuffled on the key plus a
    salt: zero for most keys; for a hot key the rows take a salt from the ``spread`` columns
    (their content, so a repeated task routes them the same way) and the lookup row is copied
    once per salt. Rows without a key are spread as well.

    To find the hot keys the rows are counted, see `key_counts`. Where ``rows`` are the result of
    other joins, ``counted`` names a cheaper frame with the same key column, or ``weights`` holds
    the counts already made, in a column ``n``. Only the placing of rows depends on them.
    """
    key = lookup.key
    if lookup.fits:
        return rows.join(F.broadcast(lookup.df), key, how)
    hot_rows = _setting(rows, "hotRows", HOT_ROWS)
    if weights is None:
        weights = key_counts(rows if counted is None else counted, key, hot_rows)
    hot = weights.filter(F.col("n") > hot_rows).select(key, F.lit(True).alias("_hot"))
    salt = F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int")
    every_salt = F.sequence(F.lit(0), F.lit(SALTS - 1))
    salted_rows = rows.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.when(F.col("_hot") | F.col(key).isNull(), salt).otherwise(0)
    )
    salted_lookup = lookup.df.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), every_salt).otherwise(F.array(F.lit(0))))
    )
    joined = salted_rows.drop("_hot").join(salted_lookup.drop("_hot"), [key, "_salt"], how)
    return joined.drop("_salt")


def key_counts(rows: DataFrame, key: str, least: int) -> DataFrame:
    """Rows per key, in a column ``n``, of all keys with more than ``least`` rows, and of some others.

    Rows are first counted per part of the keys, a hash of them, which tasks do before the shuffle.
    Only the keys of parts with more than ``least`` rows are counted one by one.
    """
    keyed = rows.select(key, F.pmod(F.xxhash64(key), F.lit(COUNTED_PARTS)).alias("_part"))
    parts = keyed.groupBy("_part").agg(F.count("*").alias("n"))
    crowded = parts.filter(F.col("n") > least).select("_part")
    return keyed.join(F.broadcast(crowded), "_part", "left_semi").groupBy(key).agg(F.count("*").alias("n"))
