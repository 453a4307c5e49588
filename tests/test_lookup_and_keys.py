import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from saleskeep.operators.keys import next_key, numbered, ranked_desc
from saleskeep.operators.lookup import Lookup, broadcast_size, key_counts, lookup_join


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, a tenth without a key, some keys unknown."""
    draw = random.Random(7)
    keys = ["hot"] * 400 + [None] * 120 + [f"k{draw.randrange(90)}" for _ in range(680)]
    rows = spark.createDataFrame(list(enumerate(keys)), "raw_row_key bigint, key string")
    known = [("hot", 1)] + [(f"k{n}", n + 2) for n in range(60)]
    return rows, spark.createDataFrame(known, "key string, value int")


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("counted", [True, False])
def test_salted_join_equals_the_plain_join(skewed, how, counted, limits):
    rows, table = skewed
    expected = Counter(map(tuple, rows.join(table, "key", how).select("raw_row_key", "key", "value").collect()))
    weights = rows.groupBy("key").agg(F.count("*").alias("n")) if counted else None
    for broadcast_bytes, hot_rows in ((10_000, 1), (5_000, 1), (5_000, 50), (5_000, 10_000)):
        for counted_frame in (None, rows):
            limits(broadcast_bytes, hot_rows)
            lookup = Lookup.measured(table, "key")
            assert lookup.fits == (broadcast_bytes == 10_000)
            joined = lookup_join(
                rows, lookup, ["raw_row_key"], how, weights=weights, counted=counted_frame
            )
            assert set(joined.columns) == {"raw_row_key", "key", "value"}
            got = joined.select("raw_row_key", "key", "value").collect()
            assert Counter(map(tuple, got)) == expected


def test_salted_join_spreads_the_hot_key(spark, skewed, limits):
    limits(10, 1_000)
    rows, table = skewed
    big = rows.crossJoin(spark.range(20)).withColumn("raw_row_key", F.monotonically_increasing_id())
    lookup = Lookup(table, "key", fits=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        joined = lookup_join(big, lookup, ["raw_row_key"])
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    total = sum(row["count"] for row in sizes)
    assert total == 24_000
    assert max(row["count"] for row in sizes) < total / 4


def test_only_keys_of_crowded_parts_are_counted(skewed):
    rows = skewed[0]
    every = Counter(row.key for row in rows.collect())
    found = {row.key: row.n for row in key_counts(rows, "key", 100).collect()}
    assert {key: n for key, n in found.items() if n > 100} == {"hot": 400, None: 120}
    assert len(found) < len(every) / 2 and all(every[key] == n for key, n in found.items())


def test_broadcast_only_when_counted_small(skewed, limits):
    rows, table = skewed
    assert Lookup.measured(table, "key").fits
    size = broadcast_size(table)
    assert size == 61 * (100 + 2 * 8) + 2 * sum(len(row.key) for row in table.collect())
    limits(size, 1)
    assert Lookup.measured(table, "key").fits
    limits(size - 1, 1)
    assert not Lookup.measured(table, "key").fits
    assert not Lookup.measured(table, "key", within=rows).fits


def test_numbers_have_no_gaps_whatever_the_buckets(spark):
    rows = spark.range(1000).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("name"))
    for buckets in (1, 2, 64):
        got = numbered(rows, F.col("name"), "k", start=5, buckets=buckets).collect()
        assert sorted(row.k for row in got) == list(range(6, 1006))
        again = numbered(rows.repartition(5), F.col("name"), "k", start=5, buckets=buckets).collect()
        assert {(r.name, r.k) for r in got} == {(r.name, r.k) for r in again}
    in_order = numbered(rows, F.col("name"), "k").orderBy("k").collect()
    assert [row.name for row in in_order] == sorted(f"p{n}" for n in range(1000))
    assert next_key(spark.range(0), "id") == 0


@pytest.mark.parametrize("buckets", [2, 8, 50])
def test_ranks_equal_the_window_with_long_ties(spark, buckets):
    draw = random.Random(buckets)
    values = [100] * 300 + [draw.randrange(40) for _ in range(400)] + [draw.randrange(10**6) for _ in range(200)]
    rows = spark.createDataFrame(list(enumerate(values)), "id bigint, v bigint").withColumn(
        "v", F.col("v").cast("decimal(38,2)")
    )
    plain = rows.withColumn("r", F.rank().over(Window.orderBy(F.desc("v"))).cast("bigint"))
    split = ranked_desc(rows, "v", "r", ["id"], buckets)
    assert {(x.id, x.v, x.r) for x in split.collect()} == {(x.id, x.v, x.r) for x in plain.collect()}
    assert dict(split.dtypes)["r"] == dict(ranked_desc(rows, "v", "r", ["id"]).dtypes)["r"] == "bigint"
