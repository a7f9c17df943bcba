"""Lookups, hot keys and salting."""

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from stratalake.operators import joins


@pytest.fixture
def skewed(spark):
    """A third of the rows on key 7, a tenth without key, the rest spread."""
    return spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 500).alias("k"),
        F.col("id").alias("v"),
    )


@pytest.fixture
def lookup(spark):
    return spark.range(450).select(F.col("id").alias("key"), F.concat(F.lit("n"), "id").alias("name"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_equals_plain(spark, skewed, lookup, how):
    plain = skewed.join(lookup, F.col("k") == F.col("key"), how)
    salted = joins.salted_join(skewed, lookup, "k", "key", how, [7], 5)
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)


def test_salted_keeps_repeated_lookup_rows(spark, skewed, lookup):
    twice = lookup.unionByName(lookup)
    plain = skewed.join(twice, F.col("k") == F.col("key"), "left")
    assert rows(joins.salted_join(skewed, twice, "k", "key", "left", [7, 449, 10_000], 5)) == rows(plain)


@pytest.mark.parametrize("partitions", ["2", "16"])
def test_equal_rows_of_a_hot_key_are_spread(spark, skewed, lookup, partitions):
    """No task receives the whole hot key, though all its rows are equal."""
    equal = skewed.select("k")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    pieces = 8 * int(partitions)
    try:
        hot = joins.hot_values(equal, "k", pieces)
        joined = joins.salted_join(equal.where("k IS NOT NULL"), lookup, "k", "key", "left", hot, pieces)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert hot == [7] and max(sizes) < sum(sizes) / int(partitions) * 1.8


def test_hot_values_by_exact_share(spark, skewed):
    assert joins.hot_values(skewed, "k", 300) == [7]
    even = spark.range(1000).select((F.col("id") % 500).alias("k"))
    assert joins.hot_values(even, "k", 300) == [] and len(joins.hot_values(even, "k", 500)) == 500
    assert joins.hot_values(skewed.where("v < 0"), "k", 300) == []


def test_lookup_joins_carry_no_hint(spark, skewed, lookup):
    plan = joins.lookup_join(skewed, lookup, "k", "key")._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in plan and "__salt" not in plan


def test_shared_names_are_refused(spark, skewed):
    with pytest.raises(ValueError, match="rename"):
        joins.lookup_join(skewed, skewed, "k", "k")


def test_semi_join_does_not_repeat_rows(spark):
    laps = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "raceId int, lap string")
    keys = spark.createDataFrame([(1,), (1,), (None,)], "race int")
    got = joins.semi_join(laps, keys, "raceId", "race")
    assert rows(got) == [(1, "a")] and "LeftSemi" in plan_of(got)


def test_semi_join_sorts_no_rows(spark):
    """Wide rows are hashed at every size: neither sorted (and spilled) nor matched to keys sent to all tasks."""
    laps = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "n")], "raceId bigint, text string")
    keys = spark.createDataFrame([(1,), (1,), (3,), (None,)], "race bigint")
    got = joins.semi_join(laps, keys, "raceId", "race")
    assert rows(got) == [(1, "a"), (1, "a")]
    plan = plan_of(got)
    assert "ShuffledHashJoin" in plan and "Sort " not in plan and "Broadcast" not in plan


def test_a_stored_lookup_is_measured_by_its_rows(spark, folder):
    few = spark.range(100).select(F.col("id").alias("k"), F.rpad(F.lit("x"), 50, "x").alias("name"))
    few.write.parquet(f"{folder}/few")
    few.withColumn("name", F.rpad(F.lit("x"), 50_000, "x")).write.parquet(f"{folder}/long")  # a few KB of file
    few.withColumn("name", F.array("name")).write.parquet(f"{folder}/nested")
    hinted = {}
    for name in ("few", "long", "nested"):
        lookup = joins.sized(spark.read.parquet(f"{folder}/{name}"), 100_000)
        hinted[name] = "ResolvedHint" in lookup._jdf.queryExecution().analyzed().toString()
        assert lookup.count() == 100
    assert hinted == {"few": True, "long": False, "nested": False}
    assert "ResolvedHint" not in joins.sized(spark.range(10_000), 100_000)._jdf.queryExecution().analyzed().toString()
    assert joins.sized(spark.range(0).withColumn("t", F.lit("a"))).count() == 0
