"""Appends through key filters: equal to the plain anti join, and little history is read."""

import random

import pytest
from pyspark.sql import functions as F

from recordlens.operators import key_filters, sinks

KEYS = ["run", "k", "market"]
SCHEMA = "run string, k string, market string, v int"


def rows_of(spark, path):
    return sorted((tuple(r[c] for c in ("run", "k", "market", "v")) for r in spark.read.parquet(path).collect()), key=str)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def batches(spark, n=300):
    pick = random.Random(3)
    markets = ["AU", None, ""]
    one = lambda v: spark.createDataFrame(
        [(pick.choice(["r1", "r2", "r3", None]), str(pick.randrange(80)) or None, pick.choice(markets), v) for _ in range(n)], SCHEMA)
    return [one(v) for v in range(3)]


@pytest.mark.parametrize("partition", ["run", None])
def test_same_as_plain_anti_join(spark, path, tmp_path, partition):
    plain = str(tmp_path / "plain")
    for batch in [*batches(spark), *batches(spark)]:
        key_filters.insert_new(batch, path, KEYS, partition)
        sinks.insert_missing(batch, plain, KEYS, partition)
        assert rows_of(spark, path) == rows_of(spark, plain)


def test_partition_outside_the_key(spark, path):
    first, second = (spark.createDataFrame([(r, "a", "AU", 1), (r, r, "AU", 1)], SCHEMA) for r in ("r1", "r2"))
    for batch in (first, second, second):
        key_filters.insert_new(batch, path, ["k"], "run")
    assert [r[:2] for r in rows_of(spark, path)] == [("r1", "a"), ("r1", "r1"), ("r2", "r2")]


def test_no_false_negatives_and_few_false_positives(spark):
    names = spark.range(60_000).select(F.lit("p").alias("_part"), F.xxhash64("id").alias("_name"))
    filters = key_filters.blocks_of(names).withColumn("append", F.lit(0))
    assert filters.count() == 30 and filters.agg(F.max(F.length("bits"))).first()[0] == 4096
    assert key_filters.possible(names, filters).count() == 60_000
    others = spark.range(60_000, 120_000).select(F.lit("p").alias("_part"), F.xxhash64("id").alias("_name"))
    assert key_filters.possible(others, filters).count() < 600
    assert key_filters.possible(others.withColumn("_part", F.lit("q")), filters).isEmpty()


def test_new_keys_read_no_history(spark, path, plan_of):
    old = spark.range(5000).select(F.lit("r1").alias("run"), F.col("id").cast("string").alias("k"), F.lit("AU").alias("market"), F.lit(0).alias("v"))
    key_filters.insert_new(old, path, KEYS, "run")
    fresh = old.withColumn("run", F.lit("r2"))
    plan = plan_of(key_filters.new_rows(fresh, path, KEYS, "run"))
    assert "FileScan" not in plan
    key_filters.insert_new(fresh, path, KEYS, "run")
    again = key_filters.new_rows(fresh.limit(1), path, KEYS, "run")
    # of the history only the partition and the key are read
    scans = [line for line in plan_of(again).splitlines() if "FileScan" in line and f"file:{path}]" in line]
    assert len(scans) == 1 and "(coalesce(run" in scans[0] and "= r2)" in scans[0], scans
    assert "ReadSchema: struct<k:string,market:string>" in scans[0]
    assert again.isEmpty()


def test_filter_without_rows_and_rows_without_filter(spark, path):
    batch = batches(spark)[0]
    # the run dies after the filter
    key_filters.new_rows(batch, path, KEYS, "run")
    for _ in range(2):
        key_filters.insert_new(batch, path, KEYS, "run")
        assert len(rows_of(spark, path)) == 300
    # a table from before the filters
    old = path + "_old"
    sinks.insert_missing(batch, old, KEYS, "run")
    key_filters.insert_new(batch, old, KEYS, "run")
    assert rows_of(spark, old) == rows_of(spark, path)


def test_empty_batch(spark, path):
    key_filters.insert_new(batches(spark)[0].limit(0), path, KEYS, "run")
    key_filters.insert_new(batches(spark)[0], path, KEYS, "run")
    key_filters.insert_new(batches(spark)[0].limit(0), path, KEYS, "run")
    assert len(rows_of(spark, path)) == 300
