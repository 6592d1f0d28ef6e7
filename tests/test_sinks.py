"""Writes: a rerun changes nothing, history stays, empty dates are cleared."""

import pytest
from pyspark.sql import functions as F

from recordlens.operators import sinks
from recordlens.plans import records
from recordlens.schemas import TABLES, conform


def rows_of(spark, path):
    return sorted(tuple(r.asDict()[c] for c in sorted(r.asDict())) for r in spark.read.parquet(path).collect())


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def test_insert_missing_is_idempotent_and_null_safe(spark, path):
    batch = spark.createDataFrame([("r1", "a", "AU"), ("r1", "b", None), ("r2", "a", "AU")], "run string, k string, market string")
    keys = ["run", "k", "market"]
    sinks.insert_missing(batch, path, keys, "run")
    first = rows_of(spark, path)
    sinks.insert_missing(batch, path, keys, "run")
    assert rows_of(spark, path) == first and len(first) == 3
    more = spark.createDataFrame([("r2", "a", "AU"), ("r2", "c", None)], batch.schema)
    sinks.insert_missing(more, path, keys, "run")
    assert len(rows_of(spark, path)) == 4


def test_batch_repeats_stay(spark, path):
    batch = spark.createDataFrame([("r1", "a"), ("r1", "a")], "run string, k string")
    sinks.insert_missing(batch, path, ["run", "k"], "run")
    assert len(rows_of(spark, path)) == 2


def test_unpartitioned_insert(spark, path):
    batch = spark.createDataFrame([("a", 1)], "k string, v int")
    for _ in range(2):
        sinks.insert_missing(batch, path, ["k"], None)
    assert rows_of(spark, path) == [("a", 1)]


def test_replace_partitions_clears_empty_dates(spark, path):
    old = spark.createDataFrame([("2026-01-01", 1), ("2026-01-02", 2), ("2026-01-03", 3)], "d string, v int").withColumn("d", F.col("d").cast("date"))
    days = [r.d for r in old.orderBy("d").collect()]
    sinks.replace_partitions(old, path, "d", days)
    new = old.filter("v = 2").withColumn("v", F.lit(20))
    for _ in range(2):
        # the first date has no rows any more, the third is not part of the run
        sinks.replace_partitions(new, path, "d", days[:2])
        assert [r.v for r in spark.read.parquet(path).orderBy("v").collect()] == [3, 20]


def test_replace_by_file_key(spark, path):
    rows = spark.createDataFrame([("in/a 1.csv", 1), ("in/b=2.csv", 2)], "source_file string, v int")
    for _ in range(2):
        sinks.replace_partitions(rows, path, "source_file", ["in/a 1.csv", "in/b=2.csv"])
    assert rows_of(spark, path) == [("in/a 1.csv", 1), ("in/b=2.csv", 2)]
    sinks.replace_partitions(rows.limit(0), path, "source_file", ["in/b=2.csv"])
    assert rows_of(spark, path) == [("in/a 1.csv", 1)]


def test_rebuild_and_stored(spark, path):
    for _ in range(2):
        sinks.rebuild(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3
    again = sinks.stored(spark.range(5), path)
    assert again.count() == 5 and again.columns == ["id"]


def enriched(spark):
    rows = [
        (1, "a", "200", '{"id":7,"post_count":3}', "link/a"), (2, "b", "404", None, "link/b"),
        (3, "a", "409", None, "link/a"), (4, "b", "404", None, "link/b"), (5, "", "404", None, "raw link"),
        (6, "c", "200", "{broken", "link/c"), (7, "", "404", None, None), (8, "", "404", None, None),
    ]
    return spark.createDataFrame(rows, "row_no bigint, slug string, status string, payload_raw string, profile_link string")


def test_upsert_returns_rows_written(spark, path):
    first = records.upsert_rows(enriched(spark), None, "PERSON")
    assert sinks.upsert_ignore(conform(first, "payloads"), path) == 5
    table = spark.read.parquet(path)
    assert {r.handle for r in table.collect()} == {"a", "b", "c", "raw link", None}
    a, c = (table.filter(F.col("handle") == h).first() for h in ("a", "c"))
    assert (a.profile_id, a.post_count, a.status_code) == ("7", 3.0, 200)
    assert (c.profile_id, c.post_count) == (None, None)
    again = records.upsert_rows(enriched(spark), spark.read.parquet(path), "PERSON")
    assert sinks.upsert_ignore(conform(again, "payloads"), path) == 0
    other = records.upsert_rows(enriched(spark), spark.read.parquet(path), "COMPANY")
    assert other.count() == 5  # the profile type is part of the key


def test_split_by_day(spark, tmp_path):
    from recordlens.sources.files import read_split_exports

    rows = [("2026-06-01 10:00:00", 'a "q"'), ("2026-06-01 11:00:00", "b"), ("2026-07-02", "c\nd"), ("2025-06-01", "old"), ("", "none")]
    master = spark.createDataFrame(rows, "SUB_CREATED string, STRIPE_NAME string")
    loaded = spark.createDataFrame([("2026-07-02",)], "run_date string")
    root = str(tmp_path / "split")
    for _ in range(2):
        sinks.split_by_day(master, root, 2026)
    got = read_split_exports(spark, root, 2026)
    assert sorted((str(r.run_date), r.STRIPE_NAME) for r in got.collect()) == [
        ("2026-06-01", 'a "q"'), ("2026-06-01", "b"), ("2026-07-02", "c\nd")]
    root = str(tmp_path / "split2")
    sinks.split_by_day(master, root, 2026, loaded)
    assert {str(r.run_date) for r in read_split_exports(spark, root, 2026).collect()} == {"2026-06-01"}


def test_conform(spark):
    with pytest.raises(ValueError, match="columns differ"):
        conform(spark.range(1), "payloads")
    assert all(len(c.split()) == 2 for ddl in TABLES.values() for c in ddl.split(","))


def test_missing_table_and_other_errors(spark, path):
    assert sinks.read_or_none(spark, path) is None
    with pytest.raises(Exception):
        sinks.read_or_none(spark, "nosuchscheme://x/y")
