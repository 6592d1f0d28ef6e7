"""Tables in generations: one commit for all tables, reruns, empty results, deaths between steps."""

import pytest
from pyspark.sql import functions as F

from recordlens.operators.generations import Generations
from recordlens.schemas import TABLES


@pytest.fixture
def kept(spark, tmp_path, monkeypatch):
    for name in ("one", "two"):
        monkeypatch.setitem(TABLES, name, "d date, v int")
    return Generations(spark, str(tmp_path), "d")


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "d string, v int").withColumn("d", F.col("d").cast("date"))


def seen(kept, name, **how):
    return sorted((str(r.d), r.v) for r in kept.read(name, **how).collect())


def put(kept, frame, keys):
    g = kept.next()
    for name in ("one", "two"):
        kept.write(name, frame, g)
    kept.commit(keys.select("d").distinct(), g)


def test_replace_clear_and_add(spark, kept):
    assert seen(kept, "one") == [] and kept.next() == 1
    first = rows(spark, ("2026-01-01", 1), ("2026-01-02", 2), (None, 0))
    put(kept, first, first)
    assert seen(kept, "one") == seen(kept, "two") == [("2026-01-01", 1), ("2026-01-02", 2), ("None", 0)]
    # the first date is replaced by nothing, the second by another row
    put(kept, rows(spark, ("2026-01-02", 20)), rows(spark, ("2026-01-01", 0), ("2026-01-02", 0)))
    assert seen(kept, "one") == [("2026-01-02", 20), ("None", 0)]
    assert len(seen(kept, "one", adding=True)) == 4


def test_death_before_the_commit(spark, kept):
    first = rows(spark, ("2026-01-01", 1))
    put(kept, first, first)
    before = seen(kept, "one"), seen(kept, "two")
    g = kept.next()
    kept.write("one", rows(spark, ("2026-01-01", 9), ("2026-01-05", 9)), g)  # and the run dies
    assert (seen(kept, "one"), seen(kept, "two")) == before
    assert kept.next() == g
    new = rows(spark, ("2026-01-01", 5))
    put(kept, new, new)
    assert seen(kept, "one") == seen(kept, "two") == [("2026-01-01", 5)]


def test_many_small_files_without_a_list(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(TABLES, "land", "source_file string, v long")
    kept = Generations(spark, str(tmp_path), "source_file")
    frame = spark.range(10_000).select(F.concat(F.lit("in/f "), F.col("id")).alias("source_file"), F.col("id").alias("v"))

    class Driver:
        collected = 0

    def counted(self, old=type(frame).collect):
        out = old(self)
        Driver.collected += len(out)
        return out

    for step in (0, 100_000):
        g = kept.next()
        written = kept.write("land", frame.withColumn("v", F.col("v") + step), g, by_key=False)
        with monkeypatch.context() as m:
            m.setattr(type(frame), "collect", counted)
            kept.commit(written.groupBy("source_file").count(), g)
    assert Driver.collected <= 1
    assert tuple(kept.read("land").agg(F.count("*"), F.min("v"), F.max("v")).first()) == (10_000, 100_000, 109_999)
