"""Records of quoted files: as Spark's own multi-line reader gives them, but by many tasks and numbered."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from recordlens.operators.rows import running_total
from recordlens.sources import files
from recordlens.sources.csv_records import read_lines, read_records


@pytest.fixture
def small_blocks(spark):
    """Blocks of some hundred bytes, so that records lie across them."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def rows_of(frame, names):
    return [tuple(r[n] for n in names) for r in frame.orderBy("row_no").collect()]


def odd_value(rnd):
    parts = ["plain", "", "a,b", 'say "x"', "two\nlines", '"\n"', "\n\n", 'q"', ",", '""', "é", "x" * rnd.randint(0, 60)]
    return "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 3))).strip()


def test_equal_to_the_whole_file_reader(spark, tmp_path, small_blocks):
    rnd, names = random.Random(4), ["a", "b", "c"]
    with open(tmp_path / "big.csv", "w", newline="") as file:
        out = csv.writer(file, lineterminator="\n")
        out.writerow(names)
        rows = [tuple(odd_value(rnd) for _ in names) for _ in range(400)]
        out.writerows(rows)
    read = read_records(read_lines(spark, [str(tmp_path)]))
    got = rows_of(read, names)
    assert got == [r for r in rows if any(r)] or got == rows
    whole = spark.read.csv(str(tmp_path), header=True, multiLine=True, escape='"')
    theirs = [tuple((r[n] or "").strip() for n in names) for r in whole.collect()]
    assert [r for r in got if any(r)] == [r for r in theirs if any(r)]
    assert [r.row_no for r in read.select("row_no").orderBy("row_no").collect()] == list(range(1, len(got) + 1))
    tasks = read_lines(spark, [str(tmp_path)]).select(F.spark_partition_id()).distinct().count()
    assert tasks > 3


def test_quotes_that_open_nothing(spark, tmp_path, small_blocks):
    text = 'a,b\n5" pipe,x\n' + 'y,"open\n5"" pipe"\n' + "7,8\n" * 200 + '"",""\n9" z,"a\n\nb"\n\nlast,"end"'
    (tmp_path / "f.csv").write_text(text)
    got = rows_of(read_records(read_lines(spark, [str(tmp_path)])), ["a", "b"])
    want = [('5" pipe', "x"), ("y", 'open\n5" pipe')] + [("7", "8")] * 200 + [("", ""), ('9" z', "a\n\nb"), ("last", "end")]
    assert got == want


def test_numbers_over_charsets_headers_and_blocks(spark, tmp_path, small_blocks):
    (tmp_path / "a.csv").write_text("x,y\n" + "".join(f"{i},a\n" for i in range(150)))
    (tmp_path / "b.csv").write_bytes("y, x \r\né,150\r\n\r\nb,151\r\n".encode("latin-1"))
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_bytes("﻿z,x\n".encode() + b"".join(f"ü,{i}\n".encode() for i in range(152, 300)))
    (tmp_path / "e.csv").write_text("x\n")
    read = read_records(read_lines(spark, [str(tmp_path)]), ["x", "y", "none"])
    rows = read.orderBy("row_no").collect()
    assert [(r.row_no, r.x) for r in rows] == [(i + 1, str(i)) for i in range(300)]
    assert rows[150].y == "é" and rows[0].none is None and rows[200].y is None
    plan = read._jdf.queryExecution().executedPlan().toString()
    # one task adds up the ranges of files (a row per task), once for records of one line and
    # once for those of several; none sees all rows or files
    assert plan.count("Exchange SinglePartition") <= 2 and "range" in plan


def test_running_total_over_ranges(spark):
    rows = [(f"k{i:03d}", i % 7) for i in range(200)]
    frame = spark.createDataFrame(rows, "k string, v int").repartition(5)
    got = {r.k: r.before for r in running_total(frame, "k", "v", "before").collect()}
    assert got == {k: sum(v for _, v in rows[:i]) for i, (k, _) in enumerate(rows)}


def test_no_rows_is_an_error_or_empty(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    with pytest.raises(FileNotFoundError):
        files.read_csv_files(spark, [str(tmp_path)])
    assert read_records(read_lines(spark, [str(tmp_path)]), ["x"], required=False).count() == 0


def test_columns_of_a_file_are_found_once_per_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1\n2,3,4\n")
    (tmp_path / "b.csv").write_text('y,x\n\t5 ,"6,""7"""\n,8\n')
    named = lambda files: files.withColumn("file", F.substring_index("source_path", "/", -1))
    lines = read_lines(spark, [str(tmp_path)])
    rows = read_records(lines, ["x", "y", "z"], of_file=named).orderBy("row_no")
    assert [(r.row_no, r.file, r.x, r.y, r.z) for r in rows.collect()] == [
        (1, "a.csv", "1", "", None), (2, "a.csv", "2", "3", None),
        (3, "b.csv", '6,"7"', "5", None), (4, "b.csv", "8", "", None),
    ]
    only = read_records(lines, ["x"], of_file=lambda f: named(f).filter("file = 'b.csv'"))
    assert sorted(r.row_no for r in only.collect()) == [3, 4]
