"""The file stream equals the batch run, file by file and when run again."""

from pyspark.sql import functions as F

from recordlens.plans import customers
from recordlens.schemas import conform
from recordlens.sources import fixtures as fx
from recordlens.streaming.daily import Tables, load_batch, monitoring_only, reprocess, run_daily, run_daily_files


def snapshot(spark, tables):
    out = {}
    for name in ("rows", "staging", "summary_by_status", "monitoring"):
        rows = tables.read(spark, name)
        out[name] = sorted(map(str, rows.select(*sorted(rows.columns)).collect()))
    return out


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    side = [fx.view(spark, sf_dir, f"f_{n}") for n in ("catalog", "contact", "people")]
    table, exprs = fx.VIEWS["f_subscription"]
    events = spark.read.parquet(f"{sf_dir}/{table}.parquet").filter("ts < TIMESTAMP_NTZ '2024-01-05'")
    drop, tables = str(tmp_path / "drop"), Tables(str(tmp_path / "tables"))

    def put(day):
        events.filter(F.to_date("ts") == F.lit(day).cast("date")).coalesce(1).write.mode("append").parquet(drop)

    def drain():
        stream = spark.readStream.schema(events.schema).parquet(drop).selectExpr(*exprs)
        run_daily(stream, tables, *side)

    put("2024-01-01")
    drain()
    put("2024-01-02")
    put("2024-01-03")
    drain()
    put("2024-01-04")
    drain()
    streamed = snapshot(spark, tables)

    batch = customers.ingest(events.selectExpr(*exprs))
    staged = customers.staging(batch, *side)
    expected = {
        "rows": conform(batch, "rows"),
        "staging": conform(staged, "staging"),
        "summary_by_status": customers.summary_by_status(staged),
        "monitoring": customers.monitoring(staged),
    }
    for name, frame in expected.items():
        frame = frame.select(*sorted(tables.read(spark, name).columns))
        assert streamed[name] == sorted(map(str, frame.collect())), name

    # nothing new: nothing changes; a replayed batch neither
    drain()
    assert snapshot(spark, tables) == streamed
    again = customers.ingest(events.filter("ts < TIMESTAMP_NTZ '2024-01-02'").selectExpr(*exprs))
    load_batch(again, tables, *side)
    assert snapshot(spark, tables) == streamed


def test_dropped_files(spark, sf_dir, tmp_path, monkeypatch):
    """Files in two rounds, one of them twice, and a run that dies before its commit."""
    from recordlens.operators import sinks
    from recordlens.operators.generations import Generations
    from recordlens.sources import files

    side = [fx.view(spark, sf_dir, f"f_{n}") for n in ("catalog", "contact", "people")]
    rows = fx.view(spark, sf_dir, "f_subscription_file").filter("run_date < DATE '2024-01-05'")
    drop, tables = str(tmp_path / "drop"), Tables(str(tmp_path / "tables"))

    def put(folder, days):
        sinks.split_by_day(rows.filter(days).select(*files.EXPORT_HEADS), f"{drop}/{folder}", 2024, rows_per_file=20)
        (tmp_path / "drop" / folder / "notes.csv").write_text("no,daily,file\n1,2,3\n")

    def drain():
        run_daily_files(files.stream_exports(spark, drop), tables, *side, 2024)

    put("one", "day(run_date) <= 2")
    drain()
    first = snapshot(spark, tables)
    put("two", "day(run_date) > 2 or day(run_date) = 1")

    def dies(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(Generations, "commit", dies)
        try:
            drain()
            raise AssertionError("the run should have died")
        except Exception as error:
            assert "killed" in str(error)
    assert snapshot(spark, tables) == first  # the old dates are whole, the new ones not there
    drain()
    streamed = snapshot(spark, tables)
    batch = customers.ingest(rows)
    staged = customers.staging(batch, *side)
    expected = {
        "rows": conform(batch, "rows"), "staging": conform(staged, "staging"),
        "summary_by_status": customers.summary_by_status(staged), "monitoring": customers.monitoring(staged),
    }
    for name, frame in expected.items():
        assert streamed[name] == sorted(map(str, frame.select(*sorted(frame.columns)).collect())), name
    ledger = tables.generations(spark).ledger()
    assert ledger.filter("source_file is not null").select("source_file").distinct().count() == 4
    drain()
    reprocess(spark, tables, *side)
    monitoring_only(spark, tables, ["2024-01-02"])
    assert snapshot(spark, tables) == streamed
