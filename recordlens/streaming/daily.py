"""Daily drop as a file stream: every new file once, safe to run again.

Each micro-batch is one generation (``operators.generations``): its new rows, and staging and
summaries of the dates it touches, become visible together by one ledger entry per file. A
batch that died is replayed by the stream and writes over what it had left; a batch that died
after its commit finds its rows stored and replaces the same dates by the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlens.operators.generations import Generations
from recordlens.operators.sinks import missing_rows
from recordlens.plans import customers
from recordlens.schemas import conform
from recordlens.sources.files import exports_of_batch

SUMMARIES = {"summary_by_status": customers.summary_by_status, "monitoring": customers.monitoring}


@dataclass(frozen=True)
class Tables:
    """Folders of the tables that a daily run keeps."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def generations(self, spark: SparkSession) -> Generations:
        return Generations(spark, self.root, "run_date")

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """What is committed of the table; row files are added to, other tables replaced by date."""
        return self.generations(spark).read(name, adding=name == "rows")


def load_batch(
    rows: DataFrame, tables: Tables, catalog: DataFrame, contacts: DataFrame, people: DataFrame, batch_id: int = -1
) -> None:
    """Add the new rows, rebuild the dates of the batch from all their rows, commit both.

    ``rows`` are ingested and may have ``source_file``. The ledger gets a row per date and file.
    """
    spark = rows.sparkSession
    kept = tables.generations(spark)
    generation = kept.next()
    if "source_file" not in rows.columns:
        rows = rows.withColumn("source_file", F.lit(None).cast("string"))
    notes = rows.groupBy("run_date", "source_file").agg(F.count("*").alias("rows_read"))
    notes = kept.write("_files", notes.withColumn("batch_id", F.lit(batch_id).cast("long")), generation, by_key=False)
    dates = notes.select("run_date").distinct()
    if dates.isEmpty():
        return
    known = tables.read(spark, "rows").join(dates, "run_date", "left_semi")
    new = missing_rows(conform(rows.drop("source_file"), "rows"), known.select("run_date", "record_id"), ["run_date", "record_id"])
    new = kept.write("rows", new, generation)
    refresh(known.unionByName(new.select(known.columns)), notes, tables, generation, catalog, contacts, people)


def refresh(
    rows: DataFrame, notes: DataFrame, tables: Tables, generation: int,
    catalog: DataFrame, contacts: DataFrame, people: DataFrame,
) -> None:
    """Staging, summary and monitoring of all given rows as one generation of the dates in ``notes``."""
    kept = tables.generations(rows.sparkSession)
    staged = kept.write("staging", conform(customers.staging(rows, catalog, contacts, people), "staging"), generation)
    for name, job in SUMMARIES.items():
        kept.write(name, conform(job(staged), name), generation)
    kept.commit(notes, generation)


def _drain(stream: DataFrame, tables: Tables, each: Callable[[DataFrame, int], None]) -> None:
    def once(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # one read of the batch for all that is made of it
        try:
            each(batch, batch_id)
        finally:
            batch.unpersist()

    query = (
        stream.writeStream.foreachBatch(once)
        .option("checkpointLocation", tables.path("_progress"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_daily(exports: DataFrame, tables: Tables, catalog: DataFrame, contacts: DataFrame, people: DataFrame) -> None:
    """Drain a stream of exports (text columns and run_date) and stop."""
    _drain(exports, tables, lambda batch, i: load_batch(customers.ingest(batch), tables, catalog, contacts, people, i))


def run_daily_files(
    lines: DataFrame, tables: Tables, catalog: DataFrame, contacts: DataFrame, people: DataFrame, year: int
) -> None:
    """Drain a stream of daily CSV files (``files.stream_exports``) and stop."""

    def each(batch: DataFrame, i: int) -> None:
        if not batch.isEmpty():
            rows = customers.ingest(exports_of_batch(batch, year), keep=("source_file",))
            load_batch(rows, tables, catalog, contacts, people, i)

    _drain(lines, tables, each)


def reprocess(spark: SparkSession, tables: Tables, catalog: DataFrame, contacts: DataFrame, people: DataFrame, dates: list | None = None) -> None:
    """Staging and summaries of stored rows anew, of the given dates or all, as one generation."""
    rows = tables.read(spark, "rows")
    if dates is not None:
        rows = rows.filter(F.col("run_date").cast("string").isin(*map(str, dates)))
    _redo(rows, tables, lambda notes, g: refresh(rows, notes, tables, g, catalog, contacts, people))


def monitoring_only(spark: SparkSession, tables: Tables, dates: list | None = None) -> None:
    """The summaries of stored staging anew; staging is carried on as it is."""
    staged = tables.read(spark, "staging")
    if dates is not None:
        staged = staged.filter(F.col("run_date").cast("string").isin(*map(str, dates)))
    kept = tables.generations(spark)

    def redo(notes: DataFrame, generation: int) -> None:
        same = kept.write("staging", conform(staged, "staging"), generation)
        for name, job in SUMMARIES.items():
            kept.write(name, conform(job(same), name), generation)
        kept.commit(notes, generation)

    _redo(staged, tables, redo)


def _redo(rows: DataFrame, tables: Tables, work: Callable[[DataFrame, int], None]) -> None:
    kept = tables.generations(rows.sparkSession)
    generation = kept.next()
    notes = rows.groupBy("run_date").agg(F.count("*").alias("rows_read")).select(
        "run_date", F.lit(None).cast("string").alias("source_file"), "rows_read", F.lit(-1).cast("long").alias("batch_id")
    )
    work(kept.write("_files", notes, generation, by_key=False), generation)
