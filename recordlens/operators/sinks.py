"""Writes that may be run again without changing the result.

Tables are partitioned parquet folders. A task that is lost is run again by
Spark; its output appears only when the whole write is committed.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from recordlens.constants import DAILY_FILE_SUFFIX
from recordlens.schemas import TABLES
from recordlens.session import work_dir


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A stored table with its declared columns; one that never got a row is empty."""
    return spark.read.schema(TABLES[name]).parquet(f"{root}/{name}")


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table, or None when nothing was written yet; other errors rise."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new folder that all executors reach, and read from there.

    A frame that is used several times is planned and computed for every use, as each
    use prunes other columns and shares no exchange with the others.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def missing_rows(batch: DataFrame, stored: DataFrame | None, keys: list[str]) -> DataFrame:
    """Rows of the batch whose key is not stored; NULL key parts are equal."""
    if stored is None:
        return batch
    # equality on (text or '', is NULL) is null-safe, and the distinct below leaves the
    # stored keys where the join wants them
    parts = {}
    for k in keys:
        parts[f"_{k}"] = F.coalesce(F.col(k).cast("string"), F.lit(""))
        parts[f"_{k}_null"] = F.col(k).isNull()
    known = stored.select(*[c.alias(n) for n, c in parts.items()]).distinct()
    return batch.withColumns(parts).join(known, list(parts), "left_anti").drop(*parts)


def by_partition(df: DataFrame, column: str) -> DataFrame:
    """Rows of a partition together, so that a write of many dates makes few files.

    AQE sizes the writers by the measured data: it joins small dates and splits
    a date that holds most rows.
    """
    return df.hint("rebalance", F.col(column))


def insert_missing(
    batch: DataFrame, path: str, keys: list[str], partition: str | None = "run_date",
    partitions: DataFrame | None = None,
) -> None:
    """Append the rows whose key is not stored.

    The stored side is cut to the partitions of the batch, so old history is not read
    when the partition column is part of the key. ``partitions`` has them as rows; without
    it they are taken from the batch, which is then computed twice.
    """
    stored = read_or_none(batch.sparkSession, path)
    if stored is not None and partition in keys:
        known = (batch if partitions is None else partitions).select(F.col(partition).alias("_in")).distinct()
        stored = stored.join(known, F.col(partition).eqNullSafe(F.col("_in")), "left_semi")
    new = missing_rows(batch, stored, keys)
    if partition:
        by_partition(new, partition).write.mode("append").partitionBy(partition).parquet(path)
    else:
        new.write.mode("append").parquet(path)


def replace_partitions(df: DataFrame, path: str, column: str, values: list) -> None:
    """Replace the partitions ``values`` by the rows of ``df``.

    A dynamic overwrite leaves a partition alone that gets no rows. The write
    itself reports the values it met, and stored ones of ``values`` that are not
    among them are overwritten with nothing.
    """
    name = F.col(column).cast("string")
    seen = Observation()
    (
        by_partition(df.filter(F.col(column).isin(*values)), column)
        .observe(seen, F.collect_set(name).alias("values"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )
    stored = read_or_none(df.sparkSession, path)
    if stored is None:
        return
    stale = stored.filter(F.col(column).isin(*values) & ~name.isin(*seen.get["values"]))
    for row in stale.select(name).distinct().collect():
        nothing = df.limit(0).drop(column)
        nothing.write.mode("overwrite").parquet(f"{path}/{column}={_escape(row[0])}")


def _escape(value: str) -> str:
    """Folder name of a partition value, as Spark writes it."""
    special = "\"#%'*/:=?\\{[]^"
    return "".join(f"%{ord(c):02X}" if c in special or ord(c) < 32 else c for c in value)


def rebuild(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a step's result once and go on from the written table.

    Later steps read it instead of computing it again, and losing an executor
    costs them a read, not the whole chain.
    """
    rebuild(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def upsert_ignore(rows: DataFrame, path: str) -> int:
    """Append payload records that are new; the number of rows really written."""
    written = Observation()
    counted = rows.observe(written, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("append").parquet(path)
    return written.get["rows"]


def split_by_day(
    master: DataFrame, path: str, year: int, loaded: DataFrame | None = None,
    rows_per_file: int = 1_000_000,
) -> None:
    """Write a master export of one year as ``MM/MM_DD_CTA.csv`` by the day of SUB_CREATED.

    Dates in ``loaded`` (a ``run_date`` column) are left out. Each daily file is a folder of
    part files of up to ``rows_per_file`` rows: days are dealt out by their counts, so a day
    that holds most rows has many writers. Days take their names (at most 366) once all are
    written.
    """
    spark = master.sparkSession
    day = F.substring("SUB_CREATED", 1, 10)
    rows = master.withColumn("_date", day).filter(F.col("_date").rlike(rf"^{year}-\d\d-\d\d$"))
    if loaded is not None:
        old = loaded.select(F.col("run_date").cast("string").alias("_date")).distinct()
        rows = rows.join(old, "_date", "left_anti")
    parts = rows.groupBy("_date").agg(F.ceil(F.count("*") / rows_per_file).cast("int").alias("_parts"))
    dealt = rows.join(F.broadcast(parts), "_date").withColumn(
        "_salt", F.pmod(F.xxhash64(*master.columns), F.col("_parts"))
    )
    fresh = f"{path}/_writing"
    (
        dealt.repartition("_date", "_salt").drop("_salt", "_parts")
        .write.mode("overwrite")
        .option("header", "true")
        .option("escape", '"')
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("_date")
        .csv(fresh)
    )
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = hadoop(fresh).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for status in files.listStatus(hadoop(fresh)):
        name = status.getPath().getName()
        if name.startswith("_date="):
            _, mm, dd = name.removeprefix("_date=").split("-")
            target = hadoop(f"{path}/{mm}/{mm}_{dd}{DAILY_FILE_SUFFIX}")
            files.delete(target, True)
            files.mkdirs(target.getParent())
            files.rename(status.getPath(), target)
    files.delete(hadoop(fresh), True)
