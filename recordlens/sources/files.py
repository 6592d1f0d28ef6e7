"""Daily exports, input files, payload caches and stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlens import constants as K
from recordlens.plans.records import rename_inputs
from recordlens.sources.csv_records import as_lines, read_lines, read_records

_ISO_DATE = r"(\d{4})-(\d{2})-(\d{2})"
_SHORT_DATE = r"_(\d{2})_(\d{2})_(\d{2})"


def file_name(path: Column) -> Column:
    return F.url_decode(F.regexp_extract(path, r"([^/]+)$", 1))


def daily_file_date(name: Column, year: int) -> Column:
    """Date of ``MM_DD_CTA.csv``; NULL for another name or no real date."""
    pattern = f"(?i){K.DAILY_FILE_PATTERN}"
    month, day = (F.regexp_extract(name, pattern, i) for i in (1, 2))
    return F.concat_ws("-", F.lit(str(year)), month, day).try_cast("date")


def input_file_date(name: Column) -> Column:
    """Date in a name: ``YYYY-MM-DD``, else ``_MM_DD_YY``; NULL without one."""
    iso = F.regexp_extract(name, _ISO_DATE, 0).try_cast("date")
    month, day, year = (F.regexp_extract(name, _SHORT_DATE, i) for i in (1, 2, 3))
    return F.coalesce(iso, F.concat(F.lit("20"), year, F.lit("-"), month, F.lit("-"), day).try_cast("date"))


def read_csv_files(
    spark: SparkSession, paths: list[str], glob: str | None = None, columns: list[str] | None = None
) -> DataFrame:
    """All rows of the files as trimmed text, with ``source_path`` and ``row_no``.

    Quoted fields may hold line breaks, files may differ in charset and header, and a
    large file is read by many tasks; see ``csv_records.read_records``.
    """
    return read_records(read_lines(spark, paths, glob), columns)


def file_key(path: Column) -> Column:
    """Name of the daily file in a path: the file itself, or the folder that a writer made of it."""
    return F.url_decode(F.regexp_extract(path, rf"(?i)/([^/]+_CTA\.csv)(/[^/]+)?$", 1))


def dated_exports(rows: DataFrame, year: int) -> DataFrame:
    """Rows or names of daily files with ``source_file`` and the ``run_date`` of its name; those without a date are left out."""
    named = rows.withColumn("source_file", file_key(F.col("source_path")))
    named = named.withColumn("run_date", daily_file_date(F.col("source_file"), year))
    return named.filter(F.col("run_date").isNotNull())


def _filled(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in EXPORT_HEADS})


EXPORT_HEADS = [head for head, *_ in K.EXPORT_COLUMNS]


def read_exports(
    spark: SparkSession, root: str, year: int, month: str | None = None, day: str | None = None
) -> DataFrame:
    """Daily exports under ``root``, all or those of a month ('06') or date ('2026-06-01').

    The run date comes from the file name; files without one are left out. Columns that a
    file lacks are empty, other columns are not read.
    """
    path, name = root, ""
    if day:
        _, mm, dd = day.split("-")
        path, name = f"{root}/{mm}", f"{mm}_{dd}"
    elif month:
        path = f"{root}/{month}"
    daily = lambda p: file_key(p).endswith(name + K.DAILY_FILE_SUFFIX)
    return _filled(read_records(read_lines(spark, [path], only=daily), EXPORT_HEADS, of_file=lambda f: dated_exports(f, year)))


def read_split_exports(spark: SparkSession, root: str, year: int) -> DataFrame:
    """Exports written by ``sinks.split_by_day``, with all their columns."""
    return read_records(read_lines(spark, [root]), of_file=lambda f: dated_exports(f, year))


def stream_exports(spark: SparkSession, root: str) -> DataFrame:
    """Lines of the daily files dropped under ``root``, as a stream; ``exports_of_batch`` makes rows of them."""
    text = spark.readStream.option("recursiveFileLookup", "true").text(root)
    return text.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value"
    )


def exports_of_batch(batch: DataFrame, year: int) -> DataFrame:
    """Rows of a micro-batch of ``stream_exports``. A micro-batch has whole files."""
    named = as_lines(batch).filter(file_key(F.col("path")).endswith(K.DAILY_FILE_SUFFIX))
    return _filled(read_records(named, EXPORT_HEADS, required=False, of_file=lambda f: dated_exports(f, year)))


def read_inputs(spark: SparkSession, paths: list[str], glob: str | None = None) -> DataFrame:
    """People or company input files under the names used here, with file date.

    ``row_no`` numbers the rows 1, 2, ... over all files, by path and line, whatever their
    charsets and headers.
    """
    rows = rename_inputs(read_csv_files(spark, paths, glob))
    name = file_name(F.col("source_path"))
    return rows.withColumns({"source_file": name, "file_date": input_file_date(name)})


def read_payload_cache(spark: SparkSession, root: str) -> DataFrame:
    """One JSON file per slug, as (slug, status, raw); a stored answer is a 200."""
    files = spark.read.text(root, wholetext=True, pathGlobFilter="*.json", recursiveFileLookup=True)
    slug = F.regexp_replace(file_name(F.col("_metadata.file_path")), r"\.json$", "")
    return files.select(slug.alias("slug"), F.lit("200").alias("status"), F.col("value").alias("raw"))


def read_table(
    spark: SparkSession, path: str, columns: list[str], renamed: dict[str, str] | None = None
) -> DataFrame:
    """The named columns of a parquet table (catalog, contacts, people, regions).

    ``renamed`` maps a column name used here to the one the table has.
    """
    names = renamed or {}
    return spark.read.parquet(path).select(*[F.col(names.get(c, c)).alias(c) for c in columns])


def stored_dates(table: DataFrame) -> DataFrame:
    """Run dates that a table holds, in order."""
    return table.select("run_date").distinct().orderBy("run_date")
