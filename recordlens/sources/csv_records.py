"""Records of quoted CSV files, read by many tasks per file.

A quoted field may hold line breaks, so whether a line begins a record depends on all lines
before it. Each line is a map from the state it is entered with (0: between records, 1:
inside quotes) to the state it is left with, and maps compose: over the lines of a block
(what one task reads of a file), then over the blocks of a file. With the state at the start
of its block, every line knows its record, and records are counted over blocks and files, so
they are numbered without a sort of the rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordlens.functions.text import strip
from recordlens.operators.rows import running_total
from recordlens.session import work_dir

# a whole quoted field at its place; the rest of a field that a line is inside of
_WHOLE = r'(^|,)"[^"]*+(?:""[^"]*+)*+"'
_REST = r'^[^"]*+(?:""[^"]*+)*+"'
_OPEN = r'(^|,)"'


def read_lines(
    spark: SparkSession, paths: list[str], glob: str | None = None, only: Callable[[Column], Column] | None = None
) -> DataFrame:
    """``path, start, n, line``: lines of the files with the block they are read in and their order in it.

    ``only`` is a condition on the path; files that fail it are not read.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    text = reader.text(paths)
    return as_lines(text.filter(only(F.col("_metadata.file_path"))) if only else text)


def as_lines(text: DataFrame) -> DataFrame:
    """The same columns from a frame of the text source, or from a micro-batch of one."""
    if "path" in text.columns:
        return text.select("path", "start", F.monotonically_increasing_id().alias("n"), F.col("value").alias("line"))
    return text.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("n"), F.col("value").alias("line"),
    )


def _composed(lines: DataFrame) -> DataFrame:
    """Lines with the map from the start of their block to before and after them.

    A map is (``fixed``, ``state``): the state whatever the entry, or the entry changed by ``state``.
    """
    line = F.regexp_replace("line", "^﻿", "")
    quoted = F.contains(line, F.lit('"'))
    opened = lambda part: F.regexp_like(F.regexp_replace(part, _WHOLE, "$1"), F.lit(_OPEN)).cast("int")
    rest = F.regexp_replace(line, _REST, "x")  # what follows a closed field begins no field
    closes = F.regexp_like(line, F.lit(_REST))
    mapped = lines.withColumns({
        "from0": F.when(quoted, opened(line)).otherwise(0),
        "from1": F.when(quoted & closes, opened(rest)).otherwise(1),
    })
    block = Window.partitionBy("path", "start").orderBy("n")
    mapped = mapped.withColumns({
        "fixes": F.col("from0") == F.col("from1"),
        "swaps": F.sum(F.when((F.col("from0") == 1) & (F.col("from1") == 0), 1).otherwise(0)).over(block),
    })
    last_fix = F.last(
        F.when(F.col("fixes"), F.struct(F.col("from0").alias("v"), F.col("swaps").alias("s"))), ignorenulls=True
    )
    mapped = mapped.withColumn("fix", last_fix.over(block))
    mapped = mapped.withColumns({
        "fixed": F.col("fix").isNotNull(),
        "state": F.coalesce(F.col("fix.v") + F.col("swaps") - F.col("fix.s"), F.col("swaps")) % 2,
    })
    return mapped.withColumns({
        "fixed_before": F.coalesce(F.lag("fixed").over(block), F.lit(False)),
        "state_before": F.coalesce(F.lag("state").over(block), F.lit(0)),
        "blank": F.trim("line") == "",
    }).drop("from0", "from1", "fixes", "swaps", "fix")


def _entered(fixed: str, state: str, entry: Column | int) -> Column:
    return F.when(F.col(fixed), F.col(state)).otherwise((F.col(state) + entry) % 2)


def _ends(entry: Column | int) -> Column:
    """Whether a record ends with the line, where its block is entered with ``entry``."""
    after, before = _entered("fixed", "state", entry), _entered("fixed_before", "state_before", entry)
    return (after == 0) & ~((before == 0) & F.col("blank"))


def _blocks(mapped: DataFrame) -> DataFrame:
    """One row per block: its entry state, records before it, and the charset and header of its file."""
    blocks = mapped.groupBy("path", "start").agg(
        F.max_by(F.struct("fixed", "state"), "n").alias("last"),
        F.count_if(_ends(0)).alias("ends0"), F.count_if(_ends(1)).alias("ends1"),
        F.bool_and(F.is_valid_utf8("line")).alias("utf8"),
        F.min_by("line", F.when(~F.col("blank"), F.col("n"))).alias("head"),
    )
    file = Window.partitionBy("path").orderBy("start")
    blocks = blocks.withColumn(
        "swaps", F.sum(F.when(~F.col("last.fixed"), F.col("last.state")).otherwise(0)).over(file)
    ).withColumn("fix", F.last(
        F.when(F.col("last.fixed"), F.struct(F.col("last.state").alias("v"), F.col("swaps").alias("s"))), ignorenulls=True
    ).over(file))
    after = F.coalesce(F.col("fix.v") + F.col("swaps") - F.col("fix.s"), F.col("swaps")) % 2
    blocks = blocks.withColumn("entry", F.coalesce(F.lag(after).over(file), F.lit(0)))
    blocks = blocks.withColumn("ends", F.when(F.col("entry") == 0, F.col("ends0")).otherwise(F.col("ends1")))
    whole = Window.partitionBy("path")
    return blocks.select(
        "path", "start", "entry", "ends",
        (F.sum("ends").over(file) - F.col("ends")).alias("before"),
        F.min("utf8").over(whole).alias("utf8"),
        F.first("head", ignorenulls=True).over(file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("head"),
    )


def _decoded(text: Column) -> Column:
    """UTF-8 when all lines of the file are, else Latin-1."""
    return F.when(F.col("utf8"), text).otherwise(F.decode(text.cast("binary"), "ISO-8859-1"))


def read_records(
    lines: DataFrame, columns: list[str] | None = None, required: bool = True,
    of_file: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``source_path, row_no`` and the columns of all records of files with a header line, as trimmed text.

    ``row_no`` numbers the records 1, 2, ... over all files, by path and place. Columns are
    those named, or all that any file has; they meet by name, a file that lacks one gives
    NULL, absent values are empty. Files may differ in charset and header. The header is the
    first line that is not blank. ``of_file`` adds columns to the files (``source_path``), found
    once per file; files that it leaves out give no records, but count in ``row_no``. No line at all is an error if rows are ``required``. Lines are shuffled once, by block; records of several lines
    once more.
    """
    spark = lines.sparkSession
    mapped = _composed(lines)
    path = work_dir(spark, "blocks")
    _blocks(mapped).write.parquet(path)  # one row per block of the input
    blocks = spark.read.parquet(path)
    files = blocks.groupBy("path").agg(F.greatest(F.sum("ends") - 1, F.lit(0)).alias("rows"), F.first("head").alias("head"), F.first("utf8").alias("utf8"))
    bases = running_total(files.select("path", "rows"), "path", "rows", "base")
    heads = files.filter("head is not null").select(F.regexp_replace(_decoded(F.col("head")), "^﻿", "").alias("head"))
    wide = heads.agg(F.max(F.size(F.split("head", ",")))).first()[0]
    if wide is None:
        if required or columns is None:
            raise FileNotFoundError("no lines in the files")
        wide = 1
    schema = ", ".join(f"c{i} string" for i in range(wide))
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"}
    cells = lambda text: F.from_csv(text, F.lit(schema), options)
    as_list = lambda row: F.array(*(F.coalesce(F.col(f"{row}.c{i}"), F.lit("")) for i in range(wide)))
    if columns is None:
        names = heads.distinct().withColumn("row", cells(F.col("head"))).select(F.explode(as_list("row")).alias("name"))
        columns = sorted(r[0] for r in names.select(strip(F.col("name")).alias("name")).filter("name <> ''").distinct().collect())

    # where the columns stand is found once per file, not per record
    named = F.transform(as_list("row"), strip)
    placed_heads = files.withColumn("row", cells(F.regexp_replace(_decoded(F.col("head")), "^﻿", ""))).withColumn("names", named)
    places = F.array(*(F.array_position("names", F.lit(c)).cast("int") for c in columns)).alias("places")
    facts = placed_heads.select(F.col("path").alias("source_path"), places)
    facts = of_file(facts) if of_file else facts
    more = [c for c in facts.columns if c not in ("source_path", "places")]
    where = blocks.join(bases, "path").join(facts.withColumnRenamed("source_path", "path"), "path").select(
        F.col("path").alias("at_path"), F.col("start").alias("at_start"), "entry", "before", "base", "utf8", "places", *more
    )
    placed = mapped.join(where, (F.col("path") == F.col("at_path")) & (F.col("start") == F.col("at_start")))
    block = Window.partitionBy("path", "start").orderBy("n")
    ends = _ends(F.col("entry")).cast("long")
    placed = placed.withColumns({
        "inside": _entered("fixed_before", "state_before", F.col("entry")) == 1,
        "open": _entered("fixed", "state", F.col("entry")) == 1,
        # records that end before the line; the header is record 0
        "record": F.col("before") + F.sum(ends).over(block) - ends,
    })
    text = _decoded(F.col("line"))
    keep = ["path", "record", "base", "utf8", "places", *more]
    single = placed.filter("not inside and not open and not blank").select(*keep, text.alias("text"))
    pieces = placed.filter("inside or open").groupBy(*keep).agg(
        F.array_sort(F.collect_list(F.struct("start", "n", text.alias("line")))).alias("lines")
    )
    several = pieces.select(*keep, F.array_join("lines.line", "\n").alias("text"))
    records = single.unionAll(several).filter("record > 0")
    # a record without a quote is what stands between its commas; the CSV parser takes the others
    hard = F.contains(F.col("text"), F.lit('"')) | F.startswith(F.col("text"), F.lit("\0"))
    parsed = records.select(
        "path", (F.col("base") + F.col("record")).alias("row_no"), "text", "places", hard.alias("hard"),
        cells(F.when(hard, F.col("text"))).alias("row"), *more,
    ).select("path", "row_no", "places", *more, F.when(F.col("hard"), as_list("row")).otherwise(F.split("text", ",")).alias("cells"))
    at = lambda i: F.get("places", F.lit(i))
    return parsed.select(
        F.col("path").alias("source_path"), "row_no",
        *(F.when(at(i) > 0, strip(F.coalesce(F.get("cells", at(i) - 1), F.lit("")))).alias(c) for i, c in enumerate(columns)),
        *more,
    )
