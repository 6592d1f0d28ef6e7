"""Keep-one, top-n, repeat marks and joins that stay even when one key is hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlens.session import work_dir


def keep_top(df: DataFrame, keys: list, order: list[Column], n: int = 1) -> DataFrame:
    """At most n rows per key, the first in the given order.

    Spark cuts every group to n rows on the map side before the shuffle (window
    group limit), so a hot key sends n rows per task and no more.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def mark_repeats(df: DataFrame, keys: list[str], order: str, name: str, value: str) -> DataFrame:
    """Put ``value`` in column ``name`` on all but the first row of each key.

    Rows with a NULL or blank key part are left alone. The first rows come from
    a partial aggregate; they meet the table on the unique ``order`` column, so
    a key that holds a third of the table is not gathered anywhere.
    """
    keyed = df
    for k in keys:
        keyed = keyed.filter(F.col(k).isNotNull() & (F.col(k) != ""))
    first = (
        keyed.groupBy(*keys)
        .agg(F.min(order).alias(order))
        .select(order, F.lit(True).alias("_first"))
    )
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull() & (F.col(k) != "")
    repeated = has_key & F.col("_first").isNull()
    return (
        df.join(first, order, "left")
        .withColumn(name, F.when(repeated, F.lit(value)))
        .drop("_first")
    )


def left_join_sparse(left: DataFrame, right: DataFrame, key: str, spread: str) -> DataFrame:
    """Left join on a key that is NULL in many left rows.

    A shuffle would send all NULL keys to one task. They get a stand-in made
    from the ``spread`` column, which spreads them and meets nothing: it starts
    with a NUL, which no key does.
    """
    stand_in = F.concat(F.lit("\x00"), F.col(spread).cast("string"))
    left = left.withColumn("_key", F.coalesce(F.col(key), stand_in))
    right = right.withColumnRenamed(key, "_key")
    return left.join(right, "_key", "left").drop("_key")


def salted(df: DataFrame, by: list[str], salts: int) -> DataFrame:
    """Add a salt made from other columns, the same on a recomputed task."""
    return df.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int"))


def replicated(df: DataFrame, salts: int) -> DataFrame:
    """Every row once per salt, for the small side of a salted join."""
    return df.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def stack(keys: list[str], *frames: DataFrame) -> DataFrame:
    """Put metric sets with the same keys side by side.

    One union and one aggregate instead of a chain of joins. Each set has one
    row per key and its own column names; a key missing in a set gives NULL.
    """
    frame = frames[0]
    for other in frames[1:]:
        frame = frame.unionByName(other, allowMissingColumns=True)
    values = [c for c in frame.columns if c not in keys]
    return frame.groupBy(*keys).agg(*[F.max(c).alias(c) for c in values])


def running_total(df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """``order`` and, as ``name``, the sum of ``value`` over all rows before it; ``order`` is unique.

    Rows are dealt out by ranges of ``order`` and written once, so that both passes see the
    same ranges; sums of ranges (one row per task) are added up, then the rows of a range.
    """
    path = work_dir(df.sparkSession, "ranges")
    ranged = df.select(order, value).repartitionByRange(order)
    ranged.withColumn("_range", F.spark_partition_id()).write.parquet(path)
    ranged = df.sparkSession.read.parquet(path)
    sums = ranged.groupBy("_range").agg(F.sum(value).alias("_sum"))
    sums = sums.select("_range", (F.sum("_sum").over(Window.orderBy("_range")) - F.col("_sum")).alias("_base"))
    within = F.sum(value).over(Window.partitionBy("_range").orderBy(order)) - F.col(value)
    return ranged.withColumn("_within", within).join(F.broadcast(sums), "_range").select(
        order, (F.col("_base") + F.col("_within")).alias(name)
    )
