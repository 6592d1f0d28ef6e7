"""Appends that meet stored history through filters of its keys.

Beside a table lies, per append, a blocked Bloom filter of the keys it added: the hash of a
key picks a block of 32,768 bits and ``PROBES`` bits in it. A batch meets the blocks first.
Keys that miss a bit are surely new; the rest are compared exactly with the stored rows of
their partitions. So a batch of new keys reads no history and shuffles none of it, only
blocks of about two bytes a key.

A filter is written before the rows that it names. A run that dies in between leaves keys in
it that are not stored, which costs an exact comparison and no row. The batch must be the same
when it is computed again, and one writer at a time is assumed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlens.operators.sinks import by_partition, missing_rows, read_or_none, stored

BLOCK_BITS = 32_768  # size of the bitmaps that Spark builds
BLOCK_KEYS = 2_048  # about 16 bits a key: of 400 new keys one is compared
PROBES = 4
NAMED_PARTS = 1_000  # partitions of the table that a filter on its folders may list
_KEY = ["_part", "_name"]


def _named(keys: list[str], partition: str | None) -> dict[str, Column]:
    """Partition text and hash of a key; the partition says nothing where it is not part of the key."""
    part = F.coalesce(F.col(partition).cast("string"), F.lit("")) if partition in keys else F.lit("")
    return {"_part": part, "_name": F.xxhash64(*[F.col(k).cast("string") for k in keys])}


def _probe(i: int) -> Column:
    return F.pmod(F.xxhash64("_name", F.lit(i)), F.lit(BLOCK_BITS))


def blocks_of(names: DataFrame) -> DataFrame:
    """``_part, blocks, block, bits`` of distinct names; as many blocks as the names of a partition ask for.

    Names are dealt out by block before bitmaps are made, so no task holds those of others.
    """
    sizes = names.groupBy("_part").agg(F.ceil(F.count("*") / BLOCK_KEYS).alias("blocks"))
    dealt = names.join(sizes, "_part").withColumn("block", F.pmod("_name", "blocks"))
    bit = F.explode(F.array(*[_probe(i) for i in range(PROBES)])).alias("bit")
    return (
        dealt.repartition("_part", "block").select("_part", "blocks", "block", bit)
        .groupBy("_part", "blocks", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))
    )


def possible(names: DataFrame, filters: DataFrame) -> DataFrame:
    """The names of which every probed bit is set in a block of one append."""
    sizes = filters.select("append", "_part", "blocks").distinct()
    asked = names.join(sizes, "_part").withColumn("block", F.pmod("_name", "blocks"))
    hit = F.lit(True)
    for i in range(PROBES):
        byte = F.conv(F.hex(F.substring("bits", (F.floor(_probe(i) / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        hit = hit & (F.call_function("getbit", byte, F.pmod(_probe(i), F.lit(8)).cast("int")) == 1)
    return asked.join(filters, ["append", "_part", "blocks", "block"]).filter(hit).select(*_KEY).distinct()


def _compared(history: DataFrame, suspects: DataFrame, named: dict[str, Column]) -> DataFrame:
    """Stored rows that the suspects must be compared with, read from their partitions only."""
    parts = [r[0] for r in suspects.select("_part").distinct().limit(NAMED_PARTS + 1).collect()]
    if len(parts) <= NAMED_PARTS:
        history = history.filter(named["_part"].isin(*parts))
    return history.withColumns(named).join(suspects, _KEY, "left_semi")


def new_rows(batch: DataFrame, path: str, keys: list[str], partition: str | None = "run_date") -> DataFrame:
    """Rows of the batch whose key is not stored under ``path``; NULL key parts are equal.

    Writes the names of the batch and the suspects beside the table and adds the surely new
    names to its filters. A table without filters gets them from its rows first.
    """
    spark, named = batch.sparkSession, _named(keys, partition)
    names = stored(batch.select(*[c.alias(n) for n, c in named.items()]).distinct(), f"{path}/_names")
    history, filters = read_or_none(spark, path), read_or_none(spark, f"{path}/_keys")
    if history is not None and filters is None:
        blocks_of(history.select(*[c.alias(n) for n, c in named.items()]).distinct()).write.parquet(f"{path}/_keys/append=0")
        filters = spark.read.parquet(f"{path}/_keys")
    rows, append, sure = batch, 1, names
    if filters is not None:
        append += filters.agg(F.max("append")).first()[0] or 0
        suspects = stored(possible(names, filters), f"{path}/_suspects")
        if not suspects.isEmpty():
            sure = names.join(suspects, _KEY, "left_anti")
            if history is not None:
                rows = missing_rows(batch, _compared(history, suspects, named), keys)
    if not sure.isEmpty():
        blocks_of(sure).write.mode("overwrite").parquet(f"{path}/_keys/append={append}")
    return rows


def insert_new(batch: DataFrame, path: str, keys: list[str], partition: str | None = "run_date") -> None:
    """Append the rows whose key is not stored; all writes to the table must come through here."""
    rows = new_rows(batch, path, keys, partition)
    if partition:
        by_partition(rows, partition).write.mode("append").partitionBy(partition).parquet(path)
    else:
        rows.write.mode("append").parquet(path)
