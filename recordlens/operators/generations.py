"""Tables written in generations, which readers see when one row file has named them.

A run writes all its tables under the number of a new generation and then commits it: one
small write of the keys (dates, file names) that the generation now holds. Readers join the
newest committed generation of each key. So

* several tables change in one step, or not at all if the run dies before the commit;
* a key whose new result is empty needs no write of its own;
* no list of keys or files passes through the driver;
* a run that died and is run again writes over its own uncommitted folders.

One writer at a time is assumed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlens.operators.sinks import by_partition, read_or_none
from recordlens.schemas import TABLES


@dataclass(frozen=True)
class Generations:
    """Tables under ``root`` whose rows are kept or replaced by the column ``key``."""

    spark: SparkSession
    root: str
    key: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def ledger(self) -> DataFrame | None:
        """Committed keys with their generation and what was noted of them; None before the first commit."""
        return read_or_none(self.spark, self.path("_ledger"))

    def next(self) -> int:
        """Number of the generation to write: one above the last committed."""
        ledger = self.ledger()
        last = None if ledger is None else ledger.agg(F.max("generation")).first()[0]
        return 1 if last is None else last + 1

    def write(self, name: str, rows: DataFrame, generation: int, by_key: bool = True) -> DataFrame:
        """Write rows of a table under a generation and go on from what is written."""
        path = f"{self.path(name)}/generation={generation}"
        if by_key:
            by_partition(rows, self.key).write.mode("overwrite").partitionBy(self.key).parquet(path)
        else:
            rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def commit(self, keys: DataFrame, generation: int) -> None:
        """Make the generation the newest of its keys, in one write; ``keys`` has the key and notes, one row per key or several."""
        keys.write.mode("overwrite").parquet(f"{self.path('_ledger')}/generation={generation}")

    def read(self, name: str, adding: bool = False) -> DataFrame:
        """Rows of the table in the newest generation of their key, or of all committed generations if it is only added to."""
        ledger = self.ledger()
        schema = self.spark.createDataFrame([], TABLES[name]).schema
        if ledger is None:
            return self.spark.createDataFrame([], schema)
        stored = self.spark.read.schema(schema.add("generation", "long")).parquet(self.path(name))
        # folders of a run that is not committed may be written over while this is read
        stored = stored.filter(F.col("generation") < self.next())
        if adding:
            current = ledger.select("generation").distinct()
            seen = stored.join(current, "generation", "left_semi")
        else:
            current = ledger.groupBy(self.key).agg(F.max("generation").alias("generation")).toDF("_key", "_generation")
            same = (F.col("generation") == F.col("_generation")) & F.col(self.key).eqNullSafe(F.col("_key"))
            seen = stored.join(current, same, "left_semi")
        return seen.select(*[f for f in schema.names if f != "generation"])
