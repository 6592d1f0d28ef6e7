"""Tables, the shared folder and connected components for the operators of this package."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def reach_package(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it.

    Matters where the driver found it by ``sys.path`` alone; an installed package, or
    one sent with ``--py-files``, is found anyway.
    """
    root = str(Path(__file__).resolve().parents[2])
    given = spark.sparkContext.environment
    paths = [p for p in given.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        given["PYTHONPATH"] = os.pathsep.join([*paths, root])


def give_back() -> None:
    """Returns freed memory of a Python worker to the system; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the setting is absent (tests on one machine) a new temporary folder
    is set for the session; on a cluster the absence is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read from there.

    This cuts the lineage: a lost executor costs its own tasks, not the chain
    that made the table. Tables of an application lie in one folder, which may
    be deleted when the application has ended.
    """
    spark = df.sparkSession
    reach_package(spark)
    app = spark.sparkContext.applicationId
    path = f"{shared_folder(spark)}/llm-{app}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_path = path
    return table


def release(*tables: DataFrame) -> None:
    """Deletes tables of ``stored`` that no frame still to be computed reads."""
    for table in tables:
        spark = table.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.stored_path)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """Smallest reachable id of the nodes of ``edges`` (long columns ``a``, ``b``) that are not it: ``node, root``.

    Alternating star contraction: each round links the neighbours of a node to
    the smallest of them, first the larger ones, then the smaller ones, until
    all is stars: a node has one root, and no root has one. The rounds number about
    log(nodes); a hub is only ever reduced by ``min``, which combines before the shuffle,
    and its edges are joined by the node (a skewed join that AQE may split). Rounds write
    to the shared folder. More than ``rounds`` of them are an error.
    """
    edges = stored(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    for _ in range(rounds):
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
            edges.select("b", F.lit(0), F.lit(1))
        )
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if ends.filter("up > 1 or up > 0 and down > 0").isEmpty():
            break
        old = edges
        # large star: every larger neighbour of a node goes to the node's smallest neighbour
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: a node and its smaller neighbours go to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        edges = stored(
            joined.filter("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionAll(least.select("a", F.col("m").alias("b")))
            .distinct(),
            "edges",
        )
        release(old)
    else:
        raise RuntimeError(f"edges are no stars after {rounds} rounds")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots.stored_path = edges.stored_path
    return roots
