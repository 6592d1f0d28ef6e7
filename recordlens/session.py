"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


# Settings that help these jobs on any cluster; all are public Spark options.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    # split a hot shuffle partition also where that costs one more shuffle later
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # the JVM never compiles methods above 8000 bytes; wide rows are faster split up
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.codegen.cache.maxEntries": "5000",
    "spark.sql.dataFrameQueryContext.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Sets the options of ``TUNING`` that a running session may change."""
    for key, value in TUNING.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app: str = "recordlens") -> SparkSession:
    """Session for tests and the bench on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in TUNING.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder that all executors reach.

    It lies under ``spark.checkpoint.dir``. Where that is unset, a local session
    gets a temporary folder and a cluster is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/recordlens/{name}-{uuid.uuid4().hex}"
