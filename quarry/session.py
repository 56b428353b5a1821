"""Spark session and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def get_spark(master: str | None = None, app: str = "quarry",
              shuffle_partitions: int | None = None) -> SparkSession:
    """A session: spark-submit's master and driver memory if it gives them, else a local one."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app)
    settings = SparkConf()
    if master or not settings.contains("spark.master"):
        builder = builder.master(master or f"local[{cpus}]")
    if not settings.contains("spark.driver.memory"):
        builder = builder.config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "8g"))
    builder = (
        builder
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    The setting is read from the session; only when it is unset (local
    tests) a private folder is created and registered as checkpoint dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            # a folder on the driver's disk is not shared with executors
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        conf = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors as a zip, so that their Python workers can import it."""
    sc = spark.sparkContext
    if getattr(sc, "_quarry_shipped", False):
        return
    here = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="quarry-zip-")) / "quarry.zip"  # the driver serves it
    with zipfile.ZipFile(target, "w") as z:
        for path in sorted(here.rglob("*.py")):
            z.write(path, path.relative_to(here.parent))
    sc.addPyFile(str(target))
    sc._quarry_shipped = True


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder.

    Reliable checkpoints survive the loss of executors; ``localCheckpoint``
    would not, so it is never used.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
