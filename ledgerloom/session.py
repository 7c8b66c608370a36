"""Session helpers: UTC sessions, the shared work folder, and shipping this package to executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "ledgerloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator relies on (UTC days, AQE with skew joins)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    return builder.config(map=settings).getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The folder that driver and executors share, with its scheme: spark.checkpoint.dir, set here only where it is unset
    and the master is local (tests); on a cluster that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return _qualified(spark, root.rstrip("/"))
    known = spark.sparkContext.getCheckpointDir()
    if not known:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="ledgerloom-"))
        known = spark.sparkContext.getCheckpointDir()
    return known.rstrip("/")


def _qualified(spark: SparkSession, path: str) -> str:
    """A path without a scheme belongs to Spark's default file system."""
    if "://" in path:
        return path
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and not full.startswith("file://") else full


def work_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a path that work_path() made; anything outside the shared folder is refused."""
    if not path.startswith(work_root(spark) + "/"):
        raise ValueError(f"{path} is not below the shared folder")
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stage_table(df: DataFrame, label: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once, so that functions in it can be imported there."""
    sc = spark.sparkContext
    if getattr(sc, "_ledgerloom_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="ledgerloom-"), "ledgerloom.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(Path("ledgerloom") / p.relative_to(root)))
    sc.addPyFile(target)
    sc._ledgerloom_shipped = True
