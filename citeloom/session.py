"""Session settings that the queries rely on, and the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: UTC for date filters; partition values stay strings; adaptive execution for skew and small partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

_own_dir: dict[str, str] = {}


def session(app_name: str = "citeloom", **settings: str) -> SparkSession:
    return SparkSession.builder.appName(app_name).config(map=SETTINGS | settings).getOrCreate()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application; they need not have it installed."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="citeloom-")) / "citeloom.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted((root / "citeloom").rglob("*.py")):
                z.write(f, f.relative_to(root))
        spark.sparkContext.addPyFile(str(archive))
        _shipped.add(app)


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or a folder of our own where it is unset and all run on one machine."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dir:
        _own_dir[app] = f"file://{tempfile.mkdtemp(prefix='citeloom-')}"
    return _own_dir[app]


def until_exit(spark: SparkSession, path: str) -> str:
    """What is at path (a written table) is deleted when the application ends, if nobody has deleted it before."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def kept(df: DataFrame, label: str) -> DataFrame:
    """df written to the shared folder and read back, for a small result whose size the next plan should know; it goes when the application ends."""
    spark = df.sparkSession
    path = until_exit(spark, f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, uri: str):
    """A file's path as Spark names it in _metadata, where spaces and the like are encoded."""
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))


def _filesystem(spark: SparkSession, path: str) -> tuple:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished table is at path: a half-written one has no _SUCCESS."""
    p, fs = _filesystem(spark, f"{path}/_SUCCESS")
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a table, if it is there."""
    p, fs = _filesystem(spark, path)
    fs.delete(p, True)


def overwrite(spark: SparkSession, uri: str, data: bytes) -> None:
    """Put data in place of a file's content."""
    p = hadoop_path(spark, uri)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def rename(spark: SparkSession, old: str, new: str) -> None:
    p, fs = _filesystem(spark, old)
    if not fs.rename(p, _filesystem(spark, new)[0]):
        raise OSError(f"{old} can't become {new}")
