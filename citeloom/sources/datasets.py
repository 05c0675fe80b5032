"""Stored tables: nodes and edges partitioned by message, results built once."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeloom.schemas import EDGES, NODES
from citeloom.session import delete, exists, hadoop_path

PARTITIONS = ("bm", "sm")
log = logging.getLogger("citeloom")


def write_partitioned(df: DataFrame, path: str, partitions: tuple[str, ...] = PARTITIONS) -> None:
    """Write by partition, replacing only those partitions that df has rows for. Rows are gathered by partition into tasks of about equal size; a large partition becomes several files."""
    df.hint("rebalance", *partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)
    spark = df.sparkSession
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")  # which a write of single partitions leaves out
    done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(done, True).close()


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(NODES).parquet(path)


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EDGES).parquet(path)


def materialize(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Build and write the table if it isn't there, and read it back."""
    if not exists(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def materialize_all(spark: SparkSession, paths: list[str], build: Callable[[], list[DataFrame]]) -> list[DataFrame]:
    """Build and write all tables unless every one is there, and read them back: a run that was cut off between two is done again."""
    if not all(exists(spark, p) for p in paths):
        for p, df in zip(paths, build(), strict=True):
            df.write.mode("overwrite").parquet(p)
    return [spark.read.parquet(p) for p in paths]


class Lost(NamedTuple):
    """A file that gave fewer rows than it has."""

    file: str
    rows: int | None  # by its footer; None if that can't be read
    given: int  # before it broke off; none of them are in the result


class Existing(NamedTuple):
    rows: DataFrame
    missing: list[str]  # paths without a finished table
    failed: list[str]  # paths of whose files none can be read
    lost: list[Lost]  # the files that can't be read wholly


MOST_LOST = 10_000  # broken or empty files that are looked at one by one

#: Broken files are left out of the scan, and a page is held against its checksum.
TOLERANT = {"ignoreCorruptFiles": "true", "ignoreMissingFiles": "true", "parquet.page.verify-checksum.enabled": "true"}


def footer_rows(spark: SparkSession, file: str) -> int | None:
    """The rows of one Parquet file by its footer; None if that can't be read."""
    jvm, path = spark.sparkContext._jvm, hadoop_path(spark, file)
    try:
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, spark.sparkContext._jsc.hadoopConfiguration()))
    except Py4JJavaError:
        return None
    try:
        return reader.getRecordCount()
    finally:
        reader.close()


def census(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """file, path (of its table), in_footer and given for every file of the tables: the rows that its footer names, and those that come out when
    every column is read; null where nothing came. Three scans: names only, footers only, and all pages. A file without rows is like one that can't be read."""
    file = F.col("_metadata.file_path").alias("file")
    tables = [spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(p).select(file, F.lit(p).alias("path")) for p in paths]
    files = reduce(DataFrame.unionAll, tables)
    read = spark.read.schema(schema).options(**TOLERANT)
    footers = read.parquet(*paths).groupBy(file).agg(F.count("*").alias("in_footer"))
    # the hash, whose value decides by which of the two a row is counted, keeps all columns in the scan
    odd = F.xxhash64(*schema.names) % 2 != 0
    pages = read.parquet(*paths).select(file, odd.alias("odd")).groupBy("file").agg((F.count_if("odd") + F.count_if(~F.col("odd"))).alias("given"))
    return files.join(footers, "file", "left").join(pages, "file", "left")


def read_existing(spark: SparkSession, paths: list[str], schema: T.StructType) -> Existing:
    """The rows of all files that can be read wholly, of the tables among paths, columns that a table lacks being null; what is missing, broken or cut short is left out and named.

    Every file is counted before (census()): it stays only if as many rows come out of its pages as its footer names. The
    rows are then read without tolerance, so that a file which breaks afterwards is an error and no silent loss. More than MOST_LOST
    files without rows raise: that is no table with a few broken files.
    """
    there = [p for p in paths if exists(spark, p)]
    missing = [p for p in paths if p not in there]
    if not there:
        return Existing(spark.createDataFrame([], schema), missing, [], [])
    counted = census(spark, there, schema).withColumn("whole", F.coalesce(F.col("given") == F.col("in_footer"), F.lit(False))).persist()
    try:
        doubtful = counted.where("not whole").limit(MOST_LOST + 1).collect()
        if len(doubtful) > MOST_LOST:
            raise ValueError(f"more than {MOST_LOST} files give no rows or too few")
        lost, empty = [], set()
        for r in doubtful:
            rows = r["in_footer"] if r["in_footer"] is not None else footer_rows(spark, r["file"])
            if rows == 0:
                empty.add(r["path"])
            else:
                lost.append(Lost(r["file"], rows, r["given"] or 0))
                log.warning("%s can't be read: %s of %s rows", r["file"], r["given"] or 0, "unknown" if rows is None else rows)
        named = {r["path"] for r in doubtful}
        files = {p: [hadoop_path(spark, r["file"]).toString() for r in counted.where(F.col("whole") & (F.col("path") == p)).select("file").collect()] for p in named}
    finally:
        counted.unpersist()
    failed = [p for p in there if p in named and not files[p] and p not in empty]
    good = [p for p in there if p not in failed]
    hurt = sorted({r["path"] for r in doubtful if r["file"] in {x.file for x in lost}} - set(failed))
    strict = spark.read.schema(schema).option("parquet.page.verify-checksum.enabled", "true")
    parts = [strict.parquet(*whole)] if (whole := [p for p in good if p not in hurt]) else []
    parts += [strict.option("basePath", p).parquet(*files[p]) for p in hurt if files[p]]  # the files of a table by name
    rows = reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], schema)
    return Existing(rows, missing, failed, sorted(lost))


def free(spark: SparkSession, path: str, df: DataFrame | None = None) -> None:
    """Drop a result that nobody reads any more: from the cache and from storage."""
    if df is not None:
        df.unpersist()
    delete(spark, path)


@contextmanager
def timed(label: str) -> Iterator[None]:
    """Log how long the block took, also if it fails."""
    began = time.perf_counter()
    log.info("%s: begun", label)
    try:
        yield
    finally:
        log.info("%s: %.1f s", label, time.perf_counter() - began)
