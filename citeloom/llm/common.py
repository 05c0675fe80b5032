"""What the corpus operators share: table access, written intermediate tables, clash-safe columns."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.session import shared_dir, until_exit

_shipped: set[str] = set()

#: Spark 4 can drop a query's shuffle files as soon as its output is written.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application; they need not have it installed."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parents[2]
        archive = Path(tempfile.mkdtemp(prefix="citeloom-")) / "citeloom.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted((root / "citeloom").rglob("*.py")):
                z.write(f, f.relative_to(root))
        spark.sparkContext.addPyFile(str(archive))
        _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows and bytes in a batch that Spark hands to Python; the bytes that are set while a table is written.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MOST_BYTES = 2 << 20


def materialize(df: DataFrame, label: str, batch_rows: int | None = None) -> DataFrame:
    """Write df to the shared folder and return the table read back: cuts lineage and survives lost executors.

    batch_rows: for plans whose Python steps read long rows, the most rows handed over at once, beside MOST_BYTES; settings of
    the session while the table is written. The table is deleted by scratch() or discard(), at the latest when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/citeloom/{label}-{uuid.uuid4().hex}"
    settings = {CLEANUP: "true", BATCH_BYTES: str(MOST_BYTES)} | ({BATCH: str(batch_rows)} if batch_rows else {})
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    out = spark.read.schema(df.schema).parquet(until_exit(spark, path))
    out._citeloom_path = path
    if (held := _scratch.get()) is not None:
        held.append(out)
    return out


_scratch: ContextVar[list[DataFrame] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """The tables that are materialized within the block are deleted at its end, also on failure, but for those given to the function that it yields; an outer block deletes these."""
    held: list[DataFrame] = []
    kept: set[str] = set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df._citeloom_path)
        return df

    token = _scratch.set(held)
    try:
        yield keep
    except BaseException:
        kept.clear()
        raise
    finally:
        _scratch.reset(token)
        discard(*[df for df in held if df._citeloom_path not in kept])
        if (outer := _scratch.get()) is not None:
            outer += [df for df in held if df._citeloom_path in kept]


def trim() -> None:
    """In a Python worker: hand freed memory back to the machine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


#: Texts that a Python worker is handed at once where only a narrow result is wanted back.
TEXT_ROWS = 256


def text_key(text: str = "text") -> Column:
    """With doc_id, what a row is known by: rows that agree in both are given equal results."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs but the rows that gone (doc_id, tkey; a written table) lists. Texts stay where they are unless it lists very many."""
    gone = if_small(gone.select(F.col("doc_id").alias("__id"), F.col("tkey").alias("__tkey")).distinct())
    row = pack(docs).withColumn("__k", text_key("__row.text"))
    kept = row.join(gone, F.col("__row.doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__k") == F.col("__tkey")), "left_anti")
    return kept.select(*[F.col("__row").getField(c).alias(c) for c in docs.columns])


#: Rows that a table may have to be broadcast: of rows of up to some hundred bytes, a few ten MB.
BROADCAST_ROWS = 200_000


def if_small(df: DataFrame, rows: int | None = None, most: int = BROADCAST_ROWS) -> DataFrame:
    """df, marked for broadcast if it has at most so many rows (counted unless given); a larger table is joined by a shuffle."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= most else df


def discard(*tables: DataFrame) -> None:
    """Delete tables that materialize() wrote and nobody will read again."""
    for df in tables:
        path = getattr(df, "_citeloom_path", None)
        if path:
            jvm = df.sparkSession.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def free_name(columns: list[str], base: str) -> str:
    """base, or base and underscores, that no column has."""
    while base.lower() in {c.lower() for c in columns}:
        base += "_"
    return base


def with_added(row: str, columns: list[str], added: dict[str, Column]) -> list[Column]:
    """The fields of the struct column `row`, then the added columns; an input column with the name of an added one gives way."""
    return [F.col(row).getField(c).alias(c) for c in columns if c not in added] + [v.alias(k) for k, v in added.items()]


def pack(df: DataFrame, row: str = "__row") -> DataFrame:
    """df as one struct column, so that no helper column can clash with a column of the input."""
    return df.select(F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns]).alias(row))
