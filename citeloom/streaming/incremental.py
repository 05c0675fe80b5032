"""Resumable ingestion: what is done is not done again, what fails doesn't stop the rest and is tried again."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeloom.session import delete, exists


def pending(wanted: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Distinct ids that are wanted and not done; null ids are never pending."""
    return wanted.select(key).where(f"{key} is not null").distinct().join(done.select(key), key, "left_anti")


def ingest_available(spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, partitions: tuple[str, ...] = ()) -> None:
    """Append the files of source that no earlier call has taken to target, and stop. The checkpoint remembers them; a run that is cut off resumes there."""
    writer = spark.readStream.schema(schema).parquet(source).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.trigger(availableNow=True).start().awaitTermination()


#: The column by which work says why a row failed; null for a row that is done.
ERROR = "error"


class Ingestion:
    """Files of wanted rows, each worked on once; rows that fail are kept and tried again with every later batch.

    work(rows) gives the rows back, their own columns and those it adds, with `error`: null for a row that is done, else why not; one row's error is
    no other row's. A batch is the rows of the files that are new since the last one and all rows that have failed so far. It is
    one table, batches/batch=<n>, in which state tells done from failed rows; it replaces what an attempt of the same number has left
    there, and only then does the checkpoint count the batch as taken. So a run that is cut off anywhere is repeated with the same files
    and the same failed rows and adds nothing twice. A table that was not finished is never read.

    Without new files nothing runs; retry() works on the failed rows alone.
    """

    def __init__(self, spark: SparkSession, source: str, schema: T.StructType, folder: str, work: Callable[[DataFrame], DataFrame], files_per_batch: int = 1000) -> None:
        self.spark, self.source, self.schema, self.folder, self.work, self.files_per_batch = spark, source, schema, folder, work, files_per_batch
        self.after_write: Callable[[], None] = lambda: None  # between a batch's table and the checkpoint, for tests of cut-off runs

    def _path(self, kind: str, batch: int) -> str:
        return f"{self.folder}/{kind}/batch={batch}"

    def _numbers(self) -> list[int]:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/batches")
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(int(s.getPath().getName().removeprefix("batch=")) for s in fs.listStatus(p)) if fs.exists(p) else []

    def _finished(self, batch: int) -> list[tuple[int, str]]:
        """(number, kind) of a batch's finished tables, a retry after the batch."""
        return [(batch, kind) for kind in ("batches", "retries") if exists(self.spark, self._path(kind, batch))]

    def _last(self, before: int | None = None) -> list[tuple[int, str]]:
        """The last finished table of the batches before a number, or of all; none before the first."""
        return next((found[-1:] for n in reversed(self._numbers()) if (before is None or n < before) and (found := self._finished(n))), [])

    def _read(self, tables: list[tuple[int, str]], state: str) -> DataFrame:
        stored = self.work(self.spark.createDataFrame([], self.schema)).schema.add("state", "string")
        if not tables:
            return self.spark.createDataFrame([], stored)
        parts = [self.spark.read.schema(stored).parquet(self._path(kind, n)) for n, kind in tables]
        return reduce(DataFrame.unionAll, parts).where(F.col("state") == state)

    def _take(self, rows: DataFrame, kind: str, batch: int) -> None:
        state = F.when(F.col(ERROR).isNull(), "done").otherwise("failed")
        self.work(rows).withColumn("state", state).write.mode("overwrite").partitionBy("state").parquet(self._path(kind, batch))

    def run(self) -> None:
        """Take what has come since the last call, and stop."""

        def batch(rows: DataFrame, n: int) -> None:
            delete(self.spark, self._path("retries", n))  # of an attempt that is replaced
            self._take(rows.unionByName(self.failed(before=n)), "batches", n)
            self.after_write()

        stream = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", self.files_per_batch).parquet(self.source)
        stream.writeStream.foreachBatch(batch).option("checkpointLocation", f"{self.folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()

    def retry(self) -> None:
        """Work on the failed rows without waiting for new files, as a part of the last batch; once a batch."""
        for n, kind in self._last():
            if kind == "batches":
                self._take(self.failed(), "retries", n)

    def done(self) -> DataFrame:
        """All rows that are done."""
        return self._read([t for n in self._numbers() for t in self._finished(n)], "done").drop(ERROR, "state")

    def failed(self, before: int | None = None) -> DataFrame:
        """The rows that have failed and wait, with the columns of the source; before a batch, or now."""
        return self._read(self._last(before), "failed").select(self.schema.names)

    def errors(self) -> DataFrame:
        """The rows that wait, with their errors."""
        return self._read(self._last(), "failed").drop("state")
