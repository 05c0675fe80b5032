"""A kept page index: a table in one order, written once, of which a page reads its files only."""

from __future__ import annotations

import uuid
from bisect import bisect_right
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.session import delete, hadoop_path, shared_dir, until_exit

ROWS_PER_FILE = 1_000_000
FEW = 50  # files that are named in a plan one by one
_BITS = 33  # of a row's place within its task, as in monotonically_increasing_id()


class File(NamedTuple):
    first: int  # place of its first row
    n: int
    before: int  # rows of the table before it
    path: str


class PageIndex:
    """df in an order that ends in a tiebreaker, with row numbers (long, from 1), by no task that sees all rows.

    The rows are dealt by ranges of the order, sorted in their tasks and written with their places; a task's files hold stretches of
    at most rows_per_file of them. The index is one entry a file on the driver: place and number of its rows, and how many come before. Rows with
    equal order columns are numbered in any order. close(), or leaving a with block, deletes the table; at the latest it goes
    when the application ends.
    """

    def __init__(self, df: DataFrame, order: list[Column], rows_per_file: int = ROWS_PER_FILE) -> None:
        self.spark, self.schema, self.columns = df.sparkSession, df.schema, df.columns
        self.path = until_exit(self.spark, f"{shared_dir(self.spark)}/pages-{uuid.uuid4().hex}")
        placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__place", F.monotonically_increasing_id())
        placed.write.option("maxRecordsPerFile", rows_per_file).parquet(self.path)
        self._schema = placed.schema
        found = self._read(self.path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min("__place").alias("first"), F.count("*").alias("n")).collect()
        self.files: list[File] = []
        self.n = 0
        for r in sorted(found, key=lambda r: r["first"]):
            self.files.append(File(r["first"], r["n"], self.n, r["file"]))
            self.n += r["n"]

    def _read(self, *paths: str) -> DataFrame:
        return self.spark.read.schema(self._schema).parquet(*paths)

    def rows(self) -> DataFrame:
        """All rows with row_number."""
        shift = {}
        for f in self.files:
            shift.setdefault(f.first >> _BITS, f.before - f.first + 1)
        tasks = self.spark.createDataFrame(list(shift.items()), "__task long, __shift long")
        rows = self._read(self.path).withColumn("__task", F.shiftright("__place", _BITS)).join(tasks, "__task")
        return rows.select(*self.columns, (F.col("__place") + F.col("__shift")).alias("row_number"))

    def between(self, first: int, last: int) -> DataFrame:
        """The rows with these numbers, both included, from the files that hold them, in order."""
        first, last = max(first, 1), min(last, self.n)
        if last < first:
            return self.spark.createDataFrame([], self.schema).withColumn("row_number", F.lit(0).cast("long"))
        starts = [f.before for f in self.files]
        here = self.files[bisect_right(starts, first - 1) - 1 : bisect_right(starts, last - 1)]
        if len(here) > FEW:
            numbered = self.rows()
        else:
            place, number = F.col("__place"), F.lit(None).cast("long")
            for f in here:
                number = F.when(place.between(f.first, f.first + f.n - 1), place + (f.before - f.first + 1)).otherwise(number)
            numbered = self._read(*[hadoop_path(self.spark, f.path).toString() for f in here]).select(*self.columns, number.alias("row_number"))
        return numbered.where(F.col("row_number").between(first, last)).orderBy("row_number")

    def page(self, number: int, length: int) -> DataFrame:
        """The number-th page (from 1), lazily; past the end it raises."""
        if number < 1 or length < 1 or (number - 1) * length >= max(self.n, 1):
            raise ValueError(f"no page {number}")
        return self.between((number - 1) * length + 1, number * length)

    def copy_of_page(self, number: int, length: int) -> DataFrame:
        """The page as a table of its own, at most length rows by way of the driver, that outlives the index."""
        page = self.page(number, length)
        return self.spark.createDataFrame(page.collect(), page.schema)

    def close(self) -> None:
        delete(self.spark, self.path)

    def __enter__(self) -> PageIndex:
        return self

    def __exit__(self, *_) -> None:
        self.close()
