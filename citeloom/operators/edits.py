"""A kept log of edits to a table: appended to, merged when the table is read, compacted."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.session import delete, rename, shared_dir, until_exit

LOG = "version long, key string, column string, value string"
_ROW = ""  # the column of an entry that says whether there is the row: value `added` or `removed`


class EditLog:
    """All edits of one table whose rows are known by a unique key column.

    An edit is a row (version, key, column, value): the key that the row has in the table, as text, and the new value as text, null
    for an empty cell. Of the edits of one cell the last version counts; of one version none may name a cell twice. A row that
    is added or removed has an entry of its own, so a removed row that is added again begins empty. The key of a row can be edited like
    any other cell: later edits still name the row by its key in the table (an added row by the key that it was added with).

    Each call appends one Parquet write and nothing is rewritten; apply() is one aggregation and one join, however many edits there
    are; compact() leaves one entry a cell. A call that is cut off leaves no version behind: versions are written whole or not at all.
    """

    def __init__(self, spark: SparkSession, columns: list[str], key: str, path: str | None = None) -> None:
        if key not in columns:
            raise ValueError(f"no column {key}")
        self.spark, self.columns, self.key = spark, columns, key
        self.path = path or until_exit(spark, f"{shared_dir(spark)}/edits-{uuid.uuid4().hex}")
        self.version = self._last() + 1

    def _log(self) -> DataFrame:
        try:
            return self.spark.read.schema(LOG).parquet(f"{self.path}/*")
        except Exception as e:  # nothing was written yet
            if "PATH_NOT_FOUND" in str(e):
                return self.spark.createDataFrame([], LOG)
            raise

    def _last(self) -> int:
        return self._log().agg(F.max("version")).first()[0] or 0

    def _append(self, entries: DataFrame) -> None:
        checked = F.when(F.col("column").isin([*self.columns, _ROW]), F.col("column")).otherwise(F.raise_error(F.concat(F.lit("no column "), F.coalesce("column", F.lit("null")))).cast("string"))
        entries.select(F.lit(self.version).cast("long").alias("version"), F.col("key").cast("string").alias("key"), checked.alias("column"), F.col("value").cast("string").alias("value")).write.mode("overwrite").parquet(f"{self.path}/v{self.version:012d}")
        self.version += 1

    def cells(self, edits: DataFrame) -> None:
        """edits: the key column, `column` and `value`."""
        self._append(edits.select(F.col(self.key).alias("key"), "column", "value"))

    def cell(self, key, column: str, value) -> None:
        self.row(key, {column: value})

    def row(self, key, new: dict) -> None:
        """Several cells of one row, in whatever order they are named."""
        if unknown := set(new) - set(self.columns):
            raise ValueError(f"no columns {sorted(unknown)}")
        values = [(_text(key), c, _text(v)) for c, v in new.items()]
        self._append(self.spark.createDataFrame(values, "key string, column string, value string"))

    def column(self, column: str, values: DataFrame) -> None:
        """values: the key column and `value`; rows without a value keep theirs."""
        self._append(values.select(F.col(self.key).alias("key"), F.lit(column).alias("column"), "value"))

    def rows(self, new: DataFrame) -> None:
        """Every column of the rows of `new` (columns of the table) taken from there; rows that the table lacks are not added."""
        self._append(self._cells_of(new))

    def add(self, new: DataFrame) -> None:
        """New rows."""
        self._append(self._cells_of(new).unionByName(new.select(F.col(self.key).alias("key"), F.lit(_ROW).alias("column"), F.lit("added").alias("value"))))

    def remove(self, keys: DataFrame) -> None:
        """keys: the key column."""
        self._append(keys.select(F.col(self.key).alias("key"), F.lit(_ROW).alias("column"), F.lit("removed").alias("value")))

    def _cells_of(self, new: DataFrame) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in new.columns])
        return new.select(F.col(self.key).cast("string").alias("key"), F.inline(cells))

    def latest(self) -> DataFrame:
        """key, column, version, value: one entry a cell."""
        return self._log().groupBy("key", "column").agg(F.max("version").alias("version"), F.max_by("value", "version").alias("value"))

    def apply(self, df: DataFrame) -> DataFrame:
        """df with the edits of this log."""
        entry = F.struct("column", F.struct("version", "value").alias("e"))
        edits = self.latest().groupBy("key").agg(F.map_from_entries(F.collect_list(entry)).alias("__new")).withColumnRenamed("key", "__key")
        marked = df.withColumn("__there", F.lit(True))
        joined = marked.join(edits, F.col(self.key).cast("string") == F.col("__key"), "full_outer")
        row = F.element_at("__new", F.lit(_ROW))
        there = F.when(row.isNotNull(), row["value"] == "added").otherwise(F.coalesce(F.col("__there"), F.lit(False)))
        since = F.coalesce(row["version"], F.lit(0))

        def changed(c: str) -> Column:
            e = F.element_at("__new", F.lit(c))
            new = e["value"].cast(df.schema[c].dataType)
            # of a row that was added, only what came with it or later counts
            return F.when(e.isNotNull() & (e["version"] >= since), new).when(row.isNull(), F.col(c)).alias(c)

        return joined.where(there).select(*[changed(c) for c in df.columns])

    def compact(self) -> None:
        """One entry a cell, in one version's place; the rest goes. What is read before is read from the old entries."""
        old = sorted(self._versions())
        if len(old) > 1:
            fresh = f"{self.path}-compacted"
            self.latest().select("version", "key", "column", "value").write.mode("overwrite").parquet(fresh)
            # from here on the compacted entries only repeat the last ones, so a cut between two steps changes nothing
            rename(self.spark, fresh, f"{self.path}/c{self.version:012d}")
            for v in old:
                delete(self.spark, f"{self.path}/{v}")
            self.version += 1

    def _versions(self) -> list[str]:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName()[0] in "vc"] if fs.exists(p) else []

    def close(self) -> None:
        delete(self.spark, self.path)


def _text(v) -> str | None:
    """A value as Spark would write it as text."""
    return None if v is None else str(v).lower() if isinstance(v, bool) else str(v)
