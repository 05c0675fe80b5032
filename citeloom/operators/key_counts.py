"""Filters of several handles kept up by counts: when one handle changes, only its keys and their difference are shuffled."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.session import delete, shared_dir, until_exit

BUCKETS = 64


class KeyCounts:
    """How many handles have each key, and each handle's keys, as tables bucketed by key.

    A handle's new keys are shuffled to the buckets once; what it has added and lost is a join with its old ones in place. Only this
    difference is shuffled to the counts, which stay where they are, and other handles' keys aren't read at all; keys() is a scan.
    Keys are text; null keys don't count. The tables are in the session's catalog under names of their own and go when
    they are replaced, with close(), or at the latest when the application ends. A result of keys() is to be read before the next change.
    """

    def __init__(self, spark: SparkSession, buckets: int = BUCKETS) -> None:
        self.spark, self.buckets = spark, buckets
        self.sets: dict[str, str] = {}
        self.counts: str | None = None
        self._paths: dict[str, str] = {}

    def _save(self, df: DataFrame) -> str:
        name = f"citeloom_keys_{uuid.uuid4().hex}"
        self._paths[name] = until_exit(self.spark, f"{shared_dir(self.spark)}/{name}")
        df.write.bucketBy(self.buckets, "key").sortBy("key").option("path", self._paths[name]).saveAsTable(name)
        return name

    def _drop(self, *names: str | None) -> None:
        for name in names:
            if name is not None:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
                delete(self.spark, self._paths.pop(name))

    def difference(self, old: str | None, new: str | None) -> DataFrame:
        """key and change (1 or -1) between two saved key sets."""
        if old is None or new is None:
            return self.spark.table(new or old).select("key", F.lit(1 if new else -1).alias("change"))
        o, n = (self.spark.table(t).select("key", F.lit(True).alias(c)) for t, c in ((old, "o"), (new, "n")))
        both = o.join(n, "key", "full_outer")
        return both.where("o is null or n is null").select("key", F.when(F.col("n"), 1).otherwise(-1).alias("change"))

    def changed(self, change: DataFrame) -> DataFrame:
        """The counts with a difference added; keys that no handle has any more go."""
        if self.counts is None:
            return change.select("key", F.col("change").alias("n"))
        both = self.spark.table(self.counts).join(change, "key", "full_outer")
        return both.select("key", (F.coalesce("n", F.lit(0)) + F.coalesce("change", F.lit(0))).alias("n")).where("n > 0")

    def _replace(self, handle: str, new: str | None) -> None:
        old = self.sets.get(handle)
        counts = self._save(self.changed(self.difference(old, new)))
        before, self.counts = self.counts, counts
        if new is None:
            del self.sets[handle]
        else:
            self.sets[handle] = new
        self._drop(before, old)

    def set(self, handle: str, keys: DataFrame) -> None:
        """The handle's keys (column key) from now on."""
        if keys is None:
            raise ValueError("clear() removes a filter")
        text = keys.select(F.col("key").cast("string").alias("key")).where("key is not null")
        self._replace(handle, self._save(text.repartition(self.buckets, "key").distinct()))

    def clear(self, handle: str) -> None:
        if handle in self.sets:
            self._replace(handle, None)

    def keys(self) -> DataFrame | None:
        """The keys that every handle has; None without handles."""
        return self.spark.table(self.counts).where(F.col("n") == len(self.sets)).select("key") if self.sets else None

    def close(self) -> None:
        self._drop(*self.sets.values(), self.counts)
        self.sets, self.counts = {}, None

    def __enter__(self) -> KeyCounts:
        return self

    def __exit__(self, *_) -> None:
        self.close()
