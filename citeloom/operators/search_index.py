"""A kept index for text search: character trigrams to keys, then verification of the few candidates."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.operators.grid import search, search_all
from citeloom.session import delete, shared_dir, until_exit

FEW = 1_000  # keys that are pushed to the scan by name


def trigrams(value: Column) -> Column:
    """The distinct runs of three characters of a text."""
    return F.array_distinct(F.regexp_extract_all(value, F.lit("(?s)(?=(...))"), F.lit(1)))


class SearchIndex:
    """Smart search (every word of the query somewhere, in any case) over columns of a table with a unique key, without reading all texts.

    Two tables are written: the searched texts, sorted by key, and a posting (column, trigram, key) for every distinct trigram of a
    lower-cased text, sorted by trigram; a scan for a few keys or trigrams skips the other row groups. A query's words
    of three characters or more give trigrams, and a row that holds them all is a candidate; candidates are counted by key with map-side
    sums, and their texts alone are read and searched. A query without such a word is searched in all texts. Null keys are not found.
    """

    def __init__(self, df: DataFrame, key: str, columns: Sequence[str]) -> None:
        self.spark, self.df, self.key, self.columns = df.sparkSession, df, key, list(columns)
        self.path = until_exit(self.spark, f"{shared_dir(self.spark)}/search-{uuid.uuid4().hex}")
        kept = df.where(F.col(key).isNotNull()).select(key, *[F.col(c).cast("string").alias(c) for c in self.columns if c != key])
        kept.repartitionByRange(key).sortWithinPartitions(key).write.parquet(f"{self.path}/texts")
        self.texts = self.spark.read.schema(kept.schema).parquet(f"{self.path}/texts")
        columns_of = F.array(*[F.struct(F.lit(i).alias("column"), F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias("value")) for i, c in enumerate(self.columns)])
        said = self.texts.select(F.col(key).alias("key"), F.explode(columns_of).alias("c"))
        postings = said.select("key", "c.column", F.explode(trigrams(F.col("c.value"))).alias("gram"))
        # equal trigrams of many texts are dealt by key
        postings.repartitionByRange("gram", "key").sortWithinPartitions("gram", "key").write.parquet(f"{self.path}/postings")
        self.postings = self.spark.read.schema(postings.schema).parquet(f"{self.path}/postings")

    def candidates(self, query: str, column: str | None = None) -> DataFrame | None:
        """The keys whose texts hold every trigram of every word, each word's in one column; None if no word has three characters."""
        words = sorted({w for w in query.lower().split() if len(w) >= 3})
        if not words:
            return None
        found = []
        for word in words:
            grams = sorted({word[i : i + 3] for i in range(len(word) - 2)})
            held = self.postings.where(F.col("gram").isin(grams))
            if column is not None:
                held = held.where(F.col("column") == self.columns.index(column))
            found.append(held.groupBy("key", "column").agg(F.count("*").alias("n")).where(F.col("n") == len(grams)).select("key").distinct())
        if len(found) == 1:
            return found[0]
        both = reduce(DataFrame.unionAll, found)
        return both.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") == len(found)).select("key")

    def _matching(self, query: str, condition: Column, column: str | None) -> DataFrame:
        keys = self.candidates(query, column)
        texts = self.texts
        if keys is not None:
            few = [r[0] for r in keys.limit(FEW + 1).collect()]
            texts = texts.where(F.col(self.key).isin(few)) if len(few) <= FEW else texts.join(keys.withColumnRenamed("key", self.key), self.key, "left_semi")
        hits = texts.where(condition).select(F.col(self.key).alias("__key"))
        return self.df.join(hits, F.col(self.key) == F.col("__key"), "left_semi")

    def search(self, column: str, query: str) -> DataFrame:
        """The rows of the table whose column holds every word."""
        return self._matching(query, search(F.col(column), query), column)

    def search_all(self, query: str) -> DataFrame:
        """The rows in which every word is in some column."""
        return self._matching(query, search_all(self.columns, query), None)

    def close(self) -> None:
        delete(self.spark, self.path)

    def __enter__(self) -> SearchIndex:
        return self

    def __exit__(self, *_) -> None:
        self.close()
