"""JSON payloads that carry a table as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeloom.operators.grid import columns_to_rows, numbered

CHUNK = 1_000  # rows of a payload


def to_payload(columns: list[str], order: str) -> Column:
    """Aggregate: a group's rows as one JSON object with an array for each column, in the order of a column."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("__order"), *columns)))
    return F.to_json(F.struct(*[rows.getField(c).alias(c) for c in columns]))


def payload_chunks(df: DataFrame, group: str, columns: list[str], order: list[str], rows: int = CHUNK) -> DataFrame:
    """group, chunk (from 0), json: a group's rows in order, at most `rows` of them a payload, so that no row of the result grows with its group.

    order must end in a tiebreaker. Rows are numbered over all groups by ranges of (group, order), so no task sees a whole group
    either; a chunk is a stretch of numbers, counted from its group's first. A null group is one.
    """
    inner = df.select(F.col(group).alias("__group"), *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)], *columns)
    placed = numbered(inner, [F.asc_nulls_first("__group"), *[F.col(f"__o{i}") for i in range(len(order))]])
    first = placed.groupBy("__group").agg(F.min("row_number").alias("__first")).withColumnRenamed("__group", "__g")
    chunk = F.floor((F.col("row_number") - F.col("__first")) / rows)
    dealt = placed.join(first, F.col("__group").eqNullSafe(F.col("__g"))).withColumn("__chunk", chunk)
    return dealt.groupBy("__group", "__chunk").agg(to_payload(columns, "row_number").alias("json")).select(F.col("__group").alias(group), F.col("__chunk").alias("chunk"), "json")


def read_payload(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """The rows of the payloads in a column; schema names a payload's columns and their types. Text that isn't JSON gives no rows; arrays of unequal length raise."""
    arrays = T.StructType([T.StructField(f.name, T.ArrayType(f.dataType)) for f in schema])
    parsed = df.select(F.from_json(column, arrays).alias("p")).select("p.*")
    return columns_to_rows(parsed, schema.names)
