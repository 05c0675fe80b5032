"""One citation hop around key papers, and the stored nodes and edges."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions import text
from citeloom.schemas import NESTED


class Snowball(NamedTuple):
    nodes: DataFrame
    edges: DataFrame


ROWS_A_TASK = 250_000  # rows that one task makes distinct


def tasks_for(rows: int, spark: SparkSession) -> int:
    """Tasks among which so many rows are made distinct: as many more as there are more rows, so that none needs more memory in larger tables."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_A_TASK))


def distinct(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """Distinct rows. With a number of tasks, rows are dealt to them as they are and each is held by one task only; without, Spark gathers what it deems small,
    and a task first holds the distinct rows of all that it has read."""
    return df.repartition(tasks, *df.columns).distinct() if tasks else df.distinct()


def snowball_edges(seeds: DataFrame, works: DataFrame, tasks: int | None = None) -> DataFrame:
    """Distinct edges from, to that touch a seed (id): works that seeds cite, and works that cite seeds. tasks as in distinct().

    One pass over the works: they are marked by their own id, their citations by the cited id. A task holds its part of the seeds in memory, not of the works.
    """
    ids = seeds.select("id").where("id is not null").distinct()
    known = lambda end: ids.select(F.col("id").alias(end), F.lit(True).alias(f"seed_{end}")).hint("shuffle_hash")
    marked = works.select(F.col("id").alias("from"), "referenced_works").join(known("from"), "from", "left")
    cites = marked.select("from", "seed_from", F.explode("referenced_works").alias("to")).join(known("to"), "to", "left")
    return distinct(cites.where("seed_from or seed_to").select("from", "to"), tasks)


def snowball_nodes(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """Seeds and every end of an edge; oa_input says whether the work is a seed. One pass: a seed is a row with the flag, and the flag's maximum wins."""
    marked = seeds.select("id", F.lit(True).alias("oa_input")).where("id is not null")
    ends = edges.select(F.explode(F.array("from", "to")).alias("id"), F.lit(False).alias("oa_input"))
    return marked.unionByName(ends).groupBy("id").agg(F.max("oa_input").alias("oa_input"))


def union_nodes(*parts: DataFrame) -> DataFrame:
    """Distinct rows of all parts by column name; a column that a part lacks is null, nested columns go."""
    out = parts[0].drop(*NESTED)
    for p in parts[1:]:
        out = out.unionByName(p.drop(*NESTED), allowMissingColumns=True)
    return out.distinct()


def tagged(df: DataFrame) -> DataFrame:
    """The background message is taken from the sub message."""
    return df.withColumn("bm", text.background_of(F.col("sm")))


MOST_ROWS = 1_000_000  # rows of either table that are brought to the driver


def snowball(nodes: DataFrame, edges: DataFrame, background_message: str | None = None, sub_message: str | None = None, collect: bool = True, most: int = MOST_ROWS, tasks: int | None = None) -> Snowball:
    """The distinct nodes and edges of all messages, of a background message, or of a sub message.

    Filters on bm and sm prune partitions. collect=True returns the rows themselves as lists, at most `most` of each; more raise, as they belong
    in a table: collect=False gives DataFrames. tasks as in distinct().
    """
    if background_message is not None and sub_message is not None:
        raise ValueError("give a background message or a sub message, not both")
    where = F.lit(True)
    if sub_message is not None:
        where = F.col("sm") == sub_message
    if background_message is not None:
        where = F.col("bm") == background_message
    out = Snowball(distinct(nodes.where(where), tasks), distinct(edges.where(where), tasks))
    if not collect:
        return out
    lists = Snowball(*[df.limit(most + 1).collect() for df in out])
    if max(map(len, lists)) > most:
        raise ValueError(f"more than {most} rows; collect=False gives DataFrames")
    return lists
