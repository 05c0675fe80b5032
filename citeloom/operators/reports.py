"""The report's queries over nodes. Thresholds and years are parameters with the report's values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions import text
from citeloom.session import kept

CUT_OFF = 2018


def refs_per_year_sm(nodes: DataFrame) -> DataFrame:
    """Nodes by sub message and year, a null year being a group; in order, null last."""
    out = nodes.groupBy("sm", F.col("publication_year").cast("long").alias("publication_year")).agg(F.count("*").alias("n"))
    return out.orderBy(F.asc_nulls_last("sm"), F.asc_nulls_last("publication_year"))


def plot_points(per_year: DataFrame, first: int = 2000, last: int = 2025) -> DataFrame:
    """The figure's points: years within bounds, both included, on a logarithmic scale."""
    return per_year.where(F.col("publication_year").between(first, last)).withColumn("log10_n", F.round(F.log10("n"), 6))


def numbers_table(nodes: DataFrame, cut_off: int = CUT_OFF) -> DataFrame:
    """By sub message: rows, key papers, others, and others up to and after the cut-off year. Null conditions count nowhere."""
    other, year = ~F.col("oa_input"), F.col("publication_year")
    out = nodes.groupBy("sm").agg(
        F.count("*").alias("n"),
        F.count_if("oa_input").alias("n_key"),
        F.count_if(other).alias("n_non_key"),
        F.count_if(other & (year <= cut_off)).alias("n_nkp_pre"),
        F.count_if(other & (year > cut_off)).alias("n_nkp_post"),
    )
    return out.orderBy(F.asc_nulls_last("sm"))


def publication_types(nodes: DataFrame, *by: str, cut_off: int = CUT_OFF) -> DataFrame:
    """Nodes after the cut-off year by type, and by further columns; most frequent first."""
    keys = ["type", *by]
    out = nodes.where(F.col("publication_year") > cut_off).groupBy(*keys).agg(F.count("*").alias("n"))
    return out.orderBy(F.desc("n"), *[F.asc_nulls_last(k) for k in keys])


def _many(rows: DataFrame, message: str, more_than: int) -> DataFrame:
    """id, n and the messages of the works in more than so many rows: ids and messages only, counted before the shuffle."""
    per_id = rows.select("id", message).groupBy("id").agg(F.count("*").alias("n"), F.collect_list(message).alias("found"))
    return per_id.where(F.col("n") > more_than).select("id", "n", F.array_join(F.sort_array("found"), "|").alias(f"{message}s"))


def _overlap(rows: DataFrame, many: DataFrame, message: str, extra: list[str], works: DataFrame | None) -> DataFrame:
    """The works of `many`, each variant of the other columns a row of its own. n and the list belong to the id.

    Titles and texts are read in a second phase, of the works that are in enough rows only. Where they are in the rows, `many` is written first, so
    that Spark knows its size when it plans this phase: it is broadcast if it is small, and then no other work's texts leave their task.
    A table of works, which has each text once, is joined as Spark plans it.
    """
    if works is None:
        many, works = kept(many, "overlap"), rows
    shown = works.select("id", text.strip(F.col("doi"), text.DOI_PREFIX).alias("doi"), "author", "title", *extra).join(many, "id").distinct()
    out = shown.withColumn("id", text.anchor(F.col("id"), text.WORK_PREFIX)).withColumn("doi", text.anchor(F.col("doi"), text.DOI_PREFIX))
    out = out.select("id", "doi", "author", "title", *extra, "n", f"{message}s")
    return out.orderBy(F.desc("n"), "id", "author", "title", "doi")


def overlap_key_papers_sm(nodes: DataFrame, more_than: int = 1, works: DataFrame | None = None) -> DataFrame:
    """works: the texts by id, one row a work, where nodes are kept without them; else they are read from nodes, each variant of a work a row."""
    rows = nodes.where(F.col("oa_input") & F.col("id").isNotNull())
    return _overlap(rows, _many(rows, "sm", more_than), "sm", [], works)


def _recent(nodes: DataFrame, cut_off: int) -> Column:
    return ~F.col("oa_input") & F.col("id").isNotNull() & (F.col("publication_year") > cut_off)


def overlap_recent_sm(nodes: DataFrame, cut_off: int = CUT_OFF, more_than: int = 5, works: DataFrame | None = None) -> DataFrame:
    rows = nodes.where(_recent(nodes, cut_off))
    return _overlap(rows, _many(rows, "sm", more_than), "sm", [], works)


def overlap_recent_bm(nodes: DataFrame, cut_off: int = CUT_OFF, more_than: int = 5, works: DataFrame | None = None) -> DataFrame:
    """Counts distinct rows of work, message and text; they are told apart by a 128-bit hash, so that no text is shuffled for the counts."""
    rows = nodes.where(_recent(nodes, cut_off))
    if works is not None:
        return _overlap(rows, _many(rows.select("id", "bm").distinct(), "bm", more_than), "bm", ["abstract"], works.withColumn("abstract", F.col("ab")))
    rows = rows.withColumn("abstract", F.col("ab"))
    row = F.md5(F.to_json(F.struct("author", "title", "doi", "abstract")))
    return _overlap(rows, _many(rows.select("id", "bm", row.alias("row")).distinct(), "bm", more_than), "bm", ["abstract"], None)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """How many values a column has, null counting as one."""
    return df.select(column).distinct().agg(F.count("*").alias("n"))
