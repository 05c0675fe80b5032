"""The data model over the synthetic tables: nodes, edges, references and works, in Spark and in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.operators.snowball import distinct, tasks_for

CUT_OFF = 1998
SITE = "https://messages.example"
OVER_BM = 4
FIRST_YEAR, LAST_YEAR = 1996, 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each nation's background and sub message."""
    t = lambda name: table(spark, sf_dir, name)
    bm = F.concat(F.lit("bm-"), F.col("r_regionkey").cast("string"))
    place = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return place.select("n_nationkey", bm.alias("bm"), F.concat(bm, F.lit("-"), F.col("n_nationkey").cast("string")).alias("sm"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with the nation of their supplier."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return table(spark, sf_dir, "lineitem").join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))


def tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks for work on all lines, of which there are as many as the files' footers say."""
    return tasks_for(table(spark, sf_dir, "lineitem").count(), spark)


def part_columns() -> dict:
    key = F.col("p_partkey").cast("string")
    return {
        "id": F.concat(F.lit("W"), key),
        "author": F.col("p_brand"),
        "title": F.col("p_name"),
        "type": F.col("p_type"),
        "doi": F.when(F.col("p_size") % 10 == 0, None).otherwise(F.concat(F.lit("https://doi.org/10."), key)),
        "ab": F.when(F.col("p_size") % 7 == 0, None).otherwise(F.col("p_type")),
    }


def message_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (work, message, year, flag), without the works' texts. Lines are made distinct on whole numbers before they meet the messages."""
    year = F.when(F.col("l_linenumber") == 7, None).otherwise(F.year("l_shipdate").cast("long"))
    flag = F.when(F.col("l_tax") == 0.08, None).otherwise(F.col("l_discount") >= 0.09)
    lines = distinct(_lines(spark, sf_dir).select("l_partkey", "s_nationkey", year.alias("publication_year"), flag.alias("oa_input")), tasks(spark, sf_dir))
    id_ = F.concat(F.lit("W"), F.col("l_partkey").cast("string")).alias("id")
    return lines.join(_places(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")).select(id_, "publication_year", "oa_input", "bm", "sm", "l_partkey")


def work_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The works' texts, one row a work."""
    return table(spark, sf_dir, "part").select(*[c.alias(n) for n, c in part_columns().items()])


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    works = table(spark, sf_dir, "part").select("p_partkey", *[c.alias(n) for n, c in part_columns().items() if n != "id"])
    return message_nodes(spark, sf_dir).join(works, F.col("l_partkey") == F.col("p_partkey")).select("id", "author", "title", "type", "doi", "ab", "publication_year", "oa_input", "bm", "sm")


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a line: nearly all differ, and the snowball makes them distinct."""
    rows = _lines(spark, sf_dir).select("l_orderkey", "l_partkey", "s_nationkey").join(_places(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.select(F.concat(F.lit("O"), F.col("l_orderkey").cast("string")).alias("from"), F.concat(F.lit("W"), F.col("l_partkey").cast("string")).alias("to"), "bm", "sm")


def refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as references; their DOIs spread over as many numbers as there are parts and a quarter more, which no work has."""
    o = table(spark, sf_dir, "orders")
    numbers = table(spark, sf_dir, "part").agg(F.floor(F.count("*") * 1.25)).scalar()
    bm = F.concat(F.lit("bm-"), (F.col("o_custkey") % 5).cast("string"))
    return o.select(
        bm.alias("bm"),
        F.concat(bm, F.lit("-"), (F.col("o_custkey") % 25).cast("string")).alias("sm"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("zotero"),
        F.when(F.col("o_orderkey") % 10 == 0, "").otherwise(F.concat(F.lit("10."), (F.col("o_orderkey") % numbers).cast("string"))).alias("doi"),
        F.col("o_orderkey").alias("ref_no"),
    )


def works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as fetched works; only one has no DOI."""
    key = F.col("p_partkey").cast("string")
    doi = F.when(F.col("p_partkey") == 10, None).otherwise(F.concat(F.lit("https://doi.org/10."), key))
    return table(spark, sf_dir, "part").select(F.concat(F.lit("https://openalex.org/W"), key).alias("id"), doi.alias("doi"), F.col("p_name").alias("title"))


def citing_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as works that cite their lines' parts."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").repartition(tasks(spark, sf_dir), "l_orderkey")
    rows = lines.groupBy("l_orderkey").agg(F.collect_set(F.concat(F.lit("W"), F.col("l_partkey").cast("string"))).alias("referenced_works"))
    return rows.select(F.concat(F.lit("O"), F.col("l_orderkey").cast("string")).alias("id"), "referenced_works")


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The works flagged as key papers."""
    return nodes(spark, sf_dir).where("oa_input").select("id").distinct()


def raw_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the reference list comes: messages and DOIs as URLs, blank fields, missing ones, quotes and line breaks."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.cast("string").alias(""),
        F.concat(F.lit(f"{SITE}/report/bgm/"), (F.col("o_custkey") % 5).cast("string")).alias("Background Message"),
        F.concat(F.lit(f"{SITE}/report/subm/"), (F.col("o_custkey") % 5).cast("string"), F.lit("-"), (F.col("o_custkey") % 25).cast("string")).alias("Sub Message"),
        F.when(key % 3 == 0, "").otherwise(F.col("o_orderpriority")).alias("Level if Confidence"),
        F.when(key % 7 == 0, None).otherwise(F.concat(F.lit("z"), (key % 100).cast("string"))).alias("zotero"),
        F.when(key % 10 == 0, "").otherwise(F.concat(F.lit("https://doi.org/10."), (key % 100).cast("string"))).alias("doi"),
        F.concat(F.lit('said "'), F.col("o_orderpriority"), F.lit('",\nagain')).alias("description"),
    )


NODES = """nodes AS (SELECT DISTINCT concat('W', CAST(p_partkey AS VARCHAR)) AS id, p_brand AS author, p_name AS title, p_type AS type,
  CASE WHEN p_size % 10 = 0 THEN NULL ELSE concat('https://doi.org/10.', CAST(p_partkey AS VARCHAR)) END AS doi,
  CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_type END AS ab,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(year(l_shipdate) AS BIGINT) END AS publication_year,
  CASE WHEN l_tax = 0.08 THEN NULL ELSE l_discount >= 0.09 END AS oa_input,
  concat('bm-', CAST(r_regionkey AS VARCHAR)) AS bm, concat('bm-', CAST(r_regionkey AS VARCHAR), '-', CAST(n_nationkey AS VARCHAR)) AS sm
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

EDGES = """edges AS (SELECT DISTINCT concat('O', CAST(l_orderkey AS VARCHAR)) AS "from", concat('W', CAST(l_partkey AS VARCHAR)) AS "to",
  concat('bm-', CAST(r_regionkey AS VARCHAR)) AS bm, concat('bm-', CAST(r_regionkey AS VARCHAR), '-', CAST(n_nationkey AS VARCHAR)) AS sm
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

REFS = """refs AS (SELECT concat('bm-', CAST(o_custkey % 5 AS VARCHAR)) AS bm, concat('bm-', CAST(o_custkey % 5 AS VARCHAR), '-', CAST(o_custkey % 25 AS VARCHAR)) AS sm,
  nullif(o_orderpriority, '5-LOW') AS zotero, CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE concat('10.', CAST(o_orderkey % (SELECT CAST(floor(count(*) * 1.25) AS BIGINT) FROM part) AS VARCHAR)) END AS doi,
  o_orderkey AS ref_no FROM orders)"""

WORKS = """works AS (SELECT concat('https://openalex.org/W', CAST(p_partkey AS VARCHAR)) AS id,
  CASE WHEN p_partkey = 10 THEN NULL ELSE concat('https://doi.org/10.', CAST(p_partkey AS VARCHAR)) END AS doi, p_name AS title FROM part)"""

KEY_WORKS = f"""{REFS}, {WORKS}, key_works AS (SELECT r.bm, r.sm, r.zotero, r.doi, r.ref_no, w.id, w.title FROM (SELECT bm, sm, zotero,
  CASE WHEN doi = '' THEN NULL ELSE concat('https://doi.org/', doi) END AS doi, ref_no FROM refs) r LEFT JOIN works w ON r.doi IS NOT DISTINCT FROM w.doi)"""

HOP = f"""{NODES}, seeds AS (SELECT DISTINCT id FROM nodes WHERE oa_input),
cites AS (SELECT DISTINCT concat('O', CAST(l_orderkey AS VARCHAR)) AS "from", concat('W', CAST(l_partkey AS VARCHAR)) AS "to" FROM lineitem),
hop AS (SELECT * FROM cites WHERE "from" IN (SELECT id FROM seeds) OR "to" IN (SELECT id FROM seeds))"""
