"""Every query by name, with the DuckDB SQL that gives the same rows."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeloom.functions import formats, text
from citeloom.operators import edits, grid, ingest, linked, reports, snowball
from citeloom.operators.key_counts import KeyCounts
from citeloom.operators.pages import PageIndex
from citeloom.operators.search_index import SearchIndex
from citeloom.plans import bindings as b
from citeloom.schemas import NODES
from citeloom.session import delete, overwrite, shared_dir, until_exit
from citeloom.sources import datasets, payload, refs, works_pages
from citeloom.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return add


# reports


@query(f"WITH {b.NODES} SELECT sm, publication_year, count(*) AS n FROM nodes GROUP BY sm, publication_year")
def refs_per_year_sm(spark: SparkSession, d: str) -> DataFrame:
    return reports.refs_per_year_sm(b.nodes(spark, d))


@query(f"""WITH {b.NODES} SELECT sm, publication_year, count(*) AS n, round(log10(count(*)), 6) AS log10_n FROM nodes
WHERE publication_year BETWEEN {b.FIRST_YEAR} AND {b.LAST_YEAR} GROUP BY sm, publication_year""")
def plot_points(spark: SparkSession, d: str) -> DataFrame:
    return reports.plot_points(reports.refs_per_year_sm(b.nodes(spark, d)), b.FIRST_YEAR, b.LAST_YEAR)


@query(f"""WITH {b.NODES} SELECT sm, count(*) AS n, count(*) FILTER (oa_input) AS n_key, count(*) FILTER (NOT oa_input) AS n_non_key,
count(*) FILTER (NOT oa_input AND publication_year <= {b.CUT_OFF}) AS n_nkp_pre,
count(*) FILTER (NOT oa_input AND publication_year > {b.CUT_OFF}) AS n_nkp_post FROM nodes GROUP BY sm""")
def numbers_table(spark: SparkSession, d: str) -> DataFrame:
    return reports.numbers_table(b.nodes(spark, d), b.CUT_OFF)


@query(f"WITH {b.NODES} SELECT type, count(*) AS n FROM nodes WHERE publication_year > {b.CUT_OFF} GROUP BY type")
def publication_types(spark: SparkSession, d: str) -> DataFrame:
    return reports.publication_types(b.nodes(spark, d), cut_off=b.CUT_OFF)


@query(f"WITH {b.NODES} SELECT type, bm, count(*) AS n FROM nodes WHERE publication_year > {b.CUT_OFF} GROUP BY type, bm")
def publication_types_by_bm(spark: SparkSession, d: str) -> DataFrame:
    return reports.publication_types(b.nodes(spark, d), "bm", cut_off=b.CUT_OFF)


def _overlap_sql(rows: str, message: str, extra: str, over: int) -> str:
    def link(c: str, prefix: str) -> str:
        return f"""concat('<a href="{prefix}', coalesce({c}, 'NA'), '" target="_blank">', coalesce({c}, 'NA'), '</a>')"""

    return f"""WITH {b.NODES}, chosen AS ({rows}),
listed AS (SELECT id, regexp_replace(doi, 'https://doi.org/', '', 'g') AS doi, author, title{extra}, count(*) OVER (PARTITION BY id) AS n,
  array_to_string(list_sort(list({message}) OVER (PARTITION BY id)), '|') AS {message}s FROM chosen)
SELECT DISTINCT {link('id', text.WORK_PREFIX)} AS id, {link('doi', text.DOI_PREFIX)} AS doi, author, title{extra}, n, {message}s FROM listed WHERE n > {over}"""


_RECENT = f"NOT oa_input AND id IS NOT NULL AND publication_year > {b.CUT_OFF}"


@query(_overlap_sql("SELECT * FROM nodes WHERE oa_input AND id IS NOT NULL", "sm", "", 1))
def overlap_key_papers_sm(spark: SparkSession, d: str) -> DataFrame:
    return reports.overlap_key_papers_sm(b.message_nodes(spark, d), works=b.work_texts(spark, d))


@query(_overlap_sql(f"SELECT * FROM nodes WHERE {_RECENT}", "sm", "", 5))
def overlap_recent_sm(spark: SparkSession, d: str) -> DataFrame:
    return reports.overlap_recent_sm(b.message_nodes(spark, d), b.CUT_OFF, works=b.work_texts(spark, d))


@query(_overlap_sql(f"SELECT DISTINCT author, title, doi, bm, id, ab AS abstract FROM nodes WHERE {_RECENT}", "bm", ", abstract", b.OVER_BM))
def overlap_recent_bm(spark: SparkSession, d: str) -> DataFrame:
    return reports.overlap_recent_bm(b.message_nodes(spark, d), b.CUT_OFF, b.OVER_BM, works=b.work_texts(spark, d))


@query(f"WITH {b.REFS} SELECT count(*) AS n FROM (SELECT DISTINCT zotero FROM refs)")
def key_paper_count(spark: SparkSession, d: str) -> DataFrame:
    return reports.distinct_values(b.refs(spark, d), "zotero")


@query(f"WITH {b.NODES} SELECT count(*) AS n FROM (SELECT DISTINCT id FROM nodes WHERE oa_input)")
def usable_key_paper_count(spark: SparkSession, d: str) -> DataFrame:
    return reports.distinct_values(b.nodes(spark, d).where("oa_input"), "id")


# snowballs


def _snowball(which: str, part: str, sql: str, **filters: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return getattr(snowball.snowball(b.nodes(spark, d), b.edges(spark, d), collect=False, tasks=b.tasks(spark, d), **filters), part)

    run.__name__ = f"snowball_{which}" + ("_edges" if part == "edges" else "")
    query(sql)(run)


for _which, _filters, _where in (("all", {}, "true"), ("by_sm", {"sub_message": "bm-1-1"}, "sm = 'bm-1-1'"), ("by_bm", {"background_message": "bm-3"}, "bm = 'bm-3'")):
    _snowball(_which, "nodes", f"WITH {b.NODES} SELECT * FROM nodes WHERE {_where}", **_filters)
    _snowball(_which, "edges", f"WITH {b.EDGES} SELECT * FROM edges WHERE {_where}", **_filters)


@query(f"""WITH {b.HOP} SELECT * FROM hop""")
def snowball_edges(spark: SparkSession, d: str) -> DataFrame:
    return snowball.snowball_edges(b.seeds(spark, d), b.citing_works(spark, d), b.tasks(spark, d))


@query(f"""WITH {b.HOP}, ends AS (SELECT id FROM seeds UNION SELECT "from" FROM hop UNION SELECT "to" FROM hop)
SELECT id, id IN (SELECT id FROM seeds) AS oa_input FROM ends""")
def snowball_nodes(spark: SparkSession, d: str) -> DataFrame:
    s = b.seeds(spark, d)
    return snowball.snowball_nodes(s, snowball.snowball_edges(s, b.citing_works(spark, d), b.tasks(spark, d)))


@query("""SELECT DISTINCT * FROM (SELECT concat('W', CAST(p_partkey AS VARCHAR)) AS id, p_name AS title, NULL AS ab, p_type AS type FROM part WHERE p_size <= 30
UNION ALL SELECT concat('W', CAST(p_partkey AS VARCHAR)), p_name, p_brand, NULL FROM part WHERE p_size > 20)""")
def nodes_union(spark: SparkSession, d: str) -> DataFrame:
    part = b.table(spark, d, "part")
    cols = (F.concat(F.lit("W"), F.col("p_partkey").cast("string")).alias("id"), F.col("p_name").alias("title"))
    first = part.where("p_size <= 30").select(*cols, F.col("p_type").alias("type"), F.array("p_size").alias("concepts"))
    second = part.where("p_size > 20").select(*cols, F.col("p_brand").alias("ab"))
    return snowball.union_nodes(first, second)


@query(f"WITH {b.NODES} SELECT DISTINCT sm, regexp_extract(sm, '^[^-]*-[^-]*') AS bm FROM nodes")
def bm_from_sm(spark: SparkSession, d: str) -> DataFrame:
    return snowball.tagged(b.nodes(spark, d).select("sm").distinct())


@query(f"WITH {b.REFS} SELECT DISTINCT sm FROM refs")
def sub_messages(spark: SparkSession, d: str) -> DataFrame:
    return b.refs(spark, d).select("sm").distinct()


@query(f"""WITH {b.NODES} SELECT id, doi, author, title, ab, type, CAST(publication_year AS INTEGER) AS publication_year, oa_input, bm, sm FROM nodes""")
def nodes_scan(spark: SparkSession, d: str) -> DataFrame:
    """Written by message and read back."""
    path = f"{shared_dir(spark)}/nodes-{uuid.uuid4().hex}"
    datasets.write_partitioned(b.nodes(spark, d).withColumn("publication_year", F.col("publication_year").cast("int")), path)
    return datasets.read_nodes(spark, until_exit(spark, path))


@query("SELECT 'W' AS side, p_partkey AS id, 2 AS built FROM part UNION ALL SELECT 'O', o_orderkey, 2 FROM orders")
def built_tables(spark: SparkSession, d: str) -> DataFrame:
    """Two stored tables, built together if either isn't there: a first call builds them, the next reads them, and once one is half written a third builds both again."""
    base, built = until_exit(spark, f"{shared_dir(spark)}/built-{uuid.uuid4().hex}"), []

    def build() -> list[DataFrame]:
        built.append(1)
        tables = (("W", "part", "p_partkey"), ("O", "orders", "o_orderkey"))
        return [b.table(spark, d, t).select(F.lit(side).alias("side"), F.col(key).alias("id"), F.lit(len(built)).alias("built")) for side, t, key in tables]

    for _ in range(2):
        datasets.materialize_all(spark, [f"{base}/works", f"{base}/orders"], build)
    delete(spark, f"{base}/orders/_SUCCESS")
    works, orders = datasets.materialize_all(spark, [f"{base}/works", f"{base}/orders"], build)
    return works.unionAll(orders)


# ingestion


@query(f"""WITH {b.KEY_WORKS} SELECT regexp_replace(id, 'https://openalex.org/', '', 'g') AS id, array_to_string(list_sort(list(bm)), '|') AS bms FROM key_works GROUP BY 1""")
def messages_per_work(spark: SparkSession, d: str) -> DataFrame:
    out = ingest.messages_per_work(ingest.key_works(b.refs(spark, d), b.works(spark, d)))
    return out.select("id", F.array_join("bms", "|").alias("bms"))


@query(f"WITH {b.KEY_WORKS} SELECT * FROM key_works")
def key_works_left_join(spark: SparkSession, d: str) -> DataFrame:
    return ingest.key_works(b.refs(spark, d), b.works(spark, d))


@query(f"WITH {b.REFS}, {b.WORKS} SELECT * FROM works WHERE doi IN (SELECT concat('https://doi.org/', doi) FROM refs WHERE doi <> '')")
def works_lookup(spark: SparkSession, d: str) -> DataFrame:
    return ingest.works_lookup(b.works(spark, d), b.refs(spark, d))


@query(f"""SELECT DISTINCT CAST(o_custkey % 5 AS VARCHAR) AS bm, concat(CAST(o_custkey % 5 AS VARCHAR), '-', CAST(o_custkey % 25 AS VARCHAR)) AS sm,
CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS loc, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE concat('z', CAST(o_orderkey % 100 AS VARCHAR)) END AS zotero,
CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE concat('10.', CAST(o_orderkey % 100 AS VARCHAR)) END AS doi, concat('said "', o_orderpriority, '",', chr(10), 'again') AS citation FROM orders""")
def tidy_refs(spark: SparkSession, d: str) -> DataFrame:
    """The reference list written as CSV, read and tidied."""
    path = f"{shared_dir(spark)}/refs-{uuid.uuid4().hex}"
    b.raw_refs(spark, d).write.csv(path, header=True, quote='"', escape='"', nullValue="NA", emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return refs.tidy_refs(refs.read_refs_raw(spark, until_exit(spark, path)), f"^{b.SITE}/report/bgm/", f"^{b.SITE}/report/subm/")


@query("""SELECT n_nationkey, CASE count(s_name) WHEN 0 THEN NULL WHEN 1 THEN min(s_name) WHEN 2 THEN concat(min(s_name), ' & ', max(s_name)) ELSE concat(min(s_name), ' et al.') END AS author
FROM nation LEFT JOIN supplier ON n_nationkey = s_nationkey GROUP BY n_nationkey""")
def short_authors(spark: SparkSession, d: str) -> DataFrame:
    """A nation's suppliers as a work's authors."""
    rows = b.table(spark, d, "nation").join(b.table(spark, d, "supplier"), F.col("n_nationkey") == F.col("s_nationkey"), "left")
    # three names are all that the short form looks at; each task keeps a nation's three first
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("n_nationkey").orderBy("s_name"))).where("place <= 3")
    names = F.array_sort(F.collect_list(F.when(F.col("s_name").isNotNull(), F.struct(F.col("s_name").alias("name")))))
    return rows.groupBy("n_nationkey").agg(names.alias("authors")).select("n_nationkey", text.abbreviate_authors(F.col("authors")).alias("author"))


@query("SELECT p_partkey, p_name, p_size FROM part")
def json_payload(spark: SparkSession, d: str) -> DataFrame:
    """A brand's parts as payloads of columns, each of at most so many rows, read back."""
    sent = payload.payload_chunks(b.table(spark, d, "part"), "p_brand", ["p_partkey", "p_name", "p_size"], ["p_partkey"])
    return payload.read_payload(sent, "json", b.table(spark, d, "part").select("p_partkey", "p_name", "p_size").schema)


@query("SELECT p_partkey, concat(p_name, '.', p_brand) AS first, p_type AS second FROM part")
def split_escaped(spark: SparkSession, d: str) -> DataFrame:
    parts = text.split_escaped(F.concat("p_name", F.lit("\\."), "p_brand", F.lit("."), "p_type"))
    return b.table(spark, d, "part").select("p_partkey", parts[0].alias("first"), parts[1].alias("second"))


@query("SELECT concat('W', CAST(p_partkey AS VARCHAR)) AS id, CASE WHEN p_size <= 25 THEN p_name END AS title, CASE WHEN p_size > 25 THEN p_type END AS type FROM part")
def existing_tables(spark: SparkSession, d: str) -> DataFrame:
    """Two tables with different columns, one that is missing and one that is broken."""
    base, part = f"{shared_dir(spark)}/existing-{uuid.uuid4().hex}", b.table(spark, d, "part").withColumn("id", F.concat(F.lit("W"), F.col("p_partkey").cast("string")))
    part.where("p_size <= 25").select("id", F.col("p_name").alias("title")).write.parquet(f"{base}/titles")
    part.where("p_size > 25").select("id", F.col("p_type").alias("type")).write.parquet(f"{base}/types")
    spark.range(1).select(F.lit("no table").alias("value")).write.text(f"{base}/broken")
    until_exit(spark, base)
    found = datasets.read_existing(spark, [f"{base}/{n}" for n in ("titles", "none", "types", "broken")], NODES)
    return found.rows.select("id", "title", "type")


@query("SELECT concat('W', CAST(p_partkey AS VARCHAR)) AS id, p_name AS title FROM part WHERE p_size <= 40")
def broken_files(spark: SparkSession, d: str) -> DataFrame:
    """A table some of whose files break after it was written: the rows of the others, and the names of all that broke."""
    base, part = until_exit(spark, f"{shared_dir(spark)}/broken-{uuid.uuid4().hex}"), b.table(spark, d, "part")
    id_, file = F.concat(F.lit("W"), F.col("p_partkey").cast("string")).alias("id"), F.col("_metadata.file_path").alias("file")
    part.where("p_size <= 40").select(id_, F.col("p_name").alias("title")).write.parquet(base)
    before = {r["file"] for r in spark.read.format("binaryFile").load(base).select(file).collect()}
    part.where("p_size > 40").select(id_, F.col("p_name").alias("title")).repartition(2).write.mode("append").parquet(base)
    broken = {r["file"] for r in spark.read.format("binaryFile").load(base).select(file).collect()} - before
    for f in broken:
        overwrite(spark, f, b"PAR1 half a file")
    found = datasets.read_existing(spark, [base], NODES)
    if {x.file for x in found.lost} != broken:
        raise ValueError(f"broken: {sorted(broken)}, named: {found.lost}")
    return found.rows.select("id", "title")


@query(f"WITH {b.REFS}, {b.WORKS} SELECT * FROM works WHERE doi IN (SELECT concat('https://doi.org/', doi) FROM refs WHERE doi <> '')")
def works_from_pages(spark: SparkSession, d: str) -> DataFrame:
    """The lookup over pages of JSON works, which answer a filter on DOIs themselves."""
    folder, works = until_exit(spark, f"{shared_dir(spark)}/works-{uuid.uuid4().hex}"), b.works(spark, d)
    works.write.json(folder)
    return works_pages.fetch_works(works_pages.read_works(spark, folder, works.schema), b.refs(spark, d))


@query("""SELECT event_id, user_id, c_name FROM events JOIN customer ON c_custkey = user_id""")
def ingested_events(spark: SparkSession, d: str) -> DataFrame:
    """Events that come in three parts, each to be joined with its customer. Half of the customers come late, so their events fail at first and are tried again;
    one run is cut off after its results were written, and is repeated."""
    base, events, customers = until_exit(spark, f"{shared_dir(spark)}/ingested-{uuid.uuid4().hex}"), b.table(spark, d, "events").select("event_id", "user_id"), b.table(spark, d, "customer").select("c_custkey", "c_name")
    known = [customers.where("c_custkey % 2 = 0")]

    def work(rows: DataFrame) -> DataFrame:
        joined = rows.join(known[0], F.col("user_id") == F.col("c_custkey"), "left").drop("c_custkey")
        return joined.withColumn("error", F.when(F.col("c_name").isNull(), "no such customer"))

    ingestion = incremental.Ingestion(spark, f"{base}/in", events.schema, base, work)
    for part in range(3):
        events.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == part).write.mode("append").parquet(f"{base}/in")
        if part == 1:
            cut_off = incremental.Ingestion(spark, f"{base}/in", events.schema, base, work)
            cut_off.after_write = lambda: 1 / 0
            try:
                cut_off.run()
            except StreamingQueryException:
                known[0] = customers
        ingestion.run()
    ingestion.retry()
    return ingestion.done()


@query(f"""WITH {b.REFS}, {b.WORKS} SELECT 'ref' AS side, CAST(ref_no AS VARCHAR) AS member FROM refs WHERE doi = '' UNION ALL SELECT 'work', id FROM works WHERE doi IS NULL""")
def null_doi_groups(spark: SparkSession, d: str) -> DataFrame:
    """The two groups that a null DOI links, instead of all their pairs."""
    found = ingest.key_works_grouped(b.refs(spark, d), b.works(spark, d))
    return found.refs.select(F.lit("ref").alias("side"), F.col("ref_no").cast("string").alias("member")).unionAll(found.works.select(F.lit("work"), "id"))


@query("SELECT page_id, regexp_replace(url, 'https?://', '', 'g') AS url FROM pages")
def strip_url_prefix(spark: SparkSession, d: str) -> DataFrame:
    return b.table(spark, d, "pages").select("page_id", text.strip(F.col("url"), "https?://").alias("url"))


# grid


@query("SELECT event_id, value FROM events WHERE value BETWEEN 10.0 AND 50.0")
def grid_range_filter(spark: SparkSession, d: str) -> DataFrame:
    low, high = grid.parse_range("10 ... 50", 0, 0)
    return b.table(spark, d, "events").where(grid.range_filter(F.col("value"), low, high)).select("event_id", "value")


@query("SELECT event_id, event_type FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'")
def grid_date_filter(spark: SparkSession, d: str) -> DataFrame:
    return b.table(spark, d, "events").where(grid.date_filter(F.col("ts"), datetime.date(2024, 1, 5), datetime.date(2024, 1, 20))).select("event_id", "event_type")


@query("SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= (SELECT max(CAST(CAST(ts AS DATE) AS TIMESTAMP)) FROM events)")
def grid_date_range(spark: SparkSession, d: str) -> DataFrame:
    """The range as a text with an open end, which is the column's last day."""
    events = b.table(spark, d, "events")
    days = events.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    return events.where(grid.date_filter(F.col("ts"), *grid.parse_date_range("2024-01-05 ... ", *days))).select("event_id", "event_type")


@query("SELECT event_id, value FROM events")
def grid_full_range(spark: SparkSession, d: str) -> DataFrame:
    """A range over all of a column is no filter."""
    events = b.table(spark, d, "events")
    least, most = grid.column_stats(events, ["value"]).first()
    return events.where(grid.range_filter(F.col("value"), *grid.parse_range("...", least, most), least, most)).select("event_id", "value")


@query("""WITH r AS (SELECT min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part WHERE p_size <= 25)
SELECT p_partkey, p_retailprice FROM part, r WHERE p_retailprice BETWEEN least(greatest(950.0, lo), hi) AND greatest(least(2000.0, hi), lo)""")
def grid_clipped_range(spark: SparkSession, d: str) -> DataFrame:
    """A user's range within new limits."""
    part = b.table(spark, d, "part")
    limits = grid.column_stats(part.where("p_size <= 25"), ["p_retailprice"]).first()
    return part.where(grid.range_filter(F.col("p_retailprice"), *grid.clip_range(950.0, 2000.0, *limits))).select("p_partkey", "p_retailprice")


@query("SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase')")
def grid_factor_filter(spark: SparkSession, d: str) -> DataFrame:
    return b.table(spark, d, "events").where(grid.factor_filter(F.col("event_type"), ["click", "purchase"])).select("event_id", "event_type")


@query(f"WITH {b.NODES} SELECT id, sm, oa_input FROM nodes WHERE oa_input OR oa_input IS NULL")
def grid_logical_filter(spark: SparkSession, d: str) -> DataFrame:
    return b.nodes(spark, d).where(grid.logical_filter(F.col("oa_input"), ["true", "na"])).select("id", "sm", "oa_input")


@query("""SELECT p_partkey, p_name, p_brand FROM part WHERE contains(lower(p_name), 'a') AND contains(lower(p_name), 'e')
AND regexp_matches(p_type, '(?i)steel|brass|o') AND contains(lower(concat(CAST(p_partkey AS VARCHAR), '  ', p_name, '  ', p_brand)), '1')""")
def grid_smart_search(spark: SparkSession, d: str) -> DataFrame:
    where = grid.search(F.col("p_name"), "A e") & grid.search(F.col("p_type"), "steel|brass|o", regex=True) & grid.search_all(["p_partkey", "p_name", "p_brand"], "1")
    return b.table(spark, d, "part").where(where).select("p_partkey", "p_name", "p_brand")


@query("SELECT p_partkey, p_size, row_number FROM (SELECT p_partkey, p_size, row_number() OVER (ORDER BY p_size DESC, p_partkey) AS row_number FROM part) WHERE row_number BETWEEN 21 AND 30")
def grid_page(spark: SparkSession, d: str) -> DataFrame:
    return grid.page(b.table(spark, d, "part").select("p_partkey", "p_size"), [F.desc("p_size"), F.asc("p_partkey")], 3, 10).rows


@query("SELECT p_partkey, p_size, row_number() OVER (ORDER BY p_size DESC, p_partkey) AS row_number FROM part")
def grid_row_numbers(spark: SparkSession, d: str) -> DataFrame:
    return grid.page(b.table(spark, d, "part").select("p_partkey", "p_size"), [F.desc("p_size"), F.asc("p_partkey")], 1, 10).matching


@query("SELECT p_partkey, p_size, row_number FROM (SELECT p_partkey, p_size, row_number() OVER (ORDER BY p_size, p_partkey DESC) AS row_number FROM part) WHERE row_number BETWEEN 15 AND 40")
def grid_shift_rows(spark: SparkSession, d: str) -> DataFrame:
    """A shift selection from the later row to the earlier one."""
    return grid.between_rows(PageIndex(b.table(spark, d, "part").select("p_partkey", "p_size"), [F.asc("p_size"), F.desc("p_partkey")]), 40, 15)


@query("""WITH n AS (SELECT count(*) // 20 AS k FROM part)
SELECT p_partkey, p_size, row_number FROM (SELECT p_partkey, p_size, row_number() OVER (ORDER BY p_size DESC, p_partkey) AS row_number FROM part), n WHERE row_number BETWEEN (k - 1) * 10 + 1 AND k * 10""")
def grid_deep_page(spark: SparkSession, d: str) -> DataFrame:
    """The page in the middle of the table, by an index that is gone afterwards."""
    with PageIndex(b.table(spark, d, "part").select("p_partkey", "p_size"), [F.desc("p_size"), F.asc("p_partkey")]) as index:
        return index.copy_of_page(index.n // 20, 10)


@query("""SELECT p_partkey, p_name, p_brand FROM part WHERE contains(lower(p_name), 'red') AND contains(lower(p_name), 'olt')
UNION ALL SELECT p_partkey, p_name, p_brand FROM part WHERE contains(lower(concat(p_name, '  ', p_brand)), 'blue') AND contains(lower(concat(p_name, '  ', p_brand)), 'brand#2')""")
def grid_indexed_search(spark: SparkSession, d: str) -> DataFrame:
    """Smart search in a column, then global search, both by trigrams."""
    index = SearchIndex(b.table(spark, d, "part").select("p_partkey", "p_name", "p_brand"), "p_partkey", ["p_name", "p_brand"])
    return index.search("p_name", "Red olt").unionAll(index.search_all("BLUE brand#2"))


@query("""SELECT p_partkey, 'p_brand' AS "column", p_brand AS value FROM part WHERE p_size = 7
UNION ALL SELECT p_partkey, 'p_size', CAST(p_size AS VARCHAR) FROM part WHERE p_size IN (7, 8)""")
def grid_selected_cells(spark: SparkSession, d: str) -> DataFrame:
    part = b.table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    brands, sizes = part.where("p_size = 7").select("p_partkey", F.lit("p_brand").alias("column")), part.where("p_size in (7, 8)").select("p_partkey", F.lit("p_size").alias("column"))
    return grid.selected_cells(part, "p_partkey", brands.unionByName(sizes).unionByName(sizes))


@query("""SELECT p_partkey, 'p_brand' AS "column", p_brand AS value FROM part WHERE p_size = 9 UNION ALL SELECT p_partkey, 'p_size', CAST(p_size AS VARCHAR) FROM part""")
def grid_selected_rows_and_columns(spark: SparkSession, d: str) -> DataFrame:
    part = b.table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    return grid.selected_both(part, "p_partkey", part.where("p_size = 9"), ["p_size"])


@query("""SELECT p_partkey, CASE WHEN p_size < 5 THEN concat('new ', p_name) ELSE p_name END AS p_name, CASE WHEN p_size = 3 THEN NULL WHEN p_size > 45 THEN p_size + 1 ELSE p_size END AS p_size FROM part""")
def grid_edits(spark: SparkSession, d: str) -> DataFrame:
    part = b.table(spark, d, "part").select("p_partkey", "p_name", "p_size")
    cells = part.where("p_size < 5").select("p_partkey", F.lit("p_name").alias("column"), F.concat(F.lit("new "), "p_name").alias("value"))
    emptied = part.where("p_size = 3").select("p_partkey", F.lit("p_size").alias("column"), F.lit(None).cast("string").alias("value"))
    part = grid.edit_cells(part, "p_partkey", cells.unionByName(emptied))
    return grid.edit_column(part, "p_partkey", "p_size", part.where("p_size > 45").select("p_partkey", (F.col("p_size") + 1).alias("value")))


@query("""SELECT p_partkey, CASE WHEN p_size <= 20 THEN 'edited' ELSE p_brand END AS p_brand FROM part UNION ALL SELECT -1, 'added'""")
def grid_edit_all(spark: SparkSession, d: str) -> DataFrame:
    part = b.table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    out = grid.edit_all(part, "p_partkey", part.where("p_size <= 20").withColumn("p_brand", F.lit("edited")))
    return grid.add_row(grid.show(out, hide=("p_size",)), [-1, "added"])


@query("""SELECT CASE WHEN p_partkey = 7 THEN -7 ELSE p_partkey END AS p_partkey, CASE WHEN p_partkey = 7 THEN 'seven' WHEN p_partkey = 9 THEN 'again' WHEN p_size < 5 THEN concat('new ', p_name) ELSE p_name END AS p_name,
CASE WHEN p_partkey = 7 THEN 70 WHEN p_partkey = 9 OR p_size = 3 THEN NULL WHEN p_size > 45 THEN p_size + 1 ELSE p_size END AS p_size FROM part WHERE p_size <> 11 OR p_partkey IN (7, 9)
UNION ALL SELECT -1, 'added', 5""")
def grid_edit_log(spark: SparkSession, d: str) -> DataFrame:
    """Edits of every kind through one log: cells, a column, rows with their key, rows removed, added, and added again."""
    part = b.table(spark, d, "part").select("p_partkey", "p_name", "p_size")
    log = edits.EditLog(spark, part.columns, "p_partkey")
    log.cells(part.where("p_size < 5").select("p_partkey", F.lit("p_name").alias("column"), F.concat(F.lit("new "), "p_name").alias("value")))
    log.rows(part.where("p_size = 3").withColumn("p_name", F.concat(F.lit("new "), "p_name")).withColumn("p_size", F.lit(None).cast("int")))
    log.column("p_size", part.where("p_size > 45").select("p_partkey", (F.col("p_size") + 1).alias("value")))
    log.row(7, {"p_partkey": -7, "p_name": "seven", "p_size": 70})
    log.remove(part.where("p_size = 11 and p_partkey not in (7, 9) or p_partkey = 9").select("p_partkey"))
    log.add(spark.createDataFrame([(-1, "first", 5)], part.schema))
    log.cell(-1, "p_name", "added")
    log.compact()
    log.add(spark.createDataFrame([(9, "again", None)], part.schema))
    return log.apply(part)


@query("SELECT p_partkey FROM part WHERE p_size > 30 AND p_brand < 'Brand#3'")
def grid_reload(spark: SparkSession, d: str) -> DataFrame:
    """What is left of a selection when the table is read anew with fewer rows."""
    part = b.table(spark, d, "part")
    return grid.reload(part.where("p_size > 30"), "p_partkey", part.where("p_brand < 'Brand#3'").select("p_partkey"))[1]


@query("SELECT p_partkey, regexp_replace(p_name, '(red|a)', '<mark>\\1</mark>', 'gi') AS p_name FROM part")
def grid_highlight(spark: SparkSession, d: str) -> DataFrame:
    return b.table(spark, d, "part").select("p_partkey", grid.highlighted(F.col("p_name"), "a red").alias("p_name"))


@query("""SELECT p_brand AS "group", row_number() OVER (PARTITION BY p_brand ORDER BY p_name, p_partkey) = 1 AS group_start, p_partkey, p_name FROM part""")
def grid_row_groups(spark: SparkSession, d: str) -> DataFrame:
    return grid.row_groups(b.table(spark, d, "part").select("p_partkey", "p_brand", "p_name"), "p_brand", [F.col("p_name"), F.col("p_partkey")])


@query("SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS steps, printf('%.1f', l_quantity) AS shown FROM lineitem")
def grid_fixed_scale(spark: SparkSession, d: str) -> DataFrame:
    quantity = formats.unscaled(formats.rescaled(F.col("l_quantity"), 1), 1)
    return b.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", formats.rescaled(F.col("l_extendedprice"), 2).alias("steps"), quantity.alias("shown"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey < 10 THEN printf('%.2f', CAST(o_orderkey AS DOUBLE)) WHEN o_orderkey < 100 THEN printf('%.1f', CAST(o_orderkey AS DOUBLE)) WHEN o_orderkey < 1000 THEN CAST(o_orderkey AS VARCHAR)
ELSE concat(left(CAST(o_orderkey AS VARCHAR), 1), '.', substr(CAST(o_orderkey AS VARCHAR), 2, 2), 'e+', CAST(length(CAST(o_orderkey AS VARCHAR)) - 1 AS VARCHAR)) END AS shown
FROM (SELECT CASE WHEN o_orderkey < 1000 THEN o_orderkey ELSE o_orderkey - o_orderkey % CAST(pow(10, length(CAST(o_orderkey AS VARCHAR)) - 3) AS BIGINT) END AS o_orderkey FROM orders)""")
def grid_significant(spark: SparkSession, d: str) -> DataFrame:
    """Order keys with three significant digits, those above 999 cut to three before."""
    key = F.col("o_orderkey")
    cut = F.when(key < 1000, key).otherwise(key - key % F.pow(F.lit(10), F.length(key.cast("string")) - 3).cast("long"))
    return b.table(spark, d, "orders").select(cut.alias("o_orderkey")).select("o_orderkey", formats.precise(F.col("o_orderkey"), 3).alias("shown"))


@query("SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_discount >= 0.1) AND p_partkey NOT IN (3, 5, 8)")
def grid_selected_rows(spark: SparkSession, d: str) -> DataFrame:
    keys = b.table(spark, d, "lineitem").where("l_discount >= 0.1").select(F.col("l_partkey").alias("p_partkey"))
    part = grid.selectable(b.table(spark, d, "part"), "p_partkey", [-3, -5, -8])
    return grid.selected(part, "p_partkey", keys).select("p_partkey", "p_name")


@query("""SELECT l_orderkey, l_linenumber, format('{:,.1f}', l_extendedprice) AS rounded, concat(format('{:,.0f}', l_discount * 100), '%') AS percent,
concat(CASE WHEN l_extendedprice < 0 THEN '-' ELSE '' END, '$', format('{:,.2f}', abs(l_extendedprice))) AS currency,
coalesce(concat('<', l_returnflag, '>'), '') AS string, strftime(l_shipdate, '%Y-%m-%d') AS date FROM lineitem""")
def grid_format(spark: SparkSession, d: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return b.table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        formats.format_round(price, 1).alias("rounded"),
        formats.format_percentage(F.col("l_discount")).alias("percent"),
        formats.format_currency(price).alias("currency"),
        formats.format_string(F.col("l_returnflag"), "<", ">").alias("string"),
        formats.format_date(F.col("l_shipdate")).alias("date"),
    )


# linked key sets


@query("""SELECT p_partkey, p_brand FROM part WHERE p_size BETWEEN 5 AND 40 AND p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)
AND p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_tax = 0.0) AND (p_partkey % 2 = 0 OR p_partkey % 3 = 0)""")
def linked_filter(spark: SparkSession, d: str) -> DataFrame:
    part, lines = b.table(spark, d, "part"), b.table(spark, d, "lineitem")
    handles = {
        "size": linked.slider_keys(part, "p_partkey", F.col("p_size"), 5, 40),
        "quantity": lines.where("l_quantity > 49").select(F.col("l_partkey").alias("key")),
        "tax": lines.where("l_tax = 0.0").select(F.col("l_partkey").alias("key")),
    }
    chosen = [part.where(f"p_partkey % {k} = 0").select(F.col("p_partkey").alias("key")) for k in (2, 3)]
    return linked.linked_filter(part, "p_partkey", handles, chosen).select("p_partkey", "p_brand")


@query("""WITH a AS (SELECT DISTINCT l_partkey AS key FROM lineitem WHERE l_discount > 0.09), z AS (SELECT DISTINCT l_partkey AS key FROM lineitem WHERE l_tax > 0.07 AND l_quantity > 25)
SELECT key, 'removed' AS change FROM a WHERE key NOT IN (SELECT key FROM z) UNION ALL SELECT key, 'added' FROM z WHERE key NOT IN (SELECT key FROM a)""")
def keyset_diff(spark: SparkSession, d: str) -> DataFrame:
    lines = b.table(spark, d, "lineitem")
    keys = [lines.where(w).select(F.col("l_partkey").alias("key")) for w in ("l_discount > 0.09", "l_tax > 0.07 AND l_quantity > 25")]
    return linked.keyset_diff(*keys)


@query("SELECT DISTINCT l_partkey AS key FROM lineitem WHERE l_returnflag IN ('A', 'R')")
def group_keys_union(spark: SparkSession, d: str) -> DataFrame:
    groups = b.table(spark, d, "lineitem").select(F.col("l_returnflag").alias("name"), F.col("l_partkey").alias("key"))
    return linked.group_keys(groups, ["A", "R"])


@query("""SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS key FROM lineitem WHERE l_quantity > 45
AND l_partkey IN (SELECT l_partkey FROM lineitem WHERE l_tax = 0.0)""")
def filter_set(spark: SparkSession, d: str) -> DataFrame:
    """Two views' filters on one group; a third view's is taken back."""
    lines, group = b.table(spark, d, "lineitem"), linked.Groups().get("parts")
    for where in ("l_quantity > 45", "l_tax = 0.0"):
        linked.FilterHandle(group).set(lines.where(where).select(F.col("l_partkey").alias("key")))
    third = linked.FilterHandle(group)
    third.set(lines.where("l_quantity < 2").select(F.col("l_partkey").alias("key")))
    third.close()
    return group.filter.value


@query("""SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS key FROM lineitem WHERE l_quantity > 30
AND l_partkey IN (SELECT l_partkey FROM lineitem WHERE l_tax = 0.0)""")
def filter_set_kept(spark: SparkSession, d: str) -> DataFrame:
    """The same with counts that are kept up: a handle is set, set anew, and one is taken back."""
    lines, group = b.table(spark, d, "lineitem"), linked.Group("parts", KeyCounts(spark, buckets=8))
    one, two, three = (linked.FilterHandle(group) for _ in range(3))
    for handle, where in ((one, "l_quantity > 45"), (two, "l_tax = 0.0"), (three, "l_quantity < 2"), (one, "l_quantity > 30")):
        handle.set(lines.where(where).select(F.col("l_partkey").alias("key")))
    three.close()
    return group.filter.value


@query("SELECT p_partkey, p_name FROM part WHERE p_size BETWEEN 10 AND 20")
def shared_variable(spark: SparkSession, d: str) -> DataFrame:
    """A view sets a group's variable; another view, which listens, turns it into its filter; a third one shows the rows that are left."""
    part, group = b.table(spark, d, "part"), linked.Groups().get("parts")
    slider = linked.FilterHandle(group)
    group.var("sizes").on(lambda new, old: slider.set(linked.slider_keys(part, "p_partkey", F.col("p_size"), *new)))
    for bounds in ((1, 5), (10, 20)):
        group.var("sizes").set(bounds)
    return linked.linked_filter(part, "p_partkey", {"group": group.filter.value}).select("p_partkey", "p_name")


@query("SELECT p_partkey, p_name FROM part WHERE p_size < 10")
def linked_selection(spark: SparkSession, d: str) -> DataFrame:
    """The last writer's keys, seen by another view."""
    part, group = b.table(spark, d, "part"), linked.Group("parts")
    for where in ("p_size > 10", "p_size < 10"):
        linked.SelectionHandle(group).set(part.where(where).select("p_partkey"))
    return grid.selected(part, "p_partkey", linked.SelectionHandle(group).value).select("p_partkey", "p_name")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem")
def columns_to_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey")))
    wide = b.table(spark, d, "lineitem").groupBy("l_orderkey").agg(rows.alias("r")).select("l_orderkey", F.col("r.l_linenumber").alias("l_linenumber"), F.col("r.l_partkey").alias("l_partkey"))
    return grid.columns_to_rows(wide, ["l_linenumber", "l_partkey"])
