import datetime
import json
import re
import struct
import zlib
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from citeloom import session, sinks
from citeloom.functions import formats, text
from citeloom.operators import edits, grid, ingest, linked, reports, snowball
from citeloom.operators.key_counts import KeyCounts
from citeloom.operators.pages import PageIndex
from citeloom.operators.search_index import SearchIndex
from citeloom.plans import registry
from citeloom.schemas import EDGES, NODES, WORKS
from citeloom.sources import datasets, payload, refs, works_pages
from citeloom.streaming import incremental

NODE = dict.fromkeys(NODES.names)
TABLES = "/root/testdata"


def nodes(spark, *rows):
    return spark.createDataFrame([tuple((NODE | r)[c] for c in NODES.names) for r in rows], NODES)


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()[0]


def test_csv_keeps_blanks_and_reads_na(spark, tmp_path):
    f = tmp_path / "refs.csv"
    f.write_text(
        '"","Background Message","Sub Message","Level if Confidence","zotero","doi","description"\n'
        '"1","http://h.example/report/bgm/A1","http://h.example/report/subm/A1-2-3","","z1","https://doi.org/10.1/X","said ""so"", twice\nand again"\n'
        '"2","http://h.example/report/bgm/A1","http://h.example/report/subm/A1-2-3",high,NA,,plain\n'
        '"3","http://h.example/report/bgm/A1","http://h.example/report/subm/A1-2-3",high,NA,,plain\n'
    )
    rows = {r["citation"]: r for r in refs.tidy_refs(refs.read_refs_raw(spark, str(f))).collect()}
    assert len(rows) == 2
    quoted = rows['said "so", twice\nand again']
    assert (quoted["bm"], quoted["sm"], quoted["loc"], quoted["doi"]) == ("A1", "A1-2-3", None, "10.1/X")
    assert (rows["plain"]["zotero"], rows["plain"]["doi"]) == (None, "")


def test_null_doi_meets_null_doi(spark):
    r = spark.createDataFrame([("b", "s", ""), ("b", "s", "10.1"), ("b", "s", "10.X")], "bm string, sm string, doi string")
    w = spark.createDataFrame([("https://openalex.org/W1", None), ("https://openalex.org/W2", "https://doi.org/10.1"), ("https://openalex.org/W3", "https://doi.org/10.x")], "id string, doi string")
    out = {(x["doi"], x["id"]) for x in ingest.key_works(r, w).collect()}
    assert out == {(None, "https://openalex.org/W1"), ("https://doi.org/10.1", "https://openalex.org/W2"), ("https://doi.org/10.X", None)}
    assert ingest.key_works(r, w, normalize_doi=True).where("id like '%W3'").count() == 1
    apart = {(x["doi"], x["id"]) for x in ingest.key_works(r, w, null_meets_null=False).collect()}
    assert apart == {(None, None), ("https://doi.org/10.1", "https://openalex.org/W2"), ("https://doi.org/10.X", None)}
    several = r.unionAll(r.where("doi = ''")).unionAll(r.where("doi = ''"))
    assert ingest.key_works(several, w.unionAll(w)).where("doi is null").count() == 6
    assert [x["id"][-2:] for x in ingest.works_lookup(w, r).collect()] == ["W2"]


def test_messages_per_work_keeps_repeats(spark):
    k = spark.createDataFrame([(None, "b"), ("https://openalex.org/W2", None), ("https://openalex.org/W1", "c"), ("https://openalex.org/W1", "a"), ("https://openalex.org/W1", "a")], "id string, bm string")
    assert [(x["id"], x["bms"]) for x in ingest.messages_per_work(k).collect()] == [("W1", ["a", "a", "c"]), ("W2", []), (None, ["b"])]


def test_text_functions(spark):
    assert one(spark, text.anchor(F.lit(None).cast("string"), "p/")) == '<a href="p/NA" target="_blank">NA</a>'
    assert one(spark, text.background_of(F.lit("a-b-c-d"))) == "a-b"
    with pytest.raises(PySparkException):
        one(spark, text.background_of(F.concat(F.lit("a"), F.col("id").cast("string"))))
    for given, parts in (("a.b", ["a", "b"]), ("a\\.b.c", ["a.b", "c"]), ("a\\\\.b", ["a\\", "b"]), ("", [""]), (".", ["", ""]), (None, None)):
        assert spark.createDataFrame([(given,)], "x string").select(text.split_escaped(F.col("x"))).first()[0] == parts
    authors = spark.createDataFrame([([("A",)],), ([("A",), ("B",)],), ([("A",), ("B",), ("C",)],), ([],), (None,)], "a array<struct<name:string>>")
    assert [r[0] for r in authors.select(text.abbreviate_authors(F.col("a"))).collect()] == ["A", "A & B", "A et al.", None, None]


def test_formats(spark):
    assert one(spark, formats.format_currency(F.lit(-1234.5))) == "-$1,234.50"
    assert one(spark, formats.format_currency(F.lit(float("nan")))) == ""
    assert one(spark, formats.format_currency(F.lit(0.0), zero="-")) == "-"
    assert one(spark, formats.format_percentage(F.lit(0.125), 1)) == "12.5%"
    assert one(spark, formats.format_string(F.lit(None).cast("string"), "<", ">")) == ""
    assert one(spark, formats.significant(F.lit(123456.0), 2)) == 120000.0 and one(spark, formats.significant(F.lit(0.0), 2)) == 0.0
    assert one(spark, formats.significant(F.lit(float("inf")), 2)) == float("inf") and one(spark, formats.significant(F.lit(None).cast("double"), 2)) is None
    for x, digits, shown in ((123456.0, 2, "1.2e+5"), (0.0001234, 3, "0.000123"), (1.0, 3, "1.00"), (0.0, 2, "0.0"), (-1.5e-9, 2, "-1.5e-9"), (999.9, 3, "1.00e+3"), (12.0, 1, "1e+1"), (1e21, 4, "1.000e+21")):
        assert one(spark, formats.precise(F.lit(x), digits)) == shown
    assert one(spark, formats.precise(F.lit(float("nan")), 2)) is None
    assert one(spark, formats.rescaled(F.lit(1.005), 1)) == 10 and one(spark, formats.unscaled(F.lit(-7), 2)) == "-0.07"
    assert one(spark, formats.format_round(F.lit(0.125), 2)) == "0.12"  # half-even on the binary value
    assert one(spark, formats.format_date(F.lit(datetime.date(2024, 1, 5)))) == "2024-01-05"


def test_reports_three_valued(spark):
    n = nodes(
        spark,
        {"id": "a", "sm": "s", "bm": "b", "oa_input": True, "publication_year": 2018},
        {"id": "b", "sm": "s", "bm": "b", "oa_input": False, "publication_year": 2018},
        {"id": "c", "sm": "s", "bm": "b", "oa_input": False, "publication_year": 2019},
        {"id": "d", "sm": "s", "bm": "b", "oa_input": False},
        {"id": "e", "sm": "s", "bm": "b"},
    )
    assert tuple(reports.numbers_table(n).first()) == ("s", 5, 1, 3, 1, 1)
    assert [tuple(r) for r in reports.refs_per_year_sm(n).collect()] == [("s", 2018, 2), ("s", 2019, 1), ("s", None, 2)]
    assert reports.distinct_values(n, "oa_input").first()[0] == 3


def test_overlap_counts_rows_and_keeps_variants(spark):
    n = nodes(
        spark,
        {"id": "a", "title": "T", "sm": "s1", "oa_input": True},
        {"id": "a", "title": "t", "sm": "s2", "oa_input": True},
        {"id": "b", "title": "T", "sm": "s1", "oa_input": True},
        {"id": None, "title": "T", "sm": "s1", "oa_input": True},
    )
    rows = reports.overlap_key_papers_sm(n).collect()
    assert {(r["title"], r["n"], r["sms"]) for r in rows} == {("T", 2, "s1|s2"), ("t", 2, "s1|s2")}
    assert all("NA</a>" in r["doi"] for r in rows)


def test_snowball(spark):
    works = spark.createDataFrame([("s", ["x", "y"]), ("z", ["s", "q"]), ("o", ["q"])], "id string, referenced_works array<string>")
    seeds = spark.createDataFrame([("s",), (None,)], "id string")
    e = snowball.snowball_edges(seeds, works)
    assert {tuple(r) for r in e.select("from", "to").collect()} == {("s", "x"), ("s", "y"), ("z", "s")}
    assert {tuple(r) for r in snowball.snowball_nodes(seeds, e).collect()} == {("s", True), ("x", False), ("y", False), ("z", False)}
    with pytest.raises(ValueError):
        snowball.snowball(e, e, "a", "b")


def test_snowball_edges_of_odd_works(spark):
    """Works that come twice, references that are listed twice or null, both ends seeds, a citing work without id."""
    works = spark.createDataFrame(
        [("s", ["t", "t", None, "x"]), ("s", ["x"]), ("t", ["s"]), (None, ["s", "q"]), ("o", ["q"]), ("e", []), ("n", None)], "id string, referenced_works array<string>"
    )
    seeds = spark.createDataFrame([("s",), ("s",), ("t",), (None,)], "id string")
    expected = [(None, "s"), ("s", None), ("s", "t"), ("s", "x"), ("t", "s")]
    for tasks in (None, 7):
        rows = [tuple(r) for r in snowball.snowball_edges(seeds, works, tasks).collect()]
        assert sorted(rows, key=str) == sorted(expected, key=str)


def most_in_a_task(df):
    return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_snowball_edges_are_made_distinct_by_more_tasks_in_larger_tables(spark, monkeypatch):
    monkeypatch.setattr(snowball, "ROWS_A_TASK", 500, raising=False)
    for sf in ("sf0.001", "sf0.01"):
        assert most_in_a_task(registry.QUERIES["snowball_edges"](spark, f"{TABLES}/{sf}")) < 800


def test_snowball_nodes_take_edges_made_distinct_by_more_tasks_in_larger_tables(spark, monkeypatch):
    monkeypatch.setattr(snowball, "ROWS_A_TASK", 500, raising=False)
    for sf, tasks in (("sf0.001", 12), ("sf0.01", 120)):
        plan = registry.QUERIES["snowball_nodes"](spark, f"{TABLES}/{sf}")._jdf.queryExecution().executedPlan().toString()
        assert re.search(rf"hashpartitioning\(from#\d+, to#\d+, {tasks}\), REPARTITION_BY_NUM", plan)


def test_all_edges_are_made_distinct_by_more_tasks_in_larger_tables(spark, monkeypatch):
    monkeypatch.setattr(snowball, "ROWS_A_TASK", 500, raising=False)
    for sf in ("sf0.001", "sf0.01"):
        assert most_in_a_task(registry.QUERIES["snowball_all_edges"](spark, f"{TABLES}/{sf}")) < 800


def test_nodes_are_made_distinct_by_more_tasks_in_larger_tables(spark, monkeypatch):
    monkeypatch.setattr(snowball, "ROWS_A_TASK", 500, raising=False)
    for sf, tasks in (("sf0.001", 12), ("sf0.01", 120)):
        plan = registry.QUERIES["snowball_all"](spark, f"{TABLES}/{sf}")._jdf.queryExecution().executedPlan().toString()
        assert re.search(rf"hashpartitioning\(l_partkey#\d+L, s_nationkey#\d+, publication_year#\d+L, oa_input#\d+, {tasks}\), REPARTITION_BY_NUM", plan)


def test_partitions_replace_only_their_own_and_stay_text(spark, tmp_path):
    path = str(tmp_path / "nodes")
    datasets.write_partitioned(nodes(spark, {"id": "a", "bm": "b", "sm": "2024-01-05"}, {"id": "b", "bm": "b", "sm": "x-y-z"}), path)
    datasets.write_partitioned(nodes(spark, {"id": "c", "bm": "b", "sm": "x-y-z"}), path)
    back = datasets.read_nodes(spark, path)
    assert {(r["id"], r["sm"]) for r in back.collect()} == {("a", "2024-01-05"), ("c", "x-y-z")}
    pruned = snowball.snowball(back, back, sub_message="x-y-z", collect=False).nodes
    assert "PartitionFilters: [isnotnull(sm" in pruned._jdf.queryExecution().executedPlan().toString()
    e = spark.createDataFrame([("a", "b", "b", "s"), ("a", "b", "b", "s")], EDGES)
    assert len(snowball.snowball(back, e).edges) == 1
    with pytest.raises(ValueError, match="collect=False"):
        snowball.snowball(back, e, most=1)


def test_missing_tables_and_columns(spark, tmp_path):
    spark.range(1).select(F.lit("a").alias("id")).write.parquet(str(tmp_path / "one"))
    for name in ("broken", "half"):
        spark.range(1).select(F.lit("b").alias("id")).coalesce(1).write.parquet(str(tmp_path / name))
        file = next((tmp_path / name).glob("*.parquet"))
        (tmp_path / name / f".{file.name}.crc").unlink()
        if name == "broken":
            file.write_bytes(b"no table")
        else:
            file.with_name("part-z.parquet").write_bytes(b"PAR1 no table PAR1")
    (tmp_path / "unfinished").mkdir()
    paths = [str(tmp_path / x) for x in ("one", "two", "broken", "half", "unfinished")]
    df, missing, failed, lost = datasets.read_existing(spark, paths, NODES)
    assert {(r["id"], r["ab"]) for r in df.collect()} == {("a", None), ("b", None)} and missing == [paths[1], paths[4]] and failed == [paths[2]]
    assert [(x.file.split("/")[-2], x.rows, x.given) for x in lost] == [("broken", None, 0), ("half", None, 0)]
    assert datasets.read_existing(spark, paths[1:2], NODES).rows.count() == 0
    built = []
    for _ in range(2):
        datasets.materialize(spark, str(tmp_path / "m"), lambda: built.append(1) or spark.range(3))
    assert built == [1]
    pair = [str(tmp_path / x) for x in ("n", "e")]
    for _ in range(2):
        datasets.materialize_all(spark, pair, lambda: built.append(2) or [spark.range(3), spark.range(4)])
    assert built == [1, 2]
    datasets.free(spark, pair[1], spark.range(1))
    assert [t.count() for t in datasets.materialize_all(spark, pair, lambda: built.append(3) or [spark.range(5), spark.range(6)])] == [5, 6]


def test_every_lost_file_is_named(spark, tmp_path):
    """Four files, one without its footer and one with a broken page: the rows of the other two, and both names."""
    schema = "id long, s string"
    rows = spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("s"))
    rows.repartition(4, "id").write.parquet(str(tmp_path / "four files"))
    spark.range(0).withColumn("s", F.lit("")).write.parquet(str(tmp_path / "none inside"))
    files = sorted((tmp_path / "four files").glob("*.parquet"))
    for f in (tmp_path / "four files").glob(".*.crc"):
        f.unlink()
    whole = spark.read.parquet(*map(str, files[2:])).collect()
    n = spark.read.parquet(str(files[1])).count()
    data = bytearray(files[0].read_bytes())
    data[-30:] = b"x" * 30
    files[0].write_bytes(data)
    data = bytearray(files[1].read_bytes())
    data[len(data) // 2 : len(data) // 2 + 40] = bytes(40)
    files[1].write_bytes(data)
    paths = [str(tmp_path / x) for x in ("four files", "none inside", "nowhere")]
    found = datasets.read_existing(spark, paths, spark.createDataFrame([], schema).schema)
    assert sorted(map(tuple, found.rows.collect())) == sorted(map(tuple, whole)) and found.missing == paths[2:] and found.failed == []
    assert [(x.file.rsplit("/", 1)[1], x.rows, x.given) for x in found.lost] == [(files[0].name, None, 0), (files[1].name, n, 0)]
    assert datasets.read_existing(spark, paths[1:], found.rows.schema).rows.count() == 0


def test_lost_files_of_a_partitioned_table(spark, tmp_path):
    path = str(tmp_path / "nodes")
    datasets.write_partitioned(nodes(spark, {"id": "a", "bm": "b", "sm": "2024-01-05"}, {"id": "b", "bm": "b", "sm": "x y:z"}), path)
    (tmp_path / "nodes" / "bm=b" / "sm=2024-01-05" / "part-new.parquet").write_bytes(b"half a file")
    found = datasets.read_existing(spark, [path], NODES)
    assert {(r["id"], r["sm"]) for r in found.rows.collect()} == {("a", "2024-01-05"), ("b", "x y:z")} and len(found.lost) == 1


def test_timed_logs(caplog):
    with caplog.at_level("INFO", "citeloom"), pytest.raises(ZeroDivisionError), datasets.timed("step"):
        1 / 0
    assert [m.split(":")[0] for m in caplog.messages] == ["step", "step"]


def test_messages_of_a_large_partition_are_split(spark, tmp_path):
    path = str(tmp_path / "nodes")
    df = spark.range(20_000).select(*[F.sha2(F.col("id").cast("string"), 256).alias(c) if c == "id" else F.lit(None).cast(NODES[c].dataType).alias(c) for c in NODES.names if c not in ("bm", "sm")], F.lit("b").alias("bm"), F.lit("b-c").alias("sm"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        datasets.write_partitioned(df.repartition(8), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert datasets.read_nodes(spark, path).count() == 20_000 and len(list((tmp_path / "nodes").glob("bm=b/sm=b-c/*.parquet"))) > 1


def test_union_repairs_columns(spark):
    a = spark.createDataFrame([("1", "x")], "id string, doi string")
    c = spark.createDataFrame([("1", "y"), ("1", "y")], "id string, ab string")
    assert {tuple(r) for r in snowball.union_nodes(a, c).collect()} == {("1", "x", None), ("1", None, "y")}


def test_grid(spark):
    df = spark.createDataFrame([(1, 1.0, True), (2, float("nan"), None), (3, None, False), (4, 5.0, None)], "k int, v double, b boolean")
    ids = lambda d: sorted(r["k"] for r in d.collect())
    assert ids(df.where(grid.range_filter(F.col("v"), 1, 5))) == [1, 4]
    assert ids(df.where(grid.range_filter(F.col("v"), 1, 5, 1, 5))) == [1, 2, 3, 4]
    assert ids(df.where(grid.logical_filter(F.col("b"), ["na", "false"]))) == [2, 3, 4]
    assert ids(df.where(grid.factor_filter(F.col("k"), []))) == [1, 2, 3, 4]
    assert grid.parse_range("... 7", 1, 9) == (1, 7)
    for bad in ("1-7", "1 ... 2 ... 3", "a ... 2"):
        with pytest.raises(ValueError):
            grid.parse_range(bad, 1, 9)
    day = datetime.date
    assert grid.parse_date_range("2024-01-05 ...", day(2020, 1, 1), day(2025, 1, 1)) == (day(2024, 1, 5), day(2025, 1, 1))
    assert grid.parse_time_range("... 2024-01-05T10:00", datetime.datetime(2020, 1, 1), None)[1].hour == 10
    with pytest.raises(ValueError):
        grid.parse_date_range("2024-13-01 ...", day(2020, 1, 1), day(2025, 1, 1))
    cells = spark.createDataFrame([(1, "v", "7.5"), (3, "b", None)], "k int, column string, value string")
    assert {tuple(r) for r in grid.edit_cells(df, "k", cells).where("k in (1, 3)").collect()} == {(1, 7.5, True), (3, None, None)}
    assert grid.edit_row(df, "k", 4, {"v": 1, "b": True}).where("k = 4").first()[1:] == (1.0, True)
    assert ids(grid.reload(df, "k", cells)[1]) == [1, 3] and grid.reload(df, "k", cells, clear=True)[1] is None
    assert grid.selected_columns(df, "k", ["b"]).columns == ["k", "b"]
    assert one(spark, grid.highlighted(F.lit("a.b AB"), "b a.")) == "<mark>a.</mark><mark>b</mark> A<mark>B</mark>" and one(spark, grid.highlighted(F.lit("x"), " ")) == "x"
    assert [r["k"] for r in grid.page(df, [F.desc("k")], 2, 3).rows.collect()] == [1]
    with pytest.raises(ValueError):
        grid.checked_page(df, [F.col("k")], 3, 3)
    numbered = grid.page(df, [F.desc("k")], 1, 3).matching
    assert ids(grid.between_rows(numbered, 3, 2)) == [2, 3]
    assert ids(grid.selectable(df, "k", [1, 4])) == [1, 4] and ids(grid.selectable(df, "k", [-1, 0])) == [2, 3, 4]
    with pytest.raises(ValueError):
        grid.add_row(df, [1])
    assert grid.add_row(df, [9, 1.0, None]).count() == 5
    assert grid.edit(df, "k", 1, "v", 7).where("k = 1").first()["v"] == 7.0
    assert grid.show(df, hide=("v",)).columns == ["k", "b"]
    assert grid.clip_range(0, 100, 5, 50) == (5, 50)
    assert tuple(grid.column_stats(df, ["k"]).first()) == (1, 4)
    assert one(spark, grid.search(F.lit("Alpha Beta"), "beta ALPHA")) and not one(spark, grid.search(F.lit("Alpha Beta"), "beta alpha", smart=False))
    bad = spark.createDataFrame([([1, 2], [1])], "a array<int>, b array<int>")
    with pytest.raises(PySparkException):
        grid.columns_to_rows(bad, ["a", "b"]).collect()


def test_linked_sets(spark):
    keys = lambda *k: spark.createDataFrame([(str(x),) for x in k], "key string")
    df = spark.range(6).withColumnRenamed("id", "k")
    ids = lambda d: sorted(r["k"] for r in d.collect())
    assert ids(linked.linked_filter(df, "k", {})) == [0, 1, 2, 3, 4, 5]
    sets = {"a": keys(1, 2, 2, 3), "b": keys(2, 3, 4)}
    assert ids(linked.linked_filter(df, "k", sets)) == [2, 3]
    assert sorted(r[0] for r in linked.intersection(sets).collect()) == sorted(r[0] for r in sets["a"].intersect(sets["b"]).collect())
    assert ids(linked.linked_filter(df, "k", sets, [keys(3), keys(5)])) == [3]
    assert ids(linked.linked_filter(df, "k", {"a": keys()})) == []
    f = linked.FilterSet()
    assert f.keys() is None
    f.set("a", keys(1))
    with pytest.raises(ValueError):
        f.set("b", None)
    f.clear("a")
    assert f.keys() is None
    assert {tuple(r) for r in linked.keyset_diff(keys(1, 2), keys(2, 3)).collect()} == {("1", "removed"), ("3", "added")}
    with pytest.raises(ValueError):
        linked.check_sorted(["b", "a"])
    groups = spark.createDataFrame([("g", "1"), ("g", "2"), ("h", "2")], "name string, key string")
    assert sorted(r[0] for r in linked.group_keys(groups, ["g", "h"]).collect()) == ["1", "2"] and linked.group_keys(groups, []) is None
    s = linked.Selection()
    s.set(keys(1))
    s.set(keys(2))
    assert s.value.first()[0] == "2"


def test_linked_groups(spark):
    keys = lambda *k: spark.createDataFrame([(str(x),) for x in k], "key string")
    shown = lambda df: None if df is None else sorted(r["key"] for r in df.collect())
    groups, told = linked.Groups(), []
    a, z = groups.get("a"), groups.get("z")
    assert groups.get("a") is a
    off = a.filter.on(lambda new, old: told.append(shown(new)))
    one, two = linked.FilterHandle(a), linked.FilterHandle(a)
    one.set(keys(1, 2))
    two.set(keys(2, 3))
    assert shown(one.keys()) == ["2"]
    two.switch(z)  # leaves no filter behind
    assert shown(one.keys()) == ["1", "2"] and two.keys() is None
    one.close()
    one.set(keys(9))
    assert a.filter.value is None and one.keys() is None and told == [["1", "2"], ["2"], ["1", "2"], None]
    off()
    linked.FilterHandle(a).set(keys(5))
    assert len(told) == 4
    s = linked.SelectionHandle(a)
    s.set(keys(1))
    s.switch(z)
    assert s.value is None and shown(a.selection.value) == ["1"]
    s.clear()
    linked.SelectionHandle().set(keys(1))  # without a group nothing happens
    assert a.var("n") is a.var("n") and a.var("n").value is None


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("<b>", '<a href="x" target="_blank">x</a>', 2020, 10), (None, "q", 2021, 100)], "sm string, link string, publication_year int, n long")
    sinks.to_html(df, str(tmp_path / "t.html"), fixed_columns=2)
    page = (tmp_path / "t.html").read_text()
    assert "&lt;b&gt;" in page and '<a href="x"' in page and page.count("class=fixed") == 6 and "LENGTH" not in page and "FIXED" not in page
    assert sinks.to_markdown(df.select("sm", "n")).splitlines()[3] == "| NA | 100 |"
    sinks.to_csv(df, str(tmp_path / "csv"))
    with pytest.raises(ValueError):
        sinks.to_csv(df, str(tmp_path / "csv"), most=1)
    files = [str(tmp_path / "figures" / f"f.{x}") for x in ("svg", "pdf", "png")]
    assert sinks.to_figure_once(lambda: df, *files, mark=2020) and not sinks.to_figure_once(lambda: 1 / 0, *files)
    svg, pdf, png = (open(f, "rb").read() for f in files)
    assert b"<polyline" in svg and pdf.startswith(b"%PDF-") and int(pdf.split()[-2]) == pdf.index(b"xref\n0 5")
    size, data = struct.unpack(">II", png[16:24]), zlib.decompress(png[png.index(b"IDAT") + 4 : png.index(b"IEND") - 8])
    assert size == (sinks.WIDTH, sinks.HEIGHT) and len(data) == sinks.HEIGHT * (3 * sinks.WIDTH + 1) and b"\0\0\0\xff" in data
    with pytest.raises(ValueError):
        sinks.to_markdown(spark.range(5), most=3)


def test_resumable_ingestion(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    schema = spark.range(1).schema
    for n in (2, 3):
        spark.range(n).coalesce(1).write.mode("append").parquet(src)
        incremental.ingest_available(spark, src, schema, out, ck)
    assert spark.read.parquet(out).count() == 5
    wanted = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "id string")
    assert [r[0] for r in incremental.pending(wanted, wanted.where("id = 'a'")).collect()] == ["b"]


def test_page_index(spark, tmp_path):
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 7919 % 1000).alias("v"))
    order = [F.desc("v"), F.asc("k")]
    want = sorted(((r["k"], r["v"]) for r in df.collect()), key=lambda r: (-r[1], r[0]))
    with PageIndex(df.repartition(5), order, rows_per_file=100) as index:
        assert index.n == 5000 and len(index.files) >= 50
        page = index.page(33, 20)
        assert [tuple(r) for r in page.collect()] == [(*w, 641 + i) for i, w in enumerate(want[640:660])]
        assert len(page.inputFiles()) <= 2 and dict(page.dtypes)["row_number"] == "bigint"
        assert [r["row_number"] for r in index.between(4990, 9999).collect()] == list(range(4990, 5001))
        assert [tuple(r)[:2] for r in index.between(1, 5000).collect()] == want  # more files than are named
        assert index.between(7, 3).count() == 0
        assert [tuple(r) for r in index.rows().where("row_number in (1, 5000)").orderBy("row_number").collect()] == [(*want[0], 1), (*want[-1], 5000)]
        for bad in (0, 251):
            with pytest.raises(ValueError, match="no page"):
                index.page(bad, 20)
        kept = index.copy_of_page(250, 20)
        folder = Path(index.path.removeprefix("file:").replace("//", "/"))
        assert folder.exists()
    assert not folder.exists() and [tuple(r)[:2] for r in kept.collect()] == want[-20:]
    with PageIndex(df.limit(0), order) as none:
        assert none.n == 0 and none.rows().count() == 0 and none.page(1, 5).count() == 0


def test_deep_pages_leave_nothing(spark, monkeypatch):
    monkeypatch.setattr(grid, "DEEP", 50)
    df = spark.range(300).withColumnRenamed("id", "k")
    before = set(Path(session.shared_dir(spark).removeprefix("file://")).glob("pages-*"))
    assert [r["k"] for r in grid.page(df, [F.desc("k")], 7, 20).rows.collect()] == list(range(179, 159, -1))
    assert grid.page(df, [F.desc("k")], 70, 20).rows.count() == 0
    assert set(Path(session.shared_dir(spark).removeprefix("file://")).glob("pages-*")) == before
    assert grid.page(df, [F.desc("k")], 2, 60).rows.count() == 60


def test_search_index_equals_the_scan(spark):
    rows = [(1, "Red bolt", "A1"), (2, "bolted REDWOOD", None), (3, "re d", "red"), (4, None, None), (5, "naïve ÉCLAIR\nred", "b%_.*"), (6, "", ""), (7, "aaaa", "aaa"), (None, "red", "x"), *[(100 + i, f"filler {i}", "the red one" if i % 50 == 0 else "other") for i in range(3000)]]
    df = spark.createDataFrame(rows, "k long, a string, b string").repartition(4)
    known = df.where("k is not null")
    ids = lambda d: sorted(r["k"] for r in d.collect())
    with SearchIndex(df, "k", ["a", "b"]) as index:
        for query in ("red", "RED bolt", "bolt red", "éclair", "re", "", "aaa", "aaaa", "aaaaa", "filler 29", "%_.", "r e d", "one the", "nowhere"):
            assert ids(index.search("a", query)) == ids(known.where(grid.search(F.col("a"), query))), query
            assert ids(index.search_all(query)) == ids(known.where(grid.search_all(["a", "b"], query))), query
        assert ids(index.candidates("bolt red", "a").withColumnRenamed("key", "k")) == [1, 2] and index.candidates("re d") is None
        plan = index.search("a", "bolt")._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [In(k, [1,2])" in plan  # texts are read for candidates
        many = index.search_all("other")  # more than are named one by one
        assert many.count() == known.where("b = 'other'").count()


def test_edit_log(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1.5, True), (2, "b", None, None), (3, None, 2.5, False)], "k int, s string, x double, f boolean")
    path = str(tmp_path / "log")
    log = edits.EditLog(spark, df.columns, "k", path)
    rows = lambda: sorted(map(tuple, log.apply(df).collect()), key=repr)
    assert rows() == sorted(map(tuple, df.collect()), key=repr)
    log.row(1, {"k": 5, "s": "n"})  # the key first
    log.row(2, {"x": 7, "f": True, "s": None})
    assert rows() == [(2, None, 7.0, True), (3, None, 2.5, False), (5, "n", 1.5, True)]
    log.cell(1, "s", "last")  # rows go by the key they have in the table
    log.column("x", spark.createDataFrame([(1, "0.25"), (3, None)], "k int, value string"))
    assert rows() == [(2, None, 7.0, True), (3, None, None, False), (5, "last", 0.25, True)]
    log.remove(spark.createDataFrame([(2,), (99,)], "k int"))
    log.cell(2, "s", "gone all the same")
    log.add(spark.createDataFrame([(2, "back", None, None), (8, "new", None, False)], df.schema))
    log.cells(spark.createDataFrame([(8, "x", "9")], "k int, column string, value string"))
    want = [(2, "back", None, None), (3, None, None, False), (5, "last", 0.25, True), (8, "new", 9.0, False)]
    assert rows() == want
    again = edits.EditLog(spark, df.columns, "k", path)  # read anew
    assert again.version == log.version and sorted(map(tuple, again.apply(df).collect()), key=repr) == want
    log.compact()
    assert rows() == want and len(log._versions()) == 1
    log.compact()
    log.rows(spark.createDataFrame([(3, "whole", 1.0, None)], df.schema))
    assert rows() == [(2, "back", None, None), (3, "whole", 1.0, None), *want[2:]]
    for bad in (lambda: log.row(1, {"nope": 1}), lambda: log.cells(spark.createDataFrame([(1, "nope", "x")], "k int, column string, value string"))):
        with pytest.raises((ValueError, PySparkException)):
            bad()
    assert rows() == [(2, "back", None, None), (3, "whole", 1.0, None), *want[2:]]
    log.close()
    assert rows() == sorted(map(tuple, df.collect()), key=repr)


def test_a_thousand_edits_make_one_plan(spark, tmp_path):
    df = spark.range(50).select(F.col("id").alias("k"), F.lit("old").alias("s"))
    log = edits.EditLog(spark, df.columns, "k", str(tmp_path / "log"))
    depth = lambda: log.apply(df)._jdf.queryExecution().analyzed().toString().count("\n")
    log.row(0, {"s": "first"})
    one = depth()
    for i in range(20):
        log.cells(spark.createDataFrame([((i * 50 + j) % 49, "s", f"e{i * 50 + j}") for j in range(49)], "k long, column string, value string"))
    assert depth() == one and len(log._versions()) == 21
    assert {r["k"]: r["s"] for r in log.apply(df).collect()} == {**{(19 * 50 + j) % 49: f"e{950 + j}" for j in range(49)}, 49: "old"}


def test_rows_are_edited_at_once(spark):
    df = spark.createDataFrame([(4, "o"), (5, "o")], "k int, v string")
    for new in ({"k": 9, "v": "n"}, {"v": "n", "k": 9}):
        assert sorted(map(tuple, grid.edit_row(df, "k", 4, new).collect())) == [(5, "o"), (9, "n")]
    cells = spark.createDataFrame([(4, "k", "9"), (4, "v", "n")], "k int, column string, value string")
    assert sorted(map(tuple, grid.edit_cells(df, "k", cells).collect())) == [(5, "o"), (9, "n")]
    with pytest.raises(ValueError, match="no columns"):
        grid.edit_row(df, "k", 4, {"w": 1})


def test_key_counts_shuffle_the_new_keys_only(spark):
    keys = lambda *k: spark.createDataFrame([(x,) for x in k], "key long")
    shown = lambda df: sorted(r["key"] for r in df.collect())
    with KeyCounts(spark, buckets=4) as kept:
        assert kept.keys() is None
        kept.set("a", keys(1, 2, 2, 3, None))
        kept.set("b", keys(2, 3, 4))
        assert shown(kept.keys()) == ["2", "3"]
        kept.set("a", keys(3, 4, 5))
        assert shown(kept.keys()) == ["3", "4"] and {r["key"]: r["n"] for r in spark.table(kept.counts).collect()} == {"2": 1, "3": 2, "4": 2, "5": 1}
        new = kept._save(keys(5, 6).select(F.col("key").cast("string").alias("key")).repartition(4, "key").distinct())
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            update = kept.changed(kept.difference(kept.sets["b"], new))
            plan = update._jdf.queryExecution().executedPlan().toString()
            # the difference, which is a join in place, is shuffled to the counts; nothing else is
            assert plan.count("Exchange") == 1 and plan.count("SortMergeJoin") == 2 and plan.index("SortMergeJoin") < plan.index("Exchange") < plan.rindex("SortMergeJoin")
            assert {r["key"]: r["n"] for r in update.collect()} == {"3": 1, "4": 1, "5": 2, "6": 1}
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        kept._drop(new)
        kept.clear("a")
        kept.clear("nobody")
        assert shown(kept.keys()) == ["2", "3", "4"]
        kept.set("c", keys())
        assert shown(kept.keys()) == []
        kept.clear("c")
        kept.clear("b")
        assert kept.keys() is None
        with pytest.raises(ValueError):
            kept.set("a", None)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("citeloom_keys_") and t.name in kept._paths]


def test_kept_filters_of_a_group(spark):
    keys = lambda *k: spark.createDataFrame([(str(x),) for x in k], "key string")
    shown = lambda df: None if df is None else sorted(r["key"] for r in df.collect())
    with KeyCounts(spark, buckets=2) as kept:
        group = linked.Group("g", kept)
        one, two = linked.FilterHandle(group), linked.FilterHandle(group)
        one.set(keys(1, 2))
        two.set(keys(2, 3))
        assert shown(one.keys()) == ["2"]
        two.close()
        assert shown(one.keys()) == ["1", "2"]
        one.clear()
        assert one.keys() is None


def test_ingestion_repeats_and_retries(spark, tmp_path):
    schema = spark.createDataFrame([], "id long, v string").schema
    late, runs = [{"x"}], []

    def work(rows):
        runs.append(1)
        return rows.withColumn("size", F.length("v")).withColumn("error", F.when(~F.col("v").isin([*late[0]]), "not yet"))

    def given(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    make = lambda: incremental.Ingestion(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), work)
    ids = lambda df: sorted(r["id"] for r in df.collect())
    given((1, "x"), (2, "y"))
    make().run()
    assert (ids(make().done()), ids(make().failed())) == ([1], [2]) and make().errors().first()["error"] == "not yet"
    given((3, "x"), (4, "z"))
    cut = make()
    cut.after_write = lambda: 1 / 0
    for _ in range(2):  # its results are there, but it isn't taken
        with pytest.raises(PySparkException):
            cut.run()
    make().run()
    assert (ids(make().done()), ids(make().failed())) == ([1, 3], [2, 4])
    make().run()  # nothing new
    assert ids(make().done()) == [1, 3]
    late[0] |= {"y"}
    make().retry()
    make().retry()  # once a batch
    assert (ids(make().done()), ids(make().failed())) == ([1, 2, 3], [4])
    late[0] |= {"z"}
    given((5, "y"), (6, "q"))
    make().run()
    assert (ids(make().done()), ids(make().failed())) == ([1, 2, 3, 4, 5], [6])
    assert make().done().columns == ["id", "v", "size"]


def test_works_pages(spark, tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    for n in range(9):
        works = [{"id": f"W{n}-{i}", "doi": None if i == 3 else f"https://doi.org/10.{n}{i}", "title": "é", "publication_year": 2000 + i, "author": [{"name": "A", "orcid": "x"}], "referenced_works": ["W1"], "grants": [1]} for i in range(5)]
        (folder / f"page-{n}.json").write_text("".join(json.dumps(w) + "\n" for w in works))
    (folder / "_cursor").write_text("not a page")
    (folder / "page-none.json").write_text("")
    df = works_pages.read_works(spark, str(folder))
    assert df.schema == WORKS and df.count() == 45 and df.rdd.getNumPartitions() == 3
    assert tuple(df.where("id = 'W2-1'").first()) == ("W2-1", "https://doi.org/10.21", "é", None, None, 2001, [("A",)], ["W1"])
    one = df.where("doi = 'https://doi.org/10.21' and publication_year > 1990")
    assert one.count() == 1 and "Filter" in (plan := one._jdf.queryExecution().executedPlan().toString()) and "doi.org" not in plan  # answered by the pages
    refs = spark.createDataFrame([("10.21",), ("10.80",), ("10.80",), ("",), (None,), ("10.999",)], "doi string")
    assert sorted(r["id"] for r in works_pages.fetch_works(df, refs).collect()) == ["W2-1", "W8-0"]
    many = refs.unionAll(spark.range(1200).select(F.concat(F.lit("20."), "id")))
    assert sorted(r["id"] for r in works_pages.fetch_works(df, many).collect()) == ["W2-1", "W8-0"]
    (folder / "page-bad.json").write_text('{"id": "W"}\nno json\n')
    with pytest.raises(PySparkException, match="is no JSON"):
        works_pages.read_works(spark, str(folder)).count()
    assert spark.read.format("works_pages").option("mode", "permissive").load(str(folder)).count() == 46


def test_payload_chunks(spark):
    df = spark.range(2500).select(F.when(F.col("id") % 10 != 0, "hot").alias("g"), "id", F.concat(F.lit('"x'), F.col("id").cast("string")).alias("s"))
    sent = payload.payload_chunks(df, "g", ["id", "s"], ["id"], rows=100)
    sizes = sent.select("g", "chunk", F.size(F.from_json("json", "id array<long>")["id"]).alias("n")).collect()
    assert max(r["n"] for r in sizes) == 100 and sorted(r["chunk"] for r in sizes if r["g"] == "hot") == list(range(23)) and len(sizes) == 26
    back = payload.read_payload(sent, "json", df.select("id", "s").schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.select("id", "s").collect()))


def test_many_escapes(spark):
    split = lambda s: spark.createDataFrame([(s,)], "x string").select(text.split_escaped(F.col("x"))).first()[0]
    for n in (41, 43, 1000, 1001):
        whole = "\\" * (n // 2)
        assert split("\\" * n + ".b") == ([whole + ".b"] if n % 2 else [whole, "b"])
    assert split("a\\\n.b\\") == ["a\n", "b"] and split("\\a\\.\\..") == ["a..", ""]


def test_marks_reach_the_page(spark, tmp_path):
    df = spark.createDataFrame([("<b> & Red", "<mark>x</mark>")], "a string, b string").withColumn("a", grid.highlighted(F.col("a"), "red b"))
    sinks.to_html(df, str(tmp_path / "t.html"), marked=("a",))
    page = (tmp_path / "t.html").read_text()
    assert "<td>&lt;<mark>b</mark>&gt; &amp; <mark>Red</mark></td><td>&lt;mark&gt;x&lt;/mark&gt;</td>" in page


def test_null_dois_beyond_a_few(spark, monkeypatch):
    r = spark.createDataFrame([("b", "", i) for i in range(20)] + [("b", "10.1", 99)], "bm string, doi string, n int")
    w = spark.createDataFrame([(f"W{i}", None) for i in range(7)] + [("W9", "https://doi.org/10.1")], "id string, doi string")
    pairs = sorted(map(tuple, ingest.key_works(r, w).select("n", "id").collect()))
    assert len(pairs) == 141
    monkeypatch.setattr(ingest, "FEW", 3)
    assert sorted(map(tuple, ingest.key_works(r, w).select("n", "id").collect())) == pairs
    found = ingest.key_works_grouped(r, w)
    assert (found.pairs.count(), found.refs.count(), found.works.count()) == (1, 20, 7)


def test_overlap_counts_move_no_texts(spark, tmp_path):
    rows = [{"id": f"w{i % 40}", "title": f"t{i % 3}", "ab": "long text", "author": "A", "doi": f"https://doi.org/{i % 40}", "sm": f"s{i % 7}", "bm": f"b{i % 6}", "oa_input": False, "publication_year": 2020} for i in range(500)]
    nodes(spark, *rows).write.parquet(str(tmp_path / "n"))
    n = spark.read.parquet(str(tmp_path / "n"))
    counts = reports._many(n, "sm", 5)._jdf.queryExecution().executedPlan().toString()
    assert "title" not in counts and "author" not in counts
    found = {(r["id"], r["title"], r["n"]) for r in reports.overlap_recent_bm(n, more_than=5).collect()}
    want = {}
    for r in {(r["id"], r["title"], r["bm"]) for r in rows}:
        want.setdefault(r[0], []).append(r[1])
    assert {(x[0].split('"')[1].rsplit("/", 1)[1], x[1], x[2]) for x in found} == {(i, t, len(v)) for i, v in want.items() if len(v) > 5 for t in set(v)}


def test_first_rows_of_groups(spark):
    df = spark.createDataFrame([("a", 2, 1), ("a", 1, 2), ("a", 1, 1), (None, 5, 1), ("b", None, 3)], "g string, x int, k int")
    got = {tuple(r) for r in grid.row_groups(df, "g", [F.col("x"), F.col("k")]).collect()}
    assert got == {("a", False, 2, 1), ("a", False, 1, 2), ("a", True, 1, 1), (None, True, 5, 1), ("b", True, None, 3)}


def test_overlaps_of_nodes_without_texts(spark):
    """Texts from a table of works give the same rows as texts in the nodes."""
    rows = [{"id": f"w{i % 40}", "title": f"t{i % 40}", "ab": "x", "author": "A", "doi": None if i % 40 == 3 else f"https://doi.org/{i % 40}", "sm": f"s{i % 7}", "bm": f"b{i % 6}", "oa_input": i % 3 == 0, "publication_year": 2020} for i in range(500)]
    n = nodes(spark, *rows)
    works, narrow = n.select("id", "doi", "author", "title", "ab").distinct(), n.select("id", "sm", "bm", "oa_input", "publication_year")
    for f in (reports.overlap_key_papers_sm, reports.overlap_recent_sm, reports.overlap_recent_bm):
        want = f(n, more_than=1).collect()
        assert want and f(narrow, more_than=1, works=works).collect() == want
