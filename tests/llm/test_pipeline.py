import os

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from citeloom.llm import mixing

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_pipeline_equals_brute_force(spark):
    given = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    bench = [" ".join(r["text"].lower().split()) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    told = [(d, t) for d, t in given if t and any(c.isalpha() for c in t)]
    kept = [(d, t) for (d, t), (_, n, c) in zip(told, brute.components(told)) if d == c]
    clean = {d: t for d, t in kept if not any(b in " ".join(t.lower().split()) for b in bench)}
    got = corpus_pipeline.run(spark, DATA)
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where(F.col("doc_id").isin(list(clean)))
    want = mixing.mix(docs).select("doc_id", "copy_no", "shuffle_key")
    assert sorted(map(tuple, got.select("doc_id", "copy_no", "shuffle_key").collect())) == sorted(map(tuple, want.collect()))
    for r in got.collect():
        assert not brute.secrets(r["text"])
        if not brute.secrets(clean[r["doc_id"]]):
            assert r["text"] == clean[r["doc_id"]]


def test_stages_take_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, label int, sid long, __id string, tkey string, copies int"
    more = (1, 2, "x", "y", 3)
    long = " ".join(f"word{i}" for i in range(30_000))
    item = "what is the one thing that nobody in the whole wide world has ever known about it"
    rows = [
        (None, None, None, None, None), (None, "no number but some words here", "en", None, 29), (1, "", "en", "s", 0), (2, "some words here", "en", None, 15), (2, "some words here", "en", None, 15),
        (3, "other text of words", None, "s", 19), (4, "!!! 123", "en", "s", 7), (5, long, "en", "s", len(long)), (6, long + " end", "en", "s", len(long) + 4), (7, f"Q: {item.upper()}?", "en", "s", 80), (8, "password = hunter22 and more", "en", "s", 28),
    ]
    spark.createDataFrame([(0, item), (1, None), (2, "words")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for given, want in ((rows, {None, 2, 3, 5, 8}), ([], set())):
        docs = spark.createDataFrame([r + more for r in given], schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            if name == "source_mixing":
                assert out.columns == [c for c in docs.columns if c != "copies"] + ["copy_no", "copies", "rate", "shuffle_key"]
                assert {r["doc_id"] for r in out.collect()} <= want
            else:
                assert out.columns == docs.columns
                path = str(tmp_path / f"{name}{len(given)}")
                out.write.parquet(path)
                docs = spark.read.parquet(path)
        kept = docs.collect()
        assert len(kept) == len(want) and {r["doc_id"] for r in kept} == want
        assert {r["text"] for r in kept if r["doc_id"] == 8} <= {"[SECRET] and more"} and all(r["label"] == 1 and r["tkey"] == "y" for r in kept)
