"""Operators 11 to 13 against brute force, and their limits."""

import random
import re
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from citeloom.llm import collocations, fill_middle, sharding

#: Columns named like those that the operators use inside or add.
CLASH = ["1 as shard", "2 as slot", "3 as size", "4 as n", "'x' as form", "5 as f", "6 as __size", "7 as __place", "8 as rank", "9 as phrase"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# 11


def phrase_rows(seed, n=250):
    r = random.Random(seed)
    words = ["the", "of", "A", "é", "x-y", "\x1c", "b\x00c", "w1", "w2", "w3"]
    gaps = [" ", " ", " ", " ", "\t", ". ", "\n", " , ", "  ", "\r\n"]
    out = [(r.choice(["en", "en", "fr", None, "und"]), "".join(r.choice(words) + r.choice(gaps) for _ in range(r.randrange(60)))) for _ in range(n)]
    return [*out, ("en", None), ("en", ""), (None, None), ("de", "a b c d e f " * 500), ("xx", "one"), ("en", out[0][1]), ("en", out[0][1])]


@pytest.mark.parametrize(("least", "covered", "shard_words", "top"), [(5, 100, 500_000, 2000), (3, 80, 200, 40)])
def test_collocations_equal_brute_force(spark, least, covered, shard_words, top):
    given = phrase_rows(least)
    df = spark.createDataFrame(given, "lang string, text string").selectExpr("*", *CLASH).repartition(4)
    got = rows(collocations.collocations(df, least, covered=covered, shard_words=shard_words, top=top))
    assert got == sorted(brute.phrases(given, least, covered=covered, top=top), key=repr)


def test_collocations_of_nothing(spark):
    df = spark.createDataFrame([("en", None), ("en", " .\n")], "lang string, text string")
    assert rows(collocations.collocations(df)) == rows(collocations.collocations(df.limit(0))) == []
    with pytest.raises(ValueError, match="least"):
        collocations.collocations(df, least=0)


def test_products_beyond_64_bits(spark):
    """1000 a n passes 2^63."""
    words = spark.createDataFrame([(0, "en", "a", 4 * 10**9), (1, "en", "b", 3 * 10**9)], "id long, lang string, phrase string, f long")
    pair = spark.createDataFrame([(2, "en", "a b", 2_999_999_999)], "id long, lang string, phrase string, f long")
    totals = spark.createDataFrame([("en", 9 * 10**12 + 7)], "lang string, n long")
    n, a = 9 * 10**12 + 7, 2_999_999_999
    assert rows(collocations._ranked([words, pair], totals, 10, 100)) == [("en", 1, "a b", a, 4 * 10**9, 3 * 10**9, n, 1000 * a * n // (12 * 10**18))]


def test_bitmaps_extend_over_block_borders():
    """Counts in a shard are those of the word sequences, wherever they lie; gaps part them."""
    r = np.random.default_rng(5)
    for size in (1, 7, 8, 9, 64, 500):
        words = r.integers(-1, 4, size)
        maps = collocations.bitmaps(words, 4)
        assert maps.sizes.sum() == len(maps.blocks) == len(maps.bits)
        ids, known, runs = np.array([40, 10, 30, 20]), [], {(w,): int(i) for w, i in enumerate([40, 10, 30, 20])}
        for length in (2, 3, 4):
            want = Counter(tuple(words[i : i + length].tolist()) for i in range(size - length + 1) if (words[i : i + length] >= 0).all())
            got = Counter()
            for parent, word, n in collocations.extend(maps, np.arange(4), ids, known):
                for p, w, c in zip(parent.tolist(), word.tolist(), n.tolist()):
                    got[(p, w)] += c
            assert got == {(runs[k[:-1]], runs[k[-1:]]): c for k, c in want.items()}
            runs |= {k: 1000 * length + n for n, k in enumerate(want)}
            known.append(tuple(np.array(x, np.int64) for x in zip(*[(runs[k[:-1]], runs[k[-1:]], runs[k]) for k in want])) if want else (np.zeros(0, np.int64),) * 3)


def test_a_very_long_piece_and_a_word_in_every_text(spark):
    given = [("en", "the end " * 40_000), *[("en", "the " + f"w{i}") for i in range(300)]]
    df = spark.createDataFrame(given, "lang string, text string").repartition(7)
    assert rows(collocations.collocations(df, shard_words=1000)) == sorted(brute.phrases(given, 100), key=repr)


# 12

SHARD_CASES = {
    "empty": [],
    "one": [(1, "a")],
    "varied": [(i * 7919 % 1000, "é" * (i * 31 % 50)) for i in range(1000)],
    "no ids": [*[(None, "same")] * 300, (5, "é" * 1000), (5, None), (6, ""), (5, "b"), (5, "b")],
    "one huge": [(i, "y" * (50_000 if i == 3 else 1)) for i in range(40)],
}


@pytest.mark.parametrize("case", SHARD_CASES)
def test_shards_equal_brute_force(spark, docs, case):
    given = SHARD_CASES[case]
    for n in (1, 8, 13):
        assert rows(sharding.digest(docs(given, CLASH).repartition(3), n)) == sorted(brute.dealt(given, n), key=repr)


def test_shards_are_written_whole_and_in_order(spark, docs, tmp_path):
    given = SHARD_CASES["varied"]
    sharding.write_shards(docs(given, ["'kept' as more"]), str(tmp_path / "s"), 5)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert rows(back.select("doc_id", "text", "more")) == sorted(((d, t, "kept") for d, t in given), key=repr)
    ends = back.groupBy("shard").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z"), F.sum("size").alias("size"), F.count("*").alias("n"), F.max("slot").alias("last")).orderBy("shard").collect()
    assert len(ends) == 5 and all(x["z"] < y["a"] for x, y in zip(ends, ends[1:])) and all(e["last"] == e["n"] - 1 for e in ends)
    assert max(e["size"] for e in ends) - min(e["size"] for e in ends) <= 2 * 101
    with pytest.raises(ValueError, match="n_shards"):
        sharding.shards(docs(given), 0)


# 13

MIDDLE_CASES = [
    *[(i, " ".join(f"wörd{j}\U0001f600" for j in range(i % 9))) for i in range(120)],
    *[(1000 + i, t) for i, t in enumerate([None, "", " ", "\n\n", "one", " lead", "trail \t", "has <P> in it", "<S>", "a<M", "<P<S", "x y z"] * 4)],
    (None, "null id text here"), (None, None), (7, "same"), (7, "same"), (2000, "long word " * 60_000 + " " * 5000), (2**53 + 1, "a large id of its own"),
]


def test_middles_equal_brute_force(spark, docs):
    got = rows(fill_middle.digest(docs(MIDDLE_CASES, CLASH).repartition(3)))
    assert got == sorted(brute.middles(MIDDLE_CASES), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert rows(fill_middle.digest(docs([]))) == []


def test_middles_are_restored_and_columns_kept(spark, docs):
    given = docs(MIDDLE_CASES, ["'kept' as more", "1 as fim_text"])
    made = fill_middle.transform(given)
    assert made.columns == ["doc_id", "text", "lang", "source", "n_chars", "more", "n_units", "form", "prefix_chars", "middle_chars", "fim_text", "fim_sha256"]
    back = made.withColumn("again", fill_middle.restored("fim_text", "form"))
    assert back.where("again <> coalesce(text, '') or more <> 'kept'").count() == 0 and back.count() == len(MIDDLE_CASES)
    assert back.where("form <> 'plain' and (fim_text not like '%<M>%' or text like '%<M>%')").count() == 0


def test_rates_and_wrong_outputs():
    all_spm = [fill_middle.form(str(i), "a b c d", fim_percent=100, spm_percent=100) for i in range(50)]
    assert {f.form for f in all_spm} == {"spm"} and all(fill_middle.restore(f.text, f.form) == "a b c d" for f in all_spm)
    assert {fill_middle.form(str(i), "a b c d", fim_percent=0).form for i in range(50)} == {"plain"}
    for bad in ("<S>x<P>y<M>z", "<P>x", "<P>x<S>y", ""):
        with pytest.raises(ValueError, match="psm"):
            fill_middle.restore(bad, "psm")
    text = "ab \r\n" * 3 + "end \x0b"
    assert list(fill_middle.unit_ends(text)) == [m.end() for m in re.finditer(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)]
