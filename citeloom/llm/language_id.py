"""Operator 3: language identification by rank-order profiles of character n-grams.

A profile is a language's most frequent n-grams (one to three letters, word borders marked) in rank order. A
document's own most frequent n-grams are ranked the same way, and its out-of-place distance to a profile is the
sum of the rank differences, an n-gram that the profile lacks counting as out of place by the profile's size.
The language with the smallest distance is predicted; score = 1 - distance / largest possible distance.

Learning uses at most about SAMPLE documents a language (documented bound; chosen by a hash of doc_id, so any
input size gives an even sample); prediction covers every whole text. The profiles, SIZE n-grams a language, are
the only thing shipped to the tasks, and learning fails rather than ship more than MAX_LANGUAGES of them.

N-grams are packed 21 bits a letter into 64-bit integers and counted by sorting, so every script works and a text
of any length is counted in pieces.

Defined cases: null text or no letter: `und`, score 0; nothing to learn from: `und` everywhere; ties: the first
language in order; null doc_id: taken as held out; empty table gives no rows; extra columns are ignored; repeated
rows each get a result row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.common import TEXT_ROWS, free_name, materialize, text_key, trim, without
from citeloom.llm.mixing import uniform

SIZE = 300
SAMPLE = 2000
SEED = 31
MAX_LANGUAGES = 2000
UNDETERMINED = "und"
BORDER = 0x1FFFFF
PIECE = 1 << 20


class Profiles(NamedTuple):
    languages: list[str]
    grams: np.ndarray  # sorted
    ranks: np.ndarray  # languages x grams; SIZE where a profile lacks the n-gram
    size: int


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def symbols(text: str) -> np.ndarray:
    """Lower-case letters as code points, each run of anything else as one BORDER, with a BORDER at either end; empty without letters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    is_letter = letters()[codes]
    if not is_letter.any():
        return np.empty(0, np.int64)
    codes = np.where(is_letter, codes, BORDER)
    codes = np.concatenate([[BORDER], codes, [BORDER]])
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != BORDER) | (codes[:-1] != BORDER)
    return codes[keep]


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of text and how often each occurs."""
    codes = symbols(text)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for at in range(0, max(len(codes) - 1, 0), PIECE):
        a = codes[at : at + PIECE + 2]  # the two symbols beyond the piece complete the n-grams that begin in it
        one = a[:PIECE]
        two = (a[:-1] << 21 | a[1:])[:PIECE]
        three = (a[:-2] << 42 | a[1:-1] << 21 | a[2:])[:PIECE][(a[1:-1] != BORDER)[:PIECE]]
        found.append(np.unique(np.concatenate([one[one != BORDER], two, three]), return_counts=True))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if len(found) == 1:
        return found[0]
    keys, inverse = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
    return keys, np.bincount(inverse, weights=np.concatenate([f[1] for f in found])).astype(np.int64)


def most_frequent(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    if len(keys) > 4 * size:  # the size-th largest count bounds what needs sorting
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        keys, counts = keys[counts >= least], counts[counts >= least]
    return keys[np.lexsort((keys, -counts))[:size]]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def learn(docs: DataFrame, size: int = SIZE, sample: int = SAMPLE) -> Profiles:
    """Profiles from the text and lang of the documents that are not held out."""
    usable = docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return Profiles([], np.empty(0, np.int64), np.empty((0, 0), np.int64), size)
    draw = uniform(f"{SEED}", F.col("doc_id").cast("string"))
    share = docs.sparkSession.createDataFrame([(k, min(1.0, sample / n)) for k, n in sizes.items()], "lang string, share double")
    drawn = usable.join(F.broadcast(share), "lang").where(draw < F.col("share")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, dict[int, int]] = {}
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                mine = totals.setdefault(lang, {})
                for k, n in zip(*map(np.ndarray.tolist, counted(text))):
                    mine[k] = mine.get(k, 0) + n
        for lang, mine in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(mine), pa.string()), pa.array(list(mine), pa.int64()), pa.array(list(mine.values()), pa.int64())], names=["lang", "gram", "n"])

    totals = drawn.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    rows = totals.withColumn("rank", rank).where(F.col("rank") <= size).select("lang", "gram", "rank").collect()
    languages = sorted({r["lang"] for r in rows})
    grams = np.unique(np.array([r["gram"] for r in rows], dtype=np.int64))
    ranks = np.full((len(languages), len(grams)), size, dtype=np.int64)
    for r in rows:
        ranks[languages.index(r["lang"]), np.searchsorted(grams, r["gram"])] = r["rank"] - 1
    return Profiles(languages, grams, ranks, size)


def classify(text: str | None, profiles: Profiles) -> tuple[str, float]:
    if not text or not profiles.languages:
        return UNDETERMINED, 0.0
    top = most_frequent(*counted(text), profiles.size)
    if not len(top):
        return UNDETERMINED, 0.0
    at = np.minimum(np.searchsorted(profiles.grams, top), len(profiles.grams) - 1)
    known = profiles.grams[at] == top
    missing = (len(top) - int(known.sum())) * profiles.size
    ranks = profiles.ranks[:, at[known]]
    distances = np.where(ranks == profiles.size, profiles.size, np.abs(ranks - np.flatnonzero(known))).sum(axis=1) + missing
    best = int(distances.argmin())
    return profiles.languages[best], float(1 - distances[best] / (len(top) * profiles.size))


def identify(docs: DataFrame, profiles: Profiles | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in keep, then lang_pred and score, a row for every row of docs."""
    profiles = profiles or learn(docs)
    helper = free_name(list(keep), "__text")
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep) + ", lang_pred string, score double"

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [classify(t.as_py(), profiles) for t in b.column(helper)]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=[*keep, "lang_pred", "score"])
        trim()

    return docs.select(*keep, F.col("text").cast("string").alias(helper)).mapInArrow(predict, schema)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return identify(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def reject_undetermined(docs: DataFrame, profiles: Profiles | None = None) -> DataFrame:
    """The rows of docs whose language can be told; the others (null text, no letters) are rejected. Only keys of rejected rows come back from Python."""
    profiles = profiles or learn(docs)
    keyed = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), text_key().alias("tkey"))
    gone = identify(keyed, profiles, ("doc_id", "tkey")).where(F.col("lang_pred") == UNDETERMINED).select("doc_id", "tkey")
    return without(docs, materialize(gone, "undetermined", TEXT_ROWS))
