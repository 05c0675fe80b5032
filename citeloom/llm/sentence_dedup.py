"""Operator 9: substring dedup by sliding sentence spans.

A text is cut into sentences (up to and with `.`, `!`, `?` or a line break; the pieces make up the text again). The hash of a span
covers its words only, lower-cased, so marks and line breaks don't matter to it. Hashed are, of the runs of at least
SENTENCES sentences with at least WORDS words and of the single sentences with twice as many,

- every run of up to MOST_SENTENCES sentences and MOST_WORDS words, whatever its place,
- from each sentence on and up to the end of each, the shortest (which may be longer than that), and
- the same two of the text cut at `.`, `!`, `?` and blank lines only, so that longer sentences are known whatever their line breaks.

Spans are joined globally by hash, and every sentence that a span covers goes unless that span is the first of its hash, by
doc_id, then text hash, then place. Spans of one text count as well, so a passage repeated in a text stays once.

What hashing all runs of any length would remove beyond: where two texts that are cut differently agree in no two borders within
MOST_SENTENCES sentences and MOST_WORDS words, and not in two stops next to one another either, the agreeing runs are all longer and not hashed. Texts that are cut
alike lose nothing: each sentence of a repeated run is in the shortest run from it on within the run, or else in the shortest that ends with it.
Under the bounds, and for equal cuts, the tests hold it against all runs; for random cuts they measure the share.

Scale: the spans are written once. Hashes are counted first (two numbers a row, with map-side combine), and only spans whose hash occurs
again go on, so what is unique crosses the network twice and narrow. First occurrences are a minimum with map-side combine, so a
passage in a third of all texts leaves each task once; the joins back are equi-joins of written tables that adaptive execution may
split. A sentence has at most MOST_SENTENCES + 3 spans. Only runs of sentence numbers, not texts, are gathered for each text.

Defined cases: null text: no sentences, text stays null; empty text: none; fewer words than a span: never removed;
null doc_id comes last (as the greatest id); very long texts: cut and hashed whole; rows with equal doc_id and text are one document; empty table: no rows; extra columns are
ignored. Hash equality stands for equality (64 bits).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.common import materialize, scratch, text_key, trim
from citeloom.llm.hashing import mix, words

SENTENCES = 2
WORDS = 16
MOST_SENTENCES = 10
MOST_WORDS = 64
PIECE = re.compile(r"[^.!?\n]*[.!?\n]+|[^.!?\n]+")
STOP = re.compile(r"[.!?]|\n\n")
_TURN = np.random.Generator(np.random.PCG64(31)).integers(0, 2**64, 1, dtype=np.uint64) | np.uint64(1)
_LAST = 2**63 - 1


def cut(text: str) -> tuple[list[str], list[bool]]:
    """Pieces that make up text, and whether each ends at a stop or a blank line; white space and marks alone join the piece before."""
    out: list[str] = []
    stops: list[bool] = []
    for m in PIECE.finditer(text):
        stop = STOP.search(m[0]) is not None
        if out and not any(c.isalnum() for c in m[0]):
            out[-1] += m[0]
            stops[-1] |= stop
        else:
            out.append(m[0])
            stops.append(stop)
    return out, stops


def sentences(text: str) -> list[str]:
    return cut(text)[0]


def shortest(at: np.ndarray, least_sentences: int, least_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the shortest run from each sentence on and up to the end of each; at: words before each sentence, and all."""
    n = len(at) - 1
    first, until = np.arange(n), np.arange(1, n + 1)
    single = np.diff(at) >= 2 * least_words
    end = np.where(single, until, np.maximum(np.searchsorted(at, at[:-1] + least_words), first + least_sentences))
    since = np.where(single, first, np.minimum(np.searchsorted(at, at[1:] - least_words, side="right") - 1, until - least_sentences))
    return np.concatenate([first[end <= n], since[since >= 0]]), np.concatenate([end[end <= n], until[since >= 0]])


def bounded(at: np.ndarray, least_sentences: int, least_words: int, most_sentences: int, most_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of every run within the bounds."""
    first = np.arange(len(at) - 1)
    low = np.maximum(np.searchsorted(at, at[:-1] + least_words), first + least_sentences)
    high = np.minimum(np.searchsorted(at, at[:-1] + most_words, side="right") - 1, first + most_sentences)
    n = np.maximum(high - low + 1, 0)
    return np.repeat(first, n), np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def spans(text: str, least_sentences: int, least_words: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(number of sentences, first sentence, end sentence and hash of each span)."""
    parts, stops = cut(text)
    data = [re.sub(r"[^\w\s]+", " ", p.lower()).encode("utf-8", "surrogatepass") for p in parts]
    starts, hashes = words(b"\n".join(data))
    offsets = np.concatenate([[0], np.cumsum([len(d) + 1 for d in data])]) if data else np.zeros(1, np.int64)
    at = np.searchsorted(starts, offsets)  # words before each sentence
    n = len(parts)
    found = [shortest(at, least_sentences, least_words), bounded(at, least_sentences, least_words, MOST_SENTENCES, MOST_WORDS)]
    if not all(stops[:-1]):
        borders = np.unique(np.concatenate([[0], np.flatnonzero(stops) + 1, [n]]))
        found.append(tuple(borders[x] for x in shortest(at[borders], least_sentences, least_words)))
    key = np.unique(np.concatenate([f * (n + 1) + e for f, e in found]))
    first, end = key // (n + 1), key % (n + 1)
    ok = np.diff(at)[first] > 0
    first, end = first[ok], end[ok]
    # a polynomial over the words, by prefix sums with the powers of an odd number and of its inverse
    m = len(hashes)
    powers = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.repeat(_TURN, m)]))
    inverse = pow(int(_TURN[0]), -1, 1 << 64)
    back = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(m, inverse, np.uint64)]))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers[:m], dtype=np.uint64)])
    a, z = at[first], at[end]
    return n, first, end, mix((sums[z] - sums[a]) * back[a] + (z - a).astype(np.uint64))


def _covered(spans: DataFrame) -> DataFrame:
    """doc_id, tkey and the spans (first, end) of the text that are not the first of their hash."""
    found = materialize(spans, "spans")
    again = materialize(found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "again")
    found = materialize(found.join(again, "h", "left_semi"), "repeated")
    place = F.struct(F.coalesce("doc_id", F.lit(_LAST)).alias("doc_id"), "tkey", "first")
    # compares places, not rows, so that repeated rows are one document
    leading = found.groupBy("h").agg(F.min(place).alias("lead"), F.max(place).alias("last")).where("lead != last").select("h", "lead")
    leading = materialize(leading, "leading")  # a join of two plain tables, whose hot keys adaptive execution can split
    return found.join(leading, "h").where(place != F.col("lead")).groupBy("doc_id", "tkey").agg(F.collect_set(F.struct("first", "end")).alias("gone"))


def dedup(docs: DataFrame, least_sentences: int = SENTENCES, least_words: int = WORDS) -> DataFrame:
    """doc_id, n_sentences, n_removed and the remaining text of every row."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn("tkey", text_key())

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                ids, keys, first, end, h = [], [], [], [], []
                for doc_id, tkey, text in zip(part.column("doc_id").to_pylist(), part.column("tkey").to_pylist(), part.column("text").to_pylist()):
                    _, f, e, x = spans(text or "", least_sentences, least_words)
                    ids += [doc_id] * len(f)
                    keys += [tkey] * len(f)
                    first.append(f), end.append(e), h.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(h).view(np.int64)), pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(np.concatenate(first).astype(np.int32)), pa.array(np.concatenate(end).astype(np.int32))], names=["h", "doc_id", "tkey", "first", "end"])
        trim()

    with scratch() as keep:
        covered = keep(materialize(_covered(rows.mapInArrow(hashed, "h long, doc_id long, tkey long, first int, end int")), "covered"))
    covered = covered.select(F.col("doc_id").alias("i"), F.col("tkey").alias("k"), F.col("gone.first").alias("first"), F.col("gone.end").alias("end"))
    joined = rows.join(covered, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("tkey") == F.col("k")), "left").select("doc_id", "text", "first", "end")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, gone, kept = [], [], []
            for text, first, end in zip(b.column("text").to_pylist(), b.column("first").to_pylist(), b.column("end").to_pylist()):
                parts = sentences(text or "")
                total.append(len(parts))
                if first is None:
                    gone.append(0)
                    kept.append(text)
                    continue
                cover = np.zeros(len(parts) + 1, np.int64)
                np.add.at(cover, first, 1)
                np.add.at(cover, end, -1)
                stays = np.cumsum(cover[:-1]) == 0
                gone.append(len(parts) - int(stays.sum()))
                kept.append("".join(p for p, s in zip(parts, stays) if s))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_sentences", "n_removed", "text"])
        trim()

    return joined.mapInArrow(remove, "doc_id long, n_sentences long, n_removed long, text string")
