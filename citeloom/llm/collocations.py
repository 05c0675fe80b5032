"""Operator 11: phrase collocation mining with compressed position bitmaps.

Texts are lower-cased (A-Z), cut into pieces at `. , ; : ! ?` and line ends, and pieces into words at blanks and tabs. A phrase of 2 to
`longest` words that occurs at least `least` times within the pieces of a language is a candidate. Its score is the lowest of its
cuts into two parts, floor(1000 f(phrase) n / (f(first) f(rest))) with n all words of the language; candidates that a longer one covers go.

1. Each task deals its words to shards of one language and at most about `shard_words` words, numbered from 0 with a free number
   after every piece. A word's bitmap has a bit for each number; the bytes that are not 0 are kept, with their places.
2. Words are counted over all shards; those that are frequent get an id, and each shard learns which of its words they are.
3. Phrases grow by a word a round. A shard extends its frequent phrases depth-first: the phrase's bitmap is shifted by
   one and ANDed with the bitmaps of the words that have a byte in the same places, the bits left are counted. Numbers between pieces
   belong to no word, so no phrase crosses them. A phrase whose last words (all but the first) are not frequent is not counted.
   A shard's counts are packed into arrays by bucket (a hash of the phrase); a task sums a bucket over all shards, gives the frequent
   phrases ids and tells each shard which of them it has.
4. Candidates are joined with the counts of their parts, covered ones dropped and the best of each language ranked. Products are
   decimals of up to 38 digits, divided exactly.

A phrase is known as (id of all but its last word, id of its last word), so no hash stands for equality.

Scale: a shard's words never meet in one row but with those of the same task; what is shuffled are distinct (shard, word) pairs, the counts of
distinct (shard, phrase) pairs as packed arrays, and the bitmaps once a round. A word or phrase in every text has one pair a shard.
A bucket holds half of a shuffle partition's share of the pairs, so its size is set by the number of partitions. The join of words back to shards is of written tables by plain
equality, whose hot keys adaptive execution can split. A phrase that is covered is covered by one that is a word longer, as counts
only fall with length, so phrases meet those only. The ranks are taken of SALTS parts of a language first, then of the best of each.
No dictionary is broadcast by us or collected.

Defined cases: null lang: `und`; null or empty text: no words; text without cuts: one piece; a text beyond the shard size: a shard of its own;
fewer words than two: nothing; repeated rows: each counts; ties of scores: smallest cut, then count, then phrase by bytes; empty table: no rows; extra columns: ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.common import TEXT_ROWS, materialize, scratch, trim
from citeloom.llm.hashing import mix

LEAST = 100
LONGEST = 5
TOP = 2000
COVERED = 100  # percent of a phrase's count from which a longer phrase covers it
SHARD_WORDS = 500_000
ENTRIES = 250_000  # bytes of bitmaps that are extended at once
SALTS = 64

_CUT = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n" * 10 + b" ")
_NOTHING, _GAP = 0, 1
SHARD = "shard long, lang string, words array<binary>, counts array<long>, sizes binary, blocks binary, bits binary"


class Vocabulary(dict):
    """Words to numbers in the order in which they are first asked for; 0 and 1 are no words."""

    def __init__(self) -> None:
        super().__init__({b"": _NOTHING, b"\n": _GAP})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Bitmaps(NamedTuple):
    """Of each word in turn: `sizes` bytes that are not 0, their block (place // 8) and their bits."""

    sizes: np.ndarray
    blocks: np.ndarray
    bits: np.ndarray


def tokens(text: bytes) -> list[bytes]:
    """The words of a text, with line feeds where pieces end and empty words to be left out."""
    return text.lower().translate(_CUT).replace(b"\n", b" \n ").split(b" ")


def bitmaps(words: np.ndarray, n_words: int) -> Bitmaps:
    """words: at each place a word's number, or -1."""
    place = np.flatnonzero(words >= 0)
    place = place[np.argsort(words[place], kind="stable")]
    word, block = words[place], place >> 3
    new = np.ones(len(place), bool)
    new[1:] = (word[1:] != word[:-1]) | (block[1:] != block[:-1])
    first = np.flatnonzero(new)
    bits = np.bitwise_or.reduceat((1 << (place & 7)).astype(np.uint8), first) if len(first) else np.empty(0, np.uint8)
    return Bitmaps(np.bincount(word[first], minlength=n_words).astype(np.int32), block[first].astype(np.int32), bits)


class Shard:
    """The words of one language that a task gathers."""

    def __init__(self) -> None:
        self.vocabulary, self.parts, self.size = Vocabulary(), [], 0

    def add(self, text: bytes) -> int:
        """Returns the places used."""
        t = tokens(text)
        found = np.fromiter(map(self.vocabulary.__getitem__, t), np.int32, len(t))
        found = np.append(found[found != _NOTHING], np.int32(_GAP))
        keep = np.ones(len(found), bool)
        keep[1:] = (found[1:] != _GAP) | (found[:-1] != _GAP)
        self.parts.append(found[keep])
        self.size += len(self.parts[-1])
        return len(self.parts[-1])

    def row(self, number: int, lang: str) -> pa.RecordBatch:
        words = np.concatenate(self.parts) - 2
        n = len(self.vocabulary) - 2
        maps = bitmaps(words, n)
        counts = np.bincount(words[words >= 0], minlength=n)
        listed = pa.array([list(self.vocabulary)[2:]], pa.list_(pa.binary()))
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([lang]), listed, pa.array([counts.tolist()], pa.list_(pa.int64())), *[pa.array([x.tobytes()], pa.binary()) for x in maps]],
            names=["shard", "lang", "words", "counts", "sizes", "blocks", "bits"],
        )


def _shards(docs: DataFrame, shard_words: int) -> DataFrame:
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Shard] = {}
        size, number = 0, TaskContext.get().partitionId() << 32
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text")):
                size += held.setdefault(lang, Shard()).add(text.as_py())
                if size >= shard_words:
                    for k, shard in held.items():
                        yield shard.row(number, k)
                        number += 1
                    held, size = {}, 0
        for k, shard in held.items():
            yield shard.row(number, k)
            number += 1
        trim()

    text = F.col("text").cast("string").cast("binary").alias("text")
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text).where("length(text) > 0")
    return materialize(rows.mapInArrow(deal, SHARD), "phrase-shards", TEXT_ROWS)


class Level(NamedTuple):
    """A shard's frequent phrases of one length: global ids by their local numbers, and for lookups the sorted (parent, word) keys."""

    ids: np.ndarray
    keys: np.ndarray
    parent: np.ndarray
    word: np.ndarray


def _level(above: Level, words: np.ndarray, parent: np.ndarray, word: np.ndarray, ids: np.ndarray) -> Level:
    """From global ids; above: the phrases that are a word shorter, words: the sorted ids of the words."""
    by_id = np.argsort(above.ids, kind="stable")
    p = by_id[np.searchsorted(above.ids, parent, sorter=by_id)]
    w = np.searchsorted(words, word)
    keys = p * len(words) + w
    order = np.argsort(keys, kind="stable")
    return Level(ids[order], keys[order], p[order], w[order])


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of the wanted keys, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def extend(maps: Bitmaps, places: np.ndarray, ids: np.ndarray, known: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(id of a phrase, id of a word after it, count) for phrases of the greatest known length, in parts.

    places and ids: the frequent words' numbers in the shard and their ids; known: for 2 words on, (parent, word, id) of the
    frequent phrases in the shard.
    """
    order = np.argsort(ids, kind="stable")
    places, ids = places[order], ids[order]
    levels = [Level(ids, ids, np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for parent, word, own in known:
        levels.append(_level(levels[-1], ids, parent, word, own))
    if not len(ids) or not len(levels[-1].ids):
        return
    n_words = len(ids)
    # the number, a level above, of a phrase without its first word
    tails = [np.zeros(n_words, np.int64)]
    for j in range(1, len(levels)):
        tails.append(levels[j].word if j == 1 else _find(levels[j - 1].keys, tails[j - 1][levels[j].parent] * n_words + levels[j].word))
    # only phrases that lead to one of the greatest length
    needed = [np.ones(len(levels[-1].ids), bool)]
    for j in range(len(levels) - 1, 0, -1):
        lead = np.zeros(len(levels[j - 1].ids), bool)
        lead[levels[j].parent[needed[0]]] = True
        needed.insert(0, lead)
    ends = np.cumsum(maps.sizes, dtype=np.int64)
    sizes = maps.sizes[places].astype(np.int64)
    at = np.repeat(ends[places] - sizes, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    word, block, bits = np.repeat(np.arange(n_words), sizes), maps.blocks[at].astype(np.int64), maps.bits[at]
    by_block = np.argsort(block, kind="stable")
    block_word, block_bits = word[by_block], bits[by_block]
    start = np.concatenate([[0], np.cumsum(np.bincount(block, minlength=int(block.max()) + 2)), [len(block)]])

    def grow(j: int, phrase: np.ndarray, block: np.ndarray, bits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """phrase, block, bits: the bitmaps of some phrases of levels[j]."""
        over = np.flatnonzero(bits & 0x80)  # the last place of a block shifts into the next block
        inside = np.flatnonzero(bits & 0x7F)
        phrase = np.concatenate([phrase[inside], phrase[over]])
        shifted = np.concatenate([bits[inside] << np.uint8(1), np.ones(len(over), np.uint8)])
        block = np.concatenate([block[inside], block[over] + 1])
        n = start[block + 1] - start[block]
        one = np.repeat(np.arange(len(block)), n)
        other = np.arange(len(one)) + np.repeat(start[block] - (np.cumsum(n) - n), n)
        both = shifted[one] & block_bits[other]
        hit = np.flatnonzero(both)
        one, both, word = one[hit], both[hit], block_word[other[hit]]
        phrase, block = phrase[one], block[one]
        if j:
            ok = np.flatnonzero(_find(levels[j].keys, tails[j][phrase] * n_words + word) >= 0)
            phrase, block, both, word = phrase[ok], block[ok], both[ok], word[ok]
        keys = phrase * n_words + word
        if j + 1 == len(levels):
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], np.bitwise_count(both[order]).astype(np.int64)
            if len(keys):
                first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
                yield levels[j].ids[keys[first] // n_words], ids[keys[first] % n_words], np.add.reduceat(counts, first)
        else:
            child = _find(levels[j + 1].keys, keys)
            ok = np.flatnonzero(child >= 0)
            ok = ok[needed[j + 1][child[ok]]]
            if len(ok):
                yield from grow(j + 1, child[ok], block[ok], both[ok])

    roots = np.flatnonzero(needed[0])
    part = np.cumsum(sizes[roots]) // ENTRIES
    root_part = np.full(n_words, -1)
    root_part[roots] = part
    entry_part = root_part[word]
    for k in np.unique(part):
        mine = np.flatnonzero(entry_part == k)
        yield from grow(0, word[mine], block[mine], bits[mine])


def _places(b: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers and ids of a shard's frequent words."""
    return tuple(b.column(c).slice(row, 1).flatten().to_numpy(zero_copy_only=False) for c in ("places", "ids"))


def planes(x: np.ndarray) -> bytes:
    """The bytes of whole numbers, first the lowest byte of each, then the next: what Spark writes and sends of them is compressed, and most high bytes are equal."""
    return x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def from_planes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def _phrases(b: pa.RecordBatch, column: str, row: int) -> tuple[np.ndarray, ...]:
    """(parent, word, id) of a shard's frequent phrases of one length, from the parts in which the buckets gave them."""
    parts = [from_planes(x, np.int64).reshape(3, -1) for x in b.column(column)[row].as_py()]
    return tuple(np.concatenate(parts, axis=1))


def _packed(parent: np.ndarray, word: np.ndarray, n: np.ndarray, shard: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """A shard's counts, a row for each bucket of phrases."""
    bucket = (mix(mix(parent.view(np.uint64)) + word.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    bucket, parent, word, n = bucket[order], parent[order], word[order], n[order].astype(np.int32)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    ends = [*first[1:].tolist(), len(bucket)]
    arrays = [pa.array([planes(x[a:z]) for a, z in zip(first.tolist(), ends)], pa.binary()) for x in (parent, word, n)]
    yield pa.RecordBatch.from_arrays([pa.array(bucket[first]), pa.array(np.full(len(first), shard)), *arrays], names=["bucket", "shard", "parent", "word", "n"])


PACKED = "bucket int, shard long, parent binary, word binary, n binary"
MERGED = "shard long, parent array<long>, word array<long>, id array<long>, f array<long>, phrases binary"


_MERGED_NAMES = ("shard", "parent", "word", "id", "f", "phrases")
_MERGED_TYPES = (pa.int64(), *[pa.list_(pa.int64())] * 4, pa.binary())


def merge(bucket: int, held: pa.Table, least: int) -> pa.Table:
    """The counts of a bucket summed over its shards: the phrases that are frequent (a row without shard), and which of them each shard has."""
    parent, word, n = (np.concatenate([from_planes(x, kind) for x in held.column(c).to_pylist()]) for c, kind in (("parent", np.int64), ("word", np.int64), ("n", np.int32)))
    sizes = np.array([len(x) // 4 for x in held.column("n").to_pylist()])
    shard = np.repeat(held.column("shard").to_numpy(), sizes)
    order = np.lexsort((word, parent))
    parent, word, shard = parent[order], word[order], shard[order]
    new = np.ones(len(parent), bool)
    new[1:] = (parent[1:] != parent[:-1]) | (word[1:] != word[:-1])
    first = np.flatnonzero(new)
    f = np.add.reduceat(n[order].astype(np.int64), first)
    often = np.flatnonzero(f >= least)
    ids = (bucket << 32) + np.arange(len(f))
    if not len(often):
        return pa.table({c: pa.array([], t) for c, t in zip(_MERGED_NAMES, _MERGED_TYPES)})
    out = [(None, parent[first[often]], word[first[often]], ids[often], f[often], None)]
    phrase = np.cumsum(new) - 1
    kept = np.flatnonzero((f >= least)[phrase])
    kept = kept[np.argsort(shard[kept], kind="stable")]
    cuts = np.flatnonzero(np.concatenate([[True], shard[kept][1:] != shard[kept][:-1]])) if len(kept) else []
    for a, z in zip(cuts, [*cuts[1:], len(kept)]):
        k = kept[a:z]
        out.append((int(shard[k[0]]), None, None, None, None, planes(np.concatenate([parent[k], word[k], ids[phrase[k]]]))))
    return pa.table({c: pa.array([r[i] for r in out], t) for i, (c, t) in enumerate(zip(_MERGED_NAMES, _MERGED_TYPES))})


def _extended(shards: DataFrame, known: list[DataFrame], length: int, least: int) -> DataFrame:
    """The frequent phrases of this length, and those of each shard, as merge() gives them; known: by shard, the frequent words and then phrases."""
    rows = shards.select("shard", "sizes", "blocks", "bits")
    for df in known:
        rows = rows.join(df, "shard")
    buckets = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                maps = Bitmaps(*[np.frombuffer(b.column(c)[i].as_buffer(), kind) for c, kind in (("sizes", np.int32), ("blocks", np.int32), ("bits", np.uint8))])
                found = list(extend(maps, *_places(b, i), [_phrases(b, f"k{k}", i) for k in range(2, length)]))
                if found:
                    yield from _packed(*[np.concatenate(x) for x in zip(*found)], b.column("shard")[i].as_py(), buckets)
        trim()

    def summed(key: tuple, held: pa.Table) -> pa.Table:
        return merge(key[0].as_py(), held, least)

    return materialize(rows.mapInArrow(run, PACKED).groupBy("bucket").applyInArrow(summed, MERGED), f"phrases-{length}")


def _levels(docs: DataFrame, least: int, longest: int, shard_words: int) -> tuple[list[DataFrame], DataFrame]:
    """Written tables: for each length (id, lang, phrase, f); and the words of each lang."""
    shards = _shards(docs, shard_words)
    pairs = shards.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w"))
    pairs = pairs.select("shard", "lang", "place", F.col("w.words").cast("string").alias("phrase"), F.col("w.counts").alias("n"))
    summed = pairs.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    levels = [materialize(summed.select(F.monotonically_increasing_id().alias("id"), "lang", "phrase", "f"), "phrase-words")]
    totals = shards.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    totals = materialize(totals, "phrase-totals")
    back = pairs.select("shard", "lang", "place", "phrase").join(levels[0].select("lang", "phrase", "id"), ["lang", "phrase"])
    # two lists of one aggregation are in the same order
    known = [materialize(back.groupBy("shard").agg(F.collect_list("place").alias("places"), F.collect_list("id").alias("ids")), "phrase-known")]
    for length in range(2, longest + 1):
        merged = _extended(shards, known, length, least)
        often = merged.where("shard is null").select(F.inline(F.arrays_zip("parent", "word", "id", "f")))
        heads = levels[-1].select(F.col("id").alias("parent"), "lang", F.col("phrase").alias("head"))
        last = levels[0].select(F.col("id").alias("word"), F.col("phrase").alias("last"))
        spelt = often.join(heads, "parent").join(last, "word")
        level = materialize(spelt.select("id", "lang", F.concat_ws(" ", "head", "last").alias("phrase"), "f"), f"phrase-level-{length}")
        if level.isEmpty():
            break
        levels.append(level)
        if length < longest:
            known.append(merged.where("shard is not null").groupBy("shard").agg(F.collect_list("phrases").alias(f"k{length}")))
    return levels, totals


def _number(c: str) -> Column:
    return F.col(c).cast("decimal(16,0)")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int | None = TOP, covered: int = COVERED, shard_words: int = SHARD_WORDS) -> DataFrame:
    """lang, rank, phrase, a (its count), l and r (the counts of the parts of its lowest cut), n (words of the language), score; all candidates that stay if top is None."""
    if least < 1 or longest < 2 or not 0 < covered <= 100:
        raise ValueError("least must be at least 1, longest at least 2, covered from 1 to 100")
    with scratch() as keep:
        levels, totals = _levels(docs, least, longest, shard_words)
        return keep(materialize(_ranked(levels, totals, top, covered), "collocations"))


def _ranked(levels: list[DataFrame], totals: DataFrame, top: int | None, covered: int) -> DataFrame:
    counts = reduce(DataFrame.unionAll, [df.select("lang", "phrase", "f") for df in levels])
    words = F.split("phrase", " ")

    def part(first: Column | int, n: Column) -> Column:
        return F.array_join(F.slice("w", first, n), " ")

    phrases = [df.select("lang", "phrase", F.col("f").alias("a"), words.alias("w")) for df in levels[1:]] or [levels[0].select("lang", "phrase", F.col("f").alias("a"), words.alias("w")).limit(0)]
    candidates = reduce(DataFrame.unionAll, phrases)
    size = F.size("w")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).select("lang", "phrase", "a", "k", part(1, F.col("k")).alias("first"), part(F.col("k") + 1, size - F.col("k")).alias("rest"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]).join(totals, "lang")
    score = F.call_function("div", _number("a") * _number("n") * F.lit(1000).cast("decimal(4,0)"), _number("l") * _number("r"))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c"))
    longer = candidates.where(size > 2).select("lang", F.col("a").alias("f"), F.explode(F.array(part(1, size - 1), part(2, size - 1))).alias("phrase"))
    cover = longer.groupBy("lang", "phrase").agg(F.max("f").alias("cover"))
    kept = best.join(cover, ["lang", "phrase"], "left").where(F.col("cover").isNull() | (100 * F.col("cover") < covered * F.col("a")))
    kept = kept.select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if top is not None:
        salted = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
        kept = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top).drop("rank", "salt")
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
