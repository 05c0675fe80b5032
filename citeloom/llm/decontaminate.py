"""Operator 6: benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts and benchmark items are compared as lower-case code points with every run of white space as one space. An item of
m characters, however many, occurs where a piece of one text is within K = floor(RATE * m) edits of it. Of an item longer
than UNIT, windows of UNIT characters that overlap by half are looked for besides, each within its own floor(RATE * UNIT)
edits, so a passage that holds a good part of a long item is found too.

What is filtered are units: an item of at most UNIT characters, a window, or a part of a longer item, which is cut into r equal parts
of PART characters or some more. Of K edits at least one part has k = floor(K / r) or fewer, wherever they lie; where
a part is found, the whole item is aligned around it with its whole budget. By the q-gram lemma an occurrence of a unit of m
characters with at most k edits shares at least m + 1 - q (k + 1) q-grams with it on
diagonals (text position - unit position) that differ by at most k. q is the largest of LENGTHS that leaves a bound
of at least one, so the filter loses no occurrence of any length: 8 for most units, 4 for some of up to 31 characters.
Units without edits (under 10 characters) are looked for as they are.

1. A table of bits says for each q-gram of a text whether any unit of a length class has it; places whose window
   of the class's length counts fewer of them than the lemma asks are out.
2. The other hits are counted in overlapping diagonal bands of twice the class's largest k, each hit in two bands, so
   the hits of one occurrence always meet in one band. Bands below the unit's bound are out.
3. The regions of the remaining bands, cut at the ends of texts, are verified by a banded alignment with free text
   ends, again beside each occurrence until nothing more is found. Around the occurrence of a part the same is done for its item.

An item of fewer than WHOLE characters counts only between word borders, so that `art` isn't found in `part`.
Neighbouring occurrences of an item's units are reported as one span of the original text in code points.

Execution: the benchmark is read in chunks of at most CHUNK characters; a chunk's q-gram index, of a size that this
bounds, is shipped to the tasks, which scan whole texts; no shuffle. More than one chunk: one scan each, whose hits
are written before the next, and the results are united. keep_clean() takes only the keys of the rows that go back
from Python and leaves texts where they are.

Defined cases: null or empty text: no occurrence; null or blank item: none either; null item_id: reported as null;
very long texts: scanned whole, each as a block of its own; an occurrence never spans two texts, whichever rows a task
holds; of overlapping occurrences of one unit any set that leaves no gap is reported (as one span); repeated items or
rows: each gets its rows; empty tables: no rows; extra columns are ignored (keep_clean() passes them on).
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.common import TEXT_ROWS, materialize, scratch, text_key, trim, without

LENGTHS = (8, 4, 2, 1)  # of q-grams
RATE = 0.1
UNIT = 200  # at most 255: a place in a unit is packed into 8 bits
PART = 100  # the parts of a longer item have so many characters up to twice as many
WHOLE = 24
CHUNK = 2_000_000
BLOCK = 100_000  # characters of text scanned together; their arrays fit into a core's cache
TABLE_BITS = 22
RUN = 32
BREAK = 0x110000  # stands between texts, in no text
NEAR = 100  # occurrences of an item this close are one span

_POWER = np.uint64(0x9E3779B97F4A7C15)
SPANS = "doc_id long, item_id long, start int, end int, n_units int, edits int"


@lru_cache(maxsize=1)
def folding() -> np.ndarray:
    """Code point to lower-case code point; white space to a space."""
    table = np.arange(BREAK + 1, dtype=np.int32)
    for c in range(BREAK):
        s = chr(c)
        if s.isspace():
            table[c] = 32
        elif len(low := s.lower()) == 1:
            table[c] = ord(low)
    return table


def normalised(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(code points, their places in text)"""
    codes = folding()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.int32)]
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    places = np.flatnonzero(keep)
    return codes[places], places


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A hash of the q code points from each place on; q is a power of two."""
    h, width, power = codes.astype(np.uint64) * _POWER + np.uint64(1), 1, _POWER
    while width < q:
        if len(h) <= width:
            return np.empty(0, np.uint64)
        with np.errstate(over="ignore"):
            h = h[:-width] * power + h[width:]
            h ^= h >> np.uint64(29)
            power = power * power + np.uint64(2)
        width *= 2
    return h * _POWER


class Unit(NamedTuple):
    item: int
    codes: np.ndarray
    k: int
    q: int  # 0: looked for as it is
    least: int  # q-grams shared by the lemma
    bordered: bool
    whole: int = -1  # of a part, its item's number in Index.wholes
    offset: int = 0  # of a part, its place in the item


class Grams(NamedTuple):
    """The units that are filtered by q-grams of one length."""

    q: int
    table: np.ndarray  # bit c: some unit of class c has a q-gram with this hash prefix
    classes: list[tuple[int, int, int]]  # (window, least, largest k)
    hashes: np.ndarray  # sorted, with the unit and the place in it
    owner: np.ndarray
    place: np.ndarray


class Index(NamedTuple):
    item_ids: list
    units: list[Unit]
    wholes: list[Unit]  # the items longer than a unit
    grams: list[Grams]


def unit_of(item: int, codes: np.ndarray, k: int, bordered: bool = False, whole: int = -1, offset: int = 0) -> Unit:
    q = next(x for x in LENGTHS if len(codes) + 1 - x * (k + 1) >= 1) if k else 0
    return Unit(item, codes, k, q, len(codes) + 1 - q * (k + 1), bordered, whole, offset)


def units_of(item: int, codes: np.ndarray, rate: float, unit: int, whole: int) -> list[Unit]:
    """The units to look for so that no occurrence of the item is lost; whole: its number among the longer items."""
    m = len(codes)
    if m <= unit:
        return [unit_of(item, codes, int(rate * m), m < WHOLE)]
    windows = [unit_of(item, codes[s : s + unit], int(rate * unit)) for s in [*range(0, m - unit, unit // 2), m - unit]]
    r = max(-(-m // unit), m // PART)
    cuts = [m * i // r for i in range(r + 1)]
    return windows + [unit_of(item, codes[a:z], int(rate * m) // r, whole=whole, offset=a) for a, z in zip(cuts[:-1], cuts[1:])]


def grams_of(units: list[Unit], q: int, unit: int) -> Grams:
    bounds = [0, 60, 100, 140, 170, unit + 1]
    table, classes, hashes, owner, place = np.zeros(1 << TABLE_BITS, np.uint8), [], [], [], []
    for a, z in zip(bounds[:-1], bounds[1:]):
        mine = [u for u in units if u.q == q and a <= len(u.codes) < z]
        if not mine:
            continue
        bit = np.uint8(1 << len(classes))
        classes.append((max(len(u.codes) + u.k for u in mine), min(u.least for u in mine), max(u.k for u in mine)))
        for u in mine:
            table[gram_hashes(u.codes, q) >> np.uint64(64 - TABLE_BITS)] |= bit
    for n, u in enumerate(units):
        if u.q == q:
            h = gram_hashes(u.codes, q)
            hashes.append(h), owner.append(np.full(len(h), n)), place.append(np.arange(len(h)))
    g, o, p = np.concatenate(hashes), np.concatenate(owner), np.concatenate(place)
    order = np.argsort(g, kind="stable")
    return Grams(q, table, classes, g[order], o[order], p[order])


def index(items: list[tuple[int | None, str | None]], rate: float = RATE, unit: int = UNIT) -> Index:
    if not 0 <= rate < 1:
        raise ValueError("rate must be at least 0 and less than 1")
    units: list[Unit] = []
    wholes: list[Unit] = []
    for n, (_, text) in enumerate(items):
        codes = normalised(text or "")[0]
        codes = codes[1:] if len(codes) and codes[0] == 32 else codes
        codes = codes[:-1] if len(codes) and codes[-1] == 32 else codes
        if len(codes):
            units += units_of(n, codes, rate, unit, len(wholes))
            if len(codes) > unit:
                wholes.append(Unit(n, codes, int(rate * len(codes)), 0, 0, False))
    return Index([i for i, _ in items], units, wholes, [grams_of(units, q, unit) for q in LENGTHS if any(u.q == q for u in units)])


def align(pattern: np.ndarray, text: np.ndarray, k: int) -> tuple[int, int] | None:
    """(edits, end in text) of the best occurrence of pattern within text with at most k edits, free text ends.

    Only the diagonals on which such an occurrence can lie are computed: len(text) - len(pattern) + 2 k + 1 of them.
    """
    m, n = len(pattern), len(text)
    width = n - m + 2 * k + 1
    if width < 1:
        return None
    edge = np.full(k, -1, text.dtype)  # equals nothing
    padded = np.concatenate([edge, text, edge])
    row = np.zeros(width, np.int32)
    steps = np.arange(width, dtype=np.int32)
    for i, c in enumerate(pattern.tolist()):
        new = row + (padded[i : i + width] != c)
        np.minimum(new[:-1], row[1:] + 1, out=new[:-1])
        row = np.minimum.accumulate(new - steps) + steps  # insertions along the row
        if row.min() > k:
            return None
    end = int(row.argmin())
    return int(row[end]), min(max(end + m - k, 0), n)


def occurrence(u: Unit, text: np.ndarray) -> tuple[int, int, int] | None:
    """(edits, start, end) within text."""
    width = u.codes.itemsize
    at = text.tobytes().find(u.codes.tobytes())
    if at >= 0 and at % width == 0:  # the alignment without edits
        return 0, at // width, at // width + len(u.codes)
    found = align(u.codes, text, u.k) if u.k else None
    if found is None:
        return None
    edits, end = found
    back = align(u.codes[::-1], text[:end][::-1], u.k)
    return edits, end - back[1], end


def occurrences(u: Unit, joined: np.ndarray, a: int, z: int, begin: int, stop: int, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """(start, end, edits) of the occurrences between a and z in the text from begin to stop that overlap those in taken by at most k places; they are added to it."""
    m, k = len(u.codes), u.k
    gaps = [(begin, stop)]
    for s, e in taken:
        if s < z + m and a - m < e:
            gaps = [g for b, c in gaps for g in ([(b, min(c, s + k)), (max(b, e - k), c)] if s < c and b < e else [(b, c)])]
    while gaps:
        b, c = gaps.pop()
        low, high = max(a, b), min(z, c)
        hit = occurrence(u, joined[low:high]) if high - low >= m - k else None
        if hit and hit[0]:  # the region may hold a part of it only
            low, high = max(b, low + hit[1] - k), min(c, low + hit[2] + k)
            hit = occurrence(u, joined[low:high])
        if hit:
            s, e = low + hit[1], low + hit[2]
            taken.append((s, e))
            yield s, e, hit[0]
            gaps += [(b, min(c, s + k)), (max(b, e - k), c)]


def bands(ix: Grams, units: list[Unit], codes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(unit, smallest diagonal, band width) of every band that passes the filter."""
    h = gram_hashes(codes, ix.q)
    if not len(h):
        return
    bits = ix.table[h >> np.uint64(64 - TABLE_BITS)]
    alive = np.zeros(len(h), bool)
    for c, (window, least, _) in enumerate(ix.classes):
        hit = (bits >> np.uint8(c)) & np.uint8(1)
        # in runs of RUN places: any window lies within `span` runs in a row, so none that may pass is lost
        runs = np.zeros(-(-len(h) // RUN) * RUN, np.uint8)
        runs[: len(h)] = hit
        sums = np.concatenate([[0], np.cumsum(runs.reshape(-1, RUN).sum(axis=1, dtype=np.int32))])
        span = min(-(-window // RUN) + 1, len(sums) - 1)
        full = np.flatnonzero(sums[span:] - sums[:-span] >= least)
        if len(full):
            cover = np.zeros(len(sums), np.int32)
            np.add.at(cover, full, 1)
            np.add.at(cover, full + span, -1)
            alive |= np.repeat(np.cumsum(cover[:-1]) > 0, RUN)[: len(h)] & (hit > 0)
    at = np.flatnonzero(alive)
    left, right = np.searchsorted(ix.hashes, h[at]), np.searchsorted(ix.hashes, h[at], side="right")
    counts = right - left
    if not counts.sum():
        return
    text_place = np.repeat(at, counts)
    post = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(left, counts)
    unit, diagonal = ix.owner[post], text_place - ix.place[post]
    width = max(c[2] for c in ix.classes) + 1
    band = (diagonal + UNIT) // width
    key = unit * (len(codes) + 2 * UNIT) + band + 1  # so that a band before the first has a number
    key = np.concatenate([key, key - 1])
    least = np.array([u.least for u in units])
    stride = len(codes) + 2 * UNIT
    keys, n = np.unique(key, return_counts=True)
    high = keys[n >= least[keys // stride]]
    # of these, a unit's q-gram counts once, however often the text repeats it
    again = np.isin(key, high)
    single = np.sort(key[again] << 8 | np.tile(ix.place[post], 2)[again])
    keys, n = np.unique(single[np.concatenate([[True], single[1:] != single[:-1]])[: len(single)]] >> 8, return_counts=True)
    owner, number = keys // stride, keys % stride
    passed = n >= least[owner]
    order = np.argsort(-n[passed], kind="stable")
    for u, b in zip(owner[passed][order].tolist(), number[passed][order].tolist()):
        yield u, (b - 1) * width - UNIT, 2 * width


def unedited(u: Unit, codes: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, end) of every place of codes with the unit as it is."""
    width, pattern, data = codes.itemsize, u.codes.tobytes(), codes.tobytes()
    at = data.find(pattern)
    while at >= 0:
        if at % width == 0:
            yield at // width, at // width + len(u.codes)
        at = data.find(pattern, at + 1)


def between_borders(codes: np.ndarray, s: int, e: int) -> bool:
    return not (s and chr(codes[s - 1]).isalnum() and chr(codes[s]).isalnum()) and not (e < len(codes) and chr(codes[e]).isalnum() and chr(codes[e - 1]).isalnum())


def spans(ix: Index, texts: list[str | None]) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(text, item, start, end, units, edits) of every occurrence, the places in code points of the original text."""
    at = 0
    while at < len(texts):
        parts, offsets, size, upto = [], [0], 0, at
        while upto < len(texts) and (upto == at or size < BLOCK):
            codes, places = normalised(texts[upto] or "")
            parts.append((codes, places))
            size += len(codes) + 1
            offsets.append(size)
            upto += 1
        joined = np.concatenate([x for codes, _ in parts for x in (codes, np.array([BREAK], np.int32))])
        found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        taken: dict[tuple[int, int], list[tuple[int, int]]] = {}

        def add(one: Unit, text: int, s: int, e: int, edits: int) -> None:
            if not one.bordered or between_borders(parts[text][0], s, e):
                found.setdefault((text, one.item), []).append((s, e, edits))

        def hit(one: Unit, text: int, s: int, e: int, edits: int) -> None:
            """s, e: places in joined. Around a part its item is looked for."""
            begin, stop = offsets[text], offsets[text + 1] - 1
            if one.whole < 0:
                return add(one, text, s - begin, e - begin, edits)
            item = ix.wholes[one.whole]
            slack = item.k + 2 * one.k
            a, z = max(begin, s - one.offset - slack), min(stop, e - one.offset + len(item.codes) - len(one.codes) + slack)
            for s, e, edits in occurrences(item, joined, a, z, begin, stop, taken.setdefault((-1 - one.whole, text), [])):
                add(item, text, s - begin, e - begin, edits)

        for one in ix.units:
            if not one.q:
                for s, e in unedited(one, joined):
                    hit(one, bisect_right(offsets, s) - 1, s, e, 0)
        for grams in ix.grams:
            for u, low, width in bands(grams, ix.units, joined):
                one = ix.units[u]
                a, z = max(0, low - one.k), min(len(joined), low + width + len(one.codes) + one.k)
                text = bisect_right(offsets, a) - 1
                while text < len(parts) and offsets[text] < z:
                    begin, stop = offsets[text], offsets[text + 1] - 1
                    for s, e, edits in occurrences(one, joined, a, z, begin, stop, taken.setdefault((u, text), [])):
                        hit(one, text, s, e, edits)
                    text += 1
        for (text, item), hits in sorted(found.items()):
            places = parts[text][1]
            hits.sort()
            start, end, n, edits = hits[0][0], hits[0][1], 1, hits[0][2]
            for s, e, d in [*hits[1:], (1 << 60, 0, 0)]:
                if s <= end + NEAR:
                    end, n, edits = max(end, e), n + 1, edits + d
                else:
                    yield at + text, item, int(places[start]), int(places[min(end, len(places)) - 1]) + 1, n, edits
                    start, end, n, edits = s, e, 1, d
        at = upto


def chunks(benchmark: DataFrame, most: int) -> Iterator[list[tuple[int | None, str | None]]]:
    """The benchmark's items in lists of about `most` characters; one list is held at a time."""
    held, size = [], 0
    for r in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null").toLocalIterator():
        held.append((r[0], r[1]))
        size += len(r[1])
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def search(docs: DataFrame, benchmark: DataFrame, rate: float, chunk: int) -> DataFrame:
    """doc_id, tkey (of the text), item_id, start, end, n_units, edits."""
    rows = docs.select(F.col("doc_id").cast("long"), text_key().alias("tkey"), F.col("text").cast("string"))
    schema = f"tkey long, {SPANS}"
    out, todo = None, chunks(benchmark, chunk)
    items, after = next(todo, None), None
    while items is not None:
        after = next(todo, None)
        shipped = docs.sparkSession.sparkContext.broadcast(index(items, rate))

        def scan(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            ix = shipped.value
            for b in batches:
                ids, keys = b.column("doc_id"), b.column("tkey")
                hits = [(keys[t].as_py(), ids[t].as_py(), ix.item_ids[i], *rest) for t, i, *rest in spans(ix, b.column("text").to_pylist())]
                if hits:
                    types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*hits), types)], names=["tkey", "doc_id", "item_id", "start", "end", "n_units", "edits"])
            trim()

        part = rows.mapInArrow(scan, schema)
        if after is not None or out is not None:  # of many chunks one index at a time is held
            part = materialize(part, "occurrences", TEXT_ROWS)
            shipped.unpersist()
        out = part if out is None else out.unionByName(part)
        items = after
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def find(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, chunk: int = CHUNK) -> DataFrame:
    """One row for each span of docs that holds an item: doc_id, item_id, start, end, n_units, edits."""
    return search(docs, benchmark, rate, chunk).drop("tkey")


def keep_clean(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, chunk: int = CHUNK, least: int = WHOLE) -> DataFrame:
    """docs without the rows that hold a benchmark item of at least `least` characters; a row isn't given up for a few words that any text may have."""
    items = benchmark.where(F.length(F.trim(F.regexp_replace(F.col("text").cast("string"), r"\s+", " "))) >= least)
    with scratch() as keep:
        gone = keep(materialize(search(docs, items, rate, chunk).select("doc_id", "tkey"), "contaminated", TEXT_ROWS))
    return without(docs, gone)
