"""Operator 4: suffix-array dedup of repeated byte strings, by column-wise construction over anchored segments.

Every byte covered by a string of LENGTH bytes that also starts in a document with a smaller doc_id is removed;
strings are judged on the input.

Inserting one symbol of every document a round takes as many rounds as the longest document has bytes, each over
all data. So the collection is first cut into short strings that hold every string that can match:

1. Anchors. The anchor of a window of LENGTH bytes is its leftmost smallest SEED-gram by hash, so equal windows have
   equal anchors at equal offsets. An anchor's windows are consecutive; together they are its segment, of at most
   2 LENGTH - SEED bytes. All occurrences of an anchor meet in one bucket, known by hashes of 8 or 5 bytes.
2. Equal segments. All but those of the smallest doc_id are removed whole, first among the texts that a task packs
   together, before anything is shuffled, so a passage that very many texts hold leaves each pack once.
3. Of the rest, only segments that share the SEED-gram and half of the rest of a window, on either side, with another
   document can share a window. Their bytes are fetched.
4. Column-wise construction. The segments of a bucket, aligned at their anchors, are one collection. A round inserts one
   symbol of every segment, from the last column to the first: the Burrows-Wheeler transform of the round before (the
   symbols in front of the sorted suffixes) is sorted stably, which sorts the longer suffixes, and the common prefixes
   follow as one more than the smallest common prefix between the two in the round before. Suffixes in a row with
   common prefixes of LENGTH or more are equal windows; those of a larger doc_id than the smallest are removed.

The rounds read and write their arrays front to back; they are held in memory, as a bucket is small (the number of
buckets follows the input's bytes) and a machine's own disk is no place for them on a cluster.

Defined cases: null text is empty; a text shorter than LENGTH is kept; null doc_id is larger than any other, and null is
not smaller than null; rows with equal doc_id don't remove from each other; rows with equal doc_id and text give equal
results; very long texts are read in pieces of PIECE bytes that overlap by a window less one; empty table: no rows; extra
columns are ignored. A row is known by doc_id, whether that is null, and 63 bits of a hash of its text. Segment hashes of
64 bits stand for equality.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.common import materialize, scratch, trim
from citeloom.llm.hashing import mix

LENGTH = 50
SEED = 16
SPAN = LENGTH - SEED + 1  # SEED-grams of a window
HALF = (LENGTH - SEED) // 2
CHUNK = 1 << 17  # bytes whose anchors are found together
PIECE = 1 << 18  # longer texts are read in pieces
FLUSH = 3_000_000  # bytes of text whose entries a task packs together
BUCKET = 3_000_000  # bytes of text for each bucket
BATCH_ROWS = 64  # texts, or blobs of some 150 KB, that a Python worker holds at once
ROWS = 4096  # segments aligned at once
NONE = 2**63 - 1  # null doc_id

_MULT = np.random.Generator(np.random.PCG64(4242)).integers(0, 2**64, 8, dtype=np.uint64) | np.uint64(1)
_BYTE = np.random.Generator(np.random.PCG64(77)).integers(0, 2**64, 256, dtype=np.uint64)
_POWER = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.repeat(_MULT[7:8], 2 * PIECE)]))
_BACK = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(2 * PIECE, pow(int(_MULT[7]), -1, 1 << 64), np.uint64)]))

ENTRY = np.dtype([("ctx", "<u8"), ("doc", "<i8"), ("start", "<u4"), ("t", "<i8"), ("l4", "<u4"), ("l1", "u1"), ("r4", "<u4"), ("r1", "u1"), ("anchor", "u1"), ("more", "u1")])
SEGMENT = np.dtype([("doc", "<i8"), ("start", "<u4"), ("t", "<i8"), ("anchor", "u1"), ("more", "u1"), ("bytes", "u1", (LENGTH + SPAN - 1,))])
RANGE = np.dtype([("doc", "<i8"), ("t", "<i8"), ("start", "<u4"), ("more", "u1")])
RANGES = "kind int, doc long, t long, start long, anchor int, more int"
REMOVED, WANTED = 0, 1
DEALT = "bucket long, blob binary"


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """A hash of the SEED bytes from each place on."""
    h, width, i = _BYTE[b], 1, 0
    while width < SEED:
        h = h[:-width] * _MULT[i] + h[width:]
        h ^= h >> np.uint64(31)
        width, i = 2 * width, i + 1
    return mix(h)


def anchors(b: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place of the anchor, first window, last window, hash) for the texts in b that end at `ends`."""
    n = len(b) - LENGTH + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    h = gram_hashes(b)
    low = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)  # the leftmost of equal hashes
    width = 1
    while 2 * width <= SPAN:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[:n], low[SPAN - width : SPAN - width + n])
    place = (low & np.uint64(0xFFFFFF)).astype(np.int64)
    text_end = ends[np.searchsorted(ends, np.arange(n), side="right")]
    starts = np.flatnonzero(np.arange(n) + LENGTH <= text_end)
    if not len(starts):
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    p = place[starts]
    new = np.concatenate([[True], (p[1:] != p[:-1]) | (starts[1:] != starts[:-1] + 1)])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(p)]]) - 1
    return p[first], starts[first], starts[last], mix(h[p[first]])  # mixed anew: as the smallest of many, an anchor's own hash is small


def entries(texts: list[bytes], docs: np.ndarray, tags: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entries, anchor hashes) of texts (pieces that begin at `offsets` in their documents)."""
    b = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    place, first, last, h = anchors(b, ends)
    out = np.zeros(len(place), ENTRY)
    if not len(place):
        return out, h
    owner = np.searchsorted(ends, first, side="right")
    begin = ends[owner] - np.array([len(t) for t in texts])[owner]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[b] * _POWER[: len(b)], dtype=np.uint64)])

    def part(a: np.ndarray, z: np.ndarray, salt: int) -> np.ndarray:
        return mix((sums[z] - sums[a]) * _BACK[a] + np.uint64(salt) * (z - a).astype(np.uint64))

    # a side that the windows can't reach gets a hash of its own
    alone = mix(docs[owner].view(np.uint64) * _MULT[5] + first.astype(np.uint64) * _MULT[6])
    left = np.where(place - HALF >= first, part(np.maximum(place - HALF, 0), place + SEED, 3), alone)
    right = np.where(place + SEED + HALF <= last + LENGTH, part(place, np.minimum(place + SEED + HALF, len(b)), 5), ~alone)
    out["ctx"] = mix(part(first, last + LENGTH, 7) + (place - first).astype(np.uint64))
    out["doc"], out["t"] = docs[owner], tags[owner]
    out["start"] = first - begin + offsets[owner]
    out["anchor"], out["more"] = place - first, last - first
    out["l4"], out["l1"] = left & np.uint64(0xFFFFFFFF), left >> np.uint64(56)
    out["r4"], out["r1"] = right & np.uint64(0xFFFFFFFF), right >> np.uint64(56)
    return out, h


def split(records: np.ndarray, h: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, blob) of records dealt by the hashes h; a blob holds its columns one after the other."""
    bucket = ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    records, bucket = records[order], bucket[order]
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.empty(0, np.int64)
    last = np.concatenate([first[1:], [len(bucket)]])
    for a in range(0, len(first), 64):
        blobs = [columns(records[i:j]) for i, j in zip(first[a : a + 64].tolist(), last[a : a + 64].tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(bucket[first[a : a + 64]]), pa.array(blobs, pa.binary())], names=["bucket", "blob"])


def columns(records: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(records[c]).tobytes() for c in records.dtype.names)


def document_order(doc: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Numbers in the order of the documents, null last; the lowest bit of t says that doc_id is null."""
    if not (doc == NONE).any():
        return doc
    return 2 * np.unique(doc, return_inverse=True)[1] + (t & 1)


def behind(e: np.ndarray) -> np.ndarray:
    """Whether the entry's segment occurs in a smaller document of these entries too."""
    rank = document_order(e["doc"], e["t"])
    order = np.lexsort((rank, e["ctx"]))
    ctx, rank = e["ctx"][order], rank[order]
    first = np.flatnonzero(np.concatenate([[True], ctx[1:] != ctx[:-1]]))
    out = np.empty(len(e), bool)
    out[order] = rank > np.repeat(rank[first], np.diff(np.concatenate([first, [len(e)]])))
    return out


def reduced(e: np.ndarray, h: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """The entries by bucket, but for those behind another of these, which are removed for certain: they go as ranges, with numbers below zero."""
    gone = behind(e) if len(e) else np.empty(0, bool)
    yield from split(e[~gone], h[~gone], buckets)
    if gone.any():
        ranges = np.zeros(int(gone.sum()), RANGE)
        for c in RANGE.names:
            ranges[c] = e[c][gone]
        yield pa.RecordBatch.from_arrays([pa.array([-1 - int(ranges["t"][0]) % buckets], pa.int64()), pa.array([columns(ranges)], pa.binary())], names=["bucket", "blob"])


def joined(blobs: list[bytes], kind: np.dtype) -> np.ndarray:
    """The records of the blobs."""
    out = np.empty(sum(len(x) // kind.itemsize for x in blobs), kind)
    at = 0
    for x in blobs:
        n, place = len(x) // kind.itemsize, 0
        for c in kind.names:
            t = kind[c]
            out[c][at : at + n] = np.frombuffer(x, t.base, n * int(np.prod(t.shape, dtype=int)), place).reshape(n, *t.shape)
            place += n * t.itemsize
        at += n
    return out


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """(bucket, blobs), one bucket after the other; rows come sorted by bucket. Blobs of ranges (numbers below zero) come one by one."""
    current, held = None, []
    for b in batches:
        for bucket, blob in zip(b.column("bucket").to_pylist(), b.column("blob")):
            if held and (bucket != current or bucket < 0):
                yield current, held
                held = []
            current = bucket
            held.append(blob.as_py())
    if held:
        yield current, held


def _ranges(kind: int, doc, t, start, anchor, more) -> pa.RecordBatch:
    n = len(doc)
    cols = [np.full(n, kind, np.int32), doc.astype(np.int64), t.astype(np.int64), start.astype(np.int64), anchor.astype(np.int32), more.astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["kind", "doc", "t", "start", "anchor", "more"])


def shared_by_documents(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether another document has the key."""
    order = np.lexsort((doc, key))
    k, d = key[order], doc[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    last = np.concatenate([first[1:], [len(k)]]) - 1
    out = np.empty(len(key), bool)
    out[order] = np.repeat(d[first] != d[last], last - first + 1)
    return out


def compare_bucket(e: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Equal segments but those of the smallest document; and the segments whose bytes are wanted."""
    later = behind(e)
    gone, rest = e[later], e[~later]
    if len(gone):
        yield _ranges(REMOVED, gone["doc"], gone["t"], gone["start"], gone["anchor"], gone["more"])
    rank = document_order(rest["doc"], rest["t"])
    left = rest["l4"].astype(np.uint64) | rest["l1"].astype(np.uint64) << np.uint64(32)
    right = rest["r4"].astype(np.uint64) | rest["r1"].astype(np.uint64) << np.uint64(32)
    want = rest[shared_by_documents(left, rank) | shared_by_documents(right, rank)]
    if len(want):
        yield _ranges(WANTED, want["doc"], want["t"], want["start"], want["anchor"], want["more"])


def least_between(lcp: np.ndarray, a: np.ndarray, z: np.ndarray) -> np.ndarray:
    """min(lcp[a + 1 .. z]) for each a < z, from the minima of runs of powers of two."""
    out = np.empty(len(a), lcp.dtype)
    level = np.frexp((z - a).astype(np.float64))[1] - 1
    table, k = lcp, 0
    for want in range(int(level.max(initial=0)) + 1):
        while k < want:
            table = np.minimum(table[: -(1 << k)], table[1 << k :])
            k += 1
        at = np.flatnonzero(level == want)
        if len(at):
            out[at] = np.minimum(table[a[at] + 1], table[z[at] - (1 << want) + 1])
    return out


def construct(symbols: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Column-wise construction over rows of symbols: for each column from the last to the first (column, rows in the order of their suffixes from it, common prefix of each with the one before)."""
    m, width = symbols.shape
    order, lcp = np.arange(m), np.zeros(m, np.int16)
    fresh = True
    for column in range(width - 1, -1, -1):
        bwt = symbols[order, column]  # the symbols in front of the sorted suffixes
        turn = np.argsort(bwt, kind="stable")
        sorted_bwt = bwt[turn]
        new = np.zeros(m, np.int16)
        same = np.flatnonzero(sorted_bwt[1:] == sorted_bwt[:-1]) + 1
        if fresh:  # all suffixes were empty
            new[same] = 1
            fresh = False
        elif len(same):
            new[same] = 1 + least_between(lcp, turn[same - 1], turn[same])
        order, lcp = order[turn], new
        yield column, order, lcp


def match_bucket(s: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The windows of the segments that a smaller document has too."""
    width, zero = LENGTH + SPAN - 1, SPAN - 1  # the anchor's column
    symbols = np.full((len(s), width), 256, np.int16)
    lengths = s["more"].astype(np.int64) + LENGTH
    shift = zero - s["anchor"].astype(np.int64)
    for at in range(0, len(s), ROWS):
        part = slice(at, at + ROWS)
        source = np.arange(width)[None, :] - shift[part, None]
        inside = (source >= 0) & (source < lengths[part, None])
        symbols[part] = np.where(inside, np.take_along_axis(s["bytes"][part], np.clip(source, 0, width - 1), axis=1), 256)
    gone, rank = [], document_order(s["doc"], s["t"])
    beyond = np.iinfo(np.int64).max
    for column, order, lcp in construct(symbols):
        if column > zero:
            continue
        row = order
        group = np.cumsum(lcp < LENGTH)
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        at = column - shift[row]  # the window's place in its segment
        valid = (at >= 0) & (at <= s["more"][row])
        smallest = np.minimum.reduceat(np.where(valid, rank[row], beyond), first)[group - group[0]]
        hit = valid & (rank[row] > smallest)
        gone.append(np.stack([row[hit], at[hit]]))
    rows, at = np.concatenate(gone, axis=1)
    if not len(rows):
        return
    order = np.lexsort((at, rows))
    rows, at = rows[order], at[order]
    first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (at[1:] != at[:-1] + 1)]))
    last = np.concatenate([first[1:], [len(rows)]]) - 1
    r = rows[first]
    yield _ranges(REMOVED, s["doc"][r], s["t"][r], s["start"][r].astype(np.int64) + at[first], np.zeros(len(r)), at[last] - at[first])


def utf8(texts: list[str | None]) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in texts]


def remove(docs: DataFrame, flush: int = FLUSH, bucket: int = BUCKET) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, the remaining bytes (kept) and their kept_sha256 for every row."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    known = F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(-2).bitwiseOR(F.col("doc_id").isNull().cast("long"))
    rows = rows.select("doc_id", "text", F.coalesce("doc_id", F.lit(NONE)).alias("doc"), known.alias("t"))
    size = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, -(-size // bucket))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, hashes, n = [], [], 0
        for b in batches:
            pieces, total = [], 0

            def take() -> None:
                e, h = entries([p[0] for p in pieces], np.array([p[1] for p in pieces], np.int64), np.array([p[2] for p in pieces], np.int64), np.array([p[3] for p in pieces], np.int64))
                held.append(e), hashes.append(h)
                pieces.clear()

            for text, doc, t in zip(utf8(b.column("text").to_pylist()), b.column("doc").to_pylist(), b.column("t").to_pylist()):
                for at in range(0, max(len(text) - LENGTH + 1, 0), PIECE):
                    part = text[at : at + PIECE + LENGTH - 1]
                    pieces.append((part, doc, t, at))
                    total += len(part)
                    n += len(part)
                    if total >= CHUNK:
                        take()
                        total = 0
            if pieces:
                take()
            if n >= flush:
                yield from reduced(np.concatenate(held), np.concatenate(hashes), buckets)
                held, hashes, n = [], [], 0
        if held:
            yield from reduced(np.concatenate(held), np.concatenate(hashes), buckets)
        trim()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, blobs in by_bucket(batches):
            if bucket < 0:
                r = joined(blobs, RANGE)
                yield _ranges(REMOVED, r["doc"], r["t"], r["start"], np.zeros(len(r)), r["more"])
            else:
                yield from compare_bucket(joined(blobs, ENTRY))
        trim()

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = LENGTH + SPAN - 1
        for b in batches:
            held = []
            for text, doc, t, start, anchor, more in zip(utf8(b.column("text").to_pylist()), *[b.column(c).to_pylist() for c in ("doc", "t", "start", "anchor", "more")]):
                s = np.zeros(len(start), SEGMENT)
                s["doc"], s["t"], s["start"], s["anchor"], s["more"] = doc, t, start, anchor, more
                padded = np.frombuffer(text + bytes(width), np.uint8)
                s["bytes"] = padded[np.array(start)[:, None] + np.arange(width)]
                held.append(s)
            if held:
                s = np.concatenate(held)
                at = s["anchor"].astype(np.int64)[:, None] + np.arange(SEED)
                grams = np.take_along_axis(s["bytes"], at, axis=1)
                sums = (_BYTE[grams] * _POWER[:SEED]).sum(axis=1, dtype=np.uint64)
                yield from split(s, mix(sums), buckets)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, blobs in by_bucket(batches):
            yield from match_bucket(joined(blobs, SEGMENT))
        trim()

    def by_text(ranges: DataFrame, *fields: str) -> DataFrame:
        return ranges.groupBy("doc", "t").agg(F.collect_set(F.struct(*fields)).alias("all")).select("doc", "t", *[F.col(f"all.{f}").alias(f) for f in fields])

    with scratch() as keep:
        dealt = rows.select("text", "doc", "t").mapInArrow(find, DEALT).repartition("bucket").sortWithinPartitions("bucket")
        equal = materialize(dealt.mapInArrow(compare, RANGES), "equal-segments", BATCH_ROWS)
        wanted = by_text(equal.where(F.col("kind") == WANTED), "start", "anchor", "more")
        segments = rows.select("text", "doc", "t").join(wanted, ["doc", "t"]).mapInArrow(fetch, DEALT).repartition("bucket").sortWithinPartitions("bucket")
        partial = materialize(segments.mapInArrow(match, RANGES), "equal-windows", BATCH_ROWS)
        gone = keep(materialize(by_text(equal.where(F.col("kind") == REMOVED).unionByName(partial), "start", "more"), "removed"))
    both = rows.join(gone, ["doc", "t"], "left").select("doc_id", "text", "start", "more")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, BATCH_ROWS):
                part = b.slice(at, BATCH_ROWS)
                out = []
                for text, start, more in zip(utf8(part.column("text").to_pylist()), part.column("start").to_pylist(), part.column("more").to_pylist()):
                    n, removed, runs, kept = len(text), 0, 0, text
                    if start is not None:
                        cover = np.zeros(n + 1, np.int32)
                        np.add.at(cover, start, 1)
                        np.add.at(cover, np.array(start) + np.array(more) + LENGTH, -1)
                        stays = np.cumsum(cover[:-1]) == 0
                        removed = n - int(stays.sum())
                        runs = int((~stays & np.concatenate([[True], stays[:-1]])).sum())
                        kept = np.frombuffer(text, np.uint8)[stays].tobytes()
                    out.append((n, removed, runs, kept, hashlib.sha256(kept).hexdigest()))
                cols = list(zip(*out))
                types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(c, t) for c, t in zip(cols, types)]], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return both.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return remove(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
