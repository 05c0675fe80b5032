"""Operator 1: exact n-gram Jaccard join by PartEnum signatures, and the groups that its links form.

A text's set holds the 64-bit hashes of its distinct word shingles. Two sets link when their Jaccard similarity
is at least t = 3/4. Equal sets are one node from the start (their members are listed, not paired).

Signatures. Sizes are cut into bands (r/2, r]. A pair belongs to the band of its larger set; a smaller set may
have at most 4/3 its size as a partner, so a set signs for its own band and, near the upper end, for the next. Linked
sets of a band differ in at most k = (|A| + |B|) (1-t)/(1+t) elements. The hash domain is cut on a first level into n
partitions and each of these on a second level into SECOND = 3; of each three, all subsets of two are enumerated, and a
set's elements within a subset are one signature. As n > k / 2, some first-level partition of a linked pair has at most
one differing element, which leaves one of its three subsets alike: the pair shares that signature. n exceeds k / 2 by
a reserve, so a linked pair shares many signatures, not just one: with d differences it shares at least 3 n - 2 d of them
(d <= n) or 2 n - d, as the first difference in a partition spoils two subsets and the second one more. Sets of up to
three shingles link with larger ones or not at all.

Soft signatures. Empty subsets say nothing, and signatures shared by more than GROUP sets are not expanded into
pairs. Both are exact to skip for a set that has more guaranteed signatures than soft ones, because a linked pair must
then share an expanded signature as well. Only pairs of sets that are both soft remain, and they are found by the
finest partition, single shingles, rarest first (a set needs only as many of its rarest shingles as it may lack), see
soft_pairs().

From groups to links:
1. a set whose shared signatures are fewer than its guaranteed ones can't link and is dropped;
2. in every group, whatever its size, each member is verified against one pivot: a star, not all pairs (in small groups
   where the pair meets in enough of them; any other is left to the next step);
3. a pair is verified exactly if its sketches allow it: the parities of a set's elements in BITS buckets; two sets
   differ in at least as many elements as parities;
4. links give components; only pairs of different components that share enough signatures are then verified.

Hence a group of any size costs about its members, and no pair of different texts that could join two components
goes unverified.

Execution. Signatures never become JVM rows: a task packs them, (signature, set) of 12 bytes (32 bits of the signature beside the bucket's; chance meetings are verified away), into one binary row
for each block of texts and bucket; a bucket is sorted in numpy with bounded memory (the number of buckets follows
the input's bytes). All later tables hold only sets that share enough signatures. All tables but the result are deleted
when it is written.

Defined cases: a very long text is hashed whole, and its set has as many signatures as its band asks; null or empty text, or no words: an empty set that links with nothing; fewer words than a shingle:
the whole sequence is the one shingle; null doc_id: takes part, but never names a component unless all are null;
repeated rows: equal sets, one component; empty table: no rows; extra columns are ignored (keep_one() passes them on).
Hash equality stands for equality: with 64 bits, n sets meet by chance with probability n^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.common import if_small, materialize, pack, scratch, text_key, trim, without
from citeloom.llm.graph import components
from citeloom.llm.hashing import mix, shingle_sets

WIDTH = 5
#: Similarity 3/4 as whole numbers; linked sets differ in at most (|A| + |B|) / 7 elements.
NUM, DEN = 75, 100
LOWEST = 3  # largest set of the lowest band, where linked sets are equal
SECOND = 3  # second-level partitions
SUBSETS = np.array([[0, 1], [0, 2], [1, 2]])  # of these, enumerated
RESERVE = 0.1  # first-level partitions beyond half the largest difference, as a share of that difference
NEVER = 1 << 30  # signatures that nobody shares
BITS = 2048  # parities in a set's sketch
GROUP = 32  # largest group whose pairs may be expanded
FLUSH = 8_000_000  # bytes of text whose signatures a task packs together
BUCKET = 8_000_000  # bytes of text for each bucket
BATCH_ROWS = 100  # texts, or blobs of some 100 KB, that a Python worker holds at once

SIGNED = "kind int, bucket int, doc_id long, tkey long, sid long, n int, scheme int, least0 int, least1 int, blob binary"
GROUPED = "kind int, doc_id long, tkey long, sid long, n int, scheme int, least0 int, least1 int, members array<long>, count int, hot int"
SETS = "sid long, n int, sketch array<long>, shingles array<long>"
MEMBER, BLOB, GROUP_ROW, SHARED, STAR = 0, 1, 2, 3, 4


class Band(NamedTuple):
    upper: int  # largest set
    parts: int  # first-level partitions


def band(scheme: int) -> Band:
    upper = LOWEST << scheme
    k = 2 * upper // 7
    return Band(upper, k // 2 + 1 + int(RESERVE * k) if k else 0)


def scheme_of(n: int) -> int:
    """The number of the band that holds sets of n elements."""
    s = 0
    while LOWEST << s < n:
        s += 1
    return s


def signatures(s: np.ndarray, mixed: np.ndarray, scheme: int, largest: int) -> tuple[np.ndarray, int]:
    """The signatures of a set for a band, and how many of them it shares at least with any linked set of up to `largest` elements there."""
    tag = np.uint64((scheme + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    n = band(scheme).parts
    if not n:
        return np.empty(0, np.uint64), NEVER
    part = ((s >> np.uint64(32)) * np.uint64(SECOND * n) >> np.uint64(32)).astype(np.int64)  # rises with s
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    sums, used = np.zeros(SECOND * n, np.uint64), np.zeros(SECOND * n, bool)
    sums[part[first]], used[part[first]] = np.add.reduceat(mixed, first), True
    pairs = (np.arange(n) * SECOND)[:, None, None] + SUBSETS  # first-level partition, subset, its two members
    filled = used[pairs].any(axis=2)
    number = (np.arange(n * len(SUBSETS), dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)).reshape(n, -1)
    found = mix(mix(sums[pairs[:, :, 0]] + number) + sums[pairs[:, :, 1]] ^ tag)[filled]
    differ = (len(s) + largest) // 7
    return found, (3 * n - 2 * differ if differ <= n else 2 * n - differ) - int((~filled).sum())


def sign(s: np.ndarray) -> tuple[int, int, list[tuple[np.ndarray, int]]]:
    """(set id, scheme of its band, its signatures there and, where a partner may be in the next band, there)."""
    n = len(s)
    mixed = mix(s ^ np.uint64(0xA0761D6478BD642F))
    sid = int(mix(mixed.sum(dtype=np.uint64, keepdims=True) + np.uint64(n))[0].astype(np.int64))
    scheme = scheme_of(n)
    most = n * DEN // NUM
    upper = band(scheme).upper
    signed = [signatures(s, mixed, scheme, min(most, upper))]
    if most > upper:
        signed.append(signatures(s, mixed, scheme + 1, most))
    return sid, scheme, signed


def collisions(sigs: np.ndarray, buckets: int) -> int:
    """How many of a set's signatures look like another one of its own once cut to a bucket and 32 bits; they are counted once, so a partner shares as many fewer."""
    return len(sigs) - len(np.unique((sigs >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32) << np.uint64(32) | sigs & np.uint64(0xFFFFFFFF)))


def lowered(texts: list[str | None]) -> list[bytes]:
    """UTF-8 with A-Z lowered, nothing else."""
    return [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]


def _signed(buckets: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        owners: list[tuple[int, int]] = []
        done: set[int] = set()
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal size
            if held:
                sigs = np.concatenate(held)
                sids = np.repeat(np.array([o[0] for o in owners], np.int64), [o[1] for o in owners])
                bucket = ((sigs >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                sigs, sids, bucket = sigs.astype("<u4")[order], sids[order], bucket[order]
                begin = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.empty(0, np.int64)
                end = np.concatenate([begin[1:], [len(bucket)]])
                for at in range(0, len(begin), 16):
                    cuts = [slice(i, j) for i, j in zip(begin[at : at + 16].tolist(), end[at : at + 16].tolist())]
                    blobs = [sigs[c].tobytes() + sids[c].tobytes() for c in cuts]
                    yield _rows(SIGNED, kind=[BLOB] * len(cuts), bucket=bucket[begin[at : at + 16]].tolist(), blob=blobs)
            held.clear(), owners.clear(), done.clear()
            size = 0

        for b in batches:
            texts = lowered(b.column("text").to_pylist())
            ids, keys = b.column("doc_id").to_pylist(), b.column("tkey").to_pylist()
            rows: dict[str, list] = {c: [] for c in ("bucket", "doc_id", "tkey", "sid", "n", "scheme", "least0", "least1")}
            for doc_id, tkey, text, s in zip(ids, keys, texts, shingle_sets(texts, width)):
                sid, scheme, signed = sign(s) if len(s) else (None, None, [])
                least = [x[1] - collisions(x[0], buckets) for x in signed] + [None, None]
                for c, v in zip(rows, (-1 - (tkey % buckets), doc_id, tkey, sid, len(s), scheme, least[0], least[1])):
                    rows[c].append(v)
                if sid is not None and sid not in done:  # copies within the block sign once
                    done.add(sid)
                    for sigs, _ in signed:
                        held.append(sigs)
                        owners.append((sid, len(sigs)))
                size += len(text)
                if size >= FLUSH:
                    yield from flush()
            yield _rows(SIGNED, kind=[MEMBER] * len(ids), **rows)
        yield from flush()
        trim()

    return run


_ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}


def _rows(schema: str, **columns: list) -> pa.RecordBatch:
    """A batch of the schema; columns not given are null."""
    n = len(next(iter(columns.values())))
    fields = [f.split(" ") for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns[c], _ARROW[t]) if c in columns else pa.nulls(n, _ARROW[t]) for c, t in fields], names=[c for c, _ in fields])


def group_bucket(sigs: np.ndarray, sids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The groups of sets that share a signature: small ones as member lists with their multiplicity, large ones as stars; and for each set how many signatures it shares."""
    order = np.argsort(sigs)
    sigs, sids = sigs[order], sids[order]
    same = sigs[1:] == sigs[:-1]
    keep = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    sigs, sids = sigs[keep], sids[keep]
    order = np.lexsort((sids, sigs))
    sigs, sids = sigs[order], sids[order]
    if len(sigs):
        new = np.concatenate([[True], (sigs[1:] != sigs[:-1]) | (sids[1:] != sids[:-1])])
        sigs, sids = sigs[new], sids[new]
    first = np.flatnonzero(np.concatenate([[True], sigs[1:] != sigs[:-1]])) if len(sigs) else np.empty(0, np.int64)
    sizes = np.diff(np.concatenate([first, [len(sigs)]]))
    shared = np.repeat(sizes >= 2, sizes)
    hot = np.repeat(sizes > GROUP, sizes)
    if not shared.any():
        return
    who, inverse = np.unique(sids[shared], return_inverse=True)
    n_shared, n_hot = np.bincount(inverse), np.bincount(inverse, weights=hot[shared]).astype(np.int64)
    yield _rows(GROUPED, kind=[SHARED] * len(who), sid=who.tolist(), count=n_shared.tolist(), hot=n_hot.tolist())
    lists: dict[bytes, int] = {}
    for a, n in zip(first[(sizes >= 2) & (sizes <= GROUP)].tolist(), sizes[(sizes >= 2) & (sizes <= GROUP)].tolist()):
        key = sids[a : a + n].tobytes()
        lists[key] = lists.get(key, 0) + 1
    if lists:
        yield _rows(GROUPED, kind=[GROUP_ROW] * len(lists), members=[np.frombuffer(k, np.int64) for k in lists], count=list(lists.values()))
    if hot.any():
        pivots = np.repeat(sids[first], sizes)[hot]
        pairs, counts = np.unique(np.stack([sids[hot], pivots]), axis=1, return_counts=True)
        other = pairs[0] != pairs[1]
        yield _rows(GROUPED, kind=[STAR] * int(other.sum()), sid=pairs[0][other], members=[[p] for p in pairs[1][other].tolist()], count=counts[other])


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket; one bucket is held at a time."""
    current, parts = None, []

    def finish() -> Iterator[pa.RecordBatch]:
        if parts:
            yield from group_bucket(*(np.concatenate([np.frombuffer(p[i], t) for p in parts]) for i, t in enumerate(("<u4", "<i8"))))
        parts.clear()

    for b in batches:
        member = np.flatnonzero(b.column("kind").to_numpy() == MEMBER)
        if len(member):
            m = b.take(pa.array(member))
            yield pa.RecordBatch.from_arrays([m.column(c) if c in m.schema.names else pa.nulls(m.num_rows, _ARROW[t]) for c, t in (f.split(" ") for f in GROUPED.split(", "))], names=[f.split(" ")[0] for f in GROUPED.split(", ")])
        for i in np.flatnonzero(b.column("kind").to_numpy() == BLOB).tolist():
            bucket, blob = b.column("bucket")[i].as_py(), b.column("blob")[i].as_py()
            if bucket != current:
                yield from finish()
                current = bucket
            n = len(blob) // 12
            parts.append((blob[: 4 * n], blob[4 * n :]))
    yield from finish()
    trim()


def sketch(s: np.ndarray) -> np.ndarray:
    odd = np.bincount((s % np.uint64(BITS)).astype(np.int64), minlength=BITS).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sids = b.column("sid").to_pylist()
            for at in range(0, b.num_rows, 1000):
                found = list(shingle_sets(lowered(b.column("text").slice(at, 1000).to_pylist()), width))
                yield _rows(SETS, sid=sids[at : at + 1000], n=[len(s) for s in found], sketch=[sketch(s) for s in found], shingles=[s.view(np.int64) for s in found])
        trim()

    return run


class Join(NamedTuple):
    members: DataFrame  # doc_id, tkey, sid, n_shingles, component_id; a row for every row of the input
    links: DataFrame  # x, y, common: set ids of verified links, enough to connect every component


def keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("tkey", text_key())


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs x, y of set ids whose sets link; every join is one of written tables, whose hot keys adaptive execution can split."""
    small = if_small(sets.select("sid", "n", "sketch"))
    x, y = (small.select(F.col("sid").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"p{c}")) for c in "xy")
    apart = F.aggregate(F.zip_with("px", "py", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda a, b: a + b)
    total = F.col("nx") + F.col("ny")
    near = materialize(pairs.select("x", "y").distinct(), "pairs").join(x, "x").join(y, "y").where(apart * (NUM + DEN) <= total * (DEN - NUM)).select("x", "y")
    x = sets.select(F.col("sid").alias("x"), F.col("shingles").alias("sx"))
    y = sets.select(F.col("sid").alias("y"), F.col("shingles").alias("sy"))
    common = F.size(F.array_intersect("sx", "sy")).cast("long")
    both = if_small(materialize(near, "near")).join(x, "x").join(y, "y").select("x", "y", common.alias("common"), (F.size("sx") + F.size("sy")).alias("total"))
    return both.where(DEN * F.col("common") >= NUM * (F.col("total") - F.col("common"))).select("x", "y", "common")


def soft_pairs(soft: DataFrame, sets: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of soft sets in different components that share one of the shingles that each may not lack all of.

    Sets take their rarest shingles first (fewest soft sets, then smallest hash). In a linked pair of a and b >= a elements
    the smaller set lacks at most a - ceil(2 a t / (1+t)) of the other's, and the larger at most b - ceil(t b); so they share
    one within one more than these of their rarest. For the sizes of a pair at hand, with o = ceil((a+b) t / (1+t)) common
    shingles, the rarest common one is within the first a - o + 1 and b - o + 1. In each shingle's group only sets outside its most common component meet
    the others, so a component of near copies is not paired with itself.
    """
    own = soft.select("sid").distinct().join(sets, "sid").join(labels.withColumnRenamed("node", "sid"), "sid", "left")
    flat = own.select("sid", F.coalesce("label", "sid").alias("label"), F.size("shingles").alias("n"), F.explode("shingles").alias("h"))
    n = F.col("n")
    as_larger, as_smaller = n - F.ceil(n * NUM / DEN) + 1, n - F.ceil(2 * n * NUM / (NUM + DEN)) + 1
    seen = materialize(flat.groupBy("h").agg(F.count("*").alias("df"), F.min("sid").alias("only")), "seen")
    # a set's shingles that no other soft set has come first; where they fill the prefix, the set meets none
    alone = seen.where("df = 1").groupBy(F.col("only").alias("sid")).agg(F.count("*").alias("alone"))
    flat = flat.join(alone, "sid", "left").withColumn("alone", F.coalesce("alone", F.lit(0))).where(F.col("alone") < as_larger)
    rank = F.col("alone") + F.row_number().over(Window.partitionBy("sid").orderBy("df", "h"))
    prefix = flat.join(seen.where("df > 1").select("h", "df"), "h").withColumn("rank", rank).where(F.col("rank") <= as_larger).select("h", "sid", "n", "label", "rank", (F.col("rank") <= as_smaller).alias("short"))
    prefix = materialize(prefix, "prefix")
    by_label = prefix.groupBy("h", "label").agg(F.count("*").alias("c"))
    mode = by_label.groupBy("h").agg(F.max_by("label", F.struct("c", "label")).alias("mode"), F.count("*").alias("labels")).where("labels > 1")
    mode = materialize(mode, "modes")  # here and below: a join of two written tables, whose hot keys adaptive execution can split
    few = materialize(prefix.join(mode, "h").where("label != mode").select("h", F.col("sid").alias("a"), F.col("n").alias("na"), F.col("label").alias("la"), F.col("rank").alias("ra"), F.col("short").alias("sa")), "few")
    larger, smaller = F.struct("na", "a") > F.struct("n", "sid"), F.struct("na", "a") < F.struct("n", "sid")
    common = F.ceil((F.col("na") + n) * NUM / (NUM + DEN))
    near = (F.col("la") != F.col("label")) & (F.col("rank") <= n - common + 1) & (F.col("ra") <= F.col("na") - common + 1)
    below = few.join(prefix.where("short"), "h").where(near & larger)
    above = few.where("sa").join(prefix, "h").where(near & smaller)
    pair = (F.least("a", "sid").alias("x"), F.greatest("a", "sid").alias("y"))
    return below.select(*pair).unionByName(above.select(*pair)).distinct()


def join(docs: DataFrame, width: int = WIDTH) -> Join:
    with scratch() as keep:
        found = _join(docs, width)
        return Join(keep(materialize(found.members, "components")), keep(materialize(found.links, "links")))


def _join(docs: DataFrame, width: int) -> Join:
    rows = keyed(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    size = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, -(-size // BUCKET))
    signed = rows.mapInArrow(_signed(buckets, width), SIGNED)
    base = materialize(signed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_grouped, GROUPED), "signatures", BATCH_ROWS)

    members = base.where(F.col("kind") == MEMBER).select("doc_id", "tkey", "sid", F.col("n").cast("long").alias("n_shingles"), "scheme", "least0", "least1")
    least = members.where("sid is not null").groupBy("sid").agg(F.min(F.struct("doc_id", "tkey")).alias("rep"), F.first(F.least("least0", "least1")).alias("least"))
    shared = base.where(F.col("kind") == SHARED).groupBy("sid").agg(F.sum("count").alias("shared"), F.sum("hot").alias("hot"))
    able = least.join(shared, "sid", "left").select("sid", "rep", "least", F.coalesce("shared", F.lit(0)).alias("shared"), F.coalesce("hot", F.lit(0)).alias("hot"))
    able = materialize(able.where("shared >= least or least <= 0"), "able")

    n_able = able.count()
    wanted = if_small(able.select("sid", F.col("rep.doc_id").alias("doc_id"), F.col("rep.tkey").alias("tkey")), n_able)
    found = rows.alias("d").join(wanted.alias("w"), F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.tkey") == F.col("w.tkey"))).select("sid", "text")
    sets = materialize(found.mapInArrow(_sets(width), SETS).dropDuplicates(["sid"]), "sets", BATCH_ROWS)

    # groups of sets that are able to link
    lists = base.where(F.col("kind") == GROUP_ROW).groupBy("members").agg(F.sum("count").alias("count"))
    needs = able.select("sid", (F.col("least") - F.col("hot")).alias("needs"))  # signatures in small groups that a link must share
    flat = lists.select(F.xxhash64("members").alias("g"), "count", F.explode("members").alias("sid")).join(if_small(needs, n_able), "sid")
    groups = materialize(flat.groupBy("g").agg(F.array_sort(F.collect_set(F.struct("sid", "needs"))).alias("members"), F.first("count").alias("count")).where(F.size("members") > 1), "groups")
    star = groups.select("count", F.element_at("members", 1).alias("a"), F.explode(F.slice("members", 2, GROUP)).alias("b"))
    star = star.groupBy(F.col("a.sid").alias("x"), F.col("b.sid").alias("y")).agg(F.sum("count").alias("count"), F.first(F.greatest("a.needs", "b.needs")).alias("needs")).where("count >= needs").select("x", "y")
    # a large group's star gets its most typical member, that of the most widely shared signatures, as its centre
    met = base.where(F.col("kind") == STAR).select(F.element_at("members", 1).alias("x"), F.col("sid").alias("y")).distinct()
    met = met.unionByName(met.select("x", F.col("x").alias("y")).distinct()).join(if_small(able.select(F.col("sid").alias("y"), "hot"), n_able), "y")
    met = materialize(met, "met")
    centre = materialize(met.groupBy("x").agg(F.max_by("y", F.struct("hot", "y")).alias("centre")), "centres")
    far = met.join(centre, "x").where("y != centre").select(F.least("centre", "y").alias("x"), F.greatest("centre", "y").alias("y")).distinct()
    links = materialize(verified(star.unionByName(far), sets), "links")
    labels = components(links.select(F.col("x").alias("u"), F.col("y").alias("v")))

    # pairs of different components with enough common signatures
    named = groups.select("g", "count", F.inline("members")).join(labels.withColumnRenamed("node", "sid"), "sid", "left")
    item = F.struct("sid", F.coalesce("label", "sid").alias("label"), "needs")
    mixed = named.groupBy("g").agg(F.collect_list(item).alias("items"), F.first("count").alias("count")).where(F.size(F.array_distinct(F.col("items.label"))) > 1)
    crossed = mixed.select("count", F.explode("items").alias("a"), "items").select("count", "a", F.explode("items").alias("b")).where("a.sid < b.sid and a.label != b.label")
    enough = crossed.groupBy(F.col("a.sid").alias("x"), F.col("b.sid").alias("y")).agg(F.sum("count").alias("count"), F.first(F.greatest("a.needs", "b.needs")).alias("needs")).where("count >= needs")
    more = enough.select("x", "y")
    soft = able.where("hot >= least")
    if not soft.isEmpty():
        more = more.unionByName(soft_pairs(soft, sets, labels))
    more = materialize(verified(more, sets), "links")
    if not more.isEmpty():
        joined = labels.select(F.col("node").alias("u"), F.col("label").alias("v")).unionByName(more.select(F.col("x").alias("u"), F.col("y").alias("v")))
        labels = components(joined)
    named = members.join(labels.withColumnRenamed("node", "sid"), "sid", "left").select("doc_id", "tkey", "sid", "n_shingles", F.coalesce("label", "sid").alias("label"))
    lowest = materialize(named.where("sid is not null").groupBy("label").agg(F.min("doc_id").alias("lowest")), "lowest")
    out = named.join(lowest, "label", "left").select("doc_id", "tkey", "sid", "n_shingles", F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("lowest")).alias("component_id"), "label")
    return Join(out, links.unionByName(more))


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    with scratch() as keep:
        return keep(join(docs).members).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """docs with one document of each component, that of the smallest doc_id; texts without words all stay."""
    with scratch() as keep:
        found = join(docs).members
        first = found.where("sid is not null").groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tkey")).alias("first"))
        gone = found.join(first, "label").where(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("tkey") == F.col("first.tkey")))).select("doc_id", "tkey").distinct()
        gone = keep(materialize(gone, "gone"))
        repeated = found.where("sid is not null").groupBy("doc_id", "tkey").count().where("count > 1").select(F.col("doc_id").alias("__id"), F.col("tkey").alias("__tkey"))
        repeated = keep(materialize(repeated, "repeated"))
    kept = without(docs, gone)
    if repeated.isEmpty():
        return kept
    # rows with the same doc_id and text: one stays
    row = pack(kept).withColumn("__k", text_key("__row.text"))
    again = F.col("__row.doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__k") == F.col("__tkey"))
    twice = row.join(repeated, again, "left_semi")
    once = twice.groupBy(F.col("__row.doc_id").alias("i"), "__k").agg(F.first("__row").alias("__row")).select("__row", "__k")
    row = row.join(repeated, again, "left_anti").unionByName(once)
    return row.select(*[F.col("__row").getField(c).alias(c) for c in docs.columns])
