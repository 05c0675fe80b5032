"""Operator 12: contiguous shards of nearly equal size, cut from global prefix sums of bytes.

Rows are put in one global order (by default doc_id, then the checksum of the text). A row's size is the UTF-8 bytes of its text
plus 1. With B bytes before a row, S its size and T the total, the row belongs to shard floor((2 B + S) n / 2 T): the cut at each
multiple of T / n goes beside the row in which it falls, to the side that is nearer. So a shard differs from T / n by at
most one row's size, shards are contiguous in the order, and the same rows give the same shards however they are partitioned.

1. One range shuffle sorts the rows; they are written with their place, partition number and index in the partition.
2. Bytes and rows of each partition (narrow columns only) are summed; prefix sums over the partitions tell in which of them
   every cut falls. A running sum within these few partitions gives the row.
3. A row's shard is the number of cuts up to its place, its slot the global index less that of the shard's first row: both
   are comparisons with numbers, so the table is read once more without shuffle or join.

Scale: texts move once. Equal keys are dealt apart by the row's number in the input, so rows without doc_id, or repeated ones,
may make up any share of the table. What reaches the driver: three numbers a partition, whose number a setting gives, and one a shard.

Defined cases: null text: size 1, checksum 0; empty text: the same; null key: last; ties in key and checksum: equal texts, whose
order doesn't matter to any shard's size; a row larger than T / n: a shard of its own, and others may be empty; repeated rows:
each has a slot; empty table: no rows; extra columns pass through, but for those named like an added one.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.common import materialize, pack, scratch, with_added
from citeloom.llm.mixing import drawn_count

SHARDS = 8
_ROWS = 33  # bits of a row's index in its partition, as in monotonically_increasing_id()


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text.cast("string")), F.lit(0)).cast("long") + 1


def checksum(text: Column) -> Column:
    return F.coalesce(F.crc32(text.cast("string").cast("binary")), F.lit(0)).cast("long")


def _sorted(docs: DataFrame, order: Sequence[str]) -> DataFrame:
    """The written table __row, __size, __crc, __place: place numbers rise in the global order."""
    text = F.col("__row.text")
    keyed = pack(docs).select("__row", size_of(text).alias("__size"), checksum(text).alias("__crc"), F.monotonically_increasing_id().alias("__tie"))
    by = [*[F.col("__row").getField(c).asc_nulls_last() for c in order], F.col("__crc").asc(), F.col("__tie").asc()]
    ordered = keyed.repartitionByRange(*by).sortWithinPartitions(*by)
    return materialize(ordered.select("__row", "__size", "__crc", F.monotonically_increasing_id().alias("__place")), "sharded")


def _cuts(table: DataFrame, n_shards: int) -> tuple[list[int], list[int], list[int], list[int]]:
    """(first place of each shard but the first, first global index of each shard, partitions, rows before each of them)"""
    part = F.shiftright("__place", _ROWS).alias("part")
    totals = table.groupBy(part).agg(F.sum("__size").alias("size"), F.count("*").alias("n")).collect()
    parts, rows_before, bytes_before, rows, size = [], [], [], 0, 0
    for r in sorted(totals):
        parts.append(r["part"])
        rows_before.append(rows)
        bytes_before.append(size)
        rows, size = rows + r["n"], size + r["size"]
    if not parts:
        return [], [0] * n_shards, [], []
    home = [bisect_right(bytes_before, size * i // n_shards) - 1 for i in range(1, n_shards)]
    firsts = []
    if home:
        base = table.sparkSession.createDataFrame(sorted({(parts[p], bytes_before[p]) for p in home}), "part long, base long")
        running = F.sum("__size").over(Window.partitionBy("part").orderBy("__place").rowsBetween(Window.unboundedPreceding, 0))
        near = table.select(part, "__place", "__size").join(F.broadcast(base), "part").withColumn("upto", F.col("base") + running)
        shard = F.expr(f"(2 * upto - __size) * {n_shards} div {2 * size}")
        firsts = sorted((r["shard"], r["place"]) for r in near.groupBy(shard.alias("shard")).agg(F.min("__place").alias("place")).collect())
    places, starts = [], [0]
    for i, p in enumerate(home, start=1):
        after = (parts[p] + 1) << _ROWS
        found = bisect_left(firsts, (i, 0))
        place = min(firsts[found][1], after) if found < len(firsts) else after
        at = bisect_right(parts, place >> _ROWS) - 1
        beyond = rows_before[at + 1] if at + 1 < len(parts) else rows
        places.append(place)
        starts.append(rows_before[at] + (place & ((1 << _ROWS) - 1)) if parts[at] == place >> _ROWS else beyond)
    return places, starts, parts, rows_before


def shards(docs: DataFrame, n_shards: int = SHARDS, order: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns of docs, then size, text_crc32, shard (from 0) and slot (from 0 in each shard)."""
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    with scratch() as keep:
        table = keep(_sorted(docs, order))
        places, starts, parts, rows_before = _cuts(table, n_shards)
    place = F.col("__place")
    if places:
        shard = drawn_count(F.lit(places), place)
    else:
        shard = F.lit(0)
    starts_of = F.lit(starts)
    if parts:
        first = F.element_at(F.lit(rows_before), drawn_count(F.lit(parts), F.shiftright(place, _ROWS)))
        index = first + place.bitwiseAND((1 << _ROWS) - 1)
    else:
        index = place
    held = table.withColumn("__shard", shard.cast("int")).withColumn("__index", index)
    slot = (F.col("__index") - F.element_at(starts_of, F.col("__shard") + 1)).cast("long")
    return held.select(*with_added("__row", docs.columns, {"size": F.col("__size"), "text_crc32": F.col("__crc"), "shard": F.col("__shard"), "slot": slot}))


def write_shards(docs: DataFrame, path: str, n_shards: int = SHARDS, order: Sequence[str] = ("doc_id",)) -> None:
    """Write the shards as folders shard=<number> of Parquet files. A task holds a stretch of the order, so it writes to few folders."""
    shards(docs, n_shards, order).write.mode("overwrite").partitionBy("shard").parquet(path)


def digest(docs: DataFrame, n_shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and, as the law isn't by key, an empty grown_shard."""
    out = shards(docs, n_shards)
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
