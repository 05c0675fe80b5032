"""Operator 2: exact top-k search with a vector-approximation file.

Vectors are turned into integers, floor(scale * x). Every dimension is cut into 2^bits cells between its smallest and
largest value; a vector's approximation is its cell numbers, a byte each. The approximation file, one row a vector, is
written once to the shared folder. A search then has three steps:

1. Scan the file, not the vectors. A cell's borders bound a query's inner product from both sides: with the lower borders
   as a vector f and the widths w, it is at least q.f + sum(min(q, 0) (w - 1)) and at most q.f + sum(max(q, 0) (w - 1)), so
   one product of cells and queries gives both. What reaches the k-th largest lower bound of its query stays a candidate.
2. Read the exact vectors of the FIRST k candidates of each query, in bound order (largest upper bound first). The k-th
   score so found is one that the result can't be below.
3. Read the exact vectors of the candidates whose upper bound reaches that score. After them the k-th result is certain:
   any other vector's upper bound is below it.

Bounds are doubles with a margin for their rounding, so they hold for numbers of any size; scores are whole numbers.

Queries are taken in chunks of at most CHUNK rows, each fetched, shipped to the tasks (so what is broadcast has a bound
that does not depend on the data), answered, written and released; one scan of the file a chunk. Exact vectors are read by
an equi-join on a 64-bit hash of id and vector; candidates are broadcast behind a row count. The file and all steps'
tables are deleted when the result is written.

Defined cases
- vectors that are null, empty, or hold null or non-finite components, and rows with a null id take no part.
- a query is compared with vectors of its own length only, and never with its own row.
- ties in score go to the smaller id; fewer than k candidates: all of them.
- repeated ids: each row is a candidate of its own. A query leaves out one row that equals it in id and vector (which of
  several equal ones makes no difference), not other rows of its id. Repeated query rows are queries of their own.
- empty table: no rows. Extra columns are ignored.
- scores outside the long range are clipped to it; vectors whose scaled components overflow a double take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.common import if_small, materialize, scratch, trim

CHUNK = 4096  # queries shipped at once
BLOCK = 4096  # vectors bounded at once
SUB = 256  # queries bounded at once
BITS = 8  # at most 8: a cell number is a byte
FIRST = 4  # times k candidates are read first
LEAST, MOST = -(2**63), 2**63 - 1

CANDIDATES = "query_no long, row long, upper double"


def usable(x: Column, scale: float) -> Column:
    return (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v * scale) != float("inf")))


def matrices(vectors: pa.Array, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of floor(scale * x)) for each vector length."""
    lengths, flat = np.diff(vectors.offsets.to_numpy()), np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False))
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        yield rows, flat[starts[rows][:, None] + np.arange(d)]


#: Vector length to (lower border of the first cell, cell width) of each dimension; the widths are whole numbers.
Grid = dict[int, tuple[np.ndarray, np.ndarray]]


def grid_of(keyed: DataFrame, scale: float, bits: int) -> Grid:
    """From the smallest and largest value of each dimension: one row for each length and dimension is all that reaches the driver."""
    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            for _, m in matrices(pa.concat_arrays([b.column("embedding")]), scale):
                low, high = found.get(m.shape[1], (m[0], m[0]))
                found[m.shape[1]] = np.minimum(low, m.min(axis=0)), np.maximum(high, m.max(axis=0))
        for d, (low, high) in found.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(d, d)), pa.array(np.arange(d)), pa.array(low), pa.array(high)], names=["d", "i", "low", "high"])

    rows = keyed.select("embedding").mapInArrow(ranges, "d long, i long, low double, high double").groupBy("d", "i").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("d", "i").collect()
    out: Grid = {}
    for d in {r["d"] for r in rows}:
        low, high = (np.array([r[c] for r in rows if r["d"] == d]) for c in ("low", "high"))
        out[d] = low, np.maximum(1.0, np.ceil((high - low + 1) / 2**bits))
    return out


def approximate(keyed: DataFrame, grid: Grid, scale: float) -> DataFrame:
    """The approximation file: row, d and the cell numbers."""
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            numbers = b.column("row").to_numpy()
            for rows, m in matrices(pa.concat_arrays([b.column("embedding")]), scale):
                d = m.shape[1]
                low, width = grid[d]
                of = np.clip((m - low) // width, 0, 255).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array(numbers[rows]), pa.array(np.full(len(rows), d, np.int32)), pa.array([r.tobytes() for r in of], pa.binary())], names=["row", "d", "cells"])
        trim()

    return keyed.select("row", "embedding").mapInArrow(cells, "row long, d int, cells binary")


class Bounds:
    """The k largest lower bounds of each query so far, and the candidates that may still reach them."""

    def __init__(self, numbers: np.ndarray, matrix: np.ndarray, low: np.ndarray, width: np.ndarray, k: int):
        self.numbers, self.k = numbers, k
        self.steps, self.base = (matrix * width).T, matrix @ low
        self.up, self.down = np.maximum(matrix, 0) @ (width - 1), np.minimum(matrix, 0) @ (width - 1)
        margin = (np.abs(matrix) @ (np.abs(low) + 256 * width)) * (len(low) + 8) * 2.0**-50
        self.up, self.down = self.up + margin, self.down - margin
        self.best = np.full((k, len(numbers)), -np.inf)
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def scan(self, rows: np.ndarray, cells: np.ndarray) -> None:
        cells = cells.astype(np.float64)
        for at in range(0, len(self.numbers), SUB):
            part = slice(at, at + SUB)
            with np.errstate(over="ignore", invalid="ignore"):
                middle = cells @ self.steps[:, part] + self.base[part]
                lower = np.nan_to_num(middle + self.down[part], nan=-np.inf, posinf=np.inf, neginf=-np.inf)
                above = np.nan_to_num(middle + self.up[part], nan=np.inf, posinf=np.inf, neginf=-np.inf)
            every = np.concatenate([self.best[:, part], lower])
            self.best[:, part] = np.partition(every, len(every) - self.k, axis=0)[len(every) - self.k :]
            v, q = np.nonzero(above >= self.best[:, part].min(axis=0))
            self.held.append((q + at, rows[v], above[v, q]))
            self.size += len(q)
        if self.size > 2_000_000:
            self.prune()

    def prune(self) -> None:
        q, row, upper = (np.concatenate(x) for x in zip(*self.held))
        stay = upper >= self.best.min(axis=0)[q]
        self.held = [(q[stay], row[stay], upper[stay])]
        self.size = int(stay.sum())


def search(file: DataFrame, keyed: DataFrame, shipped, k: int, scale: float) -> DataFrame:
    """query_id, rank, vec_id, score for each query of the broadcast chunk. All steps take one candidate more than k, as the query's own row goes."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, _, wholes, grid = shipped.value
        by_length = {m.shape[1]: Bounds(numbers[rows], m, *grid[m.shape[1]], k + 1) for rows, m in wholes if m.shape[1] in grid}
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                part = b.slice(at, BLOCK)
                keys, lengths = part.column("row").to_numpy(), part.column("d").to_numpy()
                for d in np.unique(lengths).tolist():
                    mine = np.flatnonzero(lengths == d)
                    if d in by_length:
                        data = b"".join(part.column("cells").take(pa.array(mine)).to_pylist())
                        by_length[d].scan(keys[mine], np.frombuffer(data, np.uint8).reshape(len(mine), d))
        for bounds in by_length.values():
            if bounds.held:
                bounds.prune()
                q, row, upper = bounds.held[0]
                for at in range(0, len(q), 100_000):
                    now = slice(at, at + 100_000)
                    yield pa.RecordBatch.from_arrays([pa.array(bounds.numbers[q[now]]), pa.array(row[now]), pa.array(upper[now])], names=["query_no", "row", "upper"])
        trim()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, ids, wholes, _ = shipped.value
        asked = {int(numbers[r]): (int(ids[r]), m[i]) for rows, m in wholes for i, r in enumerate(rows)}
        for b in batches:
            nos, vec_ids = b.column("query_no").to_pylist(), b.column("vec_id").to_pylist()
            own, scores = [], []
            for no, vec_id, x in zip(nos, vec_ids, b.column("embedding")):
                whole, (query_id, q) = np.floor(scale * x.values.to_numpy(zero_copy_only=False)), asked[no]
                own.append(vec_id == query_id and bool((whole == q).all()))
                exact = int(whole @ q) if np.abs(whole) @ np.abs(q) < 2.0**52 else sum(int(a) * int(c) for a, c in zip(whole, q))
                scores.append(min(max(exact, LEAST), MOST))
            query_ids = [asked[no][0] for no in nos]
            yield pa.RecordBatch.from_arrays([pa.array(nos, pa.int64()), pa.array(query_ids, pa.int64()), pa.array(vec_ids, pa.int64()), pa.array(scores, pa.int64()), pa.array(own, pa.bool_())], names=["query_no", "query_id", "vec_id", "score", "own"])

    def read(wanted: DataFrame, label: str) -> DataFrame:
        wanted = materialize(wanted.select("query_no", "row").distinct(), f"{label}-candidates")
        return materialize(if_small(wanted).join(keyed, "row").select("query_no", "vec_id", "embedding").mapInArrow(score, "query_no long, query_id long, vec_id long, score long, own boolean"), label)

    by_bound = F.row_number().over(Window.partitionBy("query_no").orderBy(F.desc("upper"), "row"))
    by_score = F.row_number().over(Window.partitionBy("query_no").orderBy(F.desc("score"), "vec_id", F.desc("own")))
    found = materialize(file.mapInArrow(scan, CANDIDATES), "candidates")
    first = materialize(found.withColumn("n", by_bound).where(F.col("n") <= FIRST * (k + 1)), "first")
    scored = read(first, "scored-first")
    kth = materialize(scored.withColumn("n", by_score).where(F.col("n") == k + 1).select("query_no", F.col("score").cast("double").alias("kth")), "kth")
    certain = F.col("kth") - F.abs("kth") * 2.0**-50  # a long is rounded as a double
    rest = found.join(if_small(kth), "query_no", "left").where(F.col("kth").isNull() | (F.col("upper") >= certain) | (F.col("kth") >= float(MOST)))
    rest = rest.join(if_small(first.select("query_no", "row")), ["query_no", "row"], "left_anti")
    ranked = scored.unionByName(read(rest, "scored-rest")).withColumn("n", by_score).where(F.col("n") <= k + 1)
    ranked = ranked.withColumn("mine", F.min(F.when(F.col("own"), F.col("n"))).over(Window.partitionBy("query_no")))
    others = ranked.where(F.coalesce(F.col("n") != F.col("mine"), F.col("n") <= k))
    rank = F.col("n") - F.when(F.col("n") > F.col("mine"), 1).otherwise(0)
    return others.select("query_id", rank.alias("rank"), "vec_id", "score")


def chunks(queries: DataFrame, most: int) -> Iterator[list[tuple[int, list[float]]]]:
    """The queries in lists of at most `most`; one list is held at a time."""
    held = []
    for r in queries.toLocalIterator():
        held.append((r["vec_id"], r["embedding"]))
        if len(held) == most:
            yield held
            held = []
    if held:
        yield held


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: float = 1024.0, bits: int = BITS, chunk: int = CHUNK) -> DataFrame:
    """vectors, queries: vec_id, embedding. Returns query_id, rank (from 1), vec_id, score."""
    clean, asked = (df.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).where(F.col("vec_id").isNotNull() & usable(F.col("embedding"), scale)) for df in (vectors, queries))
    keyed = clean.withColumn("row", F.xxhash64("vec_id", "embedding"))
    done = None
    with scratch() as keep:
        grid = grid_of(keyed, scale, bits)
        file = materialize(approximate(keyed, grid, scale), "approximations")
        for held in chunks(asked, chunk):
            wholes = list(matrices(pa.array([v for _, v in held], pa.list_(pa.float64())), scale))
            shipped = vectors.sparkSession.sparkContext.broadcast((np.arange(len(held)), np.array([i for i, _ in held], np.int64), wholes, grid))
            part = keep(materialize(search(file, keyed, shipped, k, scale), "top-k"))
            shipped.unpersist()
            done = part if done is None else done.unionByName(part)
    return done if done is not None else vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
