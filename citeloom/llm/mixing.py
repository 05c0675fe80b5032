"""Operator 8: mixing sources to target weights by Poisson replication. DataFrame functions only.

Each source s with n_s rows and target weight w_s gets the mean repetition rate

    rate_s = total_rows * w_s / (sum of w) / n_s

so that its expected number of output rows is its share of `total_rows`. Every row draws a uniform number from
a hash of the seed and its doc_id, inverts the Poisson distribution with its source's rate at that number, and is
exploded into so many copies. A source's distribution is tabulated once, by a running sum over the counts within 12
standard deviations (and 30) of its rate, beyond which no 52-bit draw falls; a row finds its count by bisection. The copies are dealt over all partitions by a second hash and sorted by it inside
each, which is a global shuffle that any rerun of a lost task repeats exactly.

Scale: rows per source are counted with map-side partial sums, and the table of rates has one row a source. The
join with it is an equi-join: the rates are written first, so Spark broadcasts them if their true size allows and
otherwise shuffles, where a hot source may be split. A table has some 24 sqrt(rate) numbers, and a source of n rows has
a rate in proportion to 1 / n, so what the rows of a source read of it stays below its number of copies. The draw itself
needs no shuffle.

Defined cases
- null source: a source of its own. A source missing from the weights, or with a weight <= 0 or null: no copies.
- null doc_id: the draw is keyed by the text instead. Rows with the same doc_id draw the same count.
- null, empty or very long text: treated like any other row.
- empty table: no rows. Extra columns pass through; an input column named like an added one is replaced.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.common import materialize, pack, with_added

SEED = 20240607


def uniform(seed: str, key: Column) -> Column:
    """A number in [0, 1) from 52 bits of a hash of the seed and key; DuckDB's md5 gives the same."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), key)), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def log_mass(k: Column, rate: Column) -> Column:
    """ln P(X = k), from Stirling's series beyond 20 so that nothing large cancels."""
    x = k.cast("double")
    series = 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - 1 / (1680 * x**7)
    far = (x - rate) - x * F.log1p((x - rate) / rate) - F.log(2 * F.pi() * x) / 2 - series
    return F.when(k <= 20, x * F.log(rate) - rate - F.log(F.factorial(F.least(k, F.lit(20)).cast("int")))).otherwise(far)


def tabulated(rates: DataFrame) -> DataFrame:
    """rates (source, rate > 0) with low, the smallest count that can be drawn, and cdf, P(X <= k) for k from low on."""
    spread = 12 * F.sqrt("rate") + 30
    low, high = F.greatest(F.lit(0), F.floor(F.col("rate") - spread)).cast("long"), F.ceil(F.col("rate") + spread).cast("long")
    flat = rates.select("source", "rate", low.alias("low"), F.explode(F.sequence(low, high)).alias("k")).withColumn("p", F.exp(log_mass(F.col("k"), F.col("rate"))))
    summed = flat.withColumn("p", F.sum("p").over(Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)))
    tables = summed.groupBy("source", "rate", "low").agg(F.array_sort(F.collect_list(F.struct("k", "p"))).alias("t"))
    return tables.select("source", "rate", "low", F.col("t.p").alias("cdf"))


def drawn_count(cdf: Column, u: Column) -> Column:
    """How many numbers of the rising array cdf are at most u, by bisection."""
    def halve(a: Column, _: Column) -> Column:
        middle = F.floor((a["lo"] + a["hi"]) / 2).cast("int")
        below = (a["lo"] < a["hi"]) & (F.element_at(cdf, F.least(middle + 1, F.size(cdf))) <= u)
        return F.struct(F.when(below, middle + 1).otherwise(a["lo"]).alias("lo"), F.when(below | (a["lo"] >= a["hi"]), a["hi"]).otherwise(middle).alias("hi"))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(cdf).cast("double"))).cast("int"))
    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(cdf).alias("hi")), halve, lambda a: a["lo"])


def source_rates(docs: DataFrame, weights: Mapping[str | None, float] | None = None, total_rows: int | None = None) -> DataFrame:
    """One row a source: source, n, weight, rate. Equal weights unless given; as many rows as the input unless given."""
    counts = docs.groupBy(F.col("source").alias("source")).agg(F.count("*").alias("n"))
    weight = F.lit(1.0)
    if weights is not None:
        weight = F.lit(None).cast("double")
        for name, w in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(weight)
        weight = F.when(weight > 0, weight).otherwise(0.0)
    counts = counts.withColumn("weight", weight)
    sums = counts.agg(F.sum("n").alias("n"), F.sum("weight").alias("w"))
    total = F.lit(float(total_rows)) if total_rows is not None else sums.select(F.col("n").cast("double")).scalar()
    rate = total * F.col("weight") / sums.select("w").scalar() / F.col("n")
    return counts.withColumn("rate", F.coalesce(rate, F.lit(0.0)))


def mix(docs: DataFrame, weights: Mapping[str | None, float] | None = None, total_rows: int | None = None, seed: int = SEED) -> DataFrame:
    """The replicated, globally shuffled rows: the columns of docs, then copy_no (from 1), copies, rate and shuffle_key."""
    key = F.coalesce(F.col("__row.doc_id").cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(F.col("__row.text"), F.lit("")))))
    rates = tabulated(source_rates(docs, weights, total_rows).where("rate > 0"))
    rates = materialize(rates.select(F.col("source").alias("__source"), F.col("rate").alias("__rate"), F.col("low").alias("__low"), F.col("cdf").alias("__cdf")), "rates")  # a row a source: broadcast by its true size, or else a shuffled join
    drawn = (
        pack(docs)
        .withColumn("__key", key)
        .withColumn("__u", uniform(f"{seed}", F.col("__key")))
        .join(rates, F.col("__row.source").eqNullSafe(F.col("__source")))
        .withColumn("__copies", (F.col("__low") + drawn_count(F.col("__cdf"), F.col("__u"))).cast("int"))
        .where("__copies > 0")
        .select("__row", "__key", "__rate", "__copies", F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("__copy"))
        .withColumn("__shuffle", F.md5(F.concat(F.lit(f"{seed}:shuffle|"), F.col("__key"), F.lit("|"), F.col("__copy").cast("string"))))
    )
    added = {"copy_no": F.col("__copy"), "copies": F.col("__copies"), "rate": F.col("__rate"), "shuffle_key": F.col("__shuffle")}
    return drawn.repartition("__shuffle").sortWithinPartitions("__shuffle").select(*with_added("__row", docs.columns, added))
