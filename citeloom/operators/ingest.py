"""From references and fetched works to key works."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.functions import text


def works_lookup(works: DataFrame, refs: DataFrame) -> DataFrame:
    """The fetched works whose DOI (with prefix) the references name; blank DOIs name none."""
    asked = refs.where("doi != ''").select(F.concat(F.lit(text.DOI_PREFIX), "doi").alias("doi")).distinct()
    return works.join(asked, "doi", "left_semi")


SALTS = 64  # tasks over which references without DOI are dealt
FEW = 10_000  # works without DOI that are sent to every task


class KeyWorks(NamedTuple):
    """References with their works, and the two groups that a null DOI links, as they are: every one of refs meets every one of works."""

    pairs: DataFrame
    refs: DataFrame
    works: DataFrame


def key_works_grouped(refs: DataFrame, works: DataFrame, normalize_doi: bool = False) -> KeyWorks:
    """Every reference with a DOI with its work; those without aren't spelt out as pairs, whose number is the product of both groups."""
    left = refs.withColumn("doi", text.prefixed(F.col("doi"), text.DOI_PREFIX))
    right = works.withColumnRenamed("doi", "work_doi")
    a, b = F.col("doi"), F.col("work_doi")
    if normalize_doi:
        a, b = F.lower(a), F.lower(b)
    known = left.where("doi is not null").join(right, a == b, "left").drop("work_doi")
    return KeyWorks(known, left.where("doi is null"), right.where("work_doi is null").drop("work_doi"))


def key_works(refs: DataFrame, works: DataFrame, normalize_doi: bool = False, null_meets_null: bool = True) -> DataFrame:
    """Every reference with its work; a reference without DOI meets every work without DOI, or none (null_meets_null).

    References without DOI are one key, so they are joined apart: with a copy of the works without DOI in every task if these are FEW,
    else dealt over SALTS numbers, each of which has a copy. key_works_grouped() leaves the pairs out.
    """
    known, blank, none = key_works_grouped(refs, works, normalize_doi)
    if not null_meets_null:
        return known.unionByName(blank, allowMissingColumns=True)
    if none.limit(FEW + 1).count() <= FEW:
        salted, copies = blank.withColumn("__salt", F.lit(0)), F.broadcast(none.withColumn("__salt", F.lit(0)))
    else:
        salted = blank.withColumn("__salt", F.pmod(F.xxhash64(*[c for c in blank.columns if c != "doi"]), F.lit(SALTS)))
        copies = none.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return known.unionByName(salted.join(copies, "__salt", "left").drop("__salt"))


def messages_per_work(key: DataFrame) -> DataFrame:
    """One row a work id (null is one, and comes last) with all its background messages, repeated ones too, in order. Repeats are counted before they are gathered."""
    counted = key.groupBy(text.strip(F.col("id"), text.WORK_PREFIX).alias("id"), "bm").agg(F.count("bm").cast("int").alias("n"))
    listed = counted.groupBy("id").agg(F.array_sort(F.collect_list(F.when(F.col("bm").isNotNull(), F.struct("bm", "n")))).alias("c"))
    return listed.select("id", F.flatten(F.transform("c", lambda x: F.array_repeat(x["bm"], x["n"]))).alias("bms")).orderBy(F.asc_nulls_last("id"))
