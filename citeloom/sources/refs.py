"""The reference list: a CSV of background message, sub message, level, zotero, doi and description."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions import text
from citeloom.schemas import REFS_RAW


def read_refs_raw(spark: SparkSession, path: str) -> DataFrame:
    """Blank fields stay blank, the text NA is null; quotes may hold doubled quotes and line breaks."""
    raw = spark.read.schema(REFS_RAW).csv(path, header=True, sep=",", quote='"', escape='"', multiLine=True, nullValue="\u0001", emptyValue="", enforceSchema=True)
    return raw.select(*[text.na_to_null(F.col(c)).alias(c) for c in raw.columns])


def tidy_refs(raw: DataFrame, background_prefix: str = text.BACKGROUND_PREFIX, sub_prefix: str = text.SUB_PREFIX) -> DataFrame:
    """Message codes without their URLs (the prefixes are patterns), blank level as null, distinct rows."""
    return raw.select(
        text.strip(F.col("background_message"), background_prefix).alias("bm"),
        text.strip(F.col("sub_message"), sub_prefix).alias("sm"),
        text.blank_to_null(F.col("level")).alias("loc"),
        "zotero",
        text.strip(F.col("doi"), text.DOI_PREFIX).alias("doi"),
        F.col("description").alias("citation"),
    ).distinct()
