"""Documents to training mix: language ID, near duplicates, benchmark decontamination, secret redaction, source mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. run() writes every stage as Parquet in the shared
folder and rereads it, so a lost executor repeats one stage's tasks at most and no lineage grows. Stages decide on
(doc_id, text): only keys of rows that go come back from Python, and texts stay where they are.

Defined cases: null or empty text, or text without a letter: goes in the first stage; null doc_id: kept like any other
row, and in a group of near duplicates the last choice; ties: the smallest doc_id of a group stays; repeated rows: one
stays; null source: a source of its own; very long texts: whole in every stage; extra columns, whatever their names, are
passed on (those that the last stage adds replace columns of the same name); empty documents or benchmark: no rows, or
nothing to look for; benchmark items of fewer than 24 characters: not looked for, as a few words are in many clean texts
(decontaminate.keep_clean() with least=1 looks for them too, between word borders).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citeloom.llm import decontaminate, language_id, mixing, ngram_join, secret_scan
from citeloom.llm.common import discard, materialize, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told (no text, no letter) go."""
    return language_id.reject_undetermined(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return ngram_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; the secrets in it are replaced."""
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in equal shares, shuffled."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("source_mixing", mix_sources),
]

#: The language profiles, the Jaccard join and the alignment can't be put in SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        new = materialize(stage(spark, docs, sf_dir), name)
        if held is not None:
            discard(held)
        docs, held = new, new
    return docs
