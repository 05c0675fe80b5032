"""Operator 13: fill-in-the-middle transformation of documents.

A text is cut into units: a word with the white space before it, or white space at the end. Two of the n + 1 borders,
drawn from a hash of the seed and doc_id, part it into prefix, middle and suffix, which are put together as

    psm    <P>prefix<S>suffix<M>middle
    spm    <S>suffix<P>prefix<M>middle

so that a model that reads from left to right learns to fill the gap. A text stays plain if it is empty, holds one of the marks
itself, or isn't among the FIM_PERCENT drawn; of the others SPM_PERCENT take the second form. restore() gives the text back
from output and form alone: a text that is rearranged holds no mark, so each mark is found once.

Execution: two pandas UDFs over Arrow batches, no shuffle. The units' ends are collected as 4 bytes each in a compact array
and only two of them looked up, so a text needs its own size and 4 bytes a unit beside it. Every row depends on itself alone, so a lost task is done
again with the same result. The id goes to Python as text: pandas has no whole numbers with nulls.

Defined cases: null text: like an empty one, n = 0, plain, output empty; white space only: one unit; null doc_id: drawn from the
seed alone; repeated rows: equal results; very long texts: whole; empty table: no rows; extra columns pass through, but
for those named like an added one.
"""

from __future__ import annotations

import hashlib
from array import array
from operator import methodcaller
from typing import NamedTuple

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeloom.llm.common import pack, with_added

SEED = 42
FIM_PERCENT = 50
SPM_PERCENT = 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: Possessive, so that trailing white space is not tried twice; the matches are those of the greedy pattern.
UNIT = regex.compile(r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++")
_end = methodcaller("end")


class Formed(NamedTuple):
    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    text: str


def unit_ends(text: str) -> array:
    ends = array("I")
    ends.extend(map(_end, UNIT.finditer(text)))
    return ends


def form(doc_id: str | None, text: str, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> Formed:
    drawn = hashlib.sha256(f"{seed}:{doc_id or ''}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(drawn[i : i + 8], 16) for i in (0, 8, 16, 24))
    ends = unit_ends(text)
    n = len(ends)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= fim_percent:
        return Formed(n, "plain", None, None, text)
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, z = ends[first - 1] if first else 0, ends[second - 1] if second else 0
    if h4 % 100 < spm_percent:
        return Formed(n, "spm", a, z - a, "".join((SUFFIX, text[z:], PREFIX, text[:a], MIDDLE, text[a:z])))
    return Formed(n, "psm", a, z - a, "".join((PREFIX, text[:a], SUFFIX, text[z:], MIDDLE, text[a:z])))


def restore(output: str, formed: str) -> str:
    """The text from which form() made the output."""
    if formed == "plain":
        return output
    one, other = (PREFIX, SUFFIX) if formed == "psm" else (SUFFIX, PREFIX)
    if not output.startswith(one):
        raise ValueError(f"no {formed} output")
    left, found, rest = output[len(one) :].partition(other)
    right, ended, middle = rest.partition(MIDDLE)
    if not found or not ended:
        raise ValueError(f"no {formed} output")
    return left + middle + right if formed == "psm" else right + middle + left


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _formed(doc_id: Column, text: Column, seed: int, fim_percent: int, spm_percent: int) -> Column:
    @F.pandas_udf("n long, form string, prefix_chars long, middle_chars long, text string, sha256 string")
    def formed(ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
        out = [form(i, t or "", seed, fim_percent, spm_percent) for i, t in zip(ids, texts)]
        columns = {k: pd.Series([getattr(f, k) for f in out], dtype=kind) for k, kind in (("n", "int64"), ("form", object), ("prefix_chars", "Int64"), ("middle_chars", "Int64"), ("text", object))}
        return pd.DataFrame(columns | {"sha256": pd.Series([sha256(f.text) for f in out], dtype=object)})

    return formed(doc_id.cast("string"), text.cast("string"))


def transform(docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """The columns of docs, then n_units, form, prefix_chars, middle_chars (null if plain), fim_text and fim_sha256."""
    held = pack(docs).withColumn("__f", _formed(F.col("__row.doc_id"), F.col("__row.text"), seed, fim_percent, spm_percent))
    names = {"n_units": "n", "form": "form", "prefix_chars": "prefix_chars", "middle_chars": "middle_chars", "fim_text": "text", "fim_sha256": "sha256"}
    return held.select(*with_added("__row", docs.columns, {k: F.col("__f").getField(v) for k, v in names.items()}))


@F.pandas_udf(T.StringType())
def restored(output: pd.Series, formed: pd.Series) -> pd.Series:
    """The texts, from fim_text and form."""
    return pd.Series([restore(o, f) for o, f in zip(output, formed)], dtype=object)


@F.pandas_udf(T.StringType())
def restored_sha256(output: pd.Series, formed: pd.Series) -> pd.Series:
    """Hex digests of what restored() gives, where the texts themselves aren't wanted back."""
    return pd.Series([sha256(restore(o, f)) for o, f in zip(output, formed)], dtype=object)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    made = transform(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    again = restored_sha256(F.col("fim_text"), F.col("form"))
    return made.select("doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars", F.col("fim_sha256").alias("output_sha256"), again.alias("restored_sha256"))
