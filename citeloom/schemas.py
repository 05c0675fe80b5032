"""Declared schemas of the stored tables; reads never infer."""

from pyspark.sql import types as T

S, I, B = T.StringType(), T.IntegerType(), T.BooleanType()

#: The reference list as it comes: unnamed first column, header names with spaces or dots.
REFS_RAW = T.StructType([T.StructField(c, S) for c in ("X", "background_message", "sub_message", "level", "zotero", "doi", "description")])
REFS = T.StructType([T.StructField(c, S) for c in ("bm", "sm", "loc", "zotero", "doi", "citation")])
NODES = T.StructType(
    [T.StructField(c, S) for c in ("id", "doi", "author", "title", "ab", "type")]
    + [T.StructField("publication_year", I), T.StructField("oa_input", B), T.StructField("bm", S), T.StructField("sm", S)]
)
EDGES = T.StructType([T.StructField(c, S) for c in ("from", "to", "bm", "sm")])
WORKS = T.StructType(
    [T.StructField(c, S) for c in ("id", "doi", "title", "ab", "type")]
    + [
        T.StructField("publication_year", I),
        T.StructField("author", T.ArrayType(T.StructType([T.StructField("name", S)]))),
        T.StructField("referenced_works", T.ArrayType(S)),
    ]
)
#: Nested columns of a fetched work that the stored nodes leave out.
NESTED = ("grants", "counts_by_year", "referenced_works", "related_works", "concepts", "topics")
