"""Fetched works as a Spark data source: a folder of pages as a works service hands them out, read by cursor, with DOI filters taken to the pages.

    spark.dataSource.register(WorksPages)
    spark.read.format("works_pages").load(folder)

A page is a file of JSON works, one a line. Each partition is a stretch of pages; a task reads one page at a time, in batches of columns. The schema is
declared (WORKS, or the one given to schema()), so nothing is inferred: what a work lacks is null, what the schema lacks is left out. Filters on doi
(equality, a list, bounds, not null) are answered while a page is read, and works that don't pass never become rows; the session setting
spark.sql.python.filterPushdown.enabled must be true for that. The folder may be on any filesystem that pyarrow opens by its URI.

Defined cases: empty folder: no rows; empty page: none; a line that is no JSON: the task fails, naming the page, unless the option
mode=permissive leaves it out; a work without doi: doi null.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThanOrEqual
from pyspark.sql.pandas.types import to_arrow_schema

from citeloom.functions import text
from citeloom.schemas import WORKS
from citeloom.session import ship

PAGES = 4  # pages of a partition
ROWS = 5_000  # works of a batch
PUSHED = 1_000  # DOIs that are named to the source one by one


@dataclass
class Stretch(InputPartition):
    pages: tuple[str, ...]


class WorksPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "works_pages"

    def schema(self) -> T.StructType:
        return WORKS

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return PageReader(schema, dict(self.options))


class PageReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]) -> None:
        self.schema, self.options, self.filters = schema, options, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes what it can answer from a work's doi; the rest is Spark's."""
        for f in filters:
            if isinstance(f, (EqualTo, In, GreaterThanOrEqual, LessThanOrEqual, IsNotNull)) and f.attribute == ("doi",):
                self.filters.append(f)
            else:
                yield f

    def _filesystem(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(path) if "://" in (path := self.options["path"]) or path.startswith("file:") else (fs.LocalFileSystem(), path)

    def partitions(self) -> Sequence[Stretch]:
        files, folder = self._filesystem()
        found = sorted(f.path for f in files.get_file_info(fs.FileSelector(folder, recursive=True)) if f.type == fs.FileType.File and f.base_name[0] not in "._")
        size = int(self.options.get("pagesperpartition", PAGES))
        return [Stretch(tuple(found[i : i + size])) for i in range(0, len(found), size)] or [Stretch(())]

    def _passes(self, doi: str | None) -> bool:
        for f in self.filters:
            if doi is None:
                return False
            if isinstance(f, EqualTo) and doi != f.value or isinstance(f, In) and doi not in f.value:
                return False
            if isinstance(f, GreaterThanOrEqual) and doi < f.value or isinstance(f, LessThanOrEqual) and doi > f.value:
                return False
        return True

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        files, _ = self._filesystem()
        schema, held = to_arrow_schema(self.schema), []
        self.filters = [In(f.attribute, frozenset(f.value)) if isinstance(f, In) else f for f in self.filters]
        for page in partition.pages:
            with files.open_input_stream(page) as stream:
                for n, line in enumerate(stream.read().splitlines(), 1):
                    try:
                        work = json.loads(line)
                    except ValueError as e:
                        if self.options.get("mode") == "permissive":
                            continue
                        raise ValueError(f"{page}, line {n} is no JSON") from e
                    if self._passes(work.get("doi")):
                        held.append(work)
                    if len(held) >= ROWS:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)


def read_works(spark: SparkSession, folder: str, schema: T.StructType = WORKS) -> DataFrame:
    ship(spark)
    spark.dataSource.register(WorksPages)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("works_pages").schema(schema).load(folder)


def fetch_works(works: DataFrame, refs: DataFrame) -> DataFrame:
    """The works whose DOI (with prefix) the references name. A few DOIs are named to the source; of many it is told the bounds, and the rest is a semi-join."""
    asked = refs.where("doi != ''").select(F.concat(F.lit(text.DOI_PREFIX), "doi").alias("doi")).distinct()
    few = [r[0] for r in asked.limit(PUSHED + 1).collect()]
    if len(few) <= PUSHED:
        return works.where(F.col("doi").isin(few))
    low, high = asked.agg(F.min("doi"), F.max("doi")).first()
    return works.where(F.col("doi").between(low, high)).join(asked, "doi", "left_semi").select(*works.columns)
