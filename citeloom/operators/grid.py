"""The result grid: filters, search, paging, selection and editing as DataFrame operations."""

from __future__ import annotations

import datetime
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.operators.pages import PageIndex


def parse_range(given: str, low, high, read: Callable = float) -> tuple:
    """`lo ... hi`, each end read by `read`; an open end is the column's own."""
    first, dots, last = given.partition("...")
    if not dots or "..." in last:
        raise ValueError(f"not a range: {given!r}")
    return tuple(read(x.strip()) if x.strip() else own for x, own in ((first, low), (last, high)))


def parse_date_range(given: str, first: datetime.date, last: datetime.date) -> tuple[datetime.date, datetime.date]:
    """The same of ISO days."""
    return parse_range(given, first, last, datetime.date.fromisoformat)


def parse_time_range(given: str, first: datetime.datetime, last: datetime.datetime) -> tuple[datetime.datetime, datetime.datetime]:
    """The same of ISO times."""
    return parse_range(given, first, last, datetime.datetime.fromisoformat)


def range_filter(c: Column, low, high, least=None, most=None) -> Column:
    """Bounds included; null and NaN are out. A range that covers all of least to most is no filter."""
    if least is not None and most is not None and low <= least and high >= most:
        return F.lit(True)
    return F.coalesce(c.between(low, high), F.lit(False))


def date_filter(c: Column, first: datetime.date, last: datetime.date) -> Column:
    """Midnight to midnight, both included."""
    start, end = (F.lit(f"{d.isoformat()} 00:00:00").cast("timestamp_ntz") for d in (first, last))
    return F.coalesce(c.cast("timestamp_ntz").between(start, end), F.lit(False))


def factor_filter(c: Column, values: list[str]) -> Column:
    """One of the values; an empty list is no filter."""
    return F.coalesce(c.isin(values), F.lit(False)) if values else F.lit(True)


def logical_filter(c: Column, values: list[str]) -> Column:
    """true, false or na."""
    return F.coalesce(c.cast("string"), F.lit("na")).isin(values) if values else F.lit(True)


def search(c: Column, query: str, regex: bool = False, smart: bool = True, case_insensitive: bool = True) -> Column:
    """A regular expression, every word of the query somewhere (smart), or the query as it is; null is the empty text."""
    value = F.coalesce(c.cast("string"), F.lit(""))
    if regex:
        return value.rlike(f"(?i){query}" if case_insensitive else query)
    if case_insensitive:
        value, query = F.lower(value), query.lower()
    found = F.lit(True)
    for word in query.split() if smart else [query]:
        found &= value.contains(word)
    return found


def search_all(columns: list[str], query: str, **options: bool) -> Column:
    """Smart search over a whole row: every word in some column."""
    row = F.concat_ws("  ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return search(row, query, **options)


DEEP = 100_000  # rows up to a page's end that one task may hold


@dataclass(frozen=True)
class Page:
    rows: DataFrame  # of the page, with row_number among all that match
    df: DataFrame
    order: list[Column]

    @property
    def matching(self) -> DataFrame:
        """All that match, with row_number."""
        return numbered(self.df, self.order)


def numbered(df: DataFrame, order: list[Column]) -> DataFrame:
    """df with row_number (long, from 1) in an order that ends in a tiebreaker; what is written for it stays until the application ends. PageIndex has more, and can be closed."""
    return PageIndex(df, order).rows()


def page(df: DataFrame, order: list[Column], number: int, length: int) -> Page:
    """The number-th page (from 1). order must end in a tiebreaker.

    The page comes from a top-k plan (only number * length rows leave the tasks), or, if it lies deep, by a PageIndex that goes
    again at once; many deep pages of one table are better read from an index that is kept. Numbering all rows is only done by
    whoever reads `matching`.
    """
    if number < 1:
        raise ValueError("pages count from 1")
    if number * length <= DEEP:
        ranked = df.orderBy(*order).limit(number * length).withColumn("row_number", F.row_number().over(Window.orderBy(*order)).cast("long"))
        return Page(ranked.where(F.col("row_number") > (number - 1) * length), df, order)
    if length > DEEP:
        return Page(PageIndex(df, order).between((number - 1) * length + 1, number * length), df, order)
    with PageIndex(df, order) as index:
        past = (number - 1) * length >= index.n
        rows = index.between(1, 0) if past else index.copy_of_page(number, length)
    return Page(rows, df, order)


def checked_page(df: DataFrame, order: list[Column], number: int, length: int) -> Page:
    """As page(), but a page past the end raises; this counts the rows."""
    if number < 1 or (number - 1) * length >= max(df.count(), 1):
        raise ValueError(f"no page {number}")
    return page(df, order, number, length)


def selected(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    return df.join(keys.select(key).distinct(), key, "left_semi")


def selected_columns(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """A column selection: the key and the chosen columns, in the table's order."""
    return df.select(*[c for c in df.columns if c == key or c in columns])


def selected_cells(df: DataFrame, key: str, cells: DataFrame) -> DataFrame:
    """cells: the key and `column`. The chosen cells as rows: key, column, value (text)."""
    shown = [c for c in df.columns if c != key]
    flat = df.select(key, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in shown])).alias("cell")).select(key, "cell.column", "cell.value")
    return flat.join(cells.select(key, "column").distinct(), [key, "column"], "left_semi")


def selected_both(df: DataFrame, key: str, keys: DataFrame, columns: list[str]) -> DataFrame:
    """A selection of rows and columns: every cell that is in a chosen row or a chosen column, as selected_cells()."""
    rows = keys.select(key).distinct().withColumn("column", F.explode(F.array(*[F.lit(c) for c in df.columns if c != key])))
    if columns:
        rows = rows.unionByName(df.select(key).withColumn("column", F.explode(F.array(*[F.lit(c) for c in columns]))))
    return selected_cells(df, key, rows)


def selectable(df: DataFrame, key: str, keys: list[int]) -> DataFrame:
    """Positive keys allow only these rows; keys of zero and less deny the rows of their absolute values."""
    if not keys:
        return df
    if all(k > 0 for k in keys):
        return df.where(F.col(key).isin(keys))
    if any(k > 0 for k in keys):
        raise ValueError("allow or deny rows, not both")
    return df.where(~F.col(key).isin([-k for k in keys]))


def between_rows(numbered: DataFrame | PageIndex, a: int, b: int) -> DataFrame:
    """A shift selection in the current order, from either end; of an index only the files that hold it are read."""
    if isinstance(numbered, PageIndex):
        return numbered.between(min(a, b), max(a, b))
    return numbered.where(F.col("row_number").between(min(a, b), max(a, b)))


def show(df: DataFrame, columns: list[str] | None = None, hide: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*[c for c in (columns or df.columns) if c not in hide])


def add_row(df: DataFrame, values: list) -> DataFrame:
    if len(values) != len(df.columns):
        raise ValueError(f"a row has {len(df.columns)} values, not {len(values)}")
    return df.union(df.sparkSession.createDataFrame([tuple(values)], df.schema))


def edit_cells(df: DataFrame, key: str, edits: DataFrame) -> DataFrame:
    """edits: the key, `column` and `value` (text, null to empty the cell), at most one row a cell; cast to the columns' types. Every edit names its row by the key that the row has before, also where it changes the key."""
    by_row = edits.groupBy(F.col(key).alias("__key")).agg(F.map_from_entries(F.collect_list(F.struct("column", "value"))).alias("__new"))

    def changed(c: str) -> Column:
        here = F.coalesce(F.map_contains_key("__new", F.lit(c)), F.lit(False))
        return F.when(here, F.element_at("__new", F.lit(c)).cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c)

    return df.join(by_row, F.col(key) == F.col("__key"), "left").select(*[changed(c) for c in df.columns])


def edit_row(df: DataFrame, key: str, value, new: dict) -> DataFrame:
    """Several cells of one row changed at once, in whatever order they are named; the row is the one that has the key before."""
    if unknown := set(new) - set(df.columns):
        raise ValueError(f"no columns {sorted(unknown)}")
    here = F.col(key) == value
    return df.select(*[F.when(here, F.lit(new[c]).cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in df.columns])


def edit_column(df: DataFrame, key: str, column: str, values: DataFrame) -> DataFrame:
    """values: the key and `value`. A whole column changed; rows without a value keep theirs."""
    return edit_cells(df, key, values.select(key, F.lit(column).alias("column"), F.col("value").cast("string").alias("value")))


def edit_all(df: DataFrame, key: str, new: DataFrame) -> DataFrame:
    """Every column of the rows of `new` (the same columns) taken from there; rows that it lacks stay."""
    return df.join(new.select(key).distinct(), key, "left_anti").select(*df.columns).unionByName(new.select(*df.columns))


def reload(fresh: DataFrame, key: str, selection: DataFrame | None, clear: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """New data, and what is left of a selection (keys) in it; clear drops the selection."""
    if selection is None or clear:
        return fresh, None
    return fresh, selection.join(fresh.select(key), key, "left_semi")


def highlighted(c: Column, query: str, regex: bool = False, case_insensitive: bool = True) -> Column:
    """c with every word of the query (or every match of the expression) within <mark>; null stays null, a blank query marks nothing."""
    words = [query] if regex else [re.escape(w) for w in sorted(set(query.split()), key=len, reverse=True)]
    if not any(words):
        return c
    return F.regexp_replace(c, ("(?i)" if case_insensitive else "") + f"({'|'.join(words)})", "<mark>$1</mark>")


def row_groups(df: DataFrame, by: str, order: list[Column], hide: bool = True) -> DataFrame:
    """Rows in groups: `group` first, then whether the row begins one; the column itself is hidden unless wanted. order: rising, the last column a
    tiebreaker. A group's first row is a minimum, joined back, so that no task sees a whole group."""
    place = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(order)])
    first = df.groupBy(F.col(by).alias("__by")).agg(F.min(place).alias("__first"))
    joined = df.join(first, F.col(by).eqNullSafe(F.col("__by")))
    return joined.select(F.col(by).alias("group"), place.eqNullSafe(F.col("__first")).alias("group_start"), *[c for c in df.columns if c != by or not hide])


def edit(df: DataFrame, key: str, value, column: str, new) -> DataFrame:
    """One cell changed."""
    return edit_row(df, key, value, {column: new})


def column_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """The smallest and largest value of each column, for its slider."""
    return df.agg(*[f(c).alias(f"{c}_{n}") for c in columns for n, f in (("min", F.min), ("max", F.max))])


def clip_range(low: float, high: float, least: float, most: float) -> tuple[float, float]:
    """A user's range within new limits."""
    return min(max(low, least), most), max(min(high, most), least)


def columns_to_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Equally long array columns to rows; unequal lengths raise."""
    sizes = [F.size(c) for c in columns]
    same = F.lit(True)
    for s in sizes[1:]:
        same &= s == sizes[0]
    rest = [c for c in df.columns if c not in columns]
    zipped = F.when(same, F.arrays_zip(*columns)).otherwise(F.raise_error(F.lit("columns of different lengths")))
    return df.select(*rest, F.inline(zipped))
