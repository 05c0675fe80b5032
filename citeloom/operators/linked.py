"""Linked key sets: filters that several handles set together, selections, differences."""

from __future__ import annotations

import itertools
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.operators.key_counts import KeyCounts


def intersection(handles: dict[str, DataFrame]) -> DataFrame | None:
    """The keys that every handle has (each a DataFrame with the column key): counted once a handle; None without handles."""
    if not handles:
        return None
    tagged = [df.select(F.col("key").cast("string").alias("key")).distinct() for df in handles.values()]
    return reduce(DataFrame.unionAll, tagged).groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") == len(tagged)).select("key")


def linked_filter(df: DataFrame, key: str, handles: dict[str, DataFrame], selections: list[DataFrame] = ()) -> DataFrame:
    """Rows whose key every handle has and, where there are selections, any selection has. No handle: no filter."""
    keys = intersection(handles)
    text = F.col(key).cast("string")
    if keys is not None:
        df = df.join(keys.withColumnRenamed("key", "__key"), text == F.col("__key"), "left_semi")
    if selections:
        chosen = reduce(DataFrame.unionAll, [s.select(F.col("key").cast("string").alias("__key")) for s in selections]).distinct()
        df = df.join(chosen, text == F.col("__key"), "left_semi")
    return df


def slider_keys(df: DataFrame, key: str, c: Column, low, high) -> DataFrame:
    """Keys of rows within the bounds, both included; a full range filters as well."""
    return df.where(c.between(low, high)).select(F.col(key).cast("string").alias("key"))


def group_keys(groups: DataFrame, chosen: list[str]) -> DataFrame | None:
    """groups: name, key, a row for each key of a group. The keys of the chosen groups, each once; None (clear) if nothing is chosen."""
    if not chosen:
        return None
    return groups.where(F.col("name").isin(chosen)).select("key").distinct()


def keyset_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """key, change (added or removed) between two key sets, in one shuffle."""
    both = old.select("key", F.lit(1).alias("o"), F.lit(0).alias("n")).unionAll(new.select("key", F.lit(0).alias("o"), F.lit(1).alias("n")))
    sides = both.groupBy("key").agg(F.max("o").alias("o"), F.max("n").alias("n")).where("o != n")
    return sides.select("key", F.when(F.col("n") == 1, "added").otherwise("removed").alias("change"))


def check_sorted(keys: list[str]) -> None:
    """Key lists handed over as lists must be sorted without repeats."""
    if any(a >= b for a, b in zip(keys, keys[1:])):
        raise ValueError("keys must be sorted and distinct")


class Var:
    """A value whose listeners are told of changes: listener(new, old). Setting what it holds already tells nobody."""

    def __init__(self, value=None) -> None:
        self.value, self.listeners = value, []

    def on(self, listener: Callable) -> Callable[[], None]:
        """Returns a function that removes the listener."""
        self.listeners.append(listener)
        return lambda: self.listeners.remove(listener) if listener in self.listeners else None

    def set(self, value) -> None:
        old, self.value = self.value, value
        if value is not old:
            for listener in list(self.listeners):
                listener(value, old)


class FilterSet:
    """A group's filter handles. set() replaces a handle's keys, clear() removes the handle; keys() is None without any.

    Without `kept` every call of keys() counts the keys of all handles anew; with it they are kept up as handles change.
    """

    def __init__(self, kept: KeyCounts | None = None) -> None:
        self.handles: dict[str, DataFrame | None] = {}
        self.kept = kept

    def set(self, handle: str, keys: DataFrame) -> None:
        if keys is None:
            raise ValueError("clear() removes a filter")
        if self.kept:
            self.kept.set(handle, keys)
        self.handles[handle] = None if self.kept else keys

    def clear(self, handle: str) -> None:
        if self.kept:
            self.kept.clear(handle)
        self.handles.pop(handle, None)

    def keys(self) -> DataFrame | None:
        return self.kept.keys() if self.kept else intersection(self.handles)


class Selection(Var):
    """The last writer's keys."""


class Group:
    """What linked views of one name share: a filter set, whose keys `filter` announces, a selection, and variables by name."""

    def __init__(self, name: str, kept: KeyCounts | None = None) -> None:
        self.name, self.filters, self.filter, self.selection = name, FilterSet(kept), Var(), Selection()
        self.variables: dict[str, Var] = {}

    def var(self, name: str) -> Var:
        return self.variables.setdefault(name, Var())


class Groups:
    """Groups by name, made when first asked for."""

    def __init__(self) -> None:
        self.by_name: dict[str, Group] = {}

    def get(self, name: str) -> Group:
        return self.by_name.setdefault(name, Group(name))


class FilterHandle:
    """One view's part in a group's filter. A handle without a group does nothing; one that changes groups leaves its old filter behind cleared."""

    _count = itertools.count()

    def __init__(self, group: Group | None = None) -> None:
        self.id, self.group = f"filter{next(FilterHandle._count)}", group

    def set(self, keys: DataFrame | None) -> None:
        if self.group:
            if keys is None:
                self.group.filters.clear(self.id)
            else:
                self.group.filters.set(self.id, keys)
            self.group.filter.set(self.group.filters.keys())

    def clear(self) -> None:
        if self.group and self.id in self.group.filters.handles:
            self.set(None)

    def close(self) -> None:
        """Takes its filter and leaves the group."""
        self.switch(None)

    def switch(self, group: Group | None) -> None:
        if group is not self.group:
            self.clear()
            self.group = group

    def keys(self) -> DataFrame | None:
        return self.group.filter.value if self.group else None


class SelectionHandle:
    """One view's access to a group's selection. A change of groups keeps both groups' values."""

    def __init__(self, group: Group | None = None) -> None:
        self.group = group

    def set(self, keys: DataFrame | None) -> None:
        if self.group:
            self.group.selection.set(keys)

    def clear(self) -> None:
        self.set(None)

    def switch(self, group: Group | None) -> None:
        self.group = group

    @property
    def value(self) -> DataFrame | None:
        return self.group.selection.value if self.group else None
