"""Text columns: prefixes, anchors, missing values, authors."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: URL prefixes of messages (as patterns, whatever the host), DOIs and works.
BACKGROUND_PREFIX = r"https?://[^/\s]+/report/bgm/"
SUB_PREFIX = r"https?://[^/\s]+/report/subm/"
DOI_PREFIX = "https://doi.org/"
WORK_PREFIX = "https://openalex.org/"


def strip(c: Column, pattern: str) -> Column:
    """Remove every match of the regular expression; null stays null."""
    return F.regexp_replace(c, pattern, "")


def paste(*parts: Column | str) -> Column:
    """Concatenate; a null part becomes the text NA."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("NA")) for p in parts])


def anchor(c: Column, prefix: str) -> Column:
    """An HTML link that opens in a new tab; nothing is escaped."""
    return paste(f'<a href="{prefix}', c, '" target="_blank">', c, "</a>")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def na_to_null(c: Column) -> Column:
    """A CSV field as read: blank stays blank, the text NA is null."""
    return F.nullif(F.coalesce(c, F.lit("")), F.lit("NA"))


def prefixed(c: Column, prefix: str) -> Column:
    """Null for a blank, else prefix and value; null gives null."""
    return F.when(c == "", None).otherwise(F.concat(F.lit(prefix), c))


def abbreviate_authors(authors: Column) -> Column:
    """`A`, `A & B` or `A et al.` from an array of structs with a name; null without authors."""
    names = F.transform(authors, lambda a: a["name"])
    first = F.element_at(names, 1)
    return F.when(F.size(names) == 1, first).when(F.size(names) == 2, F.concat_ws(" & ", first, F.element_at(names, 2))).when(F.size(names) > 2, F.concat(first, F.lit(" et al.")))


#: Stands before an escaped character while a text is split; a noncharacter, which no text may hold.
ESCAPED = "\ufdd0"


def split_escaped(c: Column, separator: str = ".", escape: str = "\\") -> Column:
    """Split at separators that aren't escaped, and take the escapes away: `a\\.b.c` is `a.b` and `c`. An escape stands before any one character; at the end it goes."""
    s, e = re.escape(separator), re.escape(escape)
    marked = F.regexp_replace(c, f"(?s){e}(.|$)", f"{ESCAPED}$1")  # from left to right, so an escaped escape marks nothing
    return F.transform(F.split(marked, f"(?<!{ESCAPED}){s}", -1), lambda p: F.regexp_replace(p, ESCAPED, ""))


def background_of(sm: Column) -> Column:
    """The first two `-` tokens of a sub message; fewer than two raise, null stays null."""
    bad = F.raise_error(F.concat(F.lit("sub message without two tokens: "), sm))
    return F.when(F.size(F.split(sm, "-")) < 2, bad.cast("string")).otherwise(F.substring_index(sm, "-", 2))
