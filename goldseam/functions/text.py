"""Text pieces: names, addresses, paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from goldseam.functions.fixed_point import as_column


def is_blank(value: Column | str) -> Column:
    """True for NULL, empty and all-space text."""
    text = as_column(value)
    return text.isNull() | (F.trim(text) == "")


def name_part(value: Column | str, position: int, sep: str = ", ") -> Column:
    """Part ``position`` (from 0) of a separated text; NULL when there are fewer parts.

    ``sep`` is plain text, not a pattern.
    """
    return F.get(F.split(F.trim(as_column(value)), f"\\Q{sep}\\E"), F.lit(position))


def joined_address(*parts: Column | str, sep: str = ", ") -> Column:
    """All parts joined, a missing part counting as empty text."""
    return F.concat_ws(sep, *(F.coalesce(as_column(p).cast("string"), F.lit("")) for p in parts))


def path_leaf(value: Column | str, sep: str = "/") -> Column:
    """The text after the last separator: a file name."""
    return F.substring_index(as_column(value), sep, -1)


def leading_token(value: Column | str, sep: str = "_") -> Column:
    """The text before the first separator: a label kept in a file name."""
    return F.substring_index(as_column(value), sep, 1)


def file_extension(value: Column | str) -> Column:
    """The lower-case word after the last dot, or empty text."""
    return F.lower(F.regexp_extract(as_column(value), r"\.(\w+)$", 1))
