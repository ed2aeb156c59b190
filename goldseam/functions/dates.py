"""Dates from untrusted text, and month buckets."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from goldseam.functions.fixed_point import as_column

# The text formats of a birth date, in the order they are tried.
BIRTH_DATE_FORMATS = ("MM/dd/yyyy", "dd/MM/yyyy", "yyyy-MM-dd", "dd-MM-yyyy", "yyyy/MM/dd")


_LARGEST = {"MM": "12", "dd": "31"}  # fields of exactly two digits


def _may_fit(text: Column, fmt: str) -> Column:
    """A cheap test that every text in this format passes.

    A failed parse costs an exception, which is far slower than looking at a few
    characters first.
    """
    test, at = F.lit(True), 1
    for field, sep in re.findall(r"([A-Za-z]+)([^A-Za-z']?)", fmt):
        if field not in _LARGEST:
            # A longer year may follow, so only the least position of the separator is known.
            return test & (F.instr(text, sep) >= at + len(field)) if sep and at == 1 else test
        test = test & (F.substring(text, at, 2) <= _LARGEST[field])
        if sep:
            test = test & (F.substring(text, at + 2, 1) == sep)
        at += 3
    return test


def parse_dates(value: Column | str, formats: Sequence[str] = BIRTH_DATE_FORMATS) -> Column:
    """The date in the first format that fits; NULL when none does."""
    text = as_column(value)
    tries = (F.when(_may_fit(text, fmt), F.try_to_timestamp(text, F.lit(fmt))) for fmt in formats)
    return F.coalesce(*tries).cast("date")


def month_label(value: Column | str) -> Column:
    """yyyy-MM text of a date or timestamp."""
    return F.date_format(as_column(value), "yyyy-MM")


def month_start(value: Column | str) -> Column:
    """The first day of the month, as a date."""
    return F.trunc(as_column(value).cast("date"), "month")
