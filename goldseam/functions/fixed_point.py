"""Exact sums, means and percentages.

A sum of doubles depends on the order in which tasks deliver their parts, so a mean that
lies on a rounding tie can change from run to run. Sums here count whole units of the last decimal: ``decimals``
of them, ten unless a caller says otherwise. A number's decimals are those of its first 15 digits; what lies beyond ``decimals`` is
rounded half up, row by row, and ``finer_than`` counts such rows. The result is rounded once, and any order of rows gives the same.

Rows add up as four BIGINTs (``limbs``), which meet in one DECIMAL per group: that costs about half of a DECIMAL sum. Each limb has room
for 9 * 10^12 rows of one group.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


DECIMALS = 10
WIDE = "decimal(38,0)"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def plain_zero(value: Column) -> Column:
    """-0.0 as 0.0. They are equal, so a minimum may come out as either."""
    return value + F.lit(0.0)


#: Digits of a double that are sure to be those it was written with.
SURE = 15
BASES = ("whole_high", "whole_low", "part_high", "part_low")


def exact(value: Column | str, decimals: int = DECIMALS) -> Column:
    """A number with all of its decimals up to ``decimals``, in 128 bits.

    NaN and infinity have no such value and stop the job; cleaning turns them into NULL and counts them.
    """
    number = as_column(value)
    return F.when(_odd(number), _refused()).otherwise(number.cast(f"decimal(38,{decimals})"))


def _odd(number: Column) -> Column:
    # NaN is larger than any number here.
    return F.abs(number.cast("double")) >= F.lit(float("inf"))


def _refused() -> Column:
    return F.raise_error(F.lit("NaN and infinity, and numbers from 10^18 on, have no fixed-point value"))


def _div(a: Column, b: Column | int) -> Column:
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def limbs(value: Column | str, decimals: int = DECIMALS) -> dict[str, Column]:
    """A number below 10^18 as four BIGINTs, to be summed one by one and read by ``from_limbs``.

    The whole part and the part after the point, each cut in two so that sums of them cannot
    overflow; a part may be a whole one, which the sum carries. This is for doubles, by their first 15 digits: Spark's own sums of
    DECIMALs and whole numbers are exact.
    """
    if not 0 <= decimals <= SURE:
        raise ValueError(f"decimals must be 0 to {SURE}: {decimals}")
    number = as_column(value).cast("double")
    given = F.when(F.abs(number) >= 1e18, _refused().cast("double")).otherwise(number)
    # The whole part and what is left are exact. The rest is read to as many decimals as a number of this size is sure of.
    whole = given.cast("bigint")
    digits = F.ceil(F.log10(F.abs(given) + 1.0))
    step = F.pow(F.lit(10.0), F.greatest(F.lit(0), F.least(F.lit(decimals), SURE - digits)))
    rest = F.floor((given - whole) * step + 0.5) * (10.0**decimals / step).cast("bigint")
    half = 10 ** (decimals // 2)
    return {"whole_high": _div(whole, 10**6), "whole_low": whole % 10**6, "part_high": _div(rest, half), "part_low": rest % half}


def from_limbs(sums: dict[str, Column], decimals: int = DECIMALS) -> Column:
    """The number whose limbs add up to ``sums``, as DECIMAL(38, decimals)."""
    high, low, fine, finest = (sums[name].cast(WIDE) for name in BASES)
    part = (fine * F.lit(10 ** (decimals // 2)).cast("decimal(8,0)") + finest).cast(WIDE)
    carried = _div(part, F.lit(10**decimals).cast("decimal(16,0)"))
    rest = (part - carried * F.lit(10**decimals).cast("decimal(16,0)")).cast(f"decimal({decimals + 1},0)")
    whole = (high * F.lit(10**6).cast("decimal(7,0)") + low + carried).cast(f"decimal({37 - decimals},0)")
    # Types are chosen so that no step has to give up decimals.
    point = F.lit(f"1e-{decimals}").cast(f"decimal({decimals + 1},{decimals})")
    return (whole.cast(f"decimal(37,{decimals})") + (rest * point).cast(f"decimal({2 * decimals + 2},{decimals})")).cast(f"decimal(38,{decimals})")


def exact_total(value: Column | str, decimals: int = DECIMALS) -> Column:
    """Aggregate: the exact sum, not yet rounded, as DECIMAL(38, decimals)."""
    return from_limbs({name: F.sum(limb) for name, limb in limbs(value, decimals).items()}, decimals)


def finer_than(value: Column | str, digits: int = DECIMALS) -> Column:
    """Quality rule: the number has more decimals than ``digits``, which an exact sum would not see."""
    number = as_column(value).cast("double")
    return number != F.round(number, digits)


def units_of(total: Column) -> Column:
    """An exact sum as a whole number of its last decimal."""
    return (total * F.lit(10**DECIMALS).cast(WIDE)).cast(WIDE)


def rounded(total: Column, digits: int = 2) -> Column:
    """An exact sum as a double, rounded once, at the end."""
    return F.round(total, digits).cast("double")


def exact_sum(value: Column | str, digits: int = 2) -> Column:
    """Aggregate: the exact sum, rounded half up to ``digits``."""
    return rounded(exact_total(value), digits)


def exact_mean(value: Column | str, digits: int = 2) -> Column:
    """Aggregate: the mean, rounded half up to ``digits``."""
    return mean_of(exact_total(value), F.count(as_column(value)), digits)


def mean_of(total: Column, count: Column, digits: int = 2) -> Column:
    """An exact sum over a count, rounded half up, ties away from zero; NULL for count 0."""
    units = units_of(total)
    parts = F.nullif(count, F.lit(0)).cast(WIDE) * F.lit(10 ** (DECIMALS - digits)).cast(WIDE)
    whole = F.call_function("div", F.abs(units) * 2 + parts, parts * 2)
    return F.when(units < 0, -whole).otherwise(whole).cast("double") / F.lit(float(10**digits))


def from_units(units: Column, carried: int) -> Column:
    return units.cast("double") / F.lit(float(10**carried))


def share(part: Column, total: Column, digits: int = 4, kind: str = "bigint") -> Column:
    """part / total of two counts, rounded half up; NULL when total is 0.

    For sums of units, which may be near the limit of BIGINT, pass ``kind=WIDE``.
    """
    doubled = part.cast(kind) * F.lit(2 * 10**digits)
    whole = total.cast(kind)
    return from_units(F.when(whole > 0, F.call_function("div", doubled + whole, whole * 2)), digits)


def percent(part: Column, total: Column, digits: int = 2, kind: str = "bigint") -> Column:
    """100 * part / total of two counts, rounded half up; NULL when total is 0."""
    return share(part.cast(kind) * 100, total, digits, kind)
