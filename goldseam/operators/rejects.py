"""Rejected rows with their reasons: malformed records, values that a cast loses, and broken rules.

``judge`` types a raw frame and says of every row, in one pass, which rules it breaks and which of its values did not fit their type. A
row that breaks a rule is rejected; a lost value alone is not a reason, since cleaning turns it into NULL, but it is counted.
Judged rows are stored once, a folder for accepted ones and one for the quarantine beside it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldseam.functions.text import is_blank
from goldseam.operators.shaping import FLOATING, conform, finite

MALFORMED = "malformed_record"
#: The columns that ``judge`` adds.
REASONS, LOST, REJECTED = "reject_reasons", "lost_values", "rejected"


@dataclass(frozen=True)
class Checks:
    """Types to cast to, and {reason: condition of a row that may stay}. A condition that is NULL is broken."""

    types: Mapping[str, str]
    keep: Mapping[str, Column] = field(default_factory=dict)


def present(column: str) -> Column:
    return F.col(column).isNotNull()


def within(column: str, low: float | None = None, high: float | None = None) -> Column:
    """A number inside its bounds; NULL, NaN and infinity are not."""
    value = F.col(column)
    number = finite(value.cast("double"))
    inside = number.isNotNull()
    for fits in ([] if low is None else [value >= low]) + ([] if high is None else [value <= high]):
        inside = inside & fits
    return inside


def is_lost(column: str, to_type: str) -> Column:
    """The raw value holds something, and its cast to the type does not."""
    value = F.col(column).try_cast(to_type)
    kept = finite(value) if to_type.lower() in FLOATING else value
    return F.col(column).isNotNull() & ~F.coalesce(is_blank(F.col(column).cast("string")), F.lit(False)) & kept.isNull()


def _names(conditions: Mapping[str, Column]) -> Column:
    """The names whose conditions hold, as an array."""
    chosen = [F.when(F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in conditions.items()]
    return F.array_compact(F.array(*chosen)) if chosen else F.array().cast("array<string>")


def judge(df: DataFrame, checks: Checks, corrupt: str | None = None) -> DataFrame:
    """Typed rows with ``reject_reasons``, ``lost_values`` and ``rejected``.

    ``corrupt`` names the column in which a reader keeps the text of malformed records. Such records are rejected for
    that alone, as their values may stand in wrong columns.
    """
    malformed = F.lit(False) if corrupt is None else F.col(corrupt).isNotNull()
    lost = _names({column: is_lost(column, to_type) & ~malformed for column, to_type in checks.types.items()})
    typed = conform(df.withColumn(LOST, lost), checks.types)
    broken = {reason: ~F.coalesce(fits, F.lit(False)) & ~malformed for reason, fits in checks.keep.items()}
    judged = typed.withColumn(REASONS, _names({MALFORMED: malformed, **broken} if corrupt else broken))
    return judged.withColumn(REJECTED, F.size(REASONS) > 0)


def accepted(judged: DataFrame) -> DataFrame:
    return judged.where(~F.col(REJECTED)).drop(REASONS, LOST, REJECTED)


def quarantine(judged: DataFrame) -> DataFrame:
    return judged.where(REJECTED).drop(REJECTED)


def tallies(reasons: Sequence[str], columns: Sequence[str]) -> dict[str, Column]:
    """Conditions to count while judged rows are written: per reason, and per column with lost values."""
    counted = {REJECTED: F.col(REJECTED)}
    counted |= {f"{REJECTED}:{reason}": F.array_contains(REASONS, reason) for reason in reasons}
    return counted | {f"lost:{column}": F.array_contains(LOST, column) for column in columns}


def rejection_report(judged: DataFrame, reasons: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(rule, n_rows) in one pass: rows read, accepted and rejected, then rows per reason and per column with lost values.

    A row may break several rules; it counts once in ``rejected``.
    """
    counts = {"read": F.lit(True), "accepted": ~F.col(REJECTED), **tallies(reasons, columns)}
    entries = [F.struct(F.lit(name).alias("rule"), F.count(F.when(holds, 1)).alias("n_rows")) for name, holds in counts.items()]
    return judged.agg(F.array(*entries).alias("rows")).select(F.inline("rows"))
