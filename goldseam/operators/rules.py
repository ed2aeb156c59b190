"""Business rules: one boolean column per rule, then a decision with its reasons."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``predicate`` (SQL text or a column) is what a row must meet.

    A row that lacks one of ``requires`` gets ``when_missing`` instead.
    """

    name: str
    predicate: Column | str
    reason: str
    requires: tuple[str, ...] = ()
    when_missing: bool = True

    def verdict(self) -> Column:
        test = F.expr(self.predicate) if isinstance(self.predicate, str) else self.predicate
        if not self.requires:
            return test
        missing = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in self.requires))
        return F.when(missing, F.lit(self.when_missing)).otherwise(test)


def apply_rules(
    df: DataFrame,
    rules: Sequence[Rule],
    decisions: Sequence[str],
    failed_as: str = "failed_rules",
    decision_as: str = "decision",
    reasons_as: str = "reasons",
    sep: str = " | ",
) -> DataFrame:
    """Adds the rule columns, the number of failed rules, the decision and the joined reasons.

    ``decisions[n]`` is the decision for n failed rules; the last one is for that many or
    more. A rule that comes out NULL does not count as failed. Without failures the reasons
    are empty text.
    """
    judged = df.withColumns({rule.name: rule.verdict() for rule in rules})
    failed = [F.col(rule.name) == F.lit(False) for rule in rules]
    count = reduce(lambda a, b: a + b, (F.when(f, 1).otherwise(0) for f in failed))
    *exact, rest = decisions
    decision = F.lit(rest)
    for n, name in reversed(list(enumerate(exact))):
        decision = F.when(F.col(failed_as) == n, name).otherwise(decision)
    reasons = F.concat_ws(sep, *(F.when(f, F.lit(rule.reason)) for f, rule in zip(failed, rules)))
    return judged.withColumns({failed_as: count, reasons_as: reasons}).withColumn(decision_as, decision)
