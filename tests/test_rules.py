import pytest

from goldseam.operators.rules import Rule, apply_rules

RULES = [
    Rule("r1", "a > 0", "a is low", ("a",)),
    Rule("r2", "b IN ('x', 'y')", "b is odd", ("b",)),
    Rule("r3", "true", "never"),
    Rule("r4", "c", "c says no"),
    Rule("r5", "d < 1", "d is missing", ("d",), when_missing=False),
]
DECISIONS = ("RELEASE", "REVIEW", "INVESTIGATE")


@pytest.mark.parametrize(
    "row, failed, decision, reasons",
    [
        ((1, "x", True, 0), 0, "RELEASE", ""),
        ((0, "x", True, 0), 1, "REVIEW", "a is low"),
        ((1, "z", True, 0), 1, "REVIEW", "b is odd"),
        ((0, "z", True, 0), 2, "INVESTIGATE", "a is low | b is odd"),
        ((0, "z", False, 5), 4, "INVESTIGATE", "a is low | b is odd | c says no | d is missing"),
        ((None, None, None, 0), 0, "RELEASE", ""),  # missing passes, and NULL is no failure
        ((None, None, None, None), 1, "REVIEW", "d is missing"),
    ],
)
def test_rules(frame, row, failed, decision, reasons):
    out = apply_rules(frame([row], "a INT, b STRING, c BOOLEAN, d INT"), RULES, DECISIONS).first()
    assert (out["failed_rules"], out["decision"], out["reasons"]) == (failed, decision, reasons)


def test_failed_rules_equal_reasons(frame):
    rows = [(a, b, c, d) for a in (0, 1, None) for b in ("x", "z", None) for c in (True, False, None) for d in (0, 2, None)]
    out = apply_rules(frame(rows, "a INT, b STRING, c BOOLEAN, d INT"), RULES, DECISIONS)
    for r in out.collect():
        assert r["failed_rules"] == len([x for x in r["reasons"].split(" | ") if x])
        assert r["failed_rules"] == sum(r[f"r{i}"] is False for i in range(1, 6))
