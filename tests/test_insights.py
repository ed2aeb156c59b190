from datetime import date

import pytest

from goldseam.operators import insights
from goldseam.plans.claims import REASONS


@pytest.fixture
def judged(frame):
    rows = [
        # make, type, severity, hour, date, total, label, score, level, r5, failed, decision
        ("BMW", "rear", "Minor Damage", 5, date(2024, 1, 3), 100.10, "dent", 0.9, "alta", True, 0, "LIBERADO"),
        ("BMW", "rear", "Total Loss", 6, date(2024, 1, 9), 300.0, "dent", 0.6, "media", False, 1, "REVISION_MENOR"),
        ("Kia", "side", "Total Loss", 23, date(2024, 2, 1), 50.0, "crack", 0.2, "baja", True, 2, "INVESTIGAR"),
        (None, None, None, None, None, None, None, None, None, None, 0, "LIBERADO"),
    ]
    df = frame(
        rows,
        "auto_make STRING, incident_type STRING, incident_severity STRING, incident_hour INT, claim_date DATE, "
        "claim_total DOUBLE, damage_label STRING, damage_score DOUBLE, confidence_level STRING, "
        "r5_coherencia_severidad BOOLEAN, reglas_fallidas INT, decision_final STRING",
    )
    others = {rule: "CAST(true AS BOOLEAN)" for rule in REASONS if rule != "r5_coherencia_severidad"}
    return df.selectExpr("*", *(f"{sql} AS {rule}" for rule, sql in others.items()))


def test_business_view(judged, values):
    assert values(insights.loss_by(judged, "incident_type")) == [("rear", 400.1), ("side", 50.0)]
    assert values(insights.claims_per_hour(judged)) == [(5, 1, "Madrugada"), (6, 1, "Mañana"), (23, 1, "Noche")]
    assert values(insights.top_makes(judged)) == [("BMW", 400.1, 88.89), ("Kia", 50.0, 11.11)]
    assert values(insights.claims_per_month(judged)) == [("2024-01", 2), ("2024-02", 1)]
    assert values(insights.claims_per_month(judged, keep_undated=True))[0] == (None, 1)


def test_prediction_view(judged, values):
    assert values(insights.counts_with_label(judged, "damage_label", insights.NO_PREDICTION)) == [
        ("Sin predicción", 1, 25.0), ("crack", 1, 25.0), ("dent", 2, 50.0),
    ]
    assert values(insights.coherence(judged)) == [("Coherente", 3, 75.0), ("Incoherente", 1, 25.0)]
    assert values(insights.score_by_label(judged)) == [("crack", 1, 0.2, 0.0), ("dent", 2, 0.75, 0.212132)]
    assert values(insights.score_against_amount(judged, amount_width=100.0)) == [
        ("crack", 4, 0, 1), ("dent", 12, 3, 1), ("dent", 18, 1, 1),
    ]
    assert values(insights.coverage(judged)) == [
        ("not_reliable", 2, 50.0), ("reliable", 2, 50.0), ("with_prediction", 3, 75.0), ("without_prediction", 1, 25.0),
    ]


def test_decision_view(judged, values):
    assert values(insights.label_by_decision(judged)) == [("crack", 0, 0, 1), ("dent", 1, 1, 0)]
    failures = dict(insights.rule_failures(judged, REASONS).collect())
    assert failures == {reason: int(rule.startswith("r5")) for rule, reason in REASONS.items()}
    assert values(insights.failures_by_severity(judged)) == [("Minor Damage", 0.0), ("Total Loss", 1.5)]
    kpis = insights.executive_kpis(judged).first().asDict()
    assert kpis == {
        "total_claims": 4, "released": 2, "released_pct": 50.0, "minor_review": 1, "minor_review_pct": 25.0,
        "to_investigate": 1, "to_investigate_pct": 25.0, "predicted": 3, "predicted_pct": 75.0,
        "mean_score": 0.5667, "total_amount": 450.1, "amount_at_risk": 50.0,
    }


def test_kpis_of_no_claims(judged):
    kpis = insights.executive_kpis(judged.limit(0)).first().asDict()
    assert kpis["total_claims"] == 0 and kpis["released_pct"] is None and kpis["total_amount"] is None
