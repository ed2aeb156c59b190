"""Judged rows: reasons, lost values, malformed records, and agreement with the cleaning filters."""

import pytest
from pyspark.sql import functions as F

from goldseam.operators.rejects import Checks, accepted, judge, present, quarantine, rejection_report, within
from goldseam.plans import claims
from goldseam.sources.readers import CORRUPT, read_csv_kept


def test_reasons_and_lost_values(spark):
    rows = [("1", "5"), ("x", "7"), (None, "-1"), ("2", "NaN"), ("3", ""), ("4", None), ("5", "1e999")]
    checks = Checks({"k": "int", "v": "double"}, {"no_k": present("k"), "v": within("v", 0, 10)})
    judged = judge(spark.createDataFrame(rows, "k string, v string"), checks)
    got = [(r.reject_reasons, r.lost_values, r.rejected) for r in judged.collect()]
    assert got == [
        ([], [], False), (["no_k"], ["k"], True), (["no_k", "v"], [], True), (["v"], ["v"], True), (["v"], [], True), (["v"], [], True), (["v"], ["v"], True),
    ]
    assert accepted(judged).collect() == [(1, 5.0)] and quarantine(judged).count() == 6
    report = {r.rule: r.n_rows for r in rejection_report(judged, ["no_k", "v"], ["k", "v"]).collect()}
    assert report == {"read": 7, "accepted": 1, "rejected": 6, "rejected:no_k": 2, "rejected:v": 5, "lost:k": 1, "lost:v": 2}
    assert [r.n_rows for r in rejection_report(judged.limit(0), ["v"], []).collect()] == [0, 0, 0, 0]


def test_malformed_records_are_kept(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\n1,2\n3\n4,5,6\n"7,8\n')
    read = read_csv_kept(spark, str(tmp_path))
    judged = judge(read, Checks({"k": "int"}, {"no_v": present("v")}), CORRUPT)
    got = {r[CORRUPT] or r.k: r.reject_reasons for r in judged.collect()}
    assert got[1] == [] and got["3"] == got["4,5,6"] == ["malformed_record"] and len(got) == 4


POLICIES = [
    ("p", "c", "1.5", "2020-01-01", "2020-01-01"), (None, "c", "1", "2020-01-01", "2020-01-02"), ("p", None, "1", "2020-01-01", "2020-01-02"),
    ("p", "c", "-1", "2020-01-01", "2020-01-02"), ("p", "c", "NaN", "2020-01-01", "2020-01-02"), ("p", "c", "x", "2020-01-01", "2020-01-02"),
    ("p", "c", "1", "2020-01-03", "2020-01-02"), ("p", "c", "1", None, "2020-01-02"), ("p", "c", "1", "2020-01-01", "soon"),
]
CLAIMS = [(1, 1, "2020-01-01", "x", 5.0, 3), (None, 1, "a", "b", 5.0, 3), (1, None, "a", "b", 5.0, 3), (1, 1, "a", "b", -1.0, 3), (1, 1, "a", "b", float("nan"), 3), (1, 1, "a", None, 1.0, None), (1, 1, "a", "b", None, 0)]
PLACES = [("c", "2020-01-01", 1.0, 1.0, 1.0), (None, "2020-01-01", 1.0, 1.0, 1.0), ("c", "x", 90.0, -180.0, 0.0), ("c", None, 91.0, 1.0, 1.0), ("c", None, 1.0, 181.0, 1.0), ("c", None, 1.0, 1.0, -1.0), ("c", None, None, 1.0, float("inf"))]


@pytest.mark.parametrize(
    "name, rows, ddl, clean",
    [
        ("policies_clean", POLICIES, "POLICY_NO string, CUST_ID string, PREMIUM string, POL_EFF_DATE string, POL_EXPIRY_DATE string", claims.silver_policies),
        ("claims_clean", CLAIMS, "claim_no int, policy_no int, claim_date string, license_issue_date string, total double, age int", claims.silver_claims),
        ("telematics_clean", PLACES, "chassis_no string, event_timestamp string, latitude double, longitude double, speed double", claims.silver_telematics),
    ],
)
def test_accepted_rows_are_those_of_the_cleaning(spark, name, rows, ddl, clean):
    raw = spark.createDataFrame(rows, ddl)
    judged = claims.judged_rows(name, raw)
    assert sorted(map(str, accepted(judged).collect())) == sorted(map(str, clean(raw).collect()))
    assert judged.where(F.col("rejected") != (F.size("reject_reasons") > 0)).isEmpty() and judged.count() == len(rows)
