from datetime import date, datetime

import numpy as np
import pytest

from goldseam.operators.insights import dashboards, executive_kpis
from goldseam.operators.scoring import enrich_predictions
from goldseam.plans import claims
from goldseam.sources.sinks import can_bucket, write_layer

LABELS = ["crack", "dent", "glass"]


@pytest.fixture
def folder(spark, tmp_path):
    for sub in ("customers", "policies", "claims", "claim_images_metadata", "training_imgs", "claim_images"):
        (tmp_path / sub).mkdir()
    (tmp_path / "customers/customers.csv").write_text(
        "customer_id,name,date_of_birth,borough,neighborhood,zip_code\n"
        '1,"Doe, Jane",02/03/1980,Queens,Astoria,11102\n2,"Roe, Rick ",25-12-1990,,,\n'
        '3,Solo,1990-01-01,a,b,1\n4,"Poe, Ann",bad,a,b,1\n5,"Moe, ",1990-01-01,a,b,1\n'
    )
    (tmp_path / "policies/policies.csv").write_text(
        "POLICY_NO,CUST_ID,CHASSIS_NO,PREMIUM,POL_EFF_DATE,POL_EXPIRY_DATE,MAKE,MODEL,MODEL_YEAR\n"
        "p1,1,ch1,100,2024-01-01,2024-12-31,BMW,X,2020\np2,9,ch2,50,2024-01-01,2024-01-31,Kia,Y,2021\n"
        "p3,1,ch3,-1,2024-01-01,2024-12-31,BMW,X,2020\np4,1,ch4,10,2024-12-31,2024-01-01,BMW,X,2020\n"
        "p5,1,ch5,10,soon,2024-01-01,BMW,X,2020\n,1,ch6,10,2024-01-01,2024-12-31,BMW,X,2020\n"
    )
    (tmp_path / "claims/claims.csv").write_text(
        "claim_no,policy_no,claim_date,license_issue_date,total,age,type,collision_type,severity,hour,"
        "number_of_vehicles_involved,injury,number_of_witnesses,date,date_1\n"
        "c1,p1,2024-05-01,2010-01-01,200,30,rear,front,Minor Damage,5,1,0,0,x,y\n"
        "c2,p2,2024-06-01,2010-01-01,400.5,30,side,front,Total Loss,13,2,0,1,x,y\n"
        "c3,p9,,,10,30,side,front,,22,2,0,1,x,y\n"
        "c4,p1,2024-05-01,2010-01-01,-5,30,rear,front,Minor Damage,5,1,0,0,x,y\n"
        "c5,p1,2024-05-01,2010-01-01,5,0,rear,front,Minor Damage,5,1,0,0,x,y\n"
        ",p1,2024-05-01,2010-01-01,5,9,rear,front,Minor Damage,5,1,0,0,x,y\n"
    )
    (tmp_path / "claim_images_metadata/image_metadata.csv").write_text(
        "image_name,image_id,claim_no,chassis_no\n1.png,1,c1,ch1\n1.png,1,c1,ch1\n2.png,2,c2,ch2\n3.png,3,c2,ch2\n4.png,4,,ch2\n"
    )
    (tmp_path / "training_imgs/dent_1.png").write_bytes(b"xx")
    (tmp_path / "training_imgs/_2.png").write_bytes(b"xx")
    for name, size in (("1.png", 9), ("2.png", 1), ("3.png", 5), ("9.png", 1)):
        (tmp_path / "claim_images" / name).write_bytes(b"x" * size)
    spark.createDataFrame(
        [
            ("ch1", "2024-01-01 10:00:00", 40.0, -3.0, 50.0),
            ("ch1", "2024-01-02 10:00:00", 42.0, -5.0, 71.0),
            ("ch1", "2024-01-03 10:00:00", 95.0, -5.0, 71.0),
            ("ch1", "2024-01-03 10:00:00", 42.0, None, 71.0),
            ("ch1", "2024-01-03 10:00:00", 42.0, -5.0, -1.0),
            (None, "2024-01-03 10:00:00", 42.0, -5.0, 1.0),
        ],
        "chassis_no STRING, event_timestamp STRING, latitude DOUBLE, longitude DOUBLE, speed DOUBLE",
    ).write.parquet(str(tmp_path / "telematics"))
    return str(tmp_path)


@pytest.fixture
def silver(spark, folder):
    return claims.silver(claims.landing(spark, folder))


def test_silver(silver, values):
    customers = silver["customers_clean"].select("customer_id", "date_of_birth", "first_name", "last_name", "address")
    assert values(customers) == [
        (1, date(1980, 2, 3), "Jane", "Doe", "Queens, Astoria, 11102"),
        (2, date(1990, 12, 25), "Rick", "Roe", ", , "),
    ]
    assert values(silver["policies_clean"].select("POLICY_NO")) == [("p1",), ("p2",)]
    assert values(silver["claims_clean"].select("claim_no")) == [("c1",), ("c2",), ("c3",)]
    assert not {"date", "date_1", "date_2"} & set(silver["claims_clean"].columns)
    assert silver["telematics_clean"].count() == 2
    assert [(r["image_name"], r["label"]) for r in silver["training_images"].collect()] == [("dent_1.png", "dent")]
    assert silver["claim_images"].count() == 4 and "content" in silver["claim_images"].columns
    assert values(silver["claim_images_metadata_clean"].select("image_name")) == [("1.png",), ("2.png",), ("3.png",)]


def test_silver_quality_has_no_failures_but_undated_claims(silver):
    for name, df in silver.items():
        failures = {r["rule"]: r["failures"] for r in claims.silver_quality(name, df).collect() if r["failures"]}
        assert failures == ({"no_claim_date": 1, "no_license_issue_date": 1} if name == "claims_clean" else {})


def test_gold_joins(silver, values):
    telematics = claims.telematics_by_vehicle(silver["telematics_clean"])
    assert telematics.first() == (
        "ch1", 60.5, 71.0, 50.0, 41.0, -4.0, 2, datetime(2024, 1, 1, 10), datetime(2024, 1, 2, 10),
    )
    frames = silver["claims_clean"], silver["policies_clean"], silver["customers_clean"]
    gold = claims.customer_claim_policy(*frames)
    assert values(gold.select("claim_no", "claim_total", "premium", "first_name")) == [
        ("c1", 200.0, 100.0, "Jane"), ("c2", 400.5, 50.0, None),
    ]
    after = claims.with_telematics(gold, telematics)
    before = claims.customer_claim_policy(*frames, telematics, hot_vehicles=["ch1"])
    assert values(after.select(sorted(after.columns))) == values(before.select(sorted(before.columns)))
    checks = dict(claims.referential_checks(after, silver["claims_clean"]).collect())
    assert checks == {"no_policy": 0, "no_customer": 0, "no_telematics": 1, "gold_rows": 2, "source_rows": 3}


def size_scorer():
    """A maker of scorers to which longer content looks more like a dent."""
    return lambda: lambda batch: np.array([[2.0, float(len(x)), 0.0] for x in np.ravel(batch)])


def test_predictions_to_decisions(spark, silver, values):
    predictions = claims.predict_damage(silver["claim_images"], size_scorer(), LABELS)
    declared = spark.createDataFrame([], claims.PREDICTION_SCHEMA)
    assert sorted(predictions.dtypes) == sorted(declared.dtypes)
    enriched = enrich_predictions(predictions, silver["claim_images_metadata_clean"], "image_name")
    curated = claims.curate_predictions(enriched, "damage@1")
    assert write_layer(curated, "layers.claim_predictions_final") == 4
    curated = spark.table("layers.claim_predictions_final")
    stats = claims.prediction_statistics(curated).first()
    assert (stats["total_registros"], stats["claims_cubiertos"], stats["imagenes_procesadas"]) == (4, 2, 4)

    best = claims.best_prediction(curated)
    assert values(best.select("claim_no", "damage_label", "confidence_level", "imagenes_confiables", "total_imagenes")) == [
        ("c1", "dent", "alta", 1, 1), ("c2", "dent", "alta", 2, 2),
    ]
    dominant = {r["claim_no"]: r for r in claims.dominant_damage(curated).collect()}
    assert dominant["c2"]["niveles_confianza"] == "alta,media" or dominant["c2"]["niveles_confianza"] == "alta"
    assert dominant[None]["num_imagenes"] == 1

    base = claims.claim_base(silver["claims_clean"], silver["policies_clean"], silver["customers_clean"], best)
    assert len(base.columns) == 29
    judged = claims.judged_claims(base)
    found = {r["claim_no"]: (r["reglas_fallidas"], r["decision_final"], r["motivos_revision"]) for r in judged.collect()}
    assert found == {
        "c1": (0, "LIBERADO", ""),
        "c2": (3, "INVESTIGAR", "Póliza no vigente | Monto excesivo | Severidad incoherente"),
        "c3": (0, "LIBERADO", ""),
    }
    assert executive_kpis(judged).first()["amount_at_risk"] == 400.5


def test_best_prediction_does_not_multiply_claims(frame):
    enriched = frame(
        [("i1", "c1", "ch1", "dent", 0.5, "media", True), ("i2", "c1", "ch2", "crack", 0.8, "alta", True)],
        "image_name STRING, claim_no STRING, chassis_no STRING, damage_label STRING, damage_score DOUBLE, "
        "confidence_level STRING, is_reliable BOOLEAN",
    )
    assert claims.best_prediction(enriched).collect() == [("c1", "crack", 0.8, "alta", 2, 2)]
    assert claims.best_prediction(enriched, ["claim_no", "chassis_no"]).count() == 2


def test_curation_needs_its_columns(frame):
    with pytest.raises(ValueError, match="claim_no, chassis_no"):
        claims.curate_predictions(
            frame([("i", "dent", 0.5, "media", True, None)],
                  "image_name STRING, damage_label STRING, damage_score DOUBLE, confidence_level STRING, "
                  "is_reliable BOOLEAN, predicted_at TIMESTAMP"),
            "v",
        )


def test_all_layers(spark, folder):
    spark.sql("CREATE DATABASE IF NOT EXISTS claims")
    written = claims.run(spark, folder, "claims", size_scorer(), LABELS, "damage@1")
    assert {t.removeprefix("claims."): w["rows"] for t, w in written.items() if "gold" in t} == {
        "gold_aggregated_telematics": 1, "gold_customer_claim_policy": 2, "gold_customer_claim_policy_telematics": 2,
        "gold_claim_images_predictions": 4, "gold_claim_damage_predictions": 4, "gold_claim_predictions_final": 4,
        "gold_best_predictions": 2, "gold_claim_insights_final": 3,
    }
    assert written["claims.silver_claims_clean"]["no_claim_date"] == 1
    assert written["claims.silver_policies_clean"]["ends_before_start"] == 0
    views = dashboards(spark.table("claims.gold_claim_insights_final"), claims.REASONS)
    assert len(views) == 20
    found = {name: [tuple(r) for r in df.collect()] for name, df in views.items()}
    assert found["claims_by_severity"] == [
        (0, "Minor Damage", 1), (1, "Major Damage", 0), (2, "Total Loss", 1), (3, "Trivial Damage", 0),
    ]
    assert found["amount_centre"] == [(203.5, 200.0)]
    assert sum(r[-1] for r in found["amount_histogram"]) == 3
    assert sorted(found["decisions"]) == [("INVESTIGAR", 1, 33.33), ("LIBERADO", 2, 66.67)]


def sides(spark, n=400):
    facts = spark.range(n).selectExpr(
        "id AS claim_no", "id % 37 AS policy_no", "DATE '2020-01-01' AS claim_date", "id * 1.0D AS total", "CAST(id % 5 AS INT) AS age"
    )
    policies = spark.range(30).selectExpr(
        "id AS POLICY_NO", "id % 7 AS CUST_ID", "id AS CHASSIS_NO", "1.0D AS PREMIUM", "DATE '2020-01-01' AS POL_EFF_DATE",
        "DATE '2021-01-01' AS POL_EXPIRY_DATE",
    )
    people = spark.range(7).selectExpr("id AS customer_id", "'a' AS first_name", "'b' AS last_name", "DATE '1980-01-01' AS date_of_birth", "'c' AS address")
    return facts, policies, people


def test_bucketed_claims_are_not_shuffled_for_their_policies(spark, values, plan, tmp_path):
    facts, policies, people = sides(spark)
    write_layer(facts, "claims_in_buckets", verify=True, bucket_by=("policy_no", 4), path=str(tmp_path / "c"))
    write_layer(policies, "policies_in_buckets", verify=True, bucket_by=("POLICY_NO", 4), path=str(tmp_path / "p"))
    assert len(list((tmp_path / "c").glob("part-*"))) <= 4
    stored = spark.table("claims_in_buckets"), spark.table("policies_in_buckets")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = claims.customer_claim_policy(facts, policies, people)
        found = claims.customer_claim_policy(*stored, people)
        text = plan(found, run=True)
        assert values(found) == values(plain) and found.count() > 0
        shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
        assert not [line for line in shuffles if "policy_no#" in line], text
        both = stored[0].join(stored[1], stored[0]["policy_no"] == stored[1]["POLICY_NO"])
        assert "Exchange" not in plan(both, run=True)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_hot_policy_is_not_put_in_one_bucket(spark):
    facts, policies, _ = sides(spark)
    assert can_bucket([(facts, "policy_no"), (policies, "POLICY_NO")], 4, min_rows=50)
    hot = facts.selectExpr("claim_no", "IF(claim_no % 3 = 0, 1L, policy_no) AS policy_no")
    assert not can_bucket([(hot, "policy_no")], 4, min_rows=50)
    assert can_bucket([(hot.limit(0), "policy_no")], 4, min_rows=0)


def test_layers_with_buckets_are_the_same(spark, folder, values):
    for database, buckets in (("claims_plain", None), ("claims_buckets", 4)):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        claims.run(spark, folder, database, size_scorer(), LABELS, "damage@1", buckets=buckets)
    for name in ("silver_claims_clean", "quarantine_policies_clean", "gold_customer_claim_policy"):
        assert values(spark.table(f"claims_buckets.{name}")) == values(spark.table(f"claims_plain.{name}"))
    judged = [values(spark.table(f"{d}.gold_claim_insights_final").drop("damage_score")) for d in ("claims_plain", "claims_buckets")]
    assert judged[0] == judged[1]
    layout = spark.sql("DESCRIBE EXTENDED claims_buckets.judged_claims_clean").where("col_name = 'Bucket Columns'").collect()
    assert "policy_no" in layout[0].data_type
