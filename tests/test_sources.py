"""Contracts, versions, run tables and reports."""

import json

from pyspark.sql import functions as F

from tidemark.operators import drift as D
from tidemark.plans import report as R
from tidemark.sources import contract as C, runs, sinks as K
from tidemark.sources.tables import new_path, shared_folder

REQUEST = {f: 1 if t == "bigint" else "x" for f, t in C.REQUEST_FIELDS.items() if f not in C.REQUEST_DEFAULTS}


def test_scoring_request_contract(spark):
    lines = [
        REQUEST, REQUEST | {"Batch_ID": 3, "Over18": "N"}, {k: v for k, v in REQUEST.items() if k != "Age"}, REQUEST | {"Age": "old"},
    ]
    df = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(lines)] + [(9, "{oops"), (10, None)], "id int, body string")
    good, bad = C.scoring_request().split(df, "body")
    rows = {r["id"]: r for r in good.collect()}
    assert set(rows) == {0, 1}
    assert (rows[0]["EmployeeCount"], rows[0]["EmployeeNumber"], rows[0]["Over18"], rows[0]["StandardHours"], rows[0]["Batch_ID"]) == (1, 0, "Y", 80, None)
    assert (rows[1]["Over18"], rows[1]["Batch_ID"]) == ("N", 3)
    problems = {r["id"]: r["problems"] for r in bad.collect()}
    assert problems == {2: ["missing Age"], 3: ["not decodable"], 9: ["not decodable"], 10: ["not decodable"]}
    assert len(C.scoring_request().required) == 25


def test_versions(spark):
    path = new_path(spark, "v")
    df = spark.range(3)
    assert K.next_version(spark, path) == 1
    assert [K.write_version(df, path) for _ in range(3)] == [1, 2, 3]
    assert {r["version"]: r["count"] for r in spark.read.parquet(path).groupBy("version").count().collect()} == {1: 3, 2: 3, 3: 3}
    df.write.parquet(f"{path}/version=12")
    assert K.next_version(spark, path) == 13


def test_history_and_comparison(spark):
    rows = [("r1", "v1", 0.7, 0.5), ("r2", "v2", 0.8, 0.4)]
    df = spark.createDataFrame(rows, "run_id string, dataset_version string, roc_auc double, f1_score double").withColumns({
        "timestamp": F.when(F.col("run_id") == "r1", F.lit("2026-01-01")).otherwise(F.lit("2026-02-01")).cast("timestamp"),
        "precision": F.lit(0.5), "recall": F.lit(None).cast("double"),
    })
    assert runs.latest_run(df).first()["run_id"] == "r2"
    got = {r["metric"]: (r["latest"], round(r["delta"], 6)) for r in runs.compare_with_latest(df, F.col("run_id") == "r1").collect()}
    assert got == {"roc_auc": (0.8, 0.1), "f1_score": (0.4, -0.1), "precision": (0.5, 0.0), "recall": (0.0, 0.0)}


def test_report_files(spark, tiny):
    lines = spark.read.parquet(f"{tiny}/lineitem.parquet").select("l_quantity", "l_tax", "l_returnflag")
    path = new_path(spark, "report")
    saved, summary = R.monitor(lines, lines, path, drop=["l_tax", "absent"])
    assert {r["feature"] for r in saved.collect()} == {"l_quantity", "l_returnflag"}
    assert summary.first()["overall_status"] == "STABLE"
    table = D.covariate_shift(lines, lines)
    document = json.loads(K.report_document(table, R.drift_summary(table, lines, lines)).first()[0])
    assert document["total_features_monitored"] == 3 and len(document["covariate_shift"]) == 3


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()).rstrip("/")


def test_missing_columns(spark):
    assert C.missing_columns(spark.range(1), ["id", "Age"]) == ["Age"]
