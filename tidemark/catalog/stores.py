"""Source and sink queries: each writes with Spark, reads back and returns what was stored."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F, types as T

from tidemark.catalog.bindings import rounded, scored_lines, table, typed
from tidemark.catalog.drift import SCORED_SQL, metrics_sql
from tidemark.functions.concurrent import run_all
from tidemark.operators import metrics as M
from tidemark.sources import commits as L
from tidemark.sources import contract as C
from tidemark.sources import inference as I
from tidemark.sources import runs as R
from tidemark.sources import sinks as K
from tidemark.sources.tables import new_path, read_csv


def csv_scan(spark, d):
    path = new_path(spark, "customer-csv")
    table(spark, d, "customer").write.csv(path, header=True)
    schema = "c_custkey bigint, c_name string, c_nationkey bigint, c_acctbal double, c_mktsegment string"
    return rounded(read_csv(spark, path, schema), 4)


def _order_lines(spark, d):
    """Orders as delimited lines: some totals are no numbers, some lines have a cell too few or too many."""
    path, key = new_path(spark, "order-lines"), F.col("o_orderkey")
    total = F.when(key % 101 == 0, "on request").when(key % 53 == 0, "NA").otherwise(F.col("o_totalprice").cast("string"))
    day, urgent = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("string")
    cells = [key.cast("string"), F.col("o_custkey").cast("string"), total, day, urgent]
    whole = F.concat_ws(",", *cells, F.col("o_orderstatus"))
    line = F.when(key % 97 == 0, F.concat_ws(",", *cells)).when(key % 89 == 0, F.concat(whole, F.lit(",?"))).otherwise(whole)
    table(spark, d, "orders").select(line.alias("value")).write.text(path)
    return I.read_inferred(spark, path, ["orderkey", "custkey", "total", "day", "urgent", "status"], tolerance=0.05)


def csv_inferred(spark, d):
    """Orders read back with inferred types; the cells that are missing are null."""
    return rounded(_order_lines(spark, d).rows.withColumn("day", F.date_format("day", "yyyy-MM-dd")), 4)


def csv_rejected(spark, d):
    """The lines that do not fit, with their reasons."""
    found = _order_lines(spark, d).rejected
    key = F.coalesce(F.col("cells.orderkey"), F.substring_index("line", ",", 1)).try_cast("bigint")
    return found.select(key.alias("orderkey"), F.concat_ws("; ", "reasons").alias("reasons"))


def csv_types(spark, d):
    """The type found for every column of the customer table written with its header."""
    path = new_path(spark, "customer-csv")
    table(spark, d, "customer").write.csv(path, header=True)
    kinds = I.infer(I.read_cells(spark, path))
    return spark.createDataFrame([(c, I.TYPES[kind].simpleString()) for c, kind in kinds.items()], "column_name string, kind string")


def _runs(spark, d):
    """One run per ship year, as a run table would hold them."""
    found = M.classification_metrics(scored_lines(spark, d), ["period"], "label", "score", "prediction")
    return found.select(
        F.concat(F.lit("run-"), F.col("period").cast("string")).alias("run_id"),
        F.concat(F.lit("lines-"), F.col("period").cast("string")).alias("dataset_version"),
        F.make_timestamp(F.col("period").cast("int"), F.lit(12), F.lit(31), F.lit(0), F.lit(0), F.lit(0)).cast("timestamp_ntz").alias("timestamp"),
        *M.METRICS,
    )


RUN_COLUMNS = "run_id string, dataset_version string, timestamp timestamp_ntz, roc_auc double, f1_score double, precision double, recall double"


def run_history(spark, d):
    """Run documents, one JSON object per file, read as a history table."""
    path = new_path(spark, "run-documents")
    row = lambda: F.struct(
        F.col("precision").alias("precision"), F.col("recall").alias("recall"), F.col("f1_score").alias("f1-score"), F.lit(1.0).alias("support")
    )
    document = F.to_json(
        F.struct("dataset_version", F.col("timestamp").cast("string").alias("timestamp"), F.struct(row().alias("1")).alias("classification_report"), "roc_auc"),
        {"pretty": "true"},
    )
    # A run history is short: one small file per training run.
    _runs(spark, d).select(document.alias("value")).coalesce(1).write.option("maxRecordsPerFile", 1).text(path)
    return rounded(R.read_history(spark, path).drop("file"))


def run_records(spark, d):
    """Append runs in two writes; the latest is the newest by timestamp."""
    path = new_path(spark, "runs")
    runs = _runs(spark, d)
    R.append_run(runs.filter("dataset_version >= 'lines-1998'"), path)
    R.append_run(runs.filter("dataset_version < 'lines-1998'"), path)
    return rounded(R.latest_run(R.read_runs(spark, path, RUN_COLUMNS)).drop("timestamp"))


def run_comparison(spark, d):
    path = new_path(spark, "runs")
    R.append_run(_runs(spark, d), path)
    runs = R.read_runs(spark, path, RUN_COLUMNS)
    return rounded(R.compare_with_latest(runs, F.col("run_id") == "run-1997"))


def _records(spark, d):
    """Events as JSON text: some cut off, some without a user, some without a value."""
    e = table(spark, d, "events")
    user = F.when(F.col("event_id") % 10 != 1, F.col("user_id"))
    value = F.when(F.col("event_id") % 10 != 2, F.col("value"))
    text = F.to_json(F.struct("event_id", user.alias("user_id"), "event_type", value.alias("value")))
    return e.select(F.when(F.col("event_id") % 10 == 0, F.substring(text, 1, 20)).otherwise(text).alias("record"))


EVENT_CONTRACT = C.RecordContract(
    {"event_id": T.LongType(), "user_id": T.LongType(), "event_type": T.StringType(), "value": T.DoubleType()}, {"value": 0.0}
)


def contract_accepted(spark, d):
    return rounded(EVENT_CONTRACT.split(_records(spark, d), "record")[0], 4)


def contract_quarantined(spark, d):
    bad = EVENT_CONTRACT.split(_records(spark, d), "record")[1]
    reason = F.concat_ws(",", "problems")
    return bad.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


def contract_props(spark, d):
    """The props text of every event under a one-field contract."""
    props = C.RecordContract({"k": T.LongType()})
    return props.split(table(spark, d, "events").select("event_id", "props"), "props")[0]


def prediction_table(spark, d):
    path = new_path(spark, "predictions")
    e = table(spark, d, "events").select(
        "event_id", (F.col("value") >= 20).cast("int").alias("prediction"), (F.col("value") / (F.col("value") + 20)).alias("probability"),
    )
    K.write_predictions(e.filter("prediction = 1"), "event_id", path)
    K.write_predictions(e, "event_id", path)
    return rounded(read_csv(spark, path, "event_id bigint, prediction bigint, probability double"))


def dataset_versions(spark, d):
    path = new_path(spark, "versions")
    customers = table(spark, d, "customer")
    K.write_version(customers, path)
    K.write_version(customers.filter("c_mktsegment = 'BUILDING'"), path)
    K.write_version(customers.filter("c_mktsegment <> 'BUILDING'"), path)
    stored = spark.read.parquet(path)
    return typed(stored.groupBy("version").agg(F.count("*").alias("n_rows")))


def committed_versions(spark, d):
    """Three writers at once, one that never commits, and all versions read back through the log."""
    path = new_path(spark, "commits")
    orders = table(spark, d, "orders")
    years = [(F.year("o_orderdate") < 1997, "early"), (F.year("o_orderdate").between(1997, 1998), "middle"), (F.year("o_orderdate") > 1998, "late")]
    orders.write.parquet(f"{path}/data/claim=abandoned")
    run_all([partial(L.CommitLog(spark, path).write, orders.filter(chosen), note) for chosen, note in years])
    log = L.CommitLog(spark, path)
    counts = log.read_all().groupBy("version").agg(F.count("*").alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return counts.join(log.manifests(), "version").select("note", "n_rows", "total", F.col("version").between(1, 3).alias("numbered"))


QUERIES = {
    "committed_versions": committed_versions,
    "csv_scan": csv_scan,
    "csv_inferred": csv_inferred,
    "csv_rejected": csv_rejected,
    "csv_types": csv_types,
    "run_history": run_history,
    "run_records": run_records,
    "run_comparison": run_comparison,
    "contract_accepted": contract_accepted,
    "contract_quarantined": contract_quarantined,
    "contract_props": contract_props,
    "prediction_table": prediction_table,
    "dataset_versions": dataset_versions,
}

_METRICS = f"WITH {SCORED_SQL}, {metrics_sql('scored', 'period')}"
_FOUR = 'round(auc, 6) AS roc_auc, round(f1, 6) AS f1_score, round(prec, 6) AS "precision", round(rec, 6) AS recall'

SQL = {
    "committed_versions": """SELECT CASE WHEN year(o_orderdate) < 1997 THEN 'early' WHEN year(o_orderdate) <= 1998 THEN 'middle' ELSE 'late' END AS note,
        count(*) AS n_rows, round(sum(o_totalprice), 2) AS total, true AS numbered FROM orders GROUP BY 1""",
    "csv_scan": "SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, round(c_acctbal, 4) AS c_acctbal, c_mktsegment FROM customer",
    "csv_inferred": """SELECT o_orderkey AS orderkey, o_custkey AS custkey, CASE WHEN o_orderkey % 53 <> 0 THEN round(o_totalprice, 4) END AS total, strftime(o_orderdate, '%Y-%m-%d') AS day,
        o_orderpriority IN ('1-URGENT', '2-HIGH') AS urgent, o_orderstatus AS status FROM orders WHERE o_orderkey % 97 <> 0 AND o_orderkey % 89 <> 0 AND o_orderkey % 101 <> 0""",
    "csv_rejected": """SELECT o_orderkey AS orderkey, CASE WHEN o_orderkey % 97 = 0 OR o_orderkey % 89 = 0 THEN 'wrong number of cells' ELSE 'total is no double: on request' END AS reasons
        FROM orders WHERE o_orderkey % 97 = 0 OR o_orderkey % 89 = 0 OR o_orderkey % 101 = 0""",
    "csv_types": "SELECT column_name, CASE WHEN column_type IN ('BIGINT', 'INTEGER') THEN 'bigint' WHEN column_type = 'VARCHAR' THEN 'string' ELSE lower(column_type) END AS kind FROM (DESCRIBE customer)",
    "run_history": f"{_METRICS} SELECT 'lines-' || period AS dataset_version, period || '-12-31 00:00:00' AS timestamp, {_FOUR} FROM metrics_",
    "run_records": f"{_METRICS} SELECT 'run-' || period AS run_id, 'lines-' || period AS dataset_version, {_FOUR} FROM metrics_ ORDER BY period DESC LIMIT 1",
    "run_comparison": f"""{_METRICS}, l AS (SELECT * FROM metrics_ ORDER BY period DESC LIMIT 1), o AS (SELECT * FROM metrics_ WHERE period = 1997)
        SELECT 'run-1997' AS run_id, 'roc_auc' AS metric, round(l.auc, 6) AS latest, round(l.auc - o.auc, 6) AS delta FROM l, o UNION ALL
        SELECT 'run-1997', 'f1_score', round(l.f1, 6), round(l.f1 - o.f1, 6) FROM l, o UNION ALL SELECT 'run-1997', 'precision', round(l.prec, 6), round(l.prec - o.prec, 6) FROM l, o
        UNION ALL SELECT 'run-1997', 'recall', round(l.rec, 6), round(l.rec - o.rec, 6) FROM l, o""",
    "contract_accepted": "SELECT event_id, user_id, event_type, CASE WHEN event_id % 10 = 2 THEN 0 ELSE round(value, 4) END AS value FROM events WHERE event_id % 10 NOT IN (0, 1)",
    "contract_quarantined": "SELECT CASE WHEN event_id % 10 = 0 THEN 'not decodable' ELSE 'missing user_id' END AS reason, count(*) AS n FROM events WHERE event_id % 10 IN (0, 1) GROUP BY 1",
    "contract_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "prediction_table": "SELECT event_id, CASE WHEN value >= 20 THEN 1::BIGINT ELSE 0 END AS prediction, round(value / (value + 20), 6) AS probability FROM events",
    "dataset_versions": """SELECT 1::BIGINT AS version, count(*) AS n_rows FROM customer UNION ALL SELECT 2, count(*) FROM customer WHERE c_mktsegment = 'BUILDING'
        UNION ALL SELECT 3, count(*) FROM customer WHERE c_mktsegment <> 'BUILDING'""",
}
