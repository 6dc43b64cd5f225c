"""Model queries and their SQL.

Fits are bound to real features and one more that decides the label. All features
are tried at each node, so any sound fit finds that one and its scores follow in
SQL, whatever the numbers and categories beside it hold.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.bindings import order_panel, rounded, table, typed
from tidemark.catalog.drift import shift_sql
from tidemark.catalog.panels import draw, order_of
from tidemark.operators import model as M
from tidemark.operators.metrics import classification_metrics
from tidemark.plans import comparison as X
from tidemark.plans import report as R
from tidemark.plans import training as T
from tidemark.sources import runs
from tidemark.sources.tables import new_path

NUMERIC = ["balance", "n_orders", "total_price", "largest"]
CATEGORICAL = ["nation"]


def customer_rows(spark, d):
    """Customers with their order history; those without orders keep NULLs.

    Orders are reduced to one row per customer before the join.
    """
    spent = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n_orders"), F.sum("o_totalprice").alias("total_price"), F.max("o_totalprice").alias("largest")
    )
    customers = table(spark, d, "customer").select(
        "c_custkey", F.col("c_acctbal").alias("balance"), F.when(F.col("c_nationkey") != 0, F.col("c_nationkey")).cast("string").alias("nation"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Yes").otherwise("No").alias("label"),
    )
    return customers.join(spent, "c_custkey", "left")


def document_rows(spark, d):
    """Labelled documents with their size, language and source."""
    docs = table(spark, d, "documents").select("doc_id", "n_chars", "lang", "source")
    return docs.join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id")


def numeric_fill(spark, d):
    return rounded(M.numeric_fill(customer_rows(spark, d), NUMERIC), 4)


def category_fill(spark, d):
    return M.category_fill(customer_rows(spark, d), CATEGORICAL)


def class_weights(spark, d):
    return rounded(typed(M.class_weights(customer_rows(spark, d), "label")))


def stratified_split(spark, d):
    rows = customer_rows(spark, d).select("c_custkey", "label")
    train, test = M.stratified_split(rows, "label", "c_custkey")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def split_column(spark, d):
    rows = customer_rows(spark, d).select("c_custkey", "label")
    return M.with_split(rows, "label", "c_custkey")


def stratified_folds(spark, d):
    rows = customer_rows(spark, d).select("c_custkey", "label")
    return typed(M.with_folds(rows, "label", "c_custkey"))


def english_rows(spark, d):
    """Labelled documents with the label english and the feature that decides it."""
    return document_rows(spark, d).select(*DOCUMENT_COLUMNS, *english())


DOCUMENT_COLUMNS = ["doc_id", "n_chars", "source"]


def english():
    is_english = F.col("lang") == "en"
    return [F.when(is_english, "yes").otherwise("no").alias("english"), F.when(is_english, "en").otherwise("other").alias("tongue")]


def forest_scores(spark, d):
    """Fit on labelled documents and score all documents."""
    model = M.fit_forest(english_rows(spark, d), "english", ["n_chars"], ["source", "tongue"], trees=20, depth=6, tried="all")
    return typed(M.score(model, table(spark, d, "documents").select(*DOCUMENT_COLUMNS, *english()), ["doc_id"]))


def grid_search(spark, d):
    found = M.grid_search(english_rows(spark, d), "english", "doc_id", ["n_chars"], ["source", "tongue"], {"numTrees": [5], "maxDepth": [3, 6], "featureSubsetStrategy": ["all"]})
    rows = [(p["maxDepth"], float(area)) for p, area in found.candidates]
    return spark.createDataFrame(rows, "max_depth bigint, mean_roc_auc double")


def training_run(spark, d):
    """Clean, normalize, split, search, evaluate, save the model, append the run and read it back."""
    path = new_path(spark, "runs")
    T.train_and_record(
        english_rows(spark, d), "english", "doc_id", ["n_chars"], ["source", "tongue"], dataset="documents",
        runs_path=path, model_path=new_path(spark, "model"), grid={"numTrees": [5], "maxDepth": [5], "featureSubsetStrategy": ["all"]}, folds=3,
    )
    run = runs.latest_run(runs.read_runs(spark, path))
    cell = lambda i, j, n: F.col("confusion_matrix")[i][j].cast("bigint").alias(n)
    return run.select(
        "dataset_version", "roc_auc", "accuracy", F.col("class_1.f1_score").alias("f1_score"),
        cell(0, 0, "tn"), cell(0, 1, "fp"), cell(1, 0, "fn"), cell(1, 1, "tp"), F.col("best_params")["maxDepth"].alias("max_depth"),
    )


def banded_customers(spark, d):
    return customer_rows(spark, d).withColumn("band", F.when(F.col("label") == "Yes", "b").otherwise("o"))


def random_split_evaluation(spark, d):
    scored, _ = T.random_split_evaluation(banded_customers(spark, d), "label", "c_custkey", NUMERIC, [*CATEGORICAL, "band"], 10, 5, "all")
    return classification_metrics(scored, [], "label", "probability", "prediction")


def batch_scoring(spark, d):
    """Score every customer, with one required feature absent and filled in."""
    rows = banded_customers(spark, d).withColumn("extra", F.lit(1))
    model = M.fit_forest(rows, "label", [*NUMERIC, "extra"], [*CATEGORICAL, "band"], trees=10, depth=5, tried="all")
    return typed(M.score_aligned(model, rows.drop("extra"), "c_custkey", [*NUMERIC, "extra"], [*CATEGORICAL, "band"]))


def batch_inference(spark, d):
    """The scoring job on all customers."""
    rows = banded_customers(spark, d)
    model = M.fit_forest(rows, "label", NUMERIC, [*CATEGORICAL, "band"], trees=10, depth=5, tried="all")
    return typed(T.batch_inference(model, rows, "c_custkey", NUMERIC, [*CATEGORICAL, "band"], new_path(spark, "predictions")))


def full_report(spark, d):
    """The saved report of orders before and after the split, with a model's part."""
    panel = order_panel(spark, d).withColumn("band", F.when(F.col("urgent") == "Yes", "high").otherwise("low"))
    panel = panel.select("period", "o_totalprice", "o_orderstatus", "band", "urgent")
    ref, cur = panel.filter("period < 1998"), panel.filter("period >= 1998")
    model = M.fit_forest(ref, "urgent", ["o_totalprice"], ["o_orderstatus", "band"], trees=10, depth=6, tried="all")
    found = R.full_report(ref, cur, new_path(spark, "report"), target="urgent", model=model, drop=["period"])
    feature = F.explode("covariate_shift").alias("f")
    return typed(found.select(
        "reference_size", "current_size", "total_features_monitored", "covariate_alerts", "concept_drift_detected", "overall_status",
        F.col("concept_drift.max_decay").alias("max_decay"), F.col("timestamp").isNotNull().alias("stamped"), feature,
    ).select("*", "f.feature", "f.type", "f.psi", "f.ks_statistic", "f.max_proportion_change", "f.severity").drop("f"))


def model_concept_drift(spark, d):
    panel = order_panel(spark, d).withColumn("band", F.when(F.col("urgent") == "Yes", "high").otherwise("low"))
    ref, cur = panel.filter("period < 1998"), panel.filter("period >= 1998")
    model = M.fit_forest(ref, "urgent", ["o_totalprice"], ["o_orderstatus", "band"], trees=10, depth=6, tried="all")
    return R.concept_drift_of_model(model, ref, cur, "urgent")


def missing_label_split(spark, d):
    """The split and the folds where a third of the labels are missing: NULL is a class of its own."""
    rows = customer_rows(spark, d).select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("label")).alias("label"))
    return typed(M.with_folds(M.with_split(rows, "label", "c_custkey"), "label", "c_custkey"))


def random_sample(spark, d):
    return M.random_rows(table(spark, d, "customer").select("c_custkey"), 20, "c_custkey", seed=1)


def perturbed_sample(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return M.perturbed_rows(rows, 30, "c_custkey", ["c_acctbal", "absent"], seed=1)


def panel_comparison(spark, d):
    """The order panel without and with its customers as entities, over all its periods."""
    rows = order_panel(spark, d).withColumn("band", F.when(F.col("urgent") == "Yes", "high").otherwise("low")).drop("o_orderpriority")
    shape = dict(period="period", label="urgent", key="o_orderkey", numeric=["o_totalprice"], categorical=["o_orderstatus", "band"], measure="o_totalprice")
    a = X.Panel("original", rows.filter("period < 2000"), entity=None, most_splits=6, **shape)
    b = X.Panel("continuous", rows, entity="o_custkey", most_splits=6, **shape)
    facts, card = X.compare_panels(a, b, table(spark, d, "orders"), trees=5, depth=4, tried="all")
    shown = facts.select("panel", "random_auc", "temporal_auc", "covariate_alerts", "label_cv", "measure_deviation", "continuity", "leakage_gap", "leakage")
    return rounded(typed(shown.join(F.broadcast(card))))


QUERIES = {
    "numeric_fill": numeric_fill,
    "category_fill": category_fill,
    "class_weights": class_weights,
    "stratified_split": stratified_split,
    "split_column": split_column,
    "stratified_folds": stratified_folds,
    "missing_label_split": missing_label_split,
    "forest_scores": forest_scores,
    "grid_search": grid_search,
    "training_run": training_run,
    "random_split_evaluation": random_split_evaluation,
    "batch_scoring": batch_scoring,
    "batch_inference": batch_inference,
    "full_report": full_report,
    "model_concept_drift": model_concept_drift,
    "random_sample": random_sample,
    "perturbed_sample": perturbed_sample,
    "panel_comparison": panel_comparison,
}

_CUSTOMERS = """WITH c AS (SELECT c_custkey, c_acctbal AS balance, CASE WHEN c_nationkey <> 0 THEN c_nationkey::VARCHAR END AS nation,
   CASE WHEN c_mktsegment = 'BUILDING' THEN 'Yes' ELSE 'No' END AS label, o.* EXCLUDE (k) FROM customer LEFT JOIN
   (SELECT o_custkey AS k, count(*) AS n_orders, sum(o_totalprice) AS total_price, max(o_totalprice) AS largest FROM orders GROUP BY 1) o ON o.k = c_custkey)"""


def _fill(column: str) -> str:
    return f"""SELECT '{column}' AS feature, (SELECT median({column}) FROM c) AS median, avg(coalesce({column}, (SELECT median({column}) FROM c))) AS mean,
      stddev_pop(coalesce({column}, (SELECT median({column}) FROM c))) AS std_pop, count(*) FILTER ({column} IS NULL) AS n_missing FROM c"""


_RANKED = f"""r AS (SELECT c_custkey, label, row_number() OVER (PARTITION BY label ORDER BY {order_of("c_custkey", "42")}, c_custkey) AS k, count(*) OVER (PARTITION BY label) AS n FROM c)"""

def _edge_alerts(chosen: str) -> str:
    """How many features of the panel's last year differ from its first."""
    rows = f"""
 edge AS (SELECT min(period) AS lo, max(period) AS hi FROM rows_all WHERE {chosen}),
 rows_ AS (SELECT CASE WHEN period = lo THEN 'r' ELSE 'c' END AS side, o_totalprice, o_orderstatus, CASE WHEN urgent THEN 'high' ELSE 'low' END AS band FROM rows_all, edge WHERE {chosen} AND period IN (lo, hi))"""
    return f"{shift_sql(rows, ['o_totalprice'], ['o_orderstatus', 'band'])} SELECT count(*) FILTER (alert) FROM shift_"


_SPLIT_ORDERS = """
 rows_ AS (SELECT CASE WHEN year(o_orderdate) < 1998 THEN 'r' ELSE 'c' END AS side, o_totalprice, o_orderstatus,
   CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'high' ELSE 'low' END AS band FROM orders)"""
_HELD = "(SELECT y, CAST(floor(count(*) * 0.2::DOUBLE) AS BIGINT) AS n FROM l GROUP BY y)"
_CELLS = f"""CAST(coalesce((SELECT n FROM {_HELD} WHERE NOT y), 0) AS BIGINT) AS tn, 0::BIGINT AS fp, 0::BIGINT AS fn, CAST(coalesce((SELECT n FROM {_HELD} WHERE y), 0) AS BIGINT) AS tp"""
_ENGLISH = "WITH l AS (SELECT doc_id, lang = 'en' AS y FROM documents JOIN labels USING (doc_id))"

SQL = {
    "forest_scores": "SELECT doc_id, CASE WHEN lang = 'en' THEN 1::BIGINT ELSE 0 END AS prediction, CASE WHEN lang = 'en' THEN 1.0::DOUBLE ELSE 0 END AS probability FROM documents",
    "grid_search": "SELECT unnest([3::BIGINT, 6]) AS max_depth, CASE WHEN count(DISTINCT lang = 'en') = 2 THEN 1.0::DOUBLE END AS mean_roc_auc FROM documents JOIN labels USING (doc_id)",
    "training_run": f"{_ENGLISH} SELECT 'documents' AS dataset_version, 1.0::DOUBLE AS roc_auc, 1.0::DOUBLE AS accuracy, 1.0::DOUBLE AS f1_score, {_CELLS}, '5' AS max_depth",
    "random_split_evaluation": f"""WITH l AS (SELECT c_mktsegment = 'BUILDING' AS y FROM customer), c AS (SELECT {_CELLS})
        SELECT tn + tp AS n_samples, 1.0::DOUBLE AS roc_auc, 1.0::DOUBLE AS f1_score, 1.0::DOUBLE AS "precision", 1.0::DOUBLE AS recall, tn, fp, fn, tp FROM c""",
    "batch_scoring": "SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 1::BIGINT ELSE 0 END AS prediction, CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0::DOUBLE ELSE 0 END AS probability FROM customer",
    "batch_inference": "SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 1::BIGINT ELSE 0 END AS prediction, CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0::DOUBLE ELSE 0 END AS probability FROM customer",
    "full_report": f"""{shift_sql(_SPLIT_ORDERS, ["o_totalprice"], ["o_orderstatus", "band"])}, one AS (SELECT count(*) AS total_features_monitored, count(*) FILTER (alert) AS covariate_alerts FROM shift_)
        SELECT (SELECT count(*) FROM rows_ WHERE side = 'r') AS reference_size, (SELECT count(*) FROM rows_ WHERE side = 'c') AS current_size, one.*, FALSE AS concept_drift_detected,
        CASE WHEN covariate_alerts > 5 THEN 'CRITICAL' WHEN covariate_alerts > 0 THEN 'WARNING' ELSE 'STABLE' END AS overall_status, 0.0::DOUBLE AS max_decay, TRUE AS stamped,
        feature, type, psi, ks_statistic, max_proportion_change, severity FROM shift_, one""",
    "model_concept_drift": "SELECT " + ", ".join(f"1.0::DOUBLE AS {m}_{s}" for s in ("reference", "current") for m in ("roc_auc", "f1_score", "precision", "recall"))
        + ", " + ", ".join(f"0.0::DOUBLE AS decay_{m}" for m in ("roc_auc", "f1_score", "precision", "recall")) + ", 0.0::DOUBLE AS max_decay, 'LOW' AS severity, FALSE AS alert",
    "missing_label_split": f"""WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN CASE WHEN c_mktsegment = 'BUILDING' THEN 'Yes' ELSE 'No' END END AS label FROM customer), {_RANKED}
        SELECT c_custkey, label, k <= floor(n * 0.2::DOUBLE) AS is_test, CASE WHEN k <= floor(n / 3) THEN 0::BIGINT WHEN k <= floor(n * 2 / 3) THEN 1 ELSE 2 END AS fold FROM r""",
    "panel_comparison": f"""WITH rows_all AS (SELECT year(o_orderdate) AS period, o_totalprice, o_orderstatus, o_custkey, o_orderpriority IN ('1-URGENT', '2-HIGH') AS urgent FROM orders),
        panels AS (SELECT 'original' AS panel, * FROM rows_all WHERE period < 2000 UNION ALL SELECT 'continuous', * FROM rows_all),
        rates AS (SELECT panel, period, avg(urgent::INT) AS rate FROM panels GROUP BY 1, 2), cv AS (SELECT panel, stddev_samp(rate) / avg(rate) AS label_cv FROM rates GROUP BY 1),
        dev AS (SELECT panel, abs(avg(o_totalprice) - (SELECT avg(o_totalprice) FROM orders)) / (SELECT avg(o_totalprice) FROM orders) AS measure_deviation FROM panels GROUP BY 1),
        t AS (SELECT panel, count(DISTINCT o_custkey) AS u, count(*) AS n, count(DISTINCT period) AS p FROM panels GROUP BY 1),
        ends AS (SELECT panel, min(period) AS lo, max(period) AS hi FROM panels GROUP BY 1),
        alerts AS (SELECT 'original' AS panel, ({_edge_alerts("period < 2000")}) AS covariate_alerts UNION ALL SELECT 'continuous', ({_edge_alerts("true")})),
        c AS (SELECT (SELECT label_cv FROM cv WHERE panel = 'continuous') < (SELECT label_cv FROM cv WHERE panel = 'original') AS steadier),
        k AS (SELECT CASE WHEN steadier THEN 4 ELSE 5 END::BIGINT AS score_first, CASE WHEN steadier THEN 3 ELSE 2 END::BIGINT AS score_second FROM c)
        SELECT panel, 1.0::DOUBLE AS random_auc, 1.0::DOUBLE AS temporal_auc, covariate_alerts, round(label_cv, 6) AS label_cv, round(measure_deviation, 6) AS measure_deviation,
        CASE WHEN panel = 'continuous' THEN round(greatest(0, least(1, 1 - (u - n / p) / nullif(n - n / p, 0))), 6) END AS continuity, 0.0::DOUBLE AS leakage_gap, FALSE AS leakage,
        score_first, score_second, CASE WHEN score_second > score_first THEN 'continuous' ELSE 'original' END AS winner FROM cv JOIN dev USING (panel) JOIN t USING (panel) JOIN alerts USING (panel), k""",
    "numeric_fill": f"""{_CUSTOMERS}, f AS ({" UNION ALL ".join(_fill(c) for c in NUMERIC)})
        SELECT feature, round(median, 4) AS median, round(mean, 4) AS mean, round(std_pop, 4) AS std_pop, n_missing FROM f""",
    "category_fill": f"""{_CUSTOMERS} SELECT 'nation' AS feature, nation AS mode, count(*) AS n FROM c WHERE nation IS NOT NULL GROUP BY nation ORDER BY n DESC, mode LIMIT 1""",
    "class_weights": f"""{_CUSTOMERS} SELECT CASE label WHEN 'Yes' THEN 1::BIGINT ELSE 0 END AS label, count(*) AS n, round((SELECT count(*) FROM c) / (2 * count(*)), 6) AS weight FROM c GROUP BY c.label""",
    "stratified_split": f"""{_CUSTOMERS}, {_RANKED} SELECT c_custkey, label, CASE WHEN k <= floor(n * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS part FROM r""",
    "split_column": f"""{_CUSTOMERS}, {_RANKED} SELECT c_custkey, label, k <= floor(n * 0.2::DOUBLE) AS is_test FROM r""",
    "stratified_folds": f"""{_CUSTOMERS}, {_RANKED} SELECT c_custkey, label, CASE WHEN k <= floor(n / 3) THEN 0::BIGINT WHEN k <= floor(n * 2 / 3) THEN 1 ELSE 2 END AS fold FROM r""",
    "random_sample": f"SELECT c_custkey FROM customer ORDER BY {order_of('c_custkey', '1')}, c_custkey LIMIT 20",
    "perturbed_sample": f"""WITH s AS (SELECT c_custkey, c_acctbal FROM customer ORDER BY {order_of("c_custkey", "1")}, c_custkey LIMIT 30)
        SELECT c_custkey, CAST(trunc(c_acctbal + sqrt(-2 * ln(greatest({draw("c_custkey", "1c_acctbala")}, 1e-12))) * cos(2 * pi() * {draw("c_custkey", "1c_acctbalb")}) * 0.05::DOUBLE
        * (SELECT stddev_samp(c_acctbal) FROM s)) AS BIGINT) AS c_acctbal FROM s""",
}
