"""Period, split-plan and performance-over-time queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.bindings import order_panel, rounded, scored_lines, table, typed
from tidemark.catalog.drift import SCORED_SQL, metrics_sql
from tidemark.operators import temporal as T
from tidemark.operators.metrics import classification_metrics
from tidemark.plans import validation as V

def period_index(spark, d):
    return typed(T.period_index(table(spark, d, "orders"), F.year("o_orderdate")))


def split_plan_expanding(spark, d):
    return typed(T.split_plan(table(spark, d, "orders"), F.year("o_orderdate"), 5, "expanding"))


def split_plan_rolling(spark, d):
    return typed(T.split_plan(table(spark, d, "orders"), F.year("o_orderdate"), 2, "rolling"))


def split_sizes(spark, d):
    return typed(T.split_sizes(table(spark, d, "orders"), F.year("o_orderdate"), 5, "expanding"))


def metric_summary(spark, d):
    scored = scored_lines(spark, d)
    found = classification_metrics(scored, ["period"], "label", "score", "prediction")
    return rounded(T.metric_summary(found))


def performance_by_period(spark, d):
    found = T.performance_by_period(scored_lines(spark, d), "period", "label", "score", "prediction")
    return rounded(typed(found), 5)


def performance_trend(spark, d):
    lines = scored_lines(spark, d)
    # A score that loses its signal year by year.
    faded = lines.withColumn("score", F.col("score") - (F.col("label") == "Yes").cast("int") * (F.col("period") - 1995) * 0.04)
    return rounded(T.performance_trend(T.performance_by_period(faded, "period", "label", "score", "prediction")), 5)


def day_windows(spark, d):
    return typed(T.day_window_plan(table(spark, d, "orders"), F.col("o_orderdate"), 5))


def banded_panel(spark, d):
    """Orders with a two-level feature that decides the label, so that any sound fit is right everywhere."""
    return order_panel(spark, d).withColumn("band", F.when(F.col("urgent") == "Yes", "high").otherwise("low"))


def _fit():
    return V.forest_fit("urgent", ["o_totalprice"], ["o_orderstatus", "band"], 5, 4, "all")


def walk_forward(spark, d):
    return typed(V.walk_forward(banded_panel(spark, d), "period", "urgent", _fit(), 6, "expanding"))


def walk_forward_rolling(spark, d):
    return typed(V.walk_forward(banded_panel(spark, d), "period", "urgent", _fit(), 6, "rolling"))


def compare_strategies(spark, d):
    return V.compare_strategies(banded_panel(spark, d), "period", "urgent", "o_orderkey", _fit(), 6)


def walk_forward_panel(spark, d):
    """Temporal evaluation of one panel: features exclude period and ids."""
    return T.metric_summary(V.walk_forward(banded_panel(spark, d).drop("o_custkey"), "period", "urgent", _fit(), 6))


def decay_after_training(spark, d):
    return typed(V.decay_after_training(banded_panel(spark, d), "period", "urgent", _fit(), 3))


QUERIES = {
    "period_index": period_index,
    "split_plan_expanding": split_plan_expanding,
    "split_plan_rolling": split_plan_rolling,
    "split_sizes": split_sizes,
    "metric_summary": metric_summary,
    "performance_by_period": performance_by_period,
    "performance_trend": performance_trend,
    "day_windows": day_windows,
    "walk_forward": walk_forward,
    "walk_forward_rolling": walk_forward_rolling,
    "compare_strategies": compare_strategies,
    "walk_forward_panel": walk_forward_panel,
    "decay_after_training": decay_after_training,
}

_PERFECT = ", ".join(f"1.0::DOUBLE AS {m}" for m in ("roc_auc", "f1_score", '"precision"', "recall"))
_PERFECT_SUMMARY = ", ".join(f"1.0::DOUBLE AS mean_{m}, 0.0::DOUBLE AS std_{m}" for m in ("roc_auc", "f1_score", "precision", "recall"))


def _walk_sql(strategy: str, first: str) -> str:
    """Every period but the first is tested; training reaches back to position `first`."""
    return f"""WITH n AS (SELECT year(o_orderdate) AS period, count(*) AS n, row_number() OVER (ORDER BY year(o_orderdate)) - 1 AS idx FROM orders GROUP BY 1)
        SELECT t.idx AS split, count(*) AS train_periods, string_agg(r.period::VARCHAR, ',' ORDER BY r.period) AS train_period_list, CAST(sum(r.n) AS BIGINT) AS train_size,
        t.period::VARCHAR AS test_period, t.n AS test_size, {_PERFECT}, '{strategy}' AS strategy FROM n t JOIN n r ON r.idx < t.idx AND r.idx >= {first} GROUP BY t.idx, t.period, t.n"""


_PERIODS = "p AS (SELECT period, row_number() OVER (ORDER BY period) - 1 AS idx FROM (SELECT DISTINCT year(o_orderdate) AS period FROM orders))"

SQL = {
    "walk_forward": _walk_sql("expanding", "0"),
    "walk_forward_rolling": _walk_sql("rolling", "t.idx - 1"),
    "compare_strategies": f"""SELECT count(DISTINCT year(o_orderdate)) - 1 AS n_splits, {_PERFECT_SUMMARY}, s AS strategy, 0.0::DOUBLE AS leakage_gap, FALSE AS leakage
        FROM orders, (SELECT unnest(['expanding', 'rolling', 'random']) AS s) GROUP BY s""",
    "walk_forward_panel": f"SELECT count(DISTINCT year(o_orderdate)) - 1 AS n_splits, {_PERFECT_SUMMARY} FROM orders",
    "decay_after_training": f"""SELECT year(o_orderdate) AS period, row_number() OVER (ORDER BY year(o_orderdate)) - 1 AS period_index, count(*) AS n_samples, {_PERFECT},
        0.0::DOUBLE AS auc_decay_pct FROM orders GROUP BY 1""",
    "period_index": f"WITH {_PERIODS} SELECT period, idx FROM p",
    "split_plan_expanding": f"""WITH {_PERIODS}, s AS (SELECT unnest(range(0, 5)) AS i)
        SELECT i + 1 AS split, CASE WHEN idx <= i THEN 'train' ELSE 'test' END AS role, period FROM s JOIN p ON idx <= i + 1""",
    "split_plan_rolling": f"""WITH {_PERIODS}, s AS (SELECT unnest(range(0, 2)) AS i), w AS (SELECT count(*) // 3 AS w FROM p)
        SELECT i + 1 AS split, CASE WHEN idx <= i THEN 'train' ELSE 'test' END AS role, period FROM s, p, w WHERE idx = i + 1 OR (idx <= i AND idx >= greatest(0, i + 1 - w))""",
    "split_sizes": f"""WITH {_PERIODS}, s AS (SELECT unnest(range(0, 5)) AS i), plan AS (SELECT i + 1 AS split, CASE WHEN idx <= i THEN 'train' ELSE 'test' END AS role, period FROM s JOIN p ON idx <= i + 1)
        SELECT split, role, count(DISTINCT plan.period) AS n_periods, count(*) AS n_rows, min(plan.period) AS first_period, max(plan.period) AS last_period
        FROM plan JOIN orders o ON year(o.o_orderdate) = plan.period GROUP BY split, role""",
    "metric_summary": f"""WITH {SCORED_SQL}, {metrics_sql("scored", "period")} SELECT count(*) AS n_splits, round(avg(auc), 6) AS mean_roc_auc, round(avg(f1), 6) AS mean_f1_score,
        round(avg(prec), 6) AS mean_precision, round(avg(rec), 6) AS mean_recall, round(stddev_pop(auc), 6) AS std_roc_auc, round(stddev_pop(f1), 6) AS std_f1_score,
        round(stddev_pop(prec), 6) AS std_precision, round(stddev_pop(rec), 6) AS std_recall FROM metrics_""",
    "performance_by_period": f"""WITH {SCORED_SQL}, {metrics_sql("scored", "period")} SELECT period, row_number() OVER (ORDER BY period) - 1 AS period_index, n AS n_samples,
        round(auc, 5) AS roc_auc, round(f1, 5) AS f1_score, round(prec, 5) AS "precision", round(rec, 5) AS recall,
        round((first_value(auc) OVER (ORDER BY period) - auc) / first_value(auc) OVER (ORDER BY period) * 100, 5) AS auc_decay_pct FROM metrics_""",
    "performance_trend": f"""WITH {SCORED_SQL}, faded AS (SELECT period, y, s - y * (period - 1995) * 0.04::DOUBLE AS s, yhat FROM scored), {metrics_sql("faded", "period")},
        t AS (SELECT regr_slope(auc, i) AS slope, count(*) AS n FROM (SELECT auc, row_number() OVER (ORDER BY period) - 1 AS i FROM metrics_))
        SELECT round(slope, 5) AS slope, n AS n_periods, CASE WHEN slope < -0.01 THEN 'ALERT' WHEN slope > 0.01 THEN 'IMPROVING' ELSE 'STABLE' END AS trend FROM t""",
    "day_windows": """WITH o AS (SELECT date_diff('day', (SELECT min(o_orderdate)::DATE FROM orders), o_orderdate::DATE) AS off FROM orders), s AS (SELECT unnest(range(0, 5)) AS i),
        r AS (SELECT i + 1 AS split, CASE WHEN off < (i + 2) * 30 THEN 'train' ELSE 'test' END AS role, off FROM s JOIN o ON off < (i + 3) * 30)
        SELECT split, role, count(*) AS n_rows, min(off) AS first_day, max(off) AS last_day FROM r GROUP BY split, role""",
}
