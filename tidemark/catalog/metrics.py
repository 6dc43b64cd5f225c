"""Classification-metric queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.bindings import SPLIT_YEAR, rounded, scored_lines, table, typed
from tidemark.catalog.drift import SCORED_SQL, metrics_sql
from tidemark.operators import metrics as M


def confusion_matrix(spark, d):
    return typed(M.confusion_matrix(scored_lines(spark, d), "label", "prediction"))


def precision_recall_f1(spark, d):
    scored = scored_lines(spark, d)
    found = M.classification_metrics(scored, ["period"], "label", "score", "prediction")
    return rounded(found.select("period", "n_samples", "precision", "recall", "f1_score", "tn", "fp", "fn", "tp"))


def roc_auc(spark, d):
    """AUC of a continuous score over whole tables: event value as a score for errors."""
    events = table(spark, d, "events").withColumn("is_error", (F.col("event_type") == "error").cast("int"))
    return rounded(M.roc_auc(events, [], "is_error", "value"))


def roc_auc_by_period(spark, d):
    return rounded(M.roc_auc(scored_lines(spark, d), ["period"], "label", "score"))


def missing_scores(spark, d):
    """Rows without a score take part in no metric."""
    lines = scored_lines(spark, d)
    lines = lines.withColumn("score", F.when(F.col("period") % 2 == 0, F.nullif("score", F.lit(0.5))).otherwise(F.when(F.col("score") == 0.5, F.lit(float("nan"))).otherwise(F.col("score"))))
    found = M.classification_metrics(lines, ["period"], "label", "score", "prediction")
    return rounded(found.select("period", "n_samples", "roc_auc", "tn", "fp", "fn", "tp"))


def classification_report(spark, d):
    return rounded(M.classification_report(scored_lines(spark, d), "label", "prediction"))


def metric_decay(spark, d):
    scored = scored_lines(spark, d).withColumn(
        "side", F.when(F.col("period") < SPLIT_YEAR, "reference").otherwise("current")
    )
    found = M.decay_of_sides(M.classification_metrics(scored, ["side"], "label", "score", "prediction"), [])
    return rounded(found.select(*[F.round(F.col(f"decay_{m}") * 100, 4).alias(m) for m in M.METRICS],
                                F.round(F.col("max_decay") * 100, 4).alias("max_decay"), "severity", "alert"), 4)


QUERIES = {
    "confusion_matrix": confusion_matrix,
    "precision_recall_f1": precision_recall_f1,
    "roc_auc": roc_auc,
    "roc_auc_by_period": roc_auc_by_period,
    "missing_scores": missing_scores,
    "classification_report": classification_report,
    "metric_decay": metric_decay,
}

SQL = {
    "missing_scores": f"""WITH {SCORED_SQL}, kept AS (SELECT * FROM scored WHERE s <> 0.5), {metrics_sql("kept", "period")}
        SELECT period, n AS n_samples, round(auc, 6) AS roc_auc, tn, fp, fn, tp FROM metrics_""",
    "confusion_matrix": f"""WITH {SCORED_SQL} SELECT y::BIGINT AS label, count(*) FILTER (yhat = 0) AS predicted_0, count(*) FILTER (yhat = 1) AS predicted_1 FROM scored GROUP BY y""",
    "precision_recall_f1": f"""WITH {SCORED_SQL}, {metrics_sql("scored", "period")}
        SELECT period, n AS n_samples, round(prec, 6) AS "precision", round(rec, 6) AS recall, round(f1, 6) AS f1_score, tn, fp, fn, tp FROM metrics_""",
    "roc_auc": f"""WITH one AS (SELECT 1 AS g, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS y, value AS s, 0 AS yhat FROM events),
        {metrics_sql("one", "g")} SELECT round(auc, 6) AS roc_auc FROM metrics_""",
    "roc_auc_by_period": f"""WITH {SCORED_SQL}, {metrics_sql("scored", "period")} SELECT period, round(auc, 6) AS roc_auc FROM metrics_""",
    "classification_report": f"""WITH {SCORED_SQL}, t AS (SELECT count(*) FILTER (y = 0 AND yhat = 0)::DOUBLE AS tn, count(*) FILTER (y = 0 AND yhat = 1)::DOUBLE AS fp,
        count(*) FILTER (y = 1 AND yhat = 0)::DOUBLE AS fn, count(*) FILTER (y = 1 AND yhat = 1)::DOUBLE AS tp FROM scored),
        c AS (SELECT '0' AS class, coalesce(tn / nullif(tn + fn, 0), 0) AS p, coalesce(tn / nullif(tn + fp, 0), 0) AS r, coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0) AS f, tn + fp AS n FROM t
         UNION ALL SELECT '1', coalesce(tp / nullif(tp + fp, 0), 0), coalesce(tp / nullif(tp + fn, 0), 0), coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), fn + tp FROM t),
        a AS (SELECT * FROM c UNION ALL SELECT 'accuracy', (tp + tn) / (tn + fp + fn + tp), (tp + tn) / (tn + fp + fn + tp), (tp + tn) / (tn + fp + fn + tp), tn + fp + fn + tp FROM t
         UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(n) FROM c UNION ALL SELECT 'weighted avg', sum(p * n) / sum(n), sum(r * n) / sum(n), sum(f * n) / sum(n), sum(n) FROM c)
        SELECT class, round(p, 6) AS "precision", round(r, 6) AS recall, round(f, 6) AS f1_score, CAST(n AS BIGINT) AS support FROM a""",
    "metric_decay": f"""WITH {SCORED_SQL}, two AS (SELECT CASE WHEN period < 1998 THEN 'r' ELSE 'c' END AS side, y, s, yhat FROM scored), {metrics_sql("two", "side")},
        d AS (SELECT (o.auc - n.auc) / o.auc AS a, (o.f1 - n.f1) / o.f1 AS f, (o.prec - n.prec) / o.prec AS p, (o.rec - n.rec) / o.rec AS r
          FROM metrics_ o JOIN metrics_ n ON o.side = 'r' AND n.side = 'c')
        SELECT round(a * 100, 4) AS roc_auc, round(f * 100, 4) AS f1_score, round(p * 100, 4) AS "precision", round(r * 100, 4) AS recall,
        round(greatest(a, f, p, r) * 100, 4) AS max_decay, CASE WHEN greatest(a, f, p, r) > 0.10 THEN 'HIGH' WHEN greatest(a, f, p, r) > 0.05 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
        greatest(a, f, p, r) > 0.05 AS alert FROM d""",
}
