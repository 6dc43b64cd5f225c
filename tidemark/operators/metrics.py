"""Exact classification metrics per group, from one pass over scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalars import label_flag, ratio
from tidemark.operators.order_stats import ROWS_PER_SLICE, column_cuts, running_totals, with_slice
from tidemark.sources.tables import materialized

METRICS = ("roc_auc", "f1_score", "precision", "recall")

# Metric decay thresholds of the concept-drift alert.
DECAY_ALERT = 0.05
DECAY_HIGH = 0.10


def scored_rows(df: DataFrame, keys: Sequence[str], label: str, score: str, prediction: str) -> DataFrame:
    """(keys, label 0/1, score, prediction 0/1); rows without a usable label, score (NaN too) or prediction are dropped."""
    return df.select(
        *keys,
        label_flag(F.col(label)).alias("label"),
        F.col(score).cast("double").alias("score"),
        label_flag(F.col(prediction)).alias("prediction"),
    ).filter("label IS NOT NULL AND score IS NOT NULL AND NOT isnan(score) AND prediction IS NOT NULL")


def confusion_counts(df: DataFrame, keys: Sequence[str], label: str, prediction: str) -> DataFrame:
    """Counts tn, fp, fn, tp per key."""
    rows = df.select(*keys, label_flag(F.col(label)).alias("label"), label_flag(F.col(prediction)).alias("prediction"))
    return rows.filter("label IS NOT NULL").groupBy(*keys).agg(*_confusion())


def _confusion() -> list[Column]:
    return [
        F.expr(f"count(CASE WHEN label = {truth} AND prediction = {said} THEN 1 END) AS {name}")
        for name, truth, said in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
    ]


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """2x2 table, one row per true class."""
    counts = confusion_counts(df, [], label, prediction)
    rows = F.explode(F.array(
        F.struct(F.lit(0).alias("label"), F.col("tn").alias("predicted_0"), F.col("fp").alias("predicted_1")),
        F.struct(F.lit(1).alias("label"), F.col("fn").alias("predicted_0"), F.col("tp").alias("predicted_1")),
    ))
    return counts.select(rows.alias("r")).select("r.*")


def precision_recall_f1(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    """Each is 0 when its denominator is 0."""
    zero = F.lit(0.0)
    precision = F.coalesce(ratio(tp, tp + fp), zero)
    recall = F.coalesce(ratio(tp, tp + fn), zero)
    f1 = F.coalesce(ratio(2 * tp, 2 * tp + fp + fn), zero)
    return precision, recall, f1


def classification_metrics(
    df: DataFrame, keys: Sequence[str], label: str, score: str, prediction: str,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """ROC-AUC (ties one half), F1, precision and recall of class 1 per key.

    Rows are reduced to counts per distinct score before they are sorted, so the
    area is exact and a frequent score is one row.
    """
    keys = list(keys)
    rows = scored_rows(df, keys, label, score, prediction)
    cells = rows.groupBy(*keys, "score").agg(
        F.expr("count(CASE WHEN label = 1 THEN 1 END) AS pos"), F.expr("count(CASE WHEN label = 0 THEN 1 END) AS neg"), *_confusion()
    )
    # Written once: the cut points and the running totals read the counts, not the rows again.
    cells = materialized(cells, "score-counts")
    cells = with_slice(cells, "score", column_cuts(cells, "score", rows_per_slice))
    ranked = running_totals(cells, keys, "score", ["pos", "neg"])
    below = F.col("cum_neg").cast("double") - F.col("neg") / 2.0
    summed = ranked.groupBy(*keys).agg(
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"),
        F.sum(F.col("pos") * below).alias("wins"),
        *[F.sum(c).alias(c) for c in ("tn", "fp", "fn", "tp")],
    )
    precision, recall, f1 = precision_recall_f1(F.col("tp"), F.col("fp"), F.col("fn"))
    area = ratio(F.col("wins"), F.col("positives").cast("double") * F.col("negatives"))
    return summed.select(
        *keys, (F.col("positives") + F.col("negatives")).alias("n_samples"),
        area.alias("roc_auc"), f1.alias("f1_score"), precision.alias("precision"), recall.alias("recall"),
        "tn", "fp", "fn", "tp",
    )


def roc_auc(df: DataFrame, keys: Sequence[str], label: str, score: str, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    found = classification_metrics(df.withColumn("_said", F.lit(0)), keys, label, score, "_said", rows_per_slice)
    return found.select(*keys, "roc_auc")


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per class, accuracy, macro and weighted averages in long form.

    The accuracy row repeats the accuracy in all three metric columns.
    """
    counts = confusion_counts(df, [], label, prediction)
    p1, r1, f1 = precision_recall_f1(F.col("tp"), F.col("fp"), F.col("fn"))
    p0, r0, f0 = precision_recall_f1(F.col("tn"), F.col("fn"), F.col("fp"))
    n0, n1 = F.col("tn") + F.col("fp"), F.col("fn") + F.col("tp")
    total = n0 + n1
    accuracy = F.coalesce(ratio(F.col("tp") + F.col("tn"), total), F.lit(0.0))

    def row(name: str, values: Sequence[Column], support: Column) -> Column:
        named = [v.cast("double").alias(n) for n, v in zip(("precision", "recall", "f1_score"), values)]
        return F.struct(F.lit(name).alias("class"), *named, support.cast("bigint").alias("support"))

    pairs = ((p0, p1), (r0, r1), (f0, f1))
    macro = [(a + b) / 2 for a, b in pairs]
    weighted = [F.coalesce(ratio(a * n0 + b * n1, total), F.lit(0.0)) for a, b in pairs]
    rows = F.array(
        row("0", (p0, r0, f0), n0), row("1", (p1, r1, f1), n1),
        row("accuracy", (accuracy, accuracy, accuracy), total),
        row("macro avg", macro, total), row("weighted avg", weighted, total),
    )
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def metric_decay(old: Column, new: Column) -> Column:
    """Relative loss against the old value, 0 when that is not positive."""
    return F.when(old > 0, (old - new) / old).when(old.isNotNull(), 0.0)


def decay_severity(decay: Column, threshold: float = DECAY_ALERT) -> Column:
    return F.when(decay > DECAY_HIGH, "HIGH").when(decay > threshold, "MEDIUM").otherwise("LOW")


def decay_of_sides(metrics: DataFrame, keys: Sequence[str], threshold: float = DECAY_ALERT) -> DataFrame:
    """Compare metric rows with side 'reference' and 'current': decay, largest decay, alert."""
    keys = list(keys)
    sides = {
        s: [F.max(F.when(F.col("side") == s, F.col(m))).alias(f"{m}_{s}") for m in METRICS]
        for s in ("reference", "current")
    }
    wide = metrics.groupBy(*keys).agg(*sides["reference"], *sides["current"])
    wide = wide.withColumns({
        f"decay_{m}": metric_decay(F.col(f"{m}_reference"), F.col(f"{m}_current")) for m in METRICS
    })
    largest = F.greatest(*[F.col(f"decay_{m}") for m in METRICS])
    return wide.withColumn("max_decay", largest).withColumn(
        "severity", decay_severity(largest, threshold)
    ).withColumn("alert", F.coalesce(largest > threshold, F.lit(False)))
