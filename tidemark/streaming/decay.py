"""Metrics of a scored stream whose labels arrive later, and their decay against the first window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.scalars import label_flag, ratio
from tidemark.operators.metrics import DECAY_ALERT, METRICS, decay_severity, metric_decay, precision_recall_f1
from tidemark.streaming.windows import TIME, Measure, WindowStore, stamped

BINS = 1000


def with_labels(scores: DataFrame, labels: DataFrame, key: str, time: str, label_time: str, wait: str = "7 days", late: str = "1 day") -> DataFrame:
    """Scores beside the labels that arrive for them within wait: a stream-stream join whose state the watermarks bound.

    scores: key, time and more; labels: key, label_time and more. A score without a
    label in time appears in no window, one with several labels counts with each.
    """
    s = stamped(scores, time).withWatermark(TIME, late)
    l = labels.withColumnRenamed(key, "_key").withColumn("_labelled", F.col(label_time).cast("timestamp")).withWatermark("_labelled", late)
    met = (F.col(key) == F.col("_key")) & (F.col("_labelled") >= F.col(TIME)) & (F.col("_labelled") <= F.col(TIME) + F.expr(f"INTERVAL {wait}"))
    return s.join(l, met).drop("_key", "_labelled", label_time)


def metric_store(path: str, label: str, score: str, prediction: str, length: str = "1 day", lateness: str = "8 days", bins: int = BINS) -> WindowStore:
    """Windows that keep confusion cells per bin of the score. lateness must cover the wait for labels and the watermark's own."""
    truth, said = label_flag(F.col(label)), label_flag(F.col(prediction))
    cells = {
        name: Measure(F.count_if((truth == t) & (said == p))) for name, t, p in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
    } | {"pos": Measure(F.count_if(truth == 1)), "neg": Measure(F.count_if(truth == 0))}
    return WindowStore(path, ["bin"], cells, length, lateness)


def binned_scores(rows: DataFrame, label: str, score: str, prediction: str, bins: int = BINS) -> DataFrame:
    """Rows for metric_store: those with a label, a score from 0 to 1 and a prediction."""
    number = F.col(score).cast("double")
    valid = F.col(label).isNotNull() & F.col(prediction).isNotNull() & number.between(0.0, 1.0)
    return rows.filter(valid).withColumn("bin", F.least(F.floor(number * bins), F.lit(bins - 1)))


def window_metrics(windows: DataFrame) -> DataFrame:
    """(window_start, n_samples, roc_auc, f1_score, precision, recall) from the windows of a metric_store.

    Scores of one bin count as tied, so the area is off by at most half the pairs
    that share a bin. A window with labels of one class has no area.
    """
    below = Window.partitionBy("window_start").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    ranked = windows.withColumn("below", F.coalesce(F.sum("neg").over(below), F.lit(0)))
    summed = ranked.groupBy("window_start").agg(
        *[F.sum(c).alias(c) for c in ("tn", "fp", "fn", "tp", "pos", "neg")], F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2)).alias("wins"),
    )
    precision, recall, f1 = precision_recall_f1(F.col("tp"), F.col("fp"), F.col("fn"))
    return summed.select(
        "window_start", (F.col("pos") + F.col("neg")).alias("n_samples"), ratio(F.col("wins"), F.col("pos").cast("double") * F.col("neg")).alias("roc_auc"),
        f1.alias("f1_score"), precision.alias("precision"), recall.alias("recall"),
    )


def decay_by_window(metrics: DataFrame, threshold: float = DECAY_ALERT) -> DataFrame:
    """metrics with max_decay, severity and alert against the first window, as concept drift judges two tables."""
    first = metrics.agg(F.min_by(F.struct(*METRICS), "window_start").alias("f")).scalar()
    wide = metrics.withColumn("first", first)
    largest = F.greatest(*[metric_decay(F.col(f"first.{m}"), F.col(m)) for m in METRICS])
    wide = wide.withColumn("max_decay", largest).drop("first")
    return wide.withColumns({"severity": decay_severity(F.col("max_decay"), threshold), "alert": F.coalesce(F.col("max_decay") > threshold, F.lit(False))})
