"""Drift jobs composed from the operators: reports, timelines, first-vs-last, concept drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.sql import DataFrame, functions as F

from tidemark.functions.scalars import round_even
from tidemark.operators.drift import covariate_shift, status_of
from tidemark.operators.metrics import DECAY_ALERT, METRICS, classification_metrics, decay_of_sides, decay_severity, metric_decay
from tidemark.operators.model import score
from tidemark.operators.normalize import column_types, normalize_frame
from tidemark.operators.order_stats import ROWS_PER_SLICE
from tidemark.operators.shape import drop_present, edge_period
from tidemark.sources.sinks import write_report
from tidemark.sources.tables import materialized


def concept_drift(
    reference: DataFrame, current: DataFrame, label: str, score_column: str, prediction: str,
    threshold: float = DECAY_ALERT, rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Metric loss of a scored current table against a scored reference; percentages.

    Empty when either table has no label.
    """
    keep = [label, score_column, prediction]
    if label not in reference.columns or label not in current.columns:
        columns = [c for c in (score_column, prediction) if c in reference.columns]
        reference = reference.select(*columns, F.lit(None).cast("string").alias(label)).limit(0)
        current = reference
    both = reference.select(*keep, F.lit("reference").alias("side")).unionByName(
        current.select(*keep, F.lit("current").alias("side"))
    )
    found = decay_of_sides(classification_metrics(both, ["side"], label, score_column, prediction, rows_per_slice), [], threshold)
    rounded = found.select(
        *[round_even(F.col(f"{m}_{s}"), 4).alias(f"{m}_{s}") for s in ("reference", "current") for m in METRICS],
        *[round_even(F.col(f"decay_{m}") * 100, 2).alias(f"decay_{m}") for m in METRICS],
        round_even(F.col("max_decay") * 100, 2).alias("max_decay"), "severity", "alert",
    )
    return rounded.filter("max_decay IS NOT NULL")


def concept_by_period(
    reference: DataFrame, current: DataFrame, period: str, label: str, score_column: str, prediction: str,
    threshold: float = DECAY_ALERT, rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """(period, max_decay, severity, alert): the metric loss of every period of a scored table against a scored reference.

    Feeds `concept` of a timeline. The reference is one more group of the same aggregation.
    """
    keep = [label, score_column, prediction]
    both = current.filter(F.col(period).isNotNull()).select(period, *keep).unionByName(reference.select(F.lit(None).alias(period), *keep))
    found = classification_metrics(both, [period], label, score_column, prediction, rows_per_slice)
    first = found.filter(F.col(period).isNull()).select(F.struct(*METRICS).alias("first")).scalar()
    wide = found.filter(F.col(period).isNotNull()).withColumn("first", first)
    wide = wide.withColumn("max_decay", F.greatest(*[metric_decay(F.col(f"first.{m}"), F.col(m)) for m in METRICS]))
    return wide.select(period, "max_decay", decay_severity(F.col("max_decay"), threshold).alias("severity"), F.coalesce(F.col("max_decay") > threshold, F.lit(False)).alias("alert"))


def normalized_pair(reference: DataFrame, current: DataFrame, exclude: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Both tables normalized by the reference's column roles."""
    categorical, numeric = column_types(reference, [c for c in reference.columns if c not in exclude])
    return tuple(normalize_frame(t, categorical, numeric, exclude) for t in (reference, current))


def concept_drift_of_model(model: Model, reference: DataFrame, current: DataFrame, label: str, threshold: float = DECAY_ALERT) -> DataFrame:
    """The same for a model: both tables are normalized, scored once and written, then measured."""
    pair = normalized_pair(reference, current, [label])
    scored = [materialized(score(model, df, [label]), "scored") for df in pair]
    return concept_drift(scored[0], scored[1], label, "probability", "prediction", threshold)


def drift_summary(table: DataFrame, reference: DataFrame, current: DataFrame, concept: DataFrame | None = None) -> DataFrame:
    """One row: sizes, features monitored, alerts and the overall status."""
    counted = table.agg(F.count("*").alias("total_features_monitored"), F.count_if("alert").alias("covariate_alerts"))
    alert = F.lit(False) if concept is None else F.coalesce(concept.agg(F.max("alert").alias("a")).scalar(), F.lit(False))
    sized = counted.withColumns({
        "reference_size": reference.agg(F.count("*").alias("n")).scalar(),
        "current_size": current.agg(F.count("*").alias("n")).scalar(),
        "concept_drift_detected": alert,
    })
    return sized.withColumn("overall_status", status_of(F.col("covariate_alerts"), F.col("concept_drift_detected")))


def monitor(
    reference: DataFrame, current: DataFrame, path: str | None = None, *, target: str | None = None,
    drop: Sequence[str] = (), normalize: bool = True, concept: DataFrame | None = None,
    rows_per_slice: int = ROWS_PER_SLICE, pvalue: str = "asymptotic",
) -> tuple[DataFrame, DataFrame]:
    """(drift table, summary): drop period and id columns, normalize both sides, compare, save."""
    ref, cur = drop_present(reference, drop), drop_present(current, drop)
    exclude = [target] if target else []
    if normalize:
        ref, cur = normalized_pair(ref, cur, exclude)
    table = covariate_shift(ref, cur, exclude=exclude, rows_per_slice=rows_per_slice, pvalue=pvalue)
    if path:
        write_report(table, path)
        table = table.sparkSession.read.schema(table.schema).json(path)
    return table, drift_summary(table, ref, cur, concept)


def full_report(
    reference: DataFrame, current: DataFrame, path: str, *, target: str | None = None, model: Model | None = None,
    drop: Sequence[str] = (), pvalue: str = "asymptotic",
) -> DataFrame:
    """The whole report as one JSON document, written to path and read back.

    Fields: timestamp, both sizes, the features (covariate_shift), the model's
    metric loss (concept_drift, if a model and a target are given), and the summary.
    """
    concept = None
    if model is not None and target:
        concept = materialized(concept_drift_of_model(model, drop_present(reference, drop), drop_present(current, drop), target), "concept")
    table, summary = monitor(reference, current, target=target, drop=drop, concept=concept, pvalue=pvalue)
    table = materialized(table, "features")
    entries = F.array_sort(F.collect_list(F.struct("feature", *[c for c in table.columns if c != "feature"])))
    document = drift_summary(table, reference, current, concept).withColumns({
        "timestamp": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"),
        "covariate_shift": table.agg(entries.alias("f")).scalar(),
    })
    if concept is not None:
        document = document.withColumn("concept_drift", concept.select(F.struct(*concept.columns)).scalar())
    document.write.mode("overwrite").json(path)
    return document.sparkSession.read.schema(document.schema).json(path)


def first_last_drift(df: DataFrame, period: str, exclude: Sequence[str] = (), pvalue: str = "asymptotic") -> DataFrame:
    """Drift table of the last period of a panel against its first, both normalized by the first's column roles."""
    first, last = normalized_pair(edge_period(df, period).drop(period), edge_period(df, period, last=True).drop(period), exclude)
    return covariate_shift(first, last, exclude=exclude, pvalue=pvalue)


def drift_timeline(
    reference: DataFrame, current: DataFrame, period: str, *, numeric: Sequence[str] | None = None,
    categorical: Sequence[str] | None = None, exclude: Sequence[str] = (), concept: DataFrame | None = None,
    rows_per_slice: int = ROWS_PER_SLICE, pvalue: str = "asymptotic",
) -> DataFrame:
    """Status of every period against a fixed reference, with a retrain flag; one job for all periods.

    `concept` may hold (period, alert) rows.
    """
    table = covariate_shift(
        reference, current, numeric=numeric, categorical=categorical, exclude=exclude, period=period,
        rows_per_slice=rows_per_slice, pvalue=pvalue,
    )
    return timeline_status(table, period, concept)


def timeline_status(table: DataFrame, period: str, concept: DataFrame | None = None) -> DataFrame:
    """One row per period from its rows of the drift table."""
    counted = table.groupBy(period).agg(
        F.count("*").alias("features"), F.count_if("alert").alias("covariate_alerts"),
        F.max("psi").alias("max_psi"), F.max("max_proportion_change").alias("max_share_change"),
    )
    if concept is None:
        counted = counted.withColumn("concept_alert", F.lit(False))
    else:
        counted = counted.join(concept.select(period, F.col("alert").alias("concept_alert")), period, "left")
    status = status_of(F.col("covariate_alerts"), F.col("concept_alert"))
    return counted.withColumn("overall_status", status).withColumn("retrain", F.col("overall_status") == "CRITICAL")
