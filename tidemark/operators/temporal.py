"""Period index, split plans and performance over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.metrics import METRICS, classification_metrics
from tidemark.operators.order_stats import ROWS_PER_SLICE

# Trend thresholds, leakage gap and length of a day window.
TREND_DOWN = -0.01
TREND_UP = 0.01
LEAKAGE_GAP = 0.05
WINDOW_DAYS = 30


def period_index(df: DataFrame, period: Column) -> DataFrame:
    """Distinct periods with their 0-based position. Sorts periods only, never rows."""
    distinct = df.select(period.alias("period")).distinct().filter("period IS NOT NULL")
    return distinct.withColumn("idx", F.dense_rank().over(Window.orderBy("period")) - 1)


def check_periods(df: DataFrame, period: Column, n_splits: int) -> int:
    """Number of periods; an error when there are too few to split."""
    count = df.agg(F.count_distinct(period)).first()[0]
    if count < n_splits + 1:
        raise ValueError(f"{n_splits} splits need at least {n_splits + 1} periods, found {count}")
    return count


def split_plan(df: DataFrame, period: Column, n_splits: int, strategy: str = "expanding") -> DataFrame:
    """(split, role, period): train and test periods of every walk-forward split.

    expanding: train on all periods so far; rolling: on the last
    floor(periods / (n_splits + 1)). The test period is the next one.
    """
    if strategy not in ("expanding", "rolling"):
        raise ValueError(f"unknown strategy {strategy!r}")
    count = check_periods(df, period, n_splits)
    width = count if strategy == "expanding" else count // (n_splits + 1)
    indexed = period_index(df, period)
    split = F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1)))
    placed = indexed.select("period", "idx", split.alias("i"))
    role = F.when((F.col("idx") <= F.col("i")) & (F.col("idx") > F.col("i") - width), "train").when(
        F.col("idx") == F.col("i") + 1, "test"
    )
    return placed.select((F.col("i") + 1).alias("split"), role.alias("role"), "period").filter("role IS NOT NULL")


def split_sizes(df: DataFrame, period: Column, n_splits: int, strategy: str = "expanding") -> DataFrame:
    """Rows and periods per split and role; rows are counted per period before the join."""
    plan = split_plan(df, period, n_splits, strategy)
    sizes = df.groupBy(period.alias("period")).agg(F.count("*").alias("n"))
    return plan.join(sizes, "period").groupBy("split", "role").agg(
        F.count("*").alias("n_periods"), F.sum("n").alias("n_rows"),
        F.min("period").alias("first_period"), F.max("period").alias("last_period"),
    )


def metric_summary(metrics: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean and population std of the metrics over splits."""
    return metrics.groupBy(*keys).agg(
        F.count("*").alias("n_splits"),
        *[F.avg(m).alias(f"mean_{m}") for m in METRICS if m in metrics.columns],
        *[F.stddev_pop(m).alias(f"std_{m}") for m in METRICS if m in metrics.columns],
    )


def performance_by_period(
    scored: DataFrame, period: str, label: str, score: str, prediction: str,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Metrics of a fixed model per period and the AUC loss against the first period in percent."""
    metrics = classification_metrics(scored, [period], label, score, prediction, rows_per_slice)
    # One row per period from here on.
    order = Window.orderBy(period)
    first = F.first("roc_auc").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return metrics.select(
        F.col(period).alias("period"), (F.dense_rank().over(order) - 1).alias("period_index"),
        "n_samples", *METRICS, (F.try_divide(first - F.col("roc_auc"), first) * 100).alias("auc_decay_pct"),
    )


def performance_trend(by_period: DataFrame) -> DataFrame:
    """Slope of AUC over the period index and what it means."""
    slope = F.regr_slope("roc_auc", "period_index")
    verdict = F.when(F.col("slope") < TREND_DOWN, "ALERT").when(F.col("slope") > TREND_UP, "IMPROVING").otherwise("STABLE")
    return by_period.agg(slope.alias("slope"), F.count("*").alias("n_periods")).withColumn("trend", verdict)


def day_window_plan(df: DataFrame, date: Column, n_splits: int = 5, days: int = WINDOW_DAYS) -> DataFrame:
    """Rows per walk-forward split by days since the first day.

    Split i trains on days below days * (i + 2) and tests on the next `days`.
    Counted per day first, so a row is never repeated per split.
    """
    start = df.agg(F.min(date).cast("date").alias("d")).scalar()
    daily = df.select(date.cast("date").alias("day")).filter("day IS NOT NULL").groupBy("day").agg(F.count("*").alias("n"))
    offset = daily.withColumn("start", start).select(F.datediff("day", "start").alias("offset"), "n")
    placed = offset.select("offset", "n", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))).alias("i"))
    edge = (F.col("i") + 2) * days
    role = F.when(F.col("offset") < edge, "train").when(F.col("offset") < edge + days, "test")
    return placed.select((F.col("i") + 1).alias("split"), role.alias("role"), "n", "offset").filter("role IS NOT NULL").groupBy(
        "split", "role"
    ).agg(F.sum("n").alias("n_rows"), F.min("offset").alias("first_day"), F.max("offset").alias("last_day"))
