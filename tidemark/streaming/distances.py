"""KS distance and area between a reference and the windows of a stream, from mergeable quantile sketches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.drift import long_numeric
from tidemark.streaming.windows import TIME, Measure, WindowStore, stamped

SIZE = 800


def rank_error(size: int = SIZE) -> float:
    """Fixed value: the published 99 % bound on the normalized rank error of a KLL sketch of this size."""
    return 2.296 / size**0.9021


def reference_sketches(reference: DataFrame, columns: Sequence[str], size: int = SIZE) -> DataFrame:
    """(feature, rows_ref, sketch_ref): one sketch of a few kilobytes per column. Save it with write.parquet; it reloads as it is."""
    return long_numeric(reference, columns).groupBy("feature").agg(F.count("*").alias("rows_ref"), F.kll_sketch_agg_double("value", F.lit(size)).alias("sketch_ref"))


def sketch_store(path: str, length: str = "1 day", lateness: str = "1 day", size: int = SIZE) -> WindowStore:
    """Windows that keep one sketch per feature; sketches of later batches are merged in."""
    sketch = Measure(F.kll_sketch_agg_double("value", F.lit(size)), lambda name: F.kll_merge_agg_double(name, F.lit(size)))
    return WindowStore(path, ["feature"], {"sketch_cur": sketch}, length, lateness)


def long_events(events: DataFrame, columns: Sequence[str], time: str) -> DataFrame:
    """(TIME, feature, value) rows of a stream, for sketch_store."""
    return long_numeric(stamped(events, time), columns, F.col(TIME))


def sketched_distances(windows: DataFrame, reference: DataFrame, size: int = SIZE, points: int = 250) -> DataFrame:
    """(window_start, feature, n_rows, ks_statistic, wasserstein_distance, ks_bound) of windows with a sketch each.

    Both sides are read at the middles of points equal steps of probability. The
    area is the mean distance of equal quantiles over the reference's range, as in
    the drift table. A distribution function is the share of quantiles that are not
    larger, and the statistic the largest difference at any quantile of either
    side. ks_bound is what it may be off by: the rank errors of both sketches and a
    step. The area is off by no more than ks_bound times the range of all values
    over the reference's; with infinite values it is NULL. Features that the
    reference lacks are left out.
    """
    steps, ends = F.array(*[F.lit((k + 0.5) / points) for k in range(points)]), F.array(F.lit(0.0), F.lit(1.0))
    # One row per monitored column.
    both = windows.join(F.broadcast(reference), "feature")
    both = both.withColumns({
        f"{name}_{side}": F.kll_sketch_get_quantile_double(f"sketch_{side}", at) for side in ("ref", "cur") for name, at in (("q", steps), ("ends", ends))
    })

    def reached(quantiles: str, value: Column) -> Column:
        return F.size(F.filter(quantiles, lambda q: q <= value)) / points

    gaps = F.transform(F.array_distinct(F.concat("q_ref", "q_cur")), lambda v: F.abs(reached("q_ref", v) - reached("q_cur", v)))
    apart = F.zip_with("q_ref", "q_cur", lambda a, b: F.abs(a - b))
    span = F.col("ends_ref")[1] - F.col("ends_ref")[0]
    area = F.when(span > 0, F.aggregate(apart, F.lit(0.0), lambda total, x: total + x) / points / span).otherwise(0.0)
    finite = F.forall(F.concat("ends_ref", "ends_cur"), lambda q: F.abs(q) < float("inf"))
    return both.select(
        "window_start", "feature", "n_rows", F.array_max(gaps).alias("ks_statistic"), F.when(finite, area).alias("wasserstein_distance"),
        F.lit(2 * rank_error(size) + 1 / points).alias("ks_bound"),
    )


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("feature string, rows_ref bigint, sketch_ref binary").parquet(path)
