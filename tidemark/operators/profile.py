"""Profiles of one table and comparisons of two, as aggregations."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.scalars import as_double, label_flag, ratio, round_even
from tidemark.operators.drift import (
    _both_sides, category_shares, long_categorical, long_numeric,
)
from tidemark.operators.order_stats import ROWS_PER_SLICE, exact_quantiles

# Thresholds of the realism interpretations, and the density grid.
CONTINUITY_HIGH = 0.7
STABLE_STD = 0.05
REALISTIC_DEVIATION = 0.1
DENSITY_POINTS = 200
DENSITY_CUT = 3.0
DENSITY_REACH = 39
# Moments per cell of the density's expansion.
DENSITY_TERMS = 18


def category_distribution(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of every category among the present values of its column."""
    cells = long_categorical(df, columns).groupBy("feature", "category").agg(F.count("*").alias("n"))
    totals = cells.groupBy("feature").agg(F.sum("n").alias("total"))
    # One row per named column.
    joined = cells.join(F.broadcast(totals), "feature")
    return joined.select("feature", "category", "n", ratio(F.col("n"), F.col("total")).alias("proportion"))


def mean_change(old: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Means of both tables and the change in percent (0 when the old mean is 0).

    A column absent from either table gives a row of NULLs.
    """
    both = [c for c in columns if c in old.columns and c in new.columns]
    rows = _both_sides(old, new, both, long_numeric)
    found = rows.groupBy("feature").agg(
        F.avg(F.when(F.col("n_ref") > 0, F.col("value"))).alias("mean_old"),
        F.avg(F.when(F.col("n_cur") > 0, F.col("value"))).alias("mean_new"),
    )
    change = F.when(F.col("mean_old") == 0, 0.0).otherwise((F.col("mean_new") - F.col("mean_old")) / F.col("mean_old") * 100)
    found = found.withColumn("drift_pct", change)
    absent = [c for c in columns if c not in both]
    if not absent:
        return found
    spark = old.sparkSession
    names = spark.createDataFrame([(c,) for c in absent], "feature string")
    return found.unionByName(names, allowMissingColumns=True)


def compare_columns(old: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """KPI comparison: mean change of numeric columns, both shares of categorical ones."""
    fields = {f.name: f.dataType for f in old.schema.fields}
    shared = [c for c in columns if c in fields and c in new.columns]
    numeric = [c for c in columns if c not in shared or isinstance(fields[c], T.NumericType)]
    categorical = [c for c in shared if c not in numeric]
    means = mean_change(old, new, numeric).select(
        "feature", F.when(F.col("feature").isin(*shared), "numeric").alias("type"),
        F.lit(None).cast("string").alias("category"),
        F.col("mean_old").alias("old"), F.col("mean_new").alias("new"), "drift_pct",
    )
    if not categorical:
        return means
    shares = category_shares(old, new, categorical).select(
        "feature", F.lit("categorical").alias("type"), "category",
        F.col("share_reference").alias("old"), F.col("share_current").alias("new"),
        F.lit(None).cast("double").alias("drift_pct"),
    )
    return means.unionByName(shares)


def aligned_distribution(old: DataFrame, new: DataFrame, column: str) -> DataFrame:
    """Both distributions side by side by category; a category unseen on one side is NULL there."""
    shares = category_shares(old, new, [column])
    return shares.select(
        "category",
        F.when(F.col("n_ref") > 0, F.col("share_reference")).alias("base"),
        F.when(F.col("n_cur") > 0, F.col("share_current")).alias("actual"),
    )


def summary_statistics(old: DataFrame, new: DataFrame, column: str, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Mean, sample std, min, exact median and max of one column in two tables."""
    one = lambda df, side: df.select(
        F.lit(side).alias("side"), as_double(F.col(column), df.schema[column].dataType).alias("value")
    ).filter("value IS NOT NULL")
    rows = one(old, "old").unionByName(one(new, "new"))
    moments = rows.groupBy("side").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    middle = exact_quantiles(rows, ["side"], "value", {"median": 0.5}, rows_per_slice)
    return moments.join(middle, "side").select("side", "mean", "std", "min", "median", "max")


def density_curve(old: DataFrame, new: DataFrame, column: str, points: int = DENSITY_POINTS) -> DataFrame:
    """Gaussian kernel density of one column in two tables on an even grid.

    A fast Gauss transform: rows are summed up to moments per cell, one bandwidth
    wide, and the kernel is expanded about the middle of each cell, so the grid
    meets cells and neither rows nor values. With values at most half a bandwidth
    from the middle, DENSITY_TERMS moments leave an error below 1e-11 of a kernel's
    peak. A cell meets only the grid points within DENSITY_REACH bandwidths, beyond
    which its kernels are below the smallest double. Bandwidth n**(-1/5) * std, and
    the grid reaches three bandwidths beyond the data.
    """
    one = lambda df, side: df.select(
        F.lit(side).alias("side"), as_double(F.col(column), df.schema[column].dataType).alias("value")
    ).filter("value IS NOT NULL")
    rows = one(old, "old").unionByName(one(new, "new"))
    shape = rows.groupBy("side").agg(
        F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"),
        (F.pow(F.count("*").cast("double"), F.lit(-0.2)) * F.stddev_samp("value")).alias("width"),
    ).filter("width > 0")
    # Two rows, one per table.
    shape = F.broadcast(shape)
    cell = F.floor((F.col("value") - F.col("lo")) / F.col("width"))
    away = (F.col("value") - F.col("lo")) / F.col("width") - F.col("cell") - 0.5
    placed = rows.join(shape, "side").withColumn("cell", cell).select("side", "cell", away.alias("away"))
    moments = [F.sum(F.pow("away", F.lit(float(p))) / math.factorial(p)).alias(f"m{p}") for p in range(DENSITY_TERMS)]
    cells = placed.groupBy("side", "cell").agg(*moments).join(shape, "side")
    low = F.col("lo") - DENSITY_CUT * F.col("width")
    step = (F.col("hi") - F.col("lo") + 2 * DENSITY_CUT * F.col("width")) / (points - 1)
    middle = F.col("lo") + (F.col("cell") + 0.5) * F.col("width")
    at = lambda value: ((value - low) / step).cast("int")
    reach = (DENSITY_REACH + 0.5) * F.col("width")
    near = F.sequence(F.greatest(at(middle - reach), F.lit(0)), F.least(at(middle + reach) + 1, F.lit(points - 1)))
    spread = cells.select("side", "n", "width", low.alias("low"), step.alias("step"), middle.alias("middle"), F.array(*[f"m{p}" for p in range(DENSITY_TERMS)]).alias("m"), F.explode(near).alias("point"))
    x = F.col("low") + F.col("point") * F.col("step")
    spread = spread.withColumns({"x": x, "t": (x - F.col("middle")) / F.col("width")})
    # The sum of moments times Hermite polynomials, each from the two before.
    start = F.struct(F.lit(0.0).alias("before"), F.lit(1.0).alias("he"), F.lit(0).alias("p"), F.lit(0.0).alias("total"))

    def term(held, moment):
        following = F.col("t") * held["he"] - held["p"] * held["before"]
        return F.struct(held["he"].alias("before"), following.alias("he"), (held["p"] + 1).alias("p"), (held["total"] + moment * held["he"]).alias("total"))

    summed = F.aggregate("m", start, term, lambda held: held["total"])
    kernel = F.exp(-0.5 * F.col("t") * F.col("t")) * summed / (F.col("width") * (2 * math.pi) ** 0.5 * F.col("n"))
    return spread.select("side", "point", "x", kernel.alias("k")).groupBy("side", "point").agg(F.max("x").alias("x"), F.greatest(F.sum("k"), F.lit(0.0)).alias("density"))


def period_summary(df: DataFrame, period: Column, entity: str, label: str, measure: str, low_share: Column) -> DataFrame:
    """Per period: head count, label rate, mean of a measure, share of a category."""
    return df.groupBy(period.alias("period")).agg(
        F.count(entity).alias("n_rows"),
        round_even(F.avg(F.coalesce(label_flag(F.col(label)), F.lit(0))), 3).alias("label_rate"),
        round_even(F.avg(measure), 3).alias("mean_measure"),
        round_even(F.avg(low_share.cast("int")), 3).alias("category_share"),
    )


def entity_continuity(df: DataFrame, entity: str, period: Column) -> DataFrame:
    """How far the same entities reappear: 1 when all do, 0 when none does.

    Rows are counted per entity, and periods on their own: two distinct counts of
    one aggregate would pass every row on three times.
    """
    t = df.select(F.col(entity).alias("entity"), period.alias("period"))
    entities = t.groupBy("entity").agg(F.count("*").alias("n")).agg(
        F.count("entity").alias("unique_entities"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
    )
    # One row on either side.
    counted = entities.crossJoin(F.broadcast(t.select("period").distinct().agg(F.count("period").alias("periods"))))
    steady = ratio(F.col("total_rows"), F.col("periods"))
    raw = 1 - F.try_divide(F.col("unique_entities") - steady, F.col("total_rows") - steady)
    return counted.withColumn("raw", raw).select(
        "unique_entities", "total_rows", "periods",
        F.when(F.col("raw").isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("raw")))).alias("continuity_score"),
        F.when(F.col("raw") > CONTINUITY_HIGH, "HIGH").otherwise("LOW").alias("interpretation"),
    )


def simple_continuity(df: DataFrame, entity: str) -> DataFrame:
    """1 - distinct entities / rows."""
    return df.agg((1 - ratio(F.count_distinct(entity), F.count("*"))).alias("continuity"))


def label_stability(df: DataFrame, period: Column, label: str) -> DataFrame:
    """Mean, sample std and coefficient of variation of the per-period label rate."""
    rates = df.select(period.alias("period"), F.coalesce(label_flag(F.col(label)), F.lit(0)).alias("flag"))
    rates = rates.groupBy("period").agg(F.avg("flag").alias("rate"))
    found = rates.agg(F.avg("rate").alias("mean"), F.stddev_samp("rate").alias("std"))
    return found.select(
        "mean", "std", F.try_divide("std", "mean").alias("cv"),
        F.when(F.col("std") < STABLE_STD, "STABLE").otherwise("VOLATILE").alias("interpretation"),
    )


def baseline_deviation(df: DataFrame, baseline: DataFrame, column: str) -> DataFrame:
    """Moments of a column and its relative mean deviation from a baseline table."""
    base = baseline.agg(F.avg(column).alias("base")).scalar()
    found = df.agg(
        F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"), F.max(column).alias("max"),
    ).withColumn("base", base)
    deviation = F.try_divide(F.abs(F.col("mean") - F.col("base")), F.col("base"))
    return found.select(
        "mean", "std", "min", "max", deviation.alias("deviation"),
        F.when(deviation < REALISTIC_DEVIATION, "REALISTIC").otherwise("UNREALISTIC").alias("interpretation"),
    )


def distinct_periods(df: DataFrame, period: Column) -> DataFrame:
    return df.agg(F.count_distinct(period).alias("n_periods"))
