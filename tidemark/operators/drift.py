"""Drift between a reference table and current tables.

Both tables are tagged, unpivoted to (feature, value) and aggregated to counts
per distinct value before anything is sorted. One plan serves all features; the
optional `groups` column lets the same plan serve many current tables (periods).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window, functions as F, types as T

from tidemark.functions.ks import exact_ks_pvalue
from tidemark.functions.scalars import ratio
from tidemark.functions.sqltext import name, number, per_feature, text
from tidemark.operators.order_stats import (
    ROWS_PER_SLICE, cuts_by_feature, running_totals, with_feature_slice,
)

# Bin count, smoothing and alert thresholds of the drift measures.
PSI_BINS = 10
PSI_SMOOTHING = 1e-6
PSI_ALERT = 0.25
PSI_HIGH = 0.5
KS_ALERT = 0.05
CATEGORY_MEDIUM = 0.15
CATEGORY_HIGH = 0.30
CRITICAL_ALERTS = 5

MOMENTS = ("mean_reference", "mean_current", "std_reference", "std_current")


def feature_columns(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric, categorical) column names by type; arrays, maps and structs are not monitored."""
    nested = (T.ArrayType, T.MapType, T.StructType, T.BinaryType)
    numeric, categorical = [], []
    for field in df.schema.fields:
        if field.name in exclude or isinstance(field.dataType, nested):
            continue
        (numeric if isinstance(field.dataType, T.NumericType) else categorical).append(field.name)
    return numeric, categorical


def long_numeric(df: DataFrame, columns: Sequence[str], *keep: Column) -> DataFrame:
    """Unpivot numeric columns to (feature, value DOUBLE); missing values are dropped."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    cells = [
        f"named_struct('feature', {text(c)}, 'value', CAST({f'nanvl({name(c)}, NULL)' if c in floating else name(c)} AS DOUBLE))"
        for c in columns
    ]
    listed = f"array({', '.join(cells)})" if cells else "CAST(array() AS array<struct<feature:string,value:double>>)"
    out = df.select(*keep, F.expr(f"inline({listed})"))
    return out.filter("value IS NOT NULL")


def _category_text(c: str, dtype: T.DataType) -> str:
    """A column as the text of its category, as SQL; booleans read True/False."""
    if isinstance(dtype, T.BooleanType):
        return f"CASE WHEN {name(c)} THEN 'True' WHEN NOT {name(c)} THEN 'False' END"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return f"CAST(nanvl({name(c)}, NULL) AS STRING)"
    return f"CAST({name(c)} AS STRING)"


def long_categorical(df: DataFrame, columns: Sequence[str], *keep: Column) -> DataFrame:
    """Unpivot columns as text to (feature, category); booleans read True/False."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    cells = [f"named_struct('feature', {text(c)}, 'category', {_category_text(c, kinds[c])})" for c in columns]
    listed = f"array({', '.join(cells)})" if cells else "CAST(array() AS array<struct<feature:string,category:string>>)"
    out = df.select(*keep, F.expr(f"inline({listed})"))
    return out.filter("category IS NOT NULL")


def as_text(column: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BooleanType):
        return F.when(column, "True").when(~column, "False")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(column), column).cast("string")
    return column.cast("string")


def _both_sides(reference: DataFrame, current: DataFrame, columns: Sequence[str], unpivot) -> DataFrame:
    """Long rows of both tables with 0/1 measures n_ref and n_cur."""
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    ref = unpivot(reference, columns, one.alias("n_ref"), zero.alias("n_cur"))
    cur = unpivot(current, columns, zero.alias("n_ref"), one.alias("n_cur"))
    return ref.unionByName(cur)


def numeric_profile(rows: DataFrame) -> dict[str, Row]:
    """Bounds, moments and row counts per feature: one driver row per monitored column."""
    found = rows.groupBy("feature").agg(*[F.expr(e) for e in (
        "count(*) AS rows", "count_if(n_ref > 0) AS rows_reference",
        "min(value) FILTER (WHERE n_ref > 0) AS lo", "max(value) FILTER (WHERE n_ref > 0) AS hi",
        "avg(value) FILTER (WHERE n_ref > 0) AS mean_reference", "avg(value) FILTER (WHERE n_cur > 0) AS mean_current",
        "stddev_samp(value) FILTER (WHERE n_ref > 0) AS std_reference",
        "stddev_samp(value) FILTER (WHERE n_cur > 0) AS std_current",
    )])
    return {r["feature"]: r for r in found.collect()}


def looked_up(profile: dict[str, Row], entry: str) -> str:
    """A profile entry of the row's feature as SQL text."""
    return per_feature({f: number(r[entry]) for f, r in profile.items()}, "CAST(NULL AS DOUBLE)")


def bin_edges(lo: float, hi: float, bins: int) -> list[float]:
    """Equal-width edges; a constant column gets the widened range [lo - 0.5, lo + 0.5]."""
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    step = (hi - lo) / bins
    return [lo + step * k for k in range(bins)] + [hi]


def bin_of_feature(bounds: dict[str, tuple[float, float]], bins: int) -> Column:
    """Equal-width bin 0..bins-1 of `value` on its feature's range, last bin closed; NULL outside."""
    found = {}
    for feature, (lo, hi) in bounds.items():
        edges = [number(e) for e in bin_edges(lo, hi, bins)]
        reached = " + ".join(["0"] + [f"CAST(value >= {e} AS INT)" for e in edges[1:-1]])
        found[feature] = f"CASE WHEN value >= {edges[0]} AND value <= {edges[-1]} THEN {reached} END"
    return F.expr(per_feature(found, "CAST(NULL AS INT)"))


def finite_bounds(profile: dict[str, Row]) -> dict[str, tuple[float, float]]:
    """The reference range per feature; without a finite one there are no bins."""
    found = {f: (r["lo"], r["hi"]) for f, r in profile.items() if r["lo"] is not None}
    return {f: b for f, b in found.items() if all(map(math.isfinite, b))}


def binned(profile: dict[str, Row], bins: int) -> Column:
    return bin_of_feature(finite_bounds(profile), bins)


def bounded_psi(profile: dict[str, Row], bins: int) -> Column:
    """The index, NULL for a feature whose reference range is not finite."""
    bounded = F.expr(per_feature(dict.fromkeys(finite_bounds(profile), "true"), "false"))
    return F.when(bounded, psi_of_counts(bins))


def bin_counts(bins: int) -> list[Column]:
    """Aggregates ref_k and cur_k: rows of each side in bin k."""
    return [
        F.expr(f"coalesce(sum(n_{side}) FILTER (WHERE bin = {k}), 0) AS {side}_{k}")
        for k in range(bins) for side in ("ref", "cur")
    ]


def psi_of_counts(bins: int) -> Column:
    """The index from ref_k, cur_k, rows_ref and rows_cur.

    Values outside the reference range count in the denominators only.
    """
    eps, spread = number(PSI_SMOOTHING), number(bins * PSI_SMOOTHING)
    pairs = ", ".join(
        f"named_struct('r', (ref_{k} + {eps}) / (rows_ref + {spread}), 'c', (cur_{k} + {eps}) / (rows_cur + {spread}))"
        for k in range(bins)
    )
    return F.expr(
        f"CASE WHEN rows_ref > 0 AND rows_cur > 0 THEN "
        f"aggregate(array({pairs}), 0D, (acc, p) -> acc + (p.c - p.r) * ln(p.c / p.r)) END"
    )


def population_stability(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None, bins: int = PSI_BINS) -> DataFrame:
    """PSI per numeric column. Two passes and one tiny shuffle: rows never move."""
    columns = feature_columns(reference)[0] if columns is None else columns
    rows = _both_sides(reference, current, columns, long_numeric)
    profile = numeric_profile(rows.filter("n_ref > 0"))
    counted = rows.withColumn("bin", binned(profile, bins)).groupBy("feature").agg(
        F.sum("n_ref").alias("rows_ref"), F.sum("n_cur").alias("rows_cur"), *bin_counts(bins)
    )
    return counted.select("feature", bounded_psi(profile, bins).alias("psi"))


def ks_pvalue(statistic: str, n_ref: str, n_cur: str) -> Column:
    """Two-sided p-value by the Kolmogorov series, good for large samples.

    With N = round(n*m/(n+m)) and x = D*sqrt(N), the series is taken at
    x + 1/(6*sqrt(N)) + (x-1)/(4*N), a published correction for finite N.
    """
    size = f"greatest(1D, rint(CAST({n_ref} AS DOUBLE) * {n_cur} / ({n_ref} + {n_cur})))"
    moved = "transform(array(size), size -> sqrt(size) * stat + 1D / (6D * sqrt(size)) + (sqrt(size) * stat - 1D) / (4D * size))[0]"
    series = "aggregate(sequence(1, 100), 0D, (acc, k) -> acc + if(k % 2 = 1, 1D, -1D) * exp(-2D * k * k * lam * lam))"
    value = f"if(lam < 0.2D, 1D, greatest(0D, least(1D, 2D * {series})))"
    # transform over a one-element array names a repeated argument.
    lam = moved.replace("array(size)", f"array({size})").replace("stat", statistic)
    return F.expr(f"CASE WHEN {statistic} IS NOT NULL THEN transform(array({lam}), lam -> {value})[0] END")


def _pvalue(measured: DataFrame, groups: Sequence[str], method: str) -> tuple[DataFrame, Column]:
    """The p-value column of (ks_statistic, rows_ref, rows_cur), and the rows to compute it on."""
    if method == "asymptotic":
        return measured, ks_pvalue("ks_statistic", "rows_ref", "rows_cur")
    if method != "exact":
        raise ValueError(f"unknown p-value method {method!r}")
    # A value is costly and the drift table small: deal its rows out before the computation.
    return measured.repartition(*groups, "feature"), exact_ks_pvalue("ks_statistic", "rows_ref", "rows_cur")


def numeric_drift(
    reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None, *,
    bins: int = PSI_BINS, rows_per_slice: int = ROWS_PER_SLICE, pvalue: str = "asymptotic",
) -> DataFrame:
    """PSI, KS, Wasserstein and moments of every numeric column, unrounded.

    pvalue: "asymptotic" takes the Kolmogorov series for every feature, "exact"
    the exact distribution for every feature. Size decides nothing.
    """
    columns = feature_columns(reference)[0] if columns is None else columns
    rows = _both_sides(reference, current, columns, long_numeric)
    cells = rows.groupBy("feature", "value").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    profile = numeric_profile(rows)
    cuts = cuts_by_feature(rows, {f: r["rows"] for f, r in profile.items()}, rows_per_slice)
    sliced = with_feature_slice(cells.withColumn("bin", binned(profile, bins)), "value", cuts)
    ordered = running_totals(sliced, ["feature"], "value", ["n_ref", "n_cur"])
    measured = ordered.groupBy("feature").agg(
        *[F.expr(e) for e in (
            "max(total_n_ref) AS rows_ref", "max(total_n_cur) AS rows_cur",
            "max(abs(try_divide(cum_n_ref, total_n_ref) - try_divide(cum_n_cur, total_n_cur))) AS ks_statistic",
            "coalesce(sum((value - prev_value) * abs(try_divide(cum_n_ref - n_ref, total_n_ref) - try_divide(cum_n_cur - n_cur, total_n_cur))), 0D) AS area",
        )],
        *bin_counts(bins),
    )
    measured, p = _pvalue(measured.filter("rows_ref > 0 AND rows_cur > 0"), [], pvalue)
    span = f"({looked_up(profile, 'hi')} - {looked_up(profile, 'lo')})"
    return measured.select(
        "feature", "rows_ref", "rows_cur", bounded_psi(profile, bins).alias("psi"), "ks_statistic",
        p.alias("ks_pvalue"),
        F.expr(f"if({span} > 0, area / {span}, 0D) AS wasserstein_distance"),
        *[F.expr(f"{looked_up(profile, m)} AS {m}") for m in MOMENTS],
    )


def numeric_drift_by_period(
    reference: DataFrame, current: DataFrame, period: str, columns: Sequence[str] | None = None, *,
    bins: int = PSI_BINS, rows_per_slice: int = ROWS_PER_SLICE, pvalue: str = "asymptotic",
) -> DataFrame:
    """(period, feature, rows_ref, rows_cur, psi, ks_statistic, ks_pvalue): every period of current against the whole reference.

    The reference is never repeated per period. Between two values of a period
    its distribution is flat and the reference's rises, so the largest distance
    lies at a value of the period, on one side of it or the other. One running
    total of the reference over all values, and one of each period, both along the
    same sorted cells, is all it takes. Any number of periods will do.
    """
    columns = feature_columns(reference, [period])[0] if columns is None else columns
    ref = long_numeric(reference, columns, F.lit(1).cast("bigint").alias("n_ref"), F.lit(0).cast("bigint").alias("n_cur"))
    profile = numeric_profile(ref)
    cuts = cuts_by_feature(ref, {f: r["rows"] for f, r in profile.items()}, rows_per_slice)
    known = ref.groupBy("feature", "value").agg(F.sum("n_ref").alias("n_ref"))
    found = numeric_drift_of_counts(known, numeric_counts(current, columns, period), profile, cuts, bins, pvalue)
    return found.withColumnRenamed("period", period)


def numeric_counts(df: DataFrame, columns: Sequence[str], period: str) -> DataFrame:
    """(period, feature, value, n_cur): what drift needs to know of the numeric columns."""
    cells = long_numeric(df, columns, F.col(period).alias("period")).filter("period IS NOT NULL")
    return cells.groupBy("period", "feature", "value").agg(F.count("*").alias("n_cur"))


def period_counts(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], period: str) -> DataFrame:
    """(period, feature, value, category, n_cur): numeric_counts and category_counts of one pass; one of value and category is NULL."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    number_of = lambda c: f"CAST({f'nanvl({name(c)}, NULL)' if isinstance(kinds[c], (T.DoubleType, T.FloatType)) else name(c)} AS DOUBLE)"
    cells = [f"named_struct('feature', {text(c)}, 'value', {number_of(c)}, 'category', CAST(NULL AS STRING))" for c in numeric]
    cells += [f"named_struct('feature', {text(c)}, 'value', CAST(NULL AS DOUBLE), 'category', {_category_text(c, kinds[c])})" for c in categorical]
    listed = f"array({', '.join(cells)})" if cells else "CAST(array() AS array<struct<feature:string,value:double,category:string>>)"
    long = df.select(F.col(period).alias("period"), F.expr(f"inline({listed})"))
    long = long.filter("period IS NOT NULL AND (value IS NOT NULL OR category IS NOT NULL)")
    return long.groupBy("period", "feature", "value", "category").agg(F.count("*").alias("n_cur"))


def numeric_drift_of_counts(
    known: DataFrame, by_period: DataFrame, profile: dict[str, Row], cuts: dict[str, list[float]], bins: int = PSI_BINS, pvalue: str = "asymptotic",
) -> DataFrame:
    """numeric_drift_by_period from the counts (feature, value, n_ref) and (period, feature, value, n_cur)."""
    none, zero = F.lit(None).cast(by_period.schema["period"].dataType), F.lit(0).cast("bigint")
    cells = known.select(none.alias("period"), "feature", "value", "n_ref", zero.alias("n_cur")).unionByName(
        by_period.select("period", "feature", "value", zero.alias("n_ref"), "n_cur")
    )
    cells = with_feature_slice(cells.withColumn("slice", F.lit(0)), "value", cuts)
    # One row per period, feature and slice, the reference being the period NULL: what lies before the slice, and in all.
    sizes = cells.groupBy("period", "feature", "slice").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    of_feature, of_period = Window.partitionBy("feature"), Window.partitionBy("feature", "period")
    before = lambda along: along.orderBy("slice").rangeBetween(Window.unboundedPreceding, -1)
    heads = sizes.select(
        "period", "feature", "slice", F.sum("n_ref").over(of_feature).alias("total_n_ref"), F.sum("n_cur").over(of_period).alias("total_n_cur"),
        F.coalesce(F.sum("n_ref").over(before(of_feature)), zero).alias("ahead_ref"), F.coalesce(F.sum("n_cur").over(before(of_period)), zero).alias("ahead_cur"),
    ).filter("period IS NOT NULL")
    # The cells move once, by feature and slice; every window below is sorted where they then lie.
    inside = cells.withColumn("cum_n_ref", F.sum("n_ref").over(Window.partitionBy("feature", "slice").orderBy("value")))
    inside = inside.withColumn("n_ref", F.sum("n_ref").over(Window.partitionBy("feature", "slice", "value"))).filter("period IS NOT NULL")
    inside = inside.withColumn("cum_n_cur", F.sum("n_cur").over(Window.partitionBy("feature", "slice", "period").orderBy("value")))
    both = inside.join(F.broadcast(heads), ["period", "feature", "slice"]).withColumns({
        "cum_n_ref": F.col("cum_n_ref") + F.col("ahead_ref"), "cum_n_cur": F.col("cum_n_cur") + F.col("ahead_cur"), "bin": binned(profile, bins),
    })
    counted = lambda side: [F.expr(f"coalesce(sum(n_{side}) FILTER (WHERE bin = {k}), 0) AS {side}_{k}") for k in range(bins)]
    measured = both.groupBy("period", "feature").agg(
        *[F.expr(e) for e in (
            "max(total_n_ref) AS rows_ref", "max(total_n_cur) AS rows_cur",
            "max(greatest(abs(try_divide(cum_n_ref, total_n_ref) - cum_n_cur / total_n_cur), "
            "abs(try_divide(cum_n_ref - n_ref, total_n_ref) - (cum_n_cur - n_cur) / total_n_cur))) AS ks_statistic",
        )],
        *counted("cur"),
    ).filter("rows_ref > 0 AND rows_cur > 0")
    # One row per monitored column.
    measured = measured.join(F.broadcast(known.withColumn("bin", binned(profile, bins)).groupBy("feature").agg(*counted("ref"))), "feature")
    measured, p = _pvalue(measured, ["period"], pvalue)
    return measured.select("period", "feature", "rows_ref", "rows_cur", bounded_psi(profile, bins).alias("psi"), "ks_statistic", p.alias("ks_pvalue"))


def numeric_severity(psi: Column, ks_p: Column, threshold_psi: float = PSI_ALERT, threshold_ks: float = KS_ALERT) -> Column:
    """KS alone can raise MEDIUM at most; HIGH needs a large PSI."""
    drifted = F.coalesce(psi >= threshold_psi, F.lit(False)) | F.coalesce(ks_p < threshold_ks, F.lit(False))
    return F.when(drifted & F.coalesce(psi >= PSI_HIGH, F.lit(False)), "HIGH").when(drifted, "MEDIUM").otherwise("LOW")


def category_severity(change: Column) -> Column:
    return F.when(change > CATEGORY_HIGH, "HIGH").when(change > CATEGORY_MEDIUM, "MEDIUM").otherwise("LOW")


def category_shares(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Both distributions aligned per (feature, category); an unseen category has share 0."""
    columns = columns if columns is not None else feature_columns(reference)[1]
    rows = _both_sides(reference, current, columns, long_categorical)
    cells = rows.groupBy("feature", "category").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    totals = cells.groupBy("feature").agg(F.sum("n_ref").alias("rows_ref"), F.sum("n_cur").alias("rows_cur"))
    # One row per monitored column.
    joined = cells.join(F.broadcast(totals), "feature")
    return joined.select(
        "feature", "category", "n_ref", "n_cur", "rows_ref", "rows_cur",
        ratio(F.col("n_ref"), F.col("rows_ref")).alias("share_reference"),
        ratio(F.col("n_cur"), F.col("rows_cur")).alias("share_current"),
    )


def categorical_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Largest change of a category's share per feature, unrounded."""
    shares = category_shares(reference, current, columns).filter("rows_ref > 0 AND rows_cur > 0")
    return shares.groupBy("feature").agg(
        F.max(F.abs(F.col("share_current") - F.col("share_reference"))).alias("max_proportion_change"),
        F.max("rows_ref").alias("rows_ref"),
        F.max("rows_cur").alias("rows_cur"),
    )


def categorical_drift_by_period(reference: DataFrame, current: DataFrame, period: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(period, feature, max_proportion_change, rows_ref, rows_cur): every period of current against the whole reference.

    Categories of the reference that a period lacks matter by their own share
    only, and of those the largest counts. Reference categories are ranked by
    share; the first rank that a period does not hold names it. So no period is
    paired with all categories.
    """
    columns = columns if columns is not None else feature_columns(reference, [period])[1]
    found = categorical_drift_of_counts(ranked_categories(reference, columns), category_counts(current, columns, period))
    return found.withColumnRenamed("period", period)


def ranked_categories(reference: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, category, n_ref, rows_ref, place): the reference's categories, place 1 being the most frequent.

    Categories of one count are told apart by hash slices, numbered slice by slice,
    so a column of as many categories as rows is not ranked in one task.
    """
    ref = long_categorical(reference, columns).groupBy("feature", "category").agg(F.count("*").alias("n_ref"))
    slices = int(reference.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ref = ref.withColumn("slice", F.pmod(F.xxhash64("category"), F.lit(slices)))
    sizes = ref.groupBy("feature", "n_ref", "slice").agg(F.count("*").alias("here"))
    before = Window.partitionBy("feature").orderBy(F.desc("n_ref"), "slice").rowsBetween(Window.unboundedPreceding, -1)
    rows = F.sum(F.col("here") * F.col("n_ref")).over(Window.partitionBy("feature"))
    sizes = sizes.select("feature", "n_ref", "slice", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("ahead"), rows.alias("rows_ref"))
    inside = F.row_number().over(Window.partitionBy("feature", "n_ref", "slice").orderBy("category"))
    placed = ref.withColumn("inside", inside).join(sizes, ["feature", "n_ref", "slice"])
    return placed.select("feature", "category", "n_ref", "rows_ref", (F.col("ahead") + F.col("inside")).alias("place"))


def category_counts(df: DataFrame, columns: Sequence[str], period: str) -> DataFrame:
    """(period, feature, category, n_cur): what drift needs to know of the categorical columns."""
    cells = long_categorical(df, columns, F.col(period).alias("period")).filter("period IS NOT NULL")
    return cells.groupBy("period", "feature", "category").agg(F.count("*").alias("n_cur"))


def first_lacking(held: DataFrame, keys: Sequence[str], block: int = 10_000) -> DataFrame:
    """(keys, place): the first place from 1 on that the rows (keys, place) of a key do not hold.

    Places are counted in blocks first; only the first block with a gap is looked
    through, so no task sees more than a block and one row per block.
    """
    keys = list(keys)
    blocked = held.withColumn("block", F.floor((F.col("place") - 1) / block))
    sizes = blocked.groupBy(*keys, "block").agg(F.count("*").alias("here"))
    along = Window.partitionBy(*keys).orderBy("block")
    # Before the first gap, the blocks are full and their numbers are their ranks.
    whole = (F.col("here") == block) & (F.col("block") == F.row_number().over(along) - 1)
    sizes = sizes.withColumn("broken", F.max(F.when(~whole, 1).otherwise(0)).over(along))
    gaps = sizes.groupBy(*keys).agg(F.count_if(F.col("broken") == 0).alias("gap"))
    inside = blocked.join(gaps, keys).filter("block = gap")
    inside = inside.withColumn("next", F.col("gap") * block + F.row_number().over(Window.partitionBy(*keys).orderBy("place")))
    found = inside.groupBy(*keys).agg(F.min(F.when(F.col("place") > F.col("next"), F.col("next"))).alias("missed"), (F.max("next") + 1).alias("after"))
    return gaps.join(found, keys, "left").select(*keys, F.coalesce("missed", "after", F.col("gap") * block + 1).alias("place"))


def categorical_drift_of_counts(ref: DataFrame, cur: DataFrame) -> DataFrame:
    """categorical_drift_by_period from ranked_categories and category_counts."""
    sizes = cur.groupBy("period", "feature").agg(F.sum("n_cur").alias("rows_cur"))
    cells = cur.join(ref.select("feature", "category", "n_ref", "place"), ["feature", "category"], "left").join(sizes, ["period", "feature"])
    cells = cells.join(F.broadcast(ref.groupBy("feature").agg(F.max("rows_ref").alias("rows_ref"))), "feature")
    change = F.abs(ratio(F.col("n_cur"), F.col("rows_cur")) - ratio(F.coalesce("n_ref", F.lit(0)), F.col("rows_ref")))
    found = cells.groupBy("period", "feature").agg(
        F.max(change).alias("present"), F.max("rows_ref").alias("rows_ref"), F.max("rows_cur").alias("rows_cur"),
    )
    held = cells.filter("place IS NOT NULL").select("period", "feature", "place")
    found = found.join(first_lacking(held, ["period", "feature"]), ["period", "feature"], "left").fillna({"place": 1})
    lacking = ref.select("feature", "place", ratio(F.col("n_ref"), F.col("rows_ref")).alias("lacking"))
    found = found.join(lacking, ["feature", "place"], "left")
    return found.select(
        "period", "feature", F.greatest("present", F.coalesce("lacking", F.lit(0.0))).alias("max_proportion_change"), "rows_ref", "rows_cur",
    )


def reported_numeric(found: DataFrame, groups: Sequence[Column], shown: Sequence[tuple[str, int]], threshold_psi: float = PSI_ALERT, threshold_ks: float = KS_ALERT) -> DataFrame:
    """Rows of the drift table, rounded; shown are the columns beside psi and KS with their digits."""
    severity = numeric_severity(F.col("psi"), F.col("ks_pvalue"), threshold_psi, threshold_ks)
    return found.select(
        *groups, "feature", *[F.expr(e) for e in (
            "'numeric' AS type", "bround(psi, 4) AS psi", "bround(ks_statistic, 4) AS ks_statistic",
            "bround(ks_pvalue, 4) AS ks_pvalue", *[f"bround({c}, {n}) AS {c}" for c, n in shown[:1]],
            "CAST(NULL AS DOUBLE) AS max_proportion_change", *[f"bround({c}, {n}) AS {c}" for c, n in shown[1:]],
        )], severity.alias("severity"),
    )


def reported_categorical(found: DataFrame, groups: Sequence[Column], shown: Sequence[tuple[str, int]]) -> DataFrame:
    return found.select(
        *groups, "feature", *[F.expr(e) for e in (
            "'categorical' AS type",
            *[f"CAST(NULL AS DOUBLE) AS {c}" for c in ("psi", "ks_statistic", "ks_pvalue", *[c for c, _ in shown[:1]])],
            "bround(max_proportion_change, 4) AS max_proportion_change", *[f"CAST(NULL AS DOUBLE) AS {c}" for c, _ in shown[1:]],
        )], category_severity(F.col("max_proportion_change")).alias("severity"),
    )


def covariate_shift(
    reference: DataFrame, current: DataFrame, *,
    numeric: Sequence[str] | None = None, categorical: Sequence[str] | None = None,
    exclude: Sequence[str] = (), threshold_psi: float = PSI_ALERT, threshold_ks: float = KS_ALERT,
    period: str | None = None, rows_per_slice: int = ROWS_PER_SLICE, pvalue: str = "asymptotic",
) -> DataFrame:
    """The drift table: one row per feature present in both tables, rounded for reporting.

    With `period` each period of `current` is compared with the whole reference,
    one row per period and feature; areas and moments are then left out.
    """
    skip = [*exclude, *([period] if period else [])]
    auto_numeric, auto_categorical = feature_columns(reference, skip)
    shared = set(current.columns)
    numeric = [c for c in (auto_numeric if numeric is None else numeric) if c in shared]
    categorical = [c for c in (auto_categorical if categorical is None else categorical) if c in shared]
    groups = [F.col(period)] if period else []
    shown = [] if period else [("wasserstein_distance", 4), *((m, 2) for m in MOMENTS)]
    parts = []
    if numeric or not categorical:
        options = {"rows_per_slice": rows_per_slice, "pvalue": pvalue}
        found = numeric_drift_by_period(reference, current, period, numeric, **options) if period else numeric_drift(reference, current, numeric, **options)
        parts.append(reported_numeric(found, groups, shown, threshold_psi, threshold_ks))
    if categorical:
        found = categorical_drift_by_period(reference, current, period, categorical) if period else categorical_drift(reference, current, categorical)
        parts.append(reported_categorical(found, groups, shown))
    table = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return table.withColumn("alert", F.col("severity") != "LOW")


def top_drifted(table: DataFrame, top_n: int = 10) -> DataFrame:
    """Features by drift score: PSI for numeric, share change for categorical ones."""
    score = F.when(F.col("type") == "numeric", F.col("psi")).otherwise(F.col("max_proportion_change"))
    return (
        table.select("feature", score.alias("drift_score"), "severity")
        .orderBy(F.col("drift_score").desc_nulls_last(), "feature")
        .limit(top_n)
    )


def status_of(alerts: Column, concept_alert: Column) -> Column:
    concept = F.coalesce(concept_alert, F.lit(False))
    return (
        F.when((alerts > CRITICAL_ALERTS) | concept, "CRITICAL").when(alerts > 0, "WARNING").otherwise("STABLE")
    )


def period_values(df: DataFrame, period: str) -> list:
    """Sorted distinct periods, for jobs that fit one model per period and so visit them one by one."""
    return sorted(r[0] for r in df.select(period).distinct().filter(F.col(period).isNotNull()).collect())
