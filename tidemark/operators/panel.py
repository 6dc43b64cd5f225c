"""Operators on entity-by-period panels: samples, cohorts, keys, schedules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.scalars import clip, hash_hex, ratio, round_even
from tidemark.operators.order_stats import hash_first, hash_ranked
from tidemark.operators.shape import active_rows, union_rows
from tidemark.operators.temporal import check_periods, period_index
from tidemark.sources.tables import materialized

# Scenario bounds of the retention rate, the monthly tenure step, the mix cap.
SCENARIOS = ("normal", "recession", "growth")
RECESSION_STEP, RECESSION_CEILING = 0.05, 0.95
GROWTH_STEP, GROWTH_FLOOR = 0.05, 0.75
MONTH_OF_YEAR = 1 / 12
PERIOD_DAYS = 30
MIX_CEILING = 0.3
MIX_ROWS = 1000


def scenario_rate(rate: float, scenario: str) -> float:
    """Retention rate under a scenario; unknown names are an error."""
    if scenario not in SCENARIOS:
        raise ValueError(f"unknown scenario {scenario!r}, use one of {SCENARIOS}")
    if scenario == "recession":
        return min(RECESSION_CEILING, rate + RECESSION_STEP)
    if scenario == "growth":
        return max(GROWTH_FLOOR, rate - GROWTH_STEP)
    return rate


def retention_sample(
    df: DataFrame, key: str, rate: float, *, groups: Sequence[str] = (), label: str | None = None,
    scenario: str = "normal", seed: str | int = "",
) -> DataFrame:
    """Exactly floor(n * rate) active rows per group, drawn without replacement by key hash."""
    rows = active_rows(df, label) if label else df
    wanted = F.floor(F.col("group_rows") * F.lit(scenario_rate(rate, scenario)))
    return hash_first(rows, groups, hash_hex(F.col(key), seed=seed), [key], wanted)


def age_cohort(
    df: DataFrame, tenure: str, tenures: Sequence[str] = (), capped: Sequence[str] = (),
    age: str | None = None, month: int = 1,
) -> DataFrame:
    """Roll a cohort forward one month.

    tenure and tenures grow by 1/12 year, rounded to one digit; capped columns
    grow too but stay between 0 and tenure; age grows every twelfth month.
    """
    step = lambda c: round_even(F.col(c).cast("double") + F.lit(MONTH_OF_YEAR), 1)
    grown = {c: step(c) for c in [tenure, *tenures] if c in df.columns}
    for c in capped:
        if c in df.columns:
            # least skips NULL, as a row-wise minimum should; the floor keeps NULL.
            grown[c] = clip(F.least(step(c), grown.get(tenure, F.lit(None).cast("double"))), lower=0.0)
    if age and age in df.columns and month % 12 == 0:
        grown[age] = F.col(age) + 1
    return df.withColumns(grown)


def period_stamp(start: str, index: Column, days: int = PERIOD_DAYS) -> Column:
    """Date of the k-th period: start plus 30 days each."""
    return F.date_add(F.lit(start).cast("date"), (index * days).cast("int"))


def cohort_movement(df: DataFrame, entity: str, period: Column) -> DataFrame:
    """Per period: entities retained from, joined since and left after the one before.

    Each row stands for its own period and for the next one; one aggregation on
    (entity, period) then tells who stayed, came and went. Partial aggregation
    removes repeats before the shuffle and no entity's history is collected.
    """
    check_periods(df, period, 1)
    periods = period_index(df, period)
    placed = df.select(F.col(entity).alias("entity"), period.alias("period")).join(periods, "period")
    both = F.explode(F.array(
        F.struct(F.col("idx"), F.lit(1).alias("here"), F.lit(0).alias("was")),
        F.struct((F.col("idx") + 1).alias("idx"), F.lit(0).alias("here"), F.lit(1).alias("was")),
    ))
    seen = placed.filter("entity IS NOT NULL").select("entity", both.alias("p")).select("entity", "p.*")
    seen = seen.groupBy("entity", "idx").agg(F.max("here").alias("here"), F.max("was").alias("was"))
    moved = seen.groupBy("idx").agg(
        F.expr("count_if(here = 1 AND was = 1)").alias("retained"),
        F.expr("count_if(here = 1 AND was = 0)").alias("joined"),
        F.expr("count_if(here = 0 AND was = 1)").alias("departed"),
        F.expr("count_if(here = 1)").alias("head_count"),
    )
    found = moved.join(periods, "idx").filter("idx > 0")
    earlier = F.col("retained") + F.col("departed")
    return found.select(
        "period", "retained", "joined", "departed", "head_count",
        ratio(F.col("retained"), earlier).alias("retention_rate"),
        (F.col("head_count") - earlier).alias("head_gap"),
    )


def numbered(df: DataFrame, key: str, after: int = 0) -> DataFrame:
    """df with keys after + 1, after + 2, ... without gaps, in the order in which its rows lie.

    The rows are written once with their place in their partition, which is all
    that the numbering needs: a count per partition, and the counts of the
    partitions before. No row is exchanged or sorted, so null, repeated or missing
    order keys are no matter. A partition that is written again is numbered as
    before only if its rows come in the same order, but the keys read are those of
    the files that were kept.
    """
    if key in df.columns:
        df = df.drop(key)
    laid = materialized(df.withColumn("_at", F.monotonically_increasing_id()), "numbered").withColumn("_part", F.shiftright("_at", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition written.
    heads = laid.groupBy("_part").agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    heads = heads.select("_part", (F.lit(after + 1) + F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return laid.join(F.broadcast(heads), "_part").select(*df.columns, (F.col("_at") + F.col("_shift")).alias(key))


def next_keys(df: DataFrame, existing: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """New surrogate keys max(key)+1, +2, ... for the rows of df.

    In hash order of `order`, which gives the same keys on every run, or as the rows lie.
    """
    top = existing.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias("m"))
    if order is None:
        return numbered(df, key, top.first()["m"])
    ranked = hash_ranked(df.drop(key), [], hash_hex(F.col(order)), [order])
    return ranked.withColumn(key, F.col("rank") + top.scalar()).drop("rank", "group_rows")


def ensure_keys(df: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Keys 1..n when the table has none."""
    if key in df.columns:
        return df
    if order is None:
        return numbered(df, key)
    return hash_ranked(df, [], hash_hex(F.col(order)), [order]).withColumnRenamed("rank", key).drop("group_rows")


def mixed_sample(real: DataFrame, extra: DataFrame, key: str, seed: str | int = "") -> DataFrame:
    """All real rows plus the share min(0.3, real rows / 1000) of the extra rows.

    The cap is a scalar subquery, the draw exact and by key hash.
    """
    share = F.least(F.lit(MIX_CEILING), real.agg(F.count("*").alias("n")).scalar() / float(MIX_ROWS))
    wanted = F.floor(F.col("group_rows") * share)
    drawn = hash_first(extra, [], hash_hex(F.col(key), seed=seed), [key], wanted)
    return union_rows(real.withColumn("origin", F.lit("real")), drawn.withColumn("origin", F.lit("extra")))
