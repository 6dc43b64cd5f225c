"""What-if versions of an existing table, to see whether a monitor reacts.

Draws come from a hash of the row key, so a rerun changes the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalars import clip, hash_uniform, weighted_choice

# One step down an ordinal scale.
DOWNGRADE = {"Very High": "High", "High": "Medium", "Medium": "Low", "Low": "Low"}

# Risk of leaving by scenario and the additions per risk factor.
BASE_RISK = {"normal": 0.12, "recession": 0.08, "growth": 0.18}
RISK_LOW_SATISFACTION = 0.25
RISK_OVERTIME = 0.15
RISK_LOW_INCOME, LOW_INCOME = 0.20, 3500
RISK_SHORT_TENURE, SHORT_TENURE = 0.15, 1
RISK_HEADHUNTED, HEADHUNTED_RATING = 0.40, 3
RISK_CEILING = 0.95

# Scenario factors on the base risk, and what each scenario overwrites.
SCENARIO_BASE = 0.12
SCENARIO_FACTOR = {
    "Normal Operation": 1.0,
    "The Great Resignation": 2.5,
    "Economic Recession": 1.8,
    "Toxic Culture Shift": 3.0,
    "Competitor Headhunting": 2.2,
}
TOXIC_JOB_SATISFACTION = {1: 0.6, 2: 0.4}
RESIGNATION_OVERTIME = {"Yes": 0.8, "No": 0.2}
RECESSION_HIKE_BELOW = 5
RECESSION_INCOME_FACTOR = 0.8


def scale_numeric(df: DataFrame, column: str, rate: Column | float) -> DataFrame:
    """x * (1 + rate), cut to a whole number."""
    return df.withColumn(column, (F.col(column) * (1 + (rate if isinstance(rate, Column) else F.lit(rate)))).cast("bigint"))


def downgrade(value: Column, steps: dict[str, str] = DOWNGRADE) -> Column:
    """One step down; values outside the scale pass through."""
    pairs = [F.lit(x) for pair in steps.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), value)


def lower_ordinal(df: DataFrame, column: str, rate: Column | float, key: str, seed: str | int = "", steps: dict[str, str] = DOWNGRADE) -> DataFrame:
    """Downgrade each row with probability |rate| when rate is negative; else change nothing."""
    rate = rate if isinstance(rate, Column) else F.lit(rate)
    hit = (rate < 0) & (hash_uniform(F.col(key), seed=seed) < F.abs(rate))
    return df.withColumn(column, F.when(hit, downgrade(F.col(column), steps)).otherwise(F.col(column)))


def raise_flag(df: DataFrame, column: str, rate: Column | float, key: str, seed: str | int = "", value: str = "Yes") -> DataFrame:
    """Set the flag with the given probability."""
    rate = rate if isinstance(rate, Column) else F.lit(rate)
    hit = hash_uniform(F.col(key), seed=seed) < rate
    return df.withColumn(column, F.when(hit, value).otherwise(F.col(column)))


def risk_score(
    base: float, *, satisfaction_low: Column | None = None, overtime: Column | None = None,
    income: Column | None = None, tenure: Column | None = None, headhunted: Column | None = None,
) -> Column:
    """Sum of the risk terms whose inputs exist, limited to [0, 0.95]."""
    terms = [
        (satisfaction_low, RISK_LOW_SATISFACTION),
        (overtime, RISK_OVERTIME),
        (None if income is None else income < LOW_INCOME, RISK_LOW_INCOME),
        (None if tenure is None else tenure < SHORT_TENURE, RISK_SHORT_TENURE),
        (headhunted, RISK_HEADHUNTED),
    ]
    total = F.lit(float(base))
    for condition, weight in terms:
        if condition is not None:
            total = total + F.when(condition, weight).otherwise(0.0)
    return clip(total, 0.0, RISK_CEILING)


def with_risk(df: DataFrame, risk: Column, key: str, seed: str | int = "") -> DataFrame:
    """Risk and the label drawn from it."""
    drawn = F.when(hash_uniform(F.col(key), seed=seed) < F.col("risk"), "Yes").otherwise("No")
    return df.withColumn("risk", risk).withColumn("drawn_label", drawn)


def scenario_base(scenario: str) -> float:
    """Base risk of a business scenario."""
    if scenario in BASE_RISK:
        return BASE_RISK[scenario]
    if scenario in SCENARIO_FACTOR:
        return SCENARIO_BASE * SCENARIO_FACTOR[scenario]
    raise ValueError(f"unknown scenario {scenario!r}")


def redraw_category(df: DataFrame, column: str, weights: dict, key: str, seed: str | int = "") -> DataFrame:
    """Replace a column by a draw from a weighted list."""
    return df.withColumn(column, weighted_choice(hash_uniform(F.col(key), seed=seed), weights))


def redraw_range(df: DataFrame, column: str, low: int, high: int, key: str, seed: str | int = "") -> DataFrame:
    """Replace a column by a whole number in [low, high)."""
    drawn = F.floor(hash_uniform(F.col(key), seed=seed) * (high - low)) + low
    return df.withColumn(column, drawn.cast("bigint"))


def apply_schedule(
    df: DataFrame, period_index: Column, schedule: Sequence[dict | None], *, key: str,
    numeric: str | None = None, ordinal: str | None = None, flag: str | None = None,
    seed: str | int = "", steps: dict[str, str] = DOWNGRADE,
) -> DataFrame:
    """Apply per-period drift: entry k of the schedule to rows of period index k.

    Entries may hold 'scale', 'downgrade' (negative) and 'flag' rates. The
    schedule is an argument, so it becomes constants in one projection.
    """
    def rate(name: str) -> Column:
        out = F.lit(0.0)
        for k, entry in enumerate(schedule):
            if entry and name in entry:
                out = F.when(period_index == k, F.lit(float(entry[name]))).otherwise(out)
        return out

    if numeric:
        df = df.withColumn("_rate", rate("scale"))
        changed = (F.col(numeric) * (1 + F.col("_rate"))).cast("bigint").cast(df.schema[numeric].dataType)
        df = df.withColumn(numeric, F.when(F.col("_rate") != 0, changed).otherwise(F.col(numeric))).drop("_rate")
    if ordinal:
        df = lower_ordinal(df, ordinal, rate("downgrade"), key, f"{seed}ordinal", steps)
    if flag:
        df = raise_flag(df, flag, rate("flag"), key, f"{seed}flag")
    return df
