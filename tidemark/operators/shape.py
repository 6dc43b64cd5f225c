"""Row and column shaping: drops, labels, alignment, code maps, period slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalars import label_flag

# Text of the ordinal codes, lowest code first and counted from 1.
LEVELS = ("Low", "Medium", "High", "Very High")
ORDINAL_LABELS = {
    "Education": ("Below College", "College", "Bachelor", "Master", "Doctor"),
    "EnvironmentSatisfaction": LEVELS,
    "JobInvolvement": LEVELS,
    "JobSatisfaction": LEVELS,
    "PerformanceRating": ("Low", "Good", "Excellent", "Outstanding"),
    "RelationshipSatisfaction": LEVELS,
    "WorkLifeBalance": ("Bad", "Good", "Better", "Best"),
}


def drop_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns; absent names are ignored."""
    return df.drop(*columns)


def with_label(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Binary label as 1/0, NULL for anything else."""
    return df.withColumn(name or column, label_flag(F.col(column)))


def labelled_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows with a usable label, label as INT."""
    return with_label(df, column).dropna(subset=[column]).withColumn(column, F.col(column).cast("int"))


def align_features(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Exactly the required columns in order; absent ones read 0 or 'Unknown'."""
    have = set(df.columns)
    return df.select(
        *[F.col(c) if c in have else F.lit(0).alias(c) for c in numeric],
        *[F.col(c) if c in have else F.lit("Unknown").alias(c) for c in categorical],
    )


def code_label(code: Column, labels: Sequence[str]) -> Column:
    """Ordinal code 1..n to its text, NULL for other codes."""
    pairs = [F.lit(x) for k, text in enumerate(labels, 1) for x in (k, text)]
    return F.try_element_at(F.create_map(*pairs), code.cast("int"))


def period_slice(df: DataFrame, period: str, value) -> DataFrame:
    return df.filter(F.col(period) == F.lit(value))


def edge_period(df: DataFrame, period: str, last: bool = False) -> DataFrame:
    """Rows of the first or the last period; the bound is a scalar subquery."""
    bound = df.agg((F.max if last else F.min)(period).alias("p")).scalar()
    return df.filter(F.col(period) == bound)


def in_periods(df: DataFrame, period: str, members: DataFrame) -> DataFrame:
    """Rows whose period is in the members table (semi join)."""
    return df.join(members.select(period).distinct(), period, "left_semi")


def active_rows(df: DataFrame, label: str) -> DataFrame:
    """Rows whose label is negative."""
    return df.filter(label_flag(F.col(label)) == 0)


def union_rows(*frames: DataFrame) -> DataFrame:
    """Union by column name; a column absent from a frame is NULL there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
