"""Entities of periods as mergeable sketches, for movement between any two periods.

The exact forms in `panel` follow consecutive periods and read the rows. These
read one sketch per period, which can be kept, merged and compared at any time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# 2**12 hashes are kept per sketch, 32 KB; up to so many entities the counts are exact.
DIGITS = 12


def period_sketches(df: DataFrame, entity: str, period: Column, digits: int = DIGITS) -> DataFrame:
    """(period, sketch): the distinct entities of each period; NULL entities and periods count nowhere."""
    rows = df.select(period.alias("period"), F.col(entity).alias("entity")).filter("period IS NOT NULL AND entity IS NOT NULL")
    return rows.groupBy("period").agg(F.theta_sketch_agg("entity", F.lit(digits)).alias("sketch"))


def merged_sketches(sketches: DataFrame, period: Column, digits: int = DIGITS) -> DataFrame:
    """Sketches of coarser periods, such as quarters of months, without the rows."""
    return sketches.groupBy(period.alias("period")).agg(F.theta_union_agg("sketch", F.lit(digits)).alias("sketch"))


def sketched_movement(sketches: DataFrame, pairs: DataFrame | None = None, digits: int = DIGITS) -> DataFrame:
    """(earlier, later, retained, joined, departed, head_count, together, bound) of pairs of periods.

    pairs holds (earlier, later) rows in any order; without it every period meets
    all later ones, of which there are few beside the rows. Counts are estimates
    unless a pair has no more than 2**digits entities together. Each is off by more
    than bound, three standard errors of the union's size, in few of a thousand cases.
    """
    early = sketches.select(F.col("period").alias("earlier"), F.col("sketch").alias("a"))
    late = sketches.select(F.col("period").alias("later"), F.col("sketch").alias("b"))
    if pairs is None:
        both = early.join(late, F.col("earlier") < F.col("later"))
    else:
        both = pairs.select("earlier", "later").join(early, "earlier").join(late, "later")
    size = lambda sketch: F.theta_sketch_estimate(sketch)
    together = size(F.theta_union("a", "b", F.lit(digits)))
    return both.select(
        "earlier", "later", size(F.theta_intersection("a", "b")).alias("retained"), size(F.theta_difference("b", "a")).alias("joined"),
        size(F.theta_difference("a", "b")).alias("departed"), size(F.col("b")).alias("head_count"), together.alias("together"),
        F.when(together <= 2**digits, 0.0).otherwise(3 * together / 2 ** (digits / 2)).alias("bound"),
    )
