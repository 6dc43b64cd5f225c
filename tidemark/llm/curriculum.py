"""Mixing sources to target weights along a curriculum."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.text import WORD, apart
from tidemark.sources.tables import materialized

#: Weights of the sources in code point order, repeated.
WEIGHTS = (5, 2, 1)

#: For each weight, its schedule: (time, intensity) knots over training time 0 to 1, linear in between.
#: Heavy sources come early and fade, light ones are held back for the end.
SCHEDULES = {
    5: ((0.0, 2.0), (0.5, 1.0), (1.0, 0.5)),
    2: ((0.0, 1.0), (1.0, 1.0)),
    1: ((0.0, 0.25), (0.5, 1.0), (1.0, 2.0)),
}


def source_targets(sizes: DataFrame, share: float = 1.5, limit: float = 2.0, weights: tuple = WEIGHTS) -> DataFrame:
    """(mix_source, source_size, weight, target) from one row of mix_source and source_size per source.

    The sources share share times all sizes by weight; no target exceeds limit
    times its source's size, and what is cut is shared again by weight until none
    is above. That is one level for all: target = least(limit * size, level *
    weight). Sources ordered by limit * size / weight reach their limit in this
    order, so the level follows from running sums. One row per source passes
    through a single task here, whatever the number of documents.
    """
    ordered = Window.orderBy(F.col("mix_source").asc_nulls_last())
    options = F.array(*(F.lit(w) for w in weights))
    weighed = sizes.withColumn("weight", F.element_at(options, ((F.row_number().over(ordered) - 1) % len(weights) + 1).cast("int")))
    capped = weighed.withColumn("cap", limit * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    rising = Window.orderBy("ratio", F.col("mix_source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    after = rising.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    budget = share * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = capped.withColumn("own_level", budget / F.sum("weight").over(after))
    level = level.withColumn("level", F.max(F.when(F.col("own_level") <= F.col("ratio"), F.col("own_level"))).over(whole))
    target = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return level.select("mix_source", "source_size", "weight", target.alias("target"))


def arrival(weight: Column, demand: Column, schedules: dict = SCHEDULES) -> Column:
    """The training time at which a source of this weight has asked for the given part (0 to 1) of its words.

    The schedule is integrated piece by piece; in the piece that holds the demand
    the quadratic is inverted in the form that does not cancel.
    """
    out = F.lit(None).cast("double")
    for w, knots in schedules.items():
        pieces, total = [], 0.0
        for (t0, a), (t1, b) in zip(knots, knots[1:]):
            pieces.append((t0, a, (b - a) / (t1 - t0), total))
            total += (a + b) / 2 * (t1 - t0)
        time = None
        for t0, a, slope, done in pieces:
            rest = demand * F.lit(total) - F.lit(done)
            here = F.lit(t0) + 2 * rest / (F.lit(a) + F.sqrt(F.greatest(F.lit(a * a) + 2 * slope * rest, F.lit(0.0))))
            time = here if time is None else F.when(rest >= 0, here).otherwise(time)
        out = F.when(weight == w, F.least(F.greatest(time, F.lit(0.0)), F.lit(1.0))).otherwise(out)
    return out


def sized(docs: DataFrame) -> DataFrame:
    """docs with mix_source, mix_size (words of the whole text, null: 0) and mix_order, a hash of doc_id."""
    return docs.withColumns({
        "mix_source": F.col("source").cast("string"),
        "mix_size": F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint"),
        "mix_order": F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))),
    })


def mixed(rows: DataFrame, stats: DataFrame | None = None, share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """rows (as from sized, other columns are kept) with mix_weight, mix_source_size, mix_target, mix_copies and mix_positions.

    Documents of a source queue up in hash order and are asked for by the source's
    schedule: all of them as often as the target covers the source wholly, then
    those at the front once more, as far as the rest of the target reaches to the
    half of a document. So a source's words come within half a document of its
    target, and nothing is cut. mix_positions holds one training position per
    copy, by inverting the cumulative demand.

    stats is a table with the same mix_ columns to read for the sums, when rows is
    costly to compute twice. Running sums are taken within slices of the hash
    order, about the square root of the table's rows per source, so a source that
    holds a third of all rows is spread over as many tasks. Null sources are one
    source, null texts have no words, repeated rows are documents of their own,
    ties of the hash are ordered by doc_id and size. An empty table stays empty.
    """
    stats = rows if stats is None else stats
    digits = max(1, math.ceil(math.log(max(stats.count(), 2), 16) / 2))
    cut = lambda df: df.withColumn("mix_slice", F.substring("mix_order", 1, digits))
    slices = cut(stats).groupBy("mix_source", "mix_slice").agg(F.sum("mix_size").alias("n"))
    targets = source_targets(slices.groupBy("mix_source").agg(F.sum("n").alias("source_size")), share, limit)
    before = Window.partitionBy("mix_source").orderBy("mix_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = slices.select("mix_source", "mix_slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    s, t = shifts.alias("s"), targets.alias("t")
    shifts = s.join(t, F.expr("s.mix_source <=> t.mix_source")).select(
        F.col("s.mix_source").alias("for_source"), F.col("s.mix_slice").alias("for_slice"), "shift",
        F.col("source_size").alias("mix_source_size"), F.col("weight").alias("mix_weight"), F.col("target").alias("mix_target"),
    )
    rows = cut(rows)
    joined = rows.join(shifts, rows["mix_source"].eqNullSafe(shifts["for_source"]) & (rows["mix_slice"] == shifts["for_slice"]))
    ahead = Window.partitionBy("mix_source", "mix_slice").orderBy("mix_order", "doc_id", "mix_size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("shift") + F.coalesce(F.sum("mix_size").over(ahead), F.lit(0))
    whole = F.when(F.col("mix_source_size") > 0, F.floor(F.col("mix_target") / F.col("mix_source_size"))).otherwise(1)
    placed = joined.withColumn("mix_start", start).withColumn("mix_whole", whole.cast("int"))
    rest = F.col("mix_target") - F.col("mix_whole") * F.col("mix_source_size")
    more = (F.col("mix_size") > 0) & (2 * F.col("mix_start") + F.col("mix_size") <= 2 * rest)
    placed = placed.withColumn("mix_copies", F.col("mix_whole") + more.cast("int"))
    demand = lambda n: F.when(F.col("mix_target") > 0, F.least((n * F.col("mix_source_size") + F.col("mix_start")) / F.col("mix_target"), F.lit(1.0))).otherwise(0.0)
    times = F.transform(F.sequence(F.lit(0), F.lit(int(limit))), lambda n: arrival(F.col("mix_weight"), demand(n)))
    placed = placed.withColumn("mix_positions", F.slice(times, 1, F.col("mix_copies")))
    return placed.drop("for_source", "for_slice", "shift", "mix_slice", "mix_start", "mix_whole")


def training_order(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns, one row per copy, in the order of training positions."""
    copies = rows.withColumn("mix_position", F.explode("mix_positions"))
    return copies.repartitionByRange("mix_position", "mix_order").sortWithinPartitions("mix_position", "mix_order").select(*columns)


def mixture(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken, first_position) per document, in the order of positions."""
    narrow = sized(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", "text")).drop("source", "text")
    rows = mixed(materialized(narrow, "sizes"))
    found = rows.select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.round("mix_target", 6).alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
        F.round(F.try_element_at("mix_positions", F.lit(1)), 6).alias("first_position"),
    )
    return found.repartitionByRange("first_position", "doc_id").sortWithinPartitions("first_position", "doc_id")


@apart
def drawn(docs: DataFrame) -> DataFrame:
    """The documents that the mix takes, whole, each as often as it is taken, in training order."""
    return training_order(mixed(sized(docs), materialized(sized(docs).select("mix_source", "mix_size", "mix_order"), "sizes")), docs.columns)
