"""A/B comparison of two panels: metrics, drift, realism and a scorecard."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.concurrent import run_all
from tidemark.operators.metrics import classification_metrics
from tidemark.operators.profile import baseline_deviation, entity_continuity, label_stability
from tidemark.operators.temporal import LEAKAGE_GAP, metric_summary
from tidemark.operators.drift import period_values
from tidemark.plans.report import first_last_drift
from tidemark.plans.training import random_split_evaluation
from tidemark.plans.validation import forest_fit, training_store, walk_forward
from tidemark.sources.tables import materialized

# Points per criterion of the scorecard.
POINTS_LEAKAGE = 2
POINTS_CONTINUITY = 2
POINTS_STABILITY = 1
POINTS_TEMPORAL = 2


@dataclass
class Panel:
    """A panel and the roles of its columns. entity may be None."""

    name: str
    rows: DataFrame
    period: str
    label: str
    key: str
    entity: str | None
    numeric: Sequence[str]
    categorical: Sequence[str]
    measure: str
    most_splits: int = 4


def panel_facts(panel: Panel, baseline: DataFrame, trees: int = 100, depth: int = 10, tried: str = "auto") -> DataFrame:
    """One row with everything the scorecard needs.

    The rows are written once by period: the walk, the label rates and the drift
    between the first and the last period read the files of their own periods.
    """
    rows = panel.rows
    held_out, _ = random_split_evaluation(rows, panel.label, panel.key, panel.numeric, panel.categorical, trees, depth, tried)
    random = classification_metrics(held_out, [], panel.label, "probability", "prediction")
    fit = forest_fit(panel.label, panel.numeric, panel.categorical, trees, depth, tried)
    store = training_store(rows, panel.period, panel.label, fit)
    periods = period_values(store.stored, panel.period)
    splits = min(panel.most_splits, len(periods) - 1)
    walked = metric_summary(walk_forward(rows, panel.period, panel.label, fit, splits, store=store))
    drift = first_last_drift(store.rows(sorted({*periods[:1], *periods[-1:]})).select(panel.period, *panel.numeric, *panel.categorical), panel.period)
    stability = label_stability(store.stored, F.col(panel.period), panel.label)
    # Written first: the optimizer cannot merge this one's inner scalar with the others below.
    deviation = materialized(baseline_deviation(rows, baseline, panel.measure), "deviation")
    facts = {
        "random_auc": random.select("roc_auc").scalar(), "random_f1": random.select("f1_score").scalar(),
        "temporal_auc": walked.select("mean_roc_auc").scalar(), "temporal_f1": walked.select("mean_f1_score").scalar(),
        "covariate_alerts": drift.agg(F.count_if("alert").alias("n")).scalar(),
        "label_cv": stability.select("cv").scalar(), "measure_deviation": deviation.select("deviation").scalar(),
        "continuity": F.lit(None).cast("double") if panel.entity is None else
        entity_continuity(rows, panel.entity, F.col(panel.period)).select("continuity_score").scalar(),
    }
    one = rows.sparkSession.range(1).select(F.lit(panel.name).alias("panel"))
    return one.withColumns(facts).withColumn(
        "leakage_gap", F.abs(F.col("random_auc") - F.col("temporal_auc"))
    ).withColumn("leakage", F.col("leakage_gap") > LEAKAGE_GAP)


def scorecard(facts: DataFrame, first: str, second: str) -> DataFrame:
    """Points of both panels; the second wins only with strictly more."""
    pick = lambda name, c: F.max(F.when(F.col("panel") == name, F.col(c)))
    wide = facts.agg(*[
        pick(n, c).alias(f"{c}_{side}")
        for side, n in (("a", first), ("b", second)) for c in ("leakage_gap", "label_cv", "temporal_auc", "continuity")
    ])
    b_leak = F.coalesce(F.col("leakage_gap_b") < F.col("leakage_gap_a"), F.lit(False))
    b_stable = F.coalesce(F.col("label_cv_b") < F.col("label_cv_a"), F.lit(False))
    b_auc = F.coalesce(F.col("temporal_auc_b") > F.col("temporal_auc_a"), F.lit(False))
    award = lambda won, points: F.when(won, points).otherwise(0)
    score_b = (
        award(b_leak, POINTS_LEAKAGE) + award(F.col("continuity_b").isNotNull(), POINTS_CONTINUITY)
        + award(b_stable, POINTS_STABILITY) + award(b_auc, POINTS_TEMPORAL)
    )
    score_a = award(~b_leak, POINTS_LEAKAGE) + award(~b_stable, POINTS_STABILITY) + award(~b_auc, POINTS_TEMPORAL)
    return wide.select(score_a.alias("score_first"), score_b.alias("score_second")).withColumn(
        "winner", F.when(F.col("score_second") > F.col("score_first"), second).otherwise(first)
    )


def compare_panels(a: Panel, b: Panel, baseline: DataFrame, trees: int = 100, depth: int = 10, tried: str = "auto") -> tuple[DataFrame, DataFrame]:
    """(facts per panel, scorecard)."""
    facts = run_all([partial(panel_facts, p, baseline, trees, depth, tried) for p in (a, b)])
    facts = materialized(facts[0].unionByName(facts[1]), "facts")
    return facts, scorecard(facts, a.name, b.name)
