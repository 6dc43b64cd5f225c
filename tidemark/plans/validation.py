"""Validation of a model over time: walk-forward fits and the leakage comparison."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import AbstractContextManager, nullcontext
from dataclasses import dataclass
from functools import partial, reduce
from threading import BoundedSemaphore

from pyspark.ml import Model
from pyspark.sql import DataFrame, functions as F

from tidemark.functions.concurrent import PARALLELISM, run_all
from tidemark.functions.scalars import label_flag
from tidemark.operators.categories import CategoryCodes, category_codes
from tidemark.operators.drift import period_values
from tidemark.operators.metrics import classification_metrics
from tidemark.operators.model import TrainingStore, feature_stages, fit_forest, fitted, forest, score, with_folds
from tidemark.operators.temporal import LEAKAGE_GAP, metric_summary, performance_by_period, split_plan
from tidemark.sources.tables import materialized

Fit = Callable[[DataFrame], Model]


@dataclass(frozen=True)
class ForestFit:
    """A fitting function for the validators, which take any callable from rows to a model.

    Over several splits of one store it shares what the splits have in common.
    """

    label: str
    numeric: Sequence[str]
    categorical: Sequence[str]
    trees: int = 100
    depth: int = 10
    tried: str = "auto"

    def __call__(self, train: DataFrame) -> Model:
        return fit_forest(train, self.label, self.numeric, self.categorical, self.trees, self.depth, tried=self.tried)

    def over(self, store: TrainingStore, groups: dict[int, Sequence]) -> Callable[[int], Model]:
        """The model of each group of parts; fills of all groups are found together."""
        fills = store.fills(groups, self.numeric, self.categorical)
        codes = store.codes(self.categorical, fills)

        def of_group(group: int) -> Model:
            stages = feature_stages(fills[group], self.numeric, self.categorical, codes[group])
            return fitted(stages, forest(self.trees, self.depth, tried=self.tried), store.training(groups[group]))

        return of_group


def forest_fit(label: str, numeric: Sequence[str], categorical: Sequence[str], trees: int = 100, depth: int = 10, tried: str = "auto") -> ForestFit:
    return ForestFit(label, numeric, categorical, trees, depth, tried)


def codes_of(df: DataFrame, label: str, fit: Fit) -> CategoryCodes | None:
    """The codes of a forest's categories, from all labelled rows."""
    if not isinstance(fit, ForestFit) or not fit.categorical:
        return None
    return category_codes(df.filter(label_flag(F.col(label)).isNotNull()), fit.categorical)


def training_store(df: DataFrame, part: str, label: str, fit: Fit, codes: CategoryCodes | None = None) -> TrainingStore:
    """The rows written by part; for a forest, its columns and the places of its categories."""
    columns = [*fit.numeric, *fit.categorical] if isinstance(fit, ForestFit) else None
    return TrainingStore(df, part, label, columns, codes or codes_of(df, label, fit))


def _models(store: TrainingStore, groups: dict[int, Sequence], fit: Fit) -> Callable[[int], Model]:
    return fit.over(store, groups) if isinstance(fit, ForestFit) else lambda group: fit(store.rows(groups[group]))


def _roles(store: TrainingStore, period: str, n_splits: int, strategy: str) -> dict[int, dict[str, list]]:
    """The train and test periods of each split."""
    plan: dict[int, dict[str, list]] = {}
    for r in split_plan(store.stored, F.col(period), n_splits, strategy).collect():
        plan.setdefault(r["split"], {"train": [], "test": []})[r["role"]].append(r["period"])
    return plan


def walk_forward(
    df: DataFrame, period: str, label: str, fit: Fit, n_splits: int = 5, strategy: str = "expanding",
    store: TrainingStore | None = None, plan: dict[int, dict[str, list]] | None = None, model: Callable[[int], Model] | None = None,
) -> DataFrame:
    """One row per split: train periods and sizes, the test period, and the four metrics.

    The rows are written once by period, or given as a store; splits are pruned
    reads of the same files. The few splits are independent, so their fits are
    submitted side by side. Scored test rows are written once and measured together
    in one job. Walks over one store may share the plan's models.
    """
    store = store or training_store(df, period, label, fit)
    plan = plan or _roles(store, period, n_splits, strategy)
    sizes = {r[0]: r[1] for r in store.stored.groupBy(period).count().collect()}
    model = model or _models(store, {split: roles["train"] for split, roles in plan.items()}, fit)

    def scored_split(split: int, train: list, test: list) -> DataFrame:
        tested = score(model(split), store.rows(test), [period, label])
        return tested.withColumns({
            "split": F.lit(split), "train_periods": F.lit(len(train)), "train_period_list": F.lit(",".join(map(str, sorted(train)))),
            "train_size": F.lit(sum(sizes[p] for p in train)).cast("bigint"),
        })

    splits = run_all([partial(scored_split, split, roles["train"], roles["test"]) for split, roles in sorted(plan.items())])
    scored = materialized(reduce(DataFrame.unionByName, splits), "walk")
    metrics = classification_metrics(scored, ["split"], label, "probability", "prediction")
    # One row per split on both sides.
    info = scored.groupBy("split").agg(
        *[F.max(c).alias(c) for c in ("train_periods", "train_period_list", "train_size")],
        F.max(F.col(period).cast("string")).alias("test_period"), F.count("*").alias("test_size"),
    )
    return info.join(metrics.drop("n_samples", "tn", "fp", "fn", "tp"), "split").withColumn("strategy", F.lit(strategy))


def fold_metrics(df: DataFrame, label: str, key: str, fit: Fit, folds: int, codes: CategoryCodes | None = None, slots: AbstractContextManager = nullcontext()) -> DataFrame:
    """The random-split baseline: stratified folds, metrics per fold. A fit takes one of the slots."""
    usable = df.filter(label_flag(F.col(label)).isNotNull())
    store = training_store(with_folds(usable, label, key, folds), "fold", label, fit, codes or codes_of(usable, label, fit))
    model = _in_slots(_models(store, {k: [i for i in range(folds) if i != k] for k in range(folds)}, fit), slots)

    def scored_fold(k: int) -> DataFrame:
        return score(model(k), store.rows([k]), ["fold", label])

    scored = reduce(DataFrame.unionByName, run_all([partial(scored_fold, k) for k in range(folds)]))
    return classification_metrics(materialized(scored, "fold-scores"), ["fold"], label, "probability", "prediction")


def _in_slots(model: Callable[[int], Model], slots: AbstractContextManager) -> Callable[[int], Model]:
    def of_group(group: int) -> Model:
        with slots:
            return model(group)

    return of_group


def compare_strategies(df: DataFrame, period: str, label: str, key: str, fit: Fit, n_splits: int = 5) -> DataFrame:
    """Summary per strategy (expanding, rolling, random) and the leakage flag.

    Both walks read one store and find their fills together; the folds take the
    same category codes. The strategies run side by side, their fits in as many
    slots as one of them alone would have.
    """
    codes, slots = codes_of(df, label, fit), BoundedSemaphore(PARALLELISM)

    def walks() -> list[DataFrame]:
        store = training_store(df, period, label, fit, codes)
        plans = [_roles(store, period, n_splits, s) for s in ("expanding", "rolling")]
        # Numbered on from one walk to the next.
        groups = {i * n_splits + split: roles["train"] for i, plan in enumerate(plans) for split, roles in plan.items()}
        model = _in_slots(_models(store, groups, fit), slots)

        def walk(i: int, strategy: str) -> DataFrame:
            return walk_forward(df, period, label, fit, n_splits, strategy, store, plans[i], lambda split: model(i * n_splits + split))

        return run_all([partial(walk, i, s) for i, s in enumerate(("expanding", "rolling"))])

    (expanding, rolling), random = run_all([walks, partial(fold_metrics, df, label, key, fit, n_splits, codes, slots)])
    found = {"expanding": expanding, "rolling": rolling, "random": random}
    table = reduce(DataFrame.unionByName, [metric_summary(metrics).withColumn("strategy", F.lit(s)) for s, metrics in found.items()])
    table = materialized(table, "strategies")
    gap = table.agg(F.abs(
        F.max(F.when(F.col("strategy") == "random", F.col("mean_roc_auc")))
        - F.max(F.when(F.col("strategy") == "expanding", F.col("mean_roc_auc")))
    ).alias("g")).scalar()
    return table.withColumn("leakage_gap", gap).withColumn("leakage", F.col("leakage_gap") > LEAKAGE_GAP)


def decay_after_training(df: DataFrame, period: str, label: str, fit: Fit, first_periods: int = 3) -> DataFrame:
    """Train on the first k periods and follow the metrics over all of them."""
    periods = period_values(df, period)
    model = fit(df.filter(F.col(period).isin(*periods[:first_periods])))
    scored = materialized(score(model, df, [period, label]), "decay")
    return performance_by_period(scored, period, label, "probability", "prediction")
