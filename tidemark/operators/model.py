"""Training and scoring with pyspark.ml."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial, reduce
from itertools import product

from pyspark import StorageLevel
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.concurrent import run_all
from tidemark.functions.scalars import as_double, hash_hex, hash_uniform, label_flag
from tidemark.functions.sqltext import name, number, text
from tidemark.operators.categories import CategoryCodes, category_codes
from tidemark.operators.drift import long_categorical, long_numeric
from tidemark.operators.order_stats import (
    ROWS_PER_SLICE, cuts_by_feature, quantiles_of_slices, with_cutoffs, with_feature_slice,
)
from tidemark.operators.metrics import classification_metrics
from tidemark.operators.shape import align_features
from tidemark.sources.tables import materialized, new_path

# The classifier's settings and the parameter grids.
TREES = 100
SEED = 42
TEST_SHARE = 0.2
FOLDS = 3
UNLIMITED_DEPTH = 30
GRID = {"numTrees": [100], "maxDepth": [10, UNLIMITED_DEPTH]}
NOISE = 0.05


def numeric_fill(df: DataFrame, columns: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """(feature, median, mean, std_pop, n_missing): exact median, and moments after filling with it."""
    long = long_numeric(df, columns)
    counts = {r["feature"]: r["n"] for r in long.groupBy("feature").agg(F.count("*").alias("n")).collect()}
    cells = long.select("*", F.lit(1).cast("bigint").alias("n"), F.lit(0).alias("slice"))
    cells = with_feature_slice(cells, "value", cuts_by_feature(long, counts, rows_per_slice))
    medians = quantiles_of_slices(cells, ["feature"], {"median": 0.5})
    fields = {f.name: f.dataType for f in df.schema.fields}
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), as_double(F.col(c), fields[c]).alias("value")) for c in columns])
    rows = df.select(F.explode(pairs).alias("c")).select("c.*")
    # One row per named column.
    filled = rows.join(F.broadcast(medians), "feature").withColumn("x", F.coalesce("value", "median"))
    return filled.groupBy("feature").agg(
        F.max("median").alias("median"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("std_pop"),
        F.count_if(F.col("value").isNull()).alias("n_missing"),
    )


def category_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, mode, n): most frequent category, the smallest one on ties."""
    counts = long_categorical(df, columns).groupBy("feature", "category").agg(F.count("*").alias("n"))
    best = F.min_by(F.struct("category", "n"), F.struct((-F.col("n")).alias("a"), F.col("category").alias("b")))
    return counts.groupBy("feature").agg(best.alias("m")).select("feature", F.col("m.category").alias("mode"), "m.n")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (classes * n_class) per class."""
    counts = df.select(label_flag(F.col(label)).alias("label")).filter("label IS NOT NULL").groupBy("label").agg(F.count("*").alias("n"))
    shape = counts.agg(F.struct(F.sum("n").alias("total"), F.count("*").alias("classes")).alias("s")).scalar()
    sized = counts.withColumn("s", shape)
    return sized.select("label", "n", (F.col("s.total") / (F.col("s.classes") * F.col("n"))).alias("weight"))


def with_weights(df: DataFrame, label: str) -> DataFrame:
    """Add the balanced weight as a column; two classes, so two constants."""
    weights = {r["label"]: r["weight"] for r in class_weights(df, label).collect()}
    flag = label_flag(F.col(label))
    out: Column = F.lit(1.0)
    for value, weight in weights.items():
        out = F.when(flag == value, F.lit(weight)).otherwise(out)
    return df.withColumn("weight", out)


def stratified_split(df: DataFrame, label: str, key: str, test_share: float = TEST_SHARE, seed: str | int = SEED) -> tuple[DataFrame, DataFrame]:
    """(train, test) with exactly floor(n * share) test rows of each class, by key hash.

    A NULL label is a class of its own. Rows that repeat a key stay on one side.

    Both are filters on the table: no row is shuffled or joined to another.
    """
    marked = with_split(df, label, key, test_share, seed)
    return marked.filter(~F.col("is_test")).drop("is_test"), marked.filter("is_test").drop("is_test")


def with_split(df: DataFrame, label: str, key: str, test_share: float = TEST_SHARE, seed: str | int = SEED) -> DataFrame:
    """The split as a column: is_test."""
    placed = with_cutoffs(df, [label], hash_hex(F.col(key), seed=seed), [key], [F.floor(F.col("group_rows") * test_share)])
    inside = F.coalesce(F.col("place") <= F.col("cut_0"), F.lit(False))
    return placed.withColumn("is_test", inside).select(*df.columns, "is_test")


def with_folds(df: DataFrame, label: str, key: str, folds: int = FOLDS, seed: str | int = SEED) -> DataFrame:
    """Stratified fold number 0..folds-1: equal stretches of each class in hash order.

    A NULL label is a class of its own. Rows that repeat a key share a fold.
    """
    wanted = [F.floor(F.col("group_rows") * F.lit(k) / folds) for k in range(1, folds)]
    placed = with_cutoffs(df, [label], hash_hex(F.col(key), seed=seed), [key], wanted)
    passed = F.lit(0)
    for i in range(len(wanted)):
        passed = passed + F.when(F.col(f"cut_{i}").isNull() | (F.col("place") > F.col(f"cut_{i}")), 1).otherwise(0)
    return placed.withColumn("fold", passed).select(*df.columns, "fold")


@dataclass(frozen=True)
class Fills:
    """What features need to know of the training rows: (median, mean, deviation) per number, the mode per category."""

    numbers: dict[str, tuple[float | None, float | None, float | None]]
    modes: dict[str, str]

    def mode(self, column: str) -> str:
        return self.modes.get(column, "Unknown")


def fills_of(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> Fills:
    numbers = {r["feature"]: (r["median"], r["mean"], r["std_pop"]) for r in numeric_fill(train, numeric).collect()} if numeric else {}
    modes = {r["feature"]: r["mode"] for r in category_fill(train, categorical).collect()} if categorical else {}
    return Fills(numbers, modes)


def feature_stages(fills: Fills, numeric: Sequence[str], categorical: Sequence[str], codes: CategoryCodes | None = None) -> list:
    """Median fill + standardization of numbers, mode fill + one-hot of categories by their codes.

    Fills and scales are constants. A category unseen in training becomes the all-zero vector.
    """
    columns, parts = [], []
    for c in numeric:
        fill, mean, std = fills.numbers.get(c, (0.0, 0.0, 1.0))
        columns.append(f"(coalesce(nanvl(cast({name(c)} AS double), NULL), {number(fill)}) - {number(mean)}) / {number(std or 1.0)} AS {name(c + '_scaled')}")
        parts.append(f"{c}_scaled")
    if categorical:
        columns += [f"coalesce(cast({name(c)} AS string), {text(fills.mode(c))}) AS {name(c + '_text')}" for c in categorical]
    stages = [SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__")]
    if categorical:
        stages += [
            codes,
            OneHotEncoder(inputCols=[f"{c}_index" for c in categorical], outputCols=[f"{c}_vector" for c in categorical], handleInvalid="keep", dropLast=True),
        ]
        parts += [f"{c}_vector" for c in categorical]
    return stages + [VectorAssembler(inputCols=parts, outputCol="features", handleInvalid="keep")]


def forest(trees: int = TREES, depth: int = UNLIMITED_DEPTH, min_rows: int = 1, seed: int = SEED, tried: str = "auto") -> RandomForestClassifier:
    """tried: the features tried at each node, "auto" for the square root of their number, "all" for every one."""
    return RandomForestClassifier(
        featuresCol="features", labelCol="label", weightCol="weight", numTrees=trees, maxDepth=depth,
        minInstancesPerNode=min_rows, seed=seed, featureSubsetStrategy=tried,
    )


def fitted(stages: Sequence, estimator: RandomForestClassifier, rows: DataFrame) -> PipelineModel:
    """The stages and the estimator fitted on rows, in one pipeline.

    A forest passes over its rows three times before it keeps them. The vectors
    are kept on the executors' disks meanwhile, so that the stages run once.
    """
    prepared = Pipeline(stages=list(stages)).fit(rows)
    vectors = prepared.transform(rows).select("features", "label", "weight").persist(StorageLevel.DISK_ONLY)
    try:
        return PipelineModel([*prepared.stages, estimator.fit(vectors)])
    finally:
        vectors.unpersist()


def training_rows(df: DataFrame, label: str, keep: Sequence[str]) -> DataFrame:
    """Labelled rows with columns `label` and `weight`, written once.

    Fitting passes over its rows many times; the written table holds only the
    columns it needs and spares each pass the plan behind them.
    """
    rows = df.withColumn("label", label_flag(F.col(label)).cast("double")).filter("label IS NOT NULL")
    return with_weights(materialized(rows.select(*dict.fromkeys([*keep, "label"])), "training"), "label")


def fit_forest(
    train: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str],
    trees: int = TREES, depth: int = 10, seed: int = SEED, tried: str = "auto",
) -> PipelineModel:
    rows = training_rows(train, label, [*numeric, *categorical])
    codes = category_codes(rows, categorical) if categorical else None
    stages = feature_stages(fills_of(rows, numeric, categorical), numeric, categorical, codes)
    return fitted(stages, forest(trees, depth, seed=seed, tried=tried), rows)


def merged_moments(parts: Sequence[tuple[int, float, float]]) -> tuple[float, float]:
    """Mean and population deviation of rows given by parts as (rows, mean, sum of squared deviations)."""
    rows = sum(n for n, _, _ in parts)
    mean = sum(n * m for n, m, _ in parts) / rows
    return mean, (sum(away + n * (m - mean) ** 2 for n, m, away in parts) / rows) ** 0.5


class TrainingStore:
    """Rows that many fits share, written once in one folder per part (a period or a fold).

    A split is a set of parts: its rows are a partition-pruned read of the same
    files, its class weights follow from counts per part, and the fills and scales
    of all splits come from counts and moments per part, and from the few values
    around the medians. The places
    of categories are those of all parts: one that a training part lacks is a
    column of zeros there, which no fit can use. Nothing is written per split, so
    many splits cost no more disk than one. The label's class is written with the
    rows and, if codes are given, the places of categories: a pass over the rows
    parses no label and joins no codes.
    """

    def __init__(self, df: DataFrame, part: str, label: str, columns: Sequence[str] | None = None, codes: CategoryCodes | None = None):
        self.label, self.coded, path = label, codes, new_path(df.sparkSession, "training")
        kept = df.select(
            *dict.fromkeys([part, label, *(df.columns if columns is None else columns)]),
            label_flag(F.col(label)).cast("double").alias("_flag"), F.col(part).cast("string").alias("_part"),
        )
        kept = codes.with_places(kept) if codes else kept
        kept.write.partitionBy("_part").parquet(path)
        self.stored = df.sparkSession.read.schema(kept.schema).parquet(path)
        counts = self.labelled().groupBy("_part", "label").agg(F.count("*").alias("n")).collect()
        self.classes = {(r["_part"], r["label"]): r["n"] for r in counts}

    def rows(self, parts: Sequence) -> DataFrame:
        return self.stored.filter(F.col("_part").isin(*[str(p) for p in parts])).drop("_part", "_flag")

    def labelled(self) -> DataFrame:
        return self.stored.withColumn("label", F.col("_flag")).filter("label IS NOT NULL").drop("_flag")

    def training(self, parts: Sequence) -> DataFrame:
        """Labelled rows of the parts with columns label and weight, balanced over these parts."""
        wanted = {str(p) for p in parts}
        sizes: dict[float, int] = {}
        for (part, flag), n in self.classes.items():
            if part in wanted:
                sizes[flag] = sizes.get(flag, 0) + n
        weight: Column = F.lit(1.0)
        for flag, n in sizes.items():
            weight = F.when(F.col("label") == flag, sum(sizes.values()) / (len(sizes) * n)).otherwise(weight)
        rows = self.labelled().filter(F.col("_part").isin(*wanted)).withColumn("weight", weight)
        if not sizes:
            return rows
        # With the classes stated, a forest need not look for the largest label.
        nominal = {"ml_attr": {"type": "nominal", "name": "label", "num_vals": int(max(sizes)) + 1}}
        return rows.withColumn("label", F.col("label").alias("label", metadata=nominal))

    def codes(self, categorical: Sequence[str], fills: dict[int, Fills]) -> dict[int, CategoryCodes | None]:
        """The codes for each set of parts, which know the places of its fills if the rows hold places."""
        if not categorical or not self.coded:
            return dict.fromkeys(fills, category_codes(self.labelled(), categorical) if categorical else None)
        return dict(zip(fills, self.coded.filled(self.stored, [{c: f.mode(c) for c in categorical} for f in fills.values()])))

    def fills(self, groups: dict[int, Sequence], numeric: Sequence[str], categorical: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE) -> dict[int, Fills]:
        """The fills of several sets of parts, from counts that are made once."""
        spark, rows, part = self.stored.sparkSession, self.labelled(), F.col("_part").alias("part")
        pairs = [(g, str(p)) for g, parts in groups.items() for p in parts]
        # One row per set and part.
        plan = F.broadcast(spark.createDataFrame(pairs, "group int, part string"))
        sizes = {g: sum(n for (p, _), n in self.classes.items() if p in {str(x) for x in parts}) for g, parts in groups.items()}
        numbers: dict[int, dict] = {g: {} for g in groups}
        modes: dict[int, dict] = {g: {} for g in groups}
        if numeric:
            long = long_numeric(rows, numeric, part)
            # One row per part and column: size, mean and squared deviations, which merge into those of any set of parts.
            per_part = long.groupBy("part", "feature").agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.var_pop("value").alias("var"))
            moments = {(r["part"], r["feature"]): (r["n"], r["mean"], r["n"] * r["var"]) for r in per_part.collect()}
            totals = {c: sum(n for (_, f), (n, _, _) in moments.items() if f == c) for c in numeric}
            cells = long.select("*", F.lit(1).cast("bigint").alias("n"), F.lit(0).alias("slice"))
            cells = with_feature_slice(cells, "value", cuts_by_feature(long, totals, rows_per_slice))
            medians = quantiles_of_slices(cells, ["group", "feature"], {"median": 0.5}, plan)
            for r in medians.collect():
                held = [moments[key] for p in groups[r["group"]] if (key := (str(p), r["feature"])) in moments]
                missing = sizes[r["group"]] - sum(n for n, _, _ in held)
                numbers[r["group"]][r["feature"]] = (r["median"], *merged_moments([*held, (missing, r["median"], 0.0)]))
            for g, c in product(groups, numeric):
                numbers[g].setdefault(c, (None, None, None))
        if categorical:
            counted = long_categorical(rows, categorical, part).groupBy("part", "feature", "category").agg(F.count("*").alias("n"))
            cells = counted.join(plan, "part").groupBy("group", "feature", "category").agg(F.sum("n").alias("n"))
            best = F.min_by("category", F.struct((-F.col("n")).alias("a"), F.col("category").alias("b")))
            for r in cells.groupBy("group", "feature").agg(best.alias("mode")).collect():
                modes[r["group"]][r["feature"]] = r["mode"]
        return {g: Fills(numbers[g], modes[g]) for g in groups}


@dataclass
class GridResult:
    """The refitted best model, its parameters, and the mean AUC of every candidate."""

    model: PipelineModel
    params: dict[str, object]
    candidates: list[tuple[dict[str, object], float]]


def grid_search(
    train: DataFrame, label: str, key: str, numeric: Sequence[str], categorical: Sequence[str],
    grid: dict[str, list] | None = None, folds: int = FOLDS,
) -> GridResult:
    """Stratified k-fold search on exact ROC-AUC, then a fit of the best on all rows.

    The rows are written once by fold; fills, scales and category codes are those
    of each fold's training part. All held-out scores are measured in one job.
    """
    placed = with_folds(df=train.filter(label_flag(F.col(label)).isNotNull()), label=label, key=key, folds=folds)
    store = TrainingStore(placed, "fold", label, [key, *numeric, *categorical])
    names = list(grid or GRID)
    candidates = [dict(zip(names, values)) for values in product(*(grid or GRID).values())]
    groups = {k: [i for i in range(folds) if i != k] for k in range(folds)} | {folds: list(range(folds))}
    fills = store.fills(groups, numeric, categorical)
    codes = store.codes(categorical, fills)

    def of_fold(k: int, params: dict[str, object]) -> PipelineModel:
        return fitted(feature_stages(fills[k], numeric, categorical, codes[k]), forest().setParams(**params), store.training(groups[k]))

    def scored_candidate(k: int, i: int) -> DataFrame:
        return score(of_fold(k, candidates[i]), store.rows([k]), [label]).withColumns({"fold": F.lit(k), "candidate": F.lit(i)})

    scored = run_all([partial(scored_candidate, k, i) for k in range(folds) for i in range(len(candidates))])
    found = classification_metrics(
        reduce(DataFrame.unionByName, scored), ["fold", "candidate"], label, "probability", "prediction"
    )
    areas: list[list[float]] = [[] for _ in candidates]
    for r in found.select("candidate", "roc_auc").collect():
        areas[r["candidate"]].append(r["roc_auc"] if r["roc_auc"] is not None else 0.5)
    means = [sum(a) / len(a) if a else 0.0 for a in areas]
    best = candidates[max(range(len(candidates)), key=means.__getitem__)]
    return GridResult(of_fold(folds, best), best, list(zip(candidates, means)))


def score(model: Model, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Class and probability of class 1 per row; works on tables and streams."""
    keep = list(keep or df.columns)
    out = model.transform(df)
    return out.select(
        *keep, F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("probability"),
    )


def score_aligned(model: Model, df: DataFrame, key: str, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Batch scoring of any table: required features are aligned first."""
    wanted = align_features(df, [key, *numeric], categorical)
    return score(model, wanted, [key])


def random_rows(df: DataFrame, n: int, key: str, seed: str | int = "") -> DataFrame:
    """n rows at random, the same ones on every run: a top-n of the key's hash."""
    return df.orderBy(hash_hex(F.col(key), seed=seed), key).limit(n)


def perturbed_rows(df: DataFrame, n: int, key: str, columns: Sequence[str], seed: str | int = "") -> DataFrame:
    """A random sample with normal noise of 5 % of a column's sample deviation, cut to whole numbers.

    The noise is a Box-Muller draw from the key hash, hence repeatable.
    """
    sampled = random_rows(df, n, key, seed)
    present = [c for c in columns if c in df.columns]
    spread = sampled.agg(F.struct(*[F.stddev_samp(c).alias(c) for c in present]).alias("s")).scalar()
    noisy = sampled.withColumn("_s", spread)
    for c in present:
        u = F.greatest(hash_uniform(F.col(key), seed=f"{seed}{c}a"), F.lit(1e-12))
        v = hash_uniform(F.col(key), seed=f"{seed}{c}b")
        draw = F.sqrt(-2 * F.ln(u)) * F.cos(2 * 3.141592653589793 * v)
        noisy = noisy.withColumn(c, (F.col(c) + draw * NOISE * F.coalesce(F.col("_s").getField(c), F.lit(0.0))).cast("bigint"))
    return noisy.drop("_s")
