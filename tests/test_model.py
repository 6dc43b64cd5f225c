"""Fits and their preparation: exact parts by value, forests by invariants."""

import glob
import os
import threading
from functools import partial

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tidemark.functions.concurrent import run_all
from tidemark.operators import model as M
from tidemark.operators import profile as Q
from tidemark.plans import comparison as X, report as R, training as T, validation as V
from tidemark.sources import runs
from tidemark.sources.tables import new_path, shared_folder


@pytest.fixture(scope="module")
def people(spark):
    rng = np.random.default_rng(21)
    n = 600
    income, kind = rng.normal(50, 10, n), rng.choice(["a", "b", "c"], n)
    left = np.where(income + (kind == "a") * 15 + rng.normal(0, 4, n) < 50, "Yes", "No")
    pdf = pd.DataFrame({"k": np.arange(n), "m": rng.integers(0, 5, n), "income": income, "kind": kind, "left": left})
    pdf.loc[::17, "income"] = np.nan
    pdf.loc[::23, "kind"] = None
    return pdf, spark.createDataFrame(pdf).repartition(4).cache()


def test_fills(people):
    pdf, df = people
    got = M.numeric_fill(df, ["income"]).first()
    full = pdf.income.fillna(pdf.income.median())
    assert got["median"] == pytest.approx(pdf.income.median()) and got["n_missing"] == pdf.income.isna().sum()
    assert got["mean"] == pytest.approx(full.mean()) and got["std_pop"] == pytest.approx(full.std(ddof=0))
    assert M.category_fill(df, ["kind"]).first()["mode"] == pdf.kind.mode()[0]


def test_mode_tie_takes_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",)], "x string")
    assert M.category_fill(df, ["x"]).first()["mode"] == "a"


def test_weights(people):
    pdf, df = people
    yes = (pdf.left == "Yes").sum()
    got = {r["label"]: r["weight"] for r in M.class_weights(df, "left").collect()}
    assert got == pytest.approx({1: len(pdf) / (2 * yes), 0: len(pdf) / (2 * (len(pdf) - yes))})


def test_split_and_folds(people):
    pdf, df = people
    train, test = M.stratified_split(df, "left", "k")
    counts = {r["left"]: r["count"] for r in test.groupBy("left").count().collect()}
    assert counts == {k: int(n * 0.2) for k, n in pdf.left.value_counts().items()}
    assert train.count() + test.count() == len(pdf) and train.join(test, "k").count() == 0
    folds = M.with_folds(df, "left", "k", 3).groupBy("left", "fold").count().collect()
    for label in ("Yes", "No"):
        sizes = [r["count"] for r in folds if r["left"] == label]
        assert len(sizes) == 3 and max(sizes) - min(sizes) <= 1


def test_forest_learns_saves_and_scores(spark, people):
    pdf, df = people
    model = M.fit_forest(df, "left", ["income"], ["kind"], trees=10, depth=5)
    path = new_path(spark, "model")
    model.write().overwrite().save(path)
    scored = M.score(PipelineModel.load(path), df, ["k", "left"])
    rows = scored.collect()
    assert len(rows) == len(pdf) and all(0 <= r["probability"] <= 1 and r["prediction"] in (0, 1) for r in rows)
    from tidemark.operators.metrics import classification_metrics

    assert classification_metrics(scored, [], "left", "probability", "prediction").first()["roc_auc"] > 0.85
    # A category never seen, and a required column that is absent.
    odd = spark.createDataFrame([(1, "zzz"), (2, None)], "k long, kind string")
    assert M.score_aligned(model, odd, "k", ["income"], ["kind"]).count() == 2


def test_grid_search_and_run_record(spark, people):
    _, df = people
    runs_path, model_path = new_path(spark, "runs"), new_path(spark, "model")
    scored = T.train_and_record(
        df, "left", "k", ["income"], ["kind"], dataset="people_v1", runs_path=runs_path, model_path=model_path,
        grid={"numTrees": [5], "maxDepth": [1, 5]}, folds=2,
    )
    run = runs.latest_run(runs.read_runs(spark, runs_path)).first()
    assert run["dataset_version"] == "people_v1" and 0.5 < run["roc_auc"] <= 1
    assert sum(sum(r) for r in run["confusion_matrix"]) == scored.count() == run["class_0"]["support"] + run["class_1"]["support"]
    assert set(run["best_params"]) == {"numTrees", "maxDepth"}
    stored = PipelineModel.load(model_path).stages[-1]
    assert stored.getNumTrees == 5 and str(stored.getMaxDepth()) == run["best_params"]["maxDepth"]


def test_grid_candidates_differ(people):
    """A forest of stumps cannot do what a deep one does: each candidate has its own settings."""
    _, df = people
    got = M.grid_search(df, "left", "k", ["income"], ["kind"], {"numTrees": [1], "maxDepth": [0, 6]}, folds=2)
    areas = {p["maxDepth"]: a for p, a in got.candidates}
    assert areas[0] == 0.5 and areas[6] > 0.8 and got.params["maxDepth"] == 6


def test_walk_forward(people):
    pdf, df = people
    fit = V.forest_fit("left", ["income"], ["kind"], trees=5, depth=4)
    got = V.walk_forward(df.drop("k"), "m", "left", fit, 3).orderBy("split").collect()
    sizes = pdf.groupby("m").size()
    assert [r["test_size"] for r in got] == [sizes[1], sizes[2], sizes[3]]
    assert [r["train_periods"] for r in got] == [1, 2, 3] and all(0 <= r["roc_auc"] <= 1 for r in got)
    with pytest.raises(ValueError):
        V.walk_forward(df, "m", "left", fit, 5)


def test_any_fit_function_will_do(people):
    """The validator takes a callable; here a model trained on one feature only."""
    _, df = people
    fit = lambda train: M.fit_forest(train, "left", ["income"], [], trees=3, depth=3)
    got = V.decay_after_training(df, "m", "left", fit, 2).orderBy("period").collect()
    assert len(got) == 5 and got[0]["auc_decay_pct"] == 0


def test_scorecard(spark):
    rows = [("a", 0.10, 0.2, 0.60, None), ("b", 0.01, 0.1, 0.70, 0.9)]
    facts = spark.createDataFrame(rows, "panel string, leakage_gap double, label_cv double, temporal_auc double, continuity double")
    got = X.scorecard(facts, "a", "b").first()
    assert (got["score_first"], got["score_second"], got["winner"]) == (0, 7, "b")
    got = X.scorecard(facts, "b", "a").first()
    assert (got["score_first"], got["score_second"], got["winner"]) == (5, 0, "b")


def test_facts_read_the_edges_of_a_panel_only(people):
    """Drift and label rates come from the rows written by period; the drift table is that of the first and the last period."""
    _, df = people
    panel = X.Panel("p", df, "m", "left", "k", None, ["income"], ["kind"], "income", most_splits=1)
    facts = X.panel_facts(panel, df, 2, 2, "all")
    plan = facts._jdf.queryExecution().toString()
    assert "_part" in plan and "IN (0,4)" in plan.replace(", ", ",")
    drift = R.first_last_drift(df.select("m", "income", "kind"), "m")
    got = facts.first()
    assert got["covariate_alerts"] == drift.filter("alert").count()
    assert got["label_cv"] == pytest.approx(Q.label_stability(df, F.col("m"), "left").first()["cv"])


def test_fold_store_has_files_of_every_task(spark):
    """Two classes in six tasks: the folds are written by all six, so the fits read them side by side."""
    rows = spark.range(0, 6000, 1, 6).select("id", F.when(F.col("id") % 3 == 0, "Yes").otherwise("No").alias("left"), (F.col("id") % 7).alias("x"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
    try:
        store = M.TrainingStore(M.with_folds(rows, "left", "id", 3), "fold", "left", ["x"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sum("_part=0" in f for f in store.stored.inputFiles()) == 6
    assert [store.rows([k]).count() for k in range(3)] == [1999, 2000, 2001]


def test_samples(people):
    _, df = people
    a, b = (M.random_rows(x, 20, "k", seed=4).select("k").collect() for x in (df, df.repartition(9)))
    assert a == b and len(a) == 20
    noisy = {r["k"]: r["income"] for r in M.perturbed_rows(df.dropna(), 20, "k", ["income"], seed=4).collect()}
    base = {r["k"]: r["income"] for r in M.random_rows(df.dropna(), 20, "k", seed=4).collect()}
    assert set(noisy) == set(base) and all(abs(noisy[k] - base[k]) < 5 for k in base)


def monthly(spark, months=7, n=1400):
    """Rows by month with missing values, a rare category, and a label that numbers and categories decide together with noise."""
    draw = np.random.default_rng(11)
    rows = []
    for i in range(n):
        age, pay, team = float(draw.integers(18, 65)), draw.lognormal(3, 0.5), str(draw.choice(["a", "b", "c"], p=[0.6, 0.3, 0.1]))
        odds = (age < 30) * 1.5 + (pay < 18) * 1.2 + (team == "c") * 1.5 - 1.6
        left = "yes" if draw.random() < 1 / (1 + np.exp(-odds)) else "no"
        rows.append((i, i % months, None if draw.random() < 0.1 else age, float(pay), None if draw.random() < 0.05 else team, None if draw.random() < 0.03 else left))
    return spark.createDataFrame(rows, "id long, month int, age double, pay double, team string, left string")


def test_store_fills_equal_those_of_each_training_part(spark):
    df = monthly(spark)
    store = M.TrainingStore(df, "month", "left", ["age", "pay", "team"])
    groups = {1: [0, 1], 2: [3], 3: list(range(7))}
    for rows_per_slice in (40, 10**6):
        found = store.fills(groups, ["age", "pay"], ["team"], rows_per_slice)
        for g, parts in groups.items():
            rows = df.filter(F.col("month").isin(parts)).filter("left IS NOT NULL")
            want = M.fills_of(rows, ["age", "pay"], ["team"])
            assert found[g].modes == want.modes
            for c in ("age", "pay"):
                assert found[g].numbers[c] == pytest.approx(want.numbers[c])
    weights = {r["label"]: r["weight"] for r in store.training([0, 1]).select("label", "weight").distinct().collect()}
    want = {r["label"]: r["weight"] for r in M.class_weights(df.filter("month < 2"), "left").collect()}
    assert weights == pytest.approx(want)
    assert store.rows([2, 5]).count() == df.filter("month IN (2, 5)").count()


def files_of(spark, prefix):
    root = shared_folder(spark).removeprefix("file:")
    return sorted((name, os.path.getsize(name)) for name in glob.glob(f"{root}/{prefix}-*/**/*.parquet", recursive=True))


def test_what_is_written_does_not_grow_with_the_splits(spark):
    df, fit = monthly(spark).coalesce(1), V.forest_fit("left", ["age", "pay"], ["team"], 3, 3)
    sizes = []
    for n in (1, 3, 6):
        before = set(files_of(spark, "training") + files_of(spark, "vectors") + files_of(spark, "folds"))
        V.walk_forward(df, "month", "left", fit, n).collect()
        written = set(files_of(spark, "training") + files_of(spark, "vectors") + files_of(spark, "folds")) - before
        sizes.append((len(written), sum(size for _, size in written)))
    assert len(set(sizes)) == 1
    before = set(files_of(spark, "training"))
    V.compare_strategies(df, "month", "left", "id", fit, 3).collect()
    # One table by period for both walks, one by fold.
    assert len({os.path.dirname(os.path.dirname(name)) for name, _ in set(files_of(spark, "training")) - before}) == 2


def test_splits_read_their_own_partitions(spark):
    store = M.TrainingStore(monthly(spark), "month", "left", ["age"])
    names = {name.split("_part=")[1].split("/")[0] for name in store.training([1, 2]).inputFiles()}
    plan = store.training([1, 2])._jdf.queryExecution().executedPlan().toString()
    assert "_part" in plan.split("PartitionFilters:")[1].split("]")[0] and {"1", "2"} <= names


def test_walk_equals_fits_of_its_own_splits(spark):
    """Metrics on scores that are neither 0 nor 1, recomputed with NumPy from fits on filtered tables."""
    df = monthly(spark)
    fit = V.forest_fit("left", ["age", "pay"], ["team"], 8, 4)
    found = {r["test_period"]: r for r in V.walk_forward(df, "month", "left", fit, 3, "expanding").collect()}
    for test, row in found.items():
        model = fit(df.filter(F.col("month") < int(test)))
        scored = M.score(model, df.filter((F.col("month") == int(test)) & F.col("left").isNotNull()), ["id", "left"]).collect()
        y, p = np.array([r["left"] == "yes" for r in scored]), np.array([r["probability"] for r in scored])
        assert 0.05 < p.min() and p.max() < 0.95 and len(set(p.round(9))) > 20
        area = (np.sign(p[y][:, None] - p[~y][None, :]) + 1).mean() / 2
        # The fits differ in the order of their rows only.
        assert row["roc_auc"] == pytest.approx(area, abs=0.08) and 0.5 < row["roc_auc"] < 0.95
        assert row["train_size"] == df.filter(F.col("month") < int(test)).count()


def counting(spark, df, column):
    """df whose column counts how often its rows are made, and the count."""
    made = spark.sparkContext.accumulator(0)

    def seen(x):
        made.add(1)
        return x

    kind = next(f.dataType for f in df.schema.fields if f.name == column)
    return df.withColumn(column, F.udf(seen, kind).asNondeterministic()(column)), made


def test_a_fit_prepares_its_rows_once(spark):
    df = monthly(spark, n=300)
    rows, made = counting(spark, M.training_rows(df, "left", ["age", "pay"]), "pay")
    stages = M.feature_stages(M.fills_of(M.training_rows(df, "left", ["age", "pay"]), ["age", "pay"], []), ["age", "pay"], [])
    model = M.fitted(stages, M.forest(3, 3), rows)
    assert made.value == df.filter("left IS NOT NULL").count() and model.stages[-1].getNumTrees == 3


def test_fills_of_a_store_keep_no_counts_per_value(spark):
    """Only the values around the medians are sorted; ties, missing values and a part without numbers included."""
    rows = [(p, float(v) if p < 3 else None, "yes" if v % 2 else "no") for p in range(4) for v in [*range(25 * (p + 1)), *[7] * 30]]
    df = spark.createDataFrame(rows, "part int, x double, left string")
    before = set(files_of(spark, "value-counts"))
    groups = {1: [0], 2: [0, 1, 2, 3], 3: [1, 2], 4: [3]}
    store = M.TrainingStore(df, "part", "left", ["x"])
    for rows_per_slice in (1, 9, 10**6):
        found = store.fills(groups, ["x"], [], rows_per_slice)
        for g, parts in groups.items():
            values = [x for p, x, _ in rows if p in parts and x is not None]
            want = float(np.median(values)) if values else None
            assert found[g].numbers["x"][0] == want
    assert set(files_of(spark, "value-counts")) == before


def test_jobs_side_by_side_have_properties_of_their_own(spark):
    """Jobs that shared them ended each other's query ids."""
    met, context = threading.Barrier(3), spark.sparkContext

    def job(i):
        met.wait(60)
        context.setLocalProperty("tidemark.job", str(i))
        met.wait(60)
        return context.getLocalProperty("tidemark.job")

    assert run_all([partial(job, i) for i in range(3)]) == ["0", "1", "2"]


def test_places_written_with_the_rows_give_the_vectors_of_the_join(spark):
    """A missing category takes the mode of its own set of parts, one seen only without a label no place; no fit joins codes or looks for the largest label."""
    df = monthly(spark, n=300).withColumn("team", F.when(F.col("id") == 7, "odd").otherwise(F.col("team"))).withColumn("left", F.when(F.col("id") != 7, F.col("left")))
    df = df.withColumn("team", F.when((F.col("month") == 2) & F.col("team").isNotNull(), "c").otherwise(F.col("team")))
    fit, groups = V.forest_fit("left", ["pay"], ["team"], 3, 3), {1: [0, 1], 2: [2], 3: list(range(7))}
    store = V.training_store(df, "month", "left", fit)
    fills = store.fills(groups, ["pay"], ["team"])
    assert fills[1].modes["team"] == "a" and fills[2].modes["team"] == "c"
    coded, plain = store.codes(["team"], fills), M.category_codes(store.labelled(), ["team"])
    for g, parts in groups.items():
        for rows in (store.training(parts), store.rows(parts)):
            made = []
            for codes in (coded[g], plain):
                stages = M.feature_stages(fills[g], ["pay"], ["team"], codes)
                out = M.Pipeline(stages=stages).fit(store.training(parts)).transform(rows).select("left", "pay", "team", "features")
                joins = "Join" in out._jdf.queryExecution().optimizedPlan().toString()
                assert joins == (codes is plain)
                made.append(sorted((str(r["left"]), r["pay"], str(r["team"]), tuple(r["features"])) for r in out.collect()))
            assert made[0] == made[1] and len(made[0]) > 20
    assert store.training([0, 1]).schema["label"].metadata["ml_attr"]["num_vals"] == 2
    assert store.rows([0]).filter("team = 'odd'").count() == 1
    model = fit.over(store, groups)(2)
    path = new_path(spark, "model")
    model.write().overwrite().save(path)
    scores = [sorted((r["id"], r["probability"]) for r in M.score(m, x, ["id"]).collect()) for m, x in ((model, df), (PipelineModel.load(path), df))]
    assert scores[0] == scores[1]


def test_strategies_find_fills_and_codes_once_per_store(spark, monkeypatch):
    """Both walks share the fills of one call, all three strategies the codes; their fits keep to the slots of one strategy."""
    calls, running, most, lock = [], [0], [0], threading.Lock()

    def counted(owner, name):
        plain = getattr(owner, name)
        monkeypatch.setattr(owner, name, lambda *a, **b: (calls.append(name), plain(*a, **b))[1])

    def held(*a, plain=V.fitted):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        try:
            return plain(*a)
        finally:
            with lock:
                running[0] -= 1

    counted(M.TrainingStore, "fills")
    counted(V, "category_codes")
    monkeypatch.setattr(V, "fitted", held)
    df = monthly(spark, n=700)
    fit = V.forest_fit("left", ["age", "pay"], ["team"], 3, 3)
    got = {r["strategy"]: r for r in V.compare_strategies(df, "month", "left", "id", fit, 3).collect()}
    assert sorted(calls) == ["category_codes", "fills", "fills"] and 1 < most[0] <= 4
    monkeypatch.undo()
    for s in ("expanding", "rolling"):
        want = V.metric_summary(V.walk_forward(df, "month", "left", fit, 3, s)).first()
        # The fits differ in the order of their rows only.
        assert got[s]["n_splits"] == 3 and got[s]["mean_roc_auc"] == pytest.approx(want["mean_roc_auc"], abs=0.08)
    want = V.metric_summary(V.fold_metrics(df, "left", "id", fit, 3)).first()
    assert got["random"]["n_splits"] == 3 and got["random"]["mean_roc_auc"] == pytest.approx(want["mean_roc_auc"], abs=0.08)
