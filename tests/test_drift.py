"""Drift measures against NumPy, their properties, and edge cases."""

import glob
import itertools
import math
import os
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions.ks import share_at_least
from tidemark.operators import drift as D
from tidemark.plans import report as R
from tidemark.plans.timeline import DriftTimeline
from tidemark.sources.tables import new_path


def table(seed, n=260, moved=False):
    """Parcels: a skewed weight, a bell-shaped distance, small counts, a zone and whether it came back."""
    draw = np.random.default_rng(seed)
    zones = draw.permutation(np.repeat(["inner", "outer", "remote", "abroad"], [n // 2, n // 4, n // 8, n - n // 2 - n // 4 - n // 8]))
    frame = pd.DataFrame({
        "weight": (draw.gamma(2.0, 400.0, n)).astype(int), "distance": np.abs(draw.normal(900, 350, n)).astype(int),
        "stops": draw.poisson(3, n), "zone": zones, "grade": draw.binomial(4, 0.6, n), "returned": (draw.random(n) < 0.2).astype(int),
    })
    if moved:
        frame["weight"] = frame["weight"] // 2
        frame["distance"] += 600
        frame["stops"] = np.minimum(frame["stops"], 2)
        frame["zone"] = np.where(draw.random(n) < 0.6, "outer", frame["zone"])
    return frame


@pytest.fixture(scope="module")
def tables(spark):
    frames = {"ref": table(5), "same": table(17), "moved": table(29, moved=True)}
    return {k: (pdf, spark.createDataFrame(pdf).cache()) for k, pdf in frames.items()}


def psi(ref, cur, bins=10):
    _, edges = np.histogram(ref, bins=bins)
    r, c = np.histogram(ref, bins=edges)[0], np.histogram(cur, bins=edges)[0]
    p, q = (r + 1e-6) / (len(ref) + bins * 1e-6), (c + 1e-6) / (len(cur) + bins * 1e-6)
    return float(np.sum((q - p) * np.log(q / p)))


def ks_w1(ref, cur):
    values = np.unique(np.concatenate([ref, cur]))
    f = np.searchsorted(np.sort(ref), values, side="right") / len(ref)
    g = np.searchsorted(np.sort(cur), values, side="right") / len(cur)
    area = float(np.sum(np.abs(f - g)[:-1] * np.diff(values)))
    span = ref.max() - ref.min()
    return float(np.max(np.abs(f - g))), area / span if span > 0 else 0.0


NUMBERS = ["weight", "distance", "stops", "grade"]


@pytest.mark.parametrize("rows_per_slice", [D.ROWS_PER_SLICE, 40])
@pytest.mark.parametrize("other", ["same", "moved"])
def test_numeric_measures_match_numpy(tables, other, rows_per_slice):
    (ref, dref), (cur, dcur) = tables["ref"], tables[other]
    got = {r["feature"]: r for r in D.numeric_drift(dref, dcur, NUMBERS, rows_per_slice=rows_per_slice).collect()}
    assert set(got) == set(NUMBERS)
    for c in NUMBERS:
        d, w = ks_w1(ref[c].to_numpy(float), cur[c].to_numpy(float))
        assert got[c]["psi"] == pytest.approx(psi(ref[c], cur[c]), abs=1e-9)
        assert got[c]["ks_statistic"] == pytest.approx(d, abs=1e-12)
        assert got[c]["wasserstein_distance"] == pytest.approx(w, abs=1e-12)
        assert got[c]["mean_current"] == pytest.approx(cur[c].mean())
        assert got[c]["std_reference"] == pytest.approx(ref[c].std())


def test_psi_alone_equals_the_joint_plan(tables):
    (ref, dref), (cur, dcur) = tables["ref"], tables["moved"]
    got = {r["feature"]: r["psi"] for r in D.population_stability(dref, dcur, NUMBERS).collect()}
    assert got == pytest.approx({c: psi(ref[c], cur[c]) for c in NUMBERS})


def test_constant_reference_and_outside_values(spark):
    ref, cur = pd.DataFrame({"x": [5.0] * 20}), pd.DataFrame({"x": [5.0] * 10 + [99.0] * 10})
    got = D.numeric_drift(spark.createDataFrame(ref), spark.createDataFrame(cur), ["x"]).first()
    assert got["psi"] == pytest.approx(psi(ref["x"], cur["x"]))
    assert got["wasserstein_distance"] == 0.0


def test_missing_values_are_dropped(spark):
    ref = spark.createDataFrame([(1.0,), (2.0,), (None,), (float("nan"),), (3.0,)], "x double")
    cur = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double")
    got = D.numeric_drift(ref, cur, ["x"]).first()
    assert (got["rows_ref"], got["rows_cur"]) == (3, 2)
    assert got["ks_statistic"] == pytest.approx(ks_w1(np.array([1.0, 2, 3]), np.array([1.0, 3]))[0])


def test_all_numeric_types_are_monitored(spark):
    df = spark.range(50).select(
        F.col("id").cast("int").alias("i"), F.col("id").cast("float").alias("f"), F.col("id").cast("decimal(10,2)").alias("d"),
    )
    got = D.covariate_shift(df, df).collect()
    assert {r["feature"] for r in got} == {"i", "f", "d"} and all(r["psi"] == 0 for r in got)


def test_identity_is_no_drift(tables):
    ref = tables["ref"][1]
    for r in D.covariate_shift(ref, ref, exclude=["returned"]).collect():
        assert (r["psi"] or 0) == 0 and (r["ks_statistic"] or 0) == 0 and (r["max_proportion_change"] or 0) == 0
        assert r["severity"] == "LOW" and not r["alert"]


def test_drift_is_seen(tables):
    ref, same, moved = (tables[k][1] for k in ("ref", "same", "moved"))
    quiet = D.covariate_shift(ref, same, exclude=["returned"]).collect()
    loud = {r["feature"]: r for r in D.covariate_shift(ref, moved, exclude=["returned"]).collect()}
    assert sum(r["alert"] for r in quiet) < 0.3 * len(quiet)
    assert loud["weight"]["psi"] > 0.1 and loud["weight"]["severity"] == "HIGH" and loud["zone"]["alert"]
    summary = R.drift_summary(D.covariate_shift(ref, moved, exclude=["returned"]), ref, moved).first()
    assert summary["overall_status"] in ("WARNING", "CRITICAL") and summary["reference_size"] == 260


def test_psi_grows_with_the_shift(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(22, 60, 400).astype(float)
    ref = spark.createDataFrame(pd.DataFrame({"x": base}))
    found = [
        D.population_stability(ref, spark.createDataFrame(pd.DataFrame({"x": base + s})), ["x"]).first()["psi"] for s in (0, 3, 10)
    ]
    assert found[0] == pytest.approx(0) and found[0] < found[1] < found[2]


def test_partitioning_does_not_matter(tables):
    ref, moved = tables["ref"][1], tables["moved"][1]
    one = D.covariate_shift(ref.repartition(1), moved.repartition(1)).orderBy("feature").collect()
    many = D.covariate_shift(ref.repartition(7), moved.repartition(5), rows_per_slice=25).orderBy("feature").collect()
    assert one == many


def test_top_features_are_sorted(tables):
    found = D.top_drifted(D.covariate_shift(tables["ref"][1], tables["moved"][1], exclude=["returned"]), 3).collect()
    scores = [r["drift_score"] for r in found]
    assert len(found) == 3 and scores == sorted(scores, reverse=True)


def test_shared_columns_and_empty_sides(spark, tables):
    ref = tables["ref"][1]
    only = D.covariate_shift(ref, ref.select("weight", "zone"))
    assert {r["feature"] for r in only.collect()} == {"weight", "zone"}
    empty = D.covariate_shift(ref, ref.limit(0))
    assert empty.count() == 0
    assert D.covariate_shift(ref.select("weight"), ref.select("zone")).count() == 0


def test_only_numeric_or_only_text(tables):
    ref, moved = tables["ref"][1], tables["moved"][1]
    assert {r["type"] for r in D.covariate_shift(ref.select(NUMBERS), moved).collect()} == {"numeric"}
    assert {r["type"] for r in D.covariate_shift(ref.select("zone"), moved).collect()} == {"categorical"}


def test_category_shares_match_pandas(tables):
    (ref, dref), (cur, dcur) = tables["ref"], tables["moved"]
    got = D.categorical_drift(dref, dcur, ["zone"]).first()["max_proportion_change"]
    a, b = ref["zone"].value_counts(normalize=True), cur["zone"].value_counts(normalize=True)
    assert got == pytest.approx(max(abs(b.get(k, 0) - a.get(k, 0)) for k in set(a.index) | set(b.index)))


def test_severity_rules(spark):
    rows = [(0.1, 0.5), (0.1, 0.01), (0.3, 0.5), (0.6, 0.5), (None, 0.01)]
    df = spark.createDataFrame(rows, "psi double, p double")
    got = [r[0] for r in df.select(D.numeric_severity(F.col("psi"), F.col("p"))).collect()]
    assert got == ["LOW", "MEDIUM", "MEDIUM", "HIGH", "MEDIUM"]
    got = [r[0] for r in spark.createDataFrame([(0.15,), (0.16,), (0.31,)], "c double").select(D.category_severity(F.col("c"))).collect()]
    assert got == ["LOW", "MEDIUM", "HIGH"]


def test_status_rules(spark):
    df = spark.createDataFrame([(0, False), (1, False), (5, False), (6, False), (0, True)], "n int, c boolean")
    got = [r[0] for r in df.select(D.status_of(F.col("n"), F.col("c"))).collect()]
    assert got == ["STABLE", "WARNING", "WARNING", "CRITICAL", "CRITICAL"]


@pytest.mark.parametrize("rows_per_slice", [D.ROWS_PER_SLICE, 30])
def test_timeline_equals_one_period_at_a_time(spark, tables, rows_per_slice):
    ref = tables["ref"][1]
    months = tables["same"][1].withColumn("m", F.lit(1)).unionByName(tables["moved"][1].withColumn("m", F.lit(2)))
    both = D.covariate_shift(ref, months, exclude=["returned"], period="m", rows_per_slice=rows_per_slice)
    for m, other in ((1, "same"), (2, "moved")):
        alone = D.covariate_shift(ref, tables[other][1], exclude=["returned"]).select(both.drop("m").columns)
        assert both.filter(F.col("m") == m).drop("m").orderBy("feature").collect() == alone.orderBy("feature").collect()


def test_retrain_flag(tables):
    ref, moved = tables["ref"][1], tables["moved"][1]
    months = moved.withColumn("m", F.lit(1)).unionByName(ref.withColumn("m", F.lit(0)))
    found = {r["m"]: r for r in R.drift_timeline(ref, months, "m", exclude=["returned"]).collect()}
    assert found[0]["overall_status"] == "STABLE" and not found[0]["retrain"]
    assert found[1]["covariate_alerts"] >= 4


def series(d, n, m):
    size = max(1, round(n * m / (n + m)))
    lam = math.sqrt(size) * d
    lam += 1 / (6 * math.sqrt(size)) + (lam - 1) / (4 * size)
    return min(1, max(0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101)))) if lam >= 0.2 else 1.0


def test_series_pvalue(spark):
    df = spark.createDataFrame([(0.0, 100, 100), (0.05, 100, 100), (0.5, 100, 100), (1.0, 50, 60), (None, 0, 5)], "d double, n long, m long")
    got = [r[0] for r in df.select(D.ks_pvalue("d", "n", "m")).collect()]
    assert got[0] == 1.0 and got[-1] is None
    assert got[:-1] == pytest.approx([series(0.0, 100, 100), series(0.05, 100, 100), series(0.5, 100, 100), series(1.0, 50, 60)])


@pytest.mark.parametrize("m,n", [(1, 1), (3, 3), (4, 5), (2, 7), (6, 4)])
def test_exact_pvalue_by_enumeration(m, n):
    """All ways to merge two samples, each equally likely."""
    stats = []
    for places in itertools.combinations(range(m + n), m):
        i = j = worst = 0
        for k in range(m + n):
            i, j = (i + 1, j) if k in places else (i, j + 1)
            worst = max(worst, abs(i * n - j * m))
        stats.append(worst)
    for worst in sorted(set(stats)):
        want = sum(s >= worst for s in stats) / len(stats)
        assert share_at_least(worst / (m * n), m, n) == pytest.approx(want, abs=1e-12)


def test_exact_and_series_agree_on_large_samples():
    for d in (0.01, 0.02, 0.03):
        assert share_at_least(d, 8000, 7000) == pytest.approx(series(d, 8000, 7000), abs=2e-3)
    assert share_at_least(0.0, 10, 10) == 1.0


def test_pvalue_methods(spark, tables):
    (ref, dref), (cur, dcur) = tables["ref"], tables["moved"]
    exact = {r["feature"]: r for r in D.numeric_drift(dref, dcur, NUMBERS, pvalue="exact").collect()}
    for c in NUMBERS:
        assert exact[c]["ks_pvalue"] == pytest.approx(share_at_least(exact[c]["ks_statistic"], len(ref), len(cur)))
    plain = {r["feature"]: r for r in D.numeric_drift(dref, dcur, NUMBERS).collect()}
    assert plain["weight"]["ks_pvalue"] == pytest.approx(series(plain["weight"]["ks_statistic"], len(ref), len(cur)))
    with pytest.raises(ValueError):
        D.numeric_drift(dref, dcur, NUMBERS, pvalue="guess")


@pytest.mark.parametrize("rows_per_slice", [D.ROWS_PER_SLICE, 40])
def test_periods_equal_one_comparison_each(spark, tables, rows_per_slice):
    (_, dref), (pdf, dcur) = tables["ref"], tables["moved"]
    panel = dcur.withColumn("p", F.pmod(F.col("weight"), F.lit(3))).withColumn("zone", F.when(F.col("p") == 1, "inner").otherwise(F.col("zone")))
    got = {(r.p, r.feature): r for r in D.numeric_drift_by_period(dref, panel, "p", NUMBERS, rows_per_slice=rows_per_slice).collect()}
    texts = {(r.p, r.feature): r for r in D.categorical_drift_by_period(dref, panel, "p", ["zone"]).collect()}
    for p in range(3):
        one = panel.filter(F.col("p") == p)
        for r in D.numeric_drift(dref, one, NUMBERS).collect():
            for c in ("rows_ref", "rows_cur", "psi", "ks_statistic", "ks_pvalue"):
                assert got[p, r.feature][c] == pytest.approx(r[c], abs=1e-12), (p, r.feature, c)
        r = D.categorical_drift(dref, one, ["zone"]).first()
        assert texts[p, "zone"].max_proportion_change == pytest.approx(r.max_proportion_change)
    assert len(got) == 3 * len(NUMBERS) and len(texts) == 3


def test_many_periods(spark):
    """20,000 periods are periods like any other."""
    from tidemark.operators import panel as P, temporal as T

    rows = spark.range(40_000).selectExpr("id % 20000 as p", "id % 7 as x", "id div 3 as e", "concat('c', id % 3) as z")
    table = R.drift_timeline(rows.filter("p < 100"), rows, "p", numeric=["x"], categorical=["z"])
    assert table.count() == 20_000
    assert P.cohort_movement(rows, "e", F.col("p")).count() == 19_999
    assert T.split_plan(rows, F.col("p"), 2).filter("role = 'test'").count() == 2


def test_infinite_reference_has_no_index(spark):
    ref = spark.createDataFrame([(float(i),) for i in range(50)] + [(float("inf"),)], "x double")
    cur = spark.range(50).selectExpr("cast(id + 9000 as double) as x")
    assert D.population_stability(ref, cur, ["x"]).first().psi is None
    assert D.numeric_drift(ref, cur, ["x"]).first().psi is None


@pytest.mark.parametrize("block", [1, 2, 3, 100])
def test_first_lacking_place(spark, block):
    held = {"a": [1, 2, 3], "b": [2, 3], "c": [1, 2, 4, 5], "d": [1], "e": [1, 2, 3, 4, 7], "f": [9], "g": list(range(1, 13)) + [14]}
    df = spark.createDataFrame([(k, p) for k, places in held.items() for p in places], "k string, place long")
    found = {r["k"]: r["place"] for r in D.first_lacking(df, ["k"], block).collect()}
    assert found == {k: min(set(range(1, 20)) - set(places)) for k, places in held.items()}


def test_ranked_categories_number_every_category_once(spark):
    rows = [(f"c{i % 700}" if i % 3 else f"id{i}",) for i in range(6000)]
    found = D.ranked_categories(spark.createDataFrame(rows, "c string"), ["c"]).orderBy("place").collect()
    assert [r["place"] for r in found] == list(range(1, len(found) + 1))
    counts = [r["n_ref"] for r in found]
    assert counts == sorted(counts, reverse=True) and {r["rows_ref"] for r in found} == {6000} and len({r["category"] for r in found}) == len(found)


def panel_rows(spark, periods):
    draw = random.Random(4)
    rows = [(p, draw.gauss(0, 1) + p / 3, float(draw.randint(0, 5)) if draw.random() < 0.9 else None, draw.choice("abcd" if p < 3 else "bcde")) for p in periods for _ in range(300)]
    return spark.createDataFrame(rows, "p int, x double, n double, c string")


@pytest.mark.parametrize("rows_per_slice", [50, 10**6])
def test_grown_timeline_equals_the_batch_one(spark, rows_per_slice):
    reference, current = panel_rows(spark, [0]), panel_rows(spark, [1, 2, 3, 4])
    grown = DriftTimeline(new_path(spark, "grown"), "p").start(reference, rows_per_slice=rows_per_slice)
    for chosen in ("p = 2", "p = 1 AND x > 0", "p IN (3, 4)", "p = 1"):
        grown.add(current.filter(chosen))
    columns = ["features", "covariate_alerts", "max_psi", "max_share_change", "concept_alert", "overall_status", "retrain"]
    want = {str(r["p"]): [r[c] for c in columns] for r in R.drift_timeline(reference, current, "p", rows_per_slice=rows_per_slice).collect()}
    assert {r["p"]: [r[c] for c in columns] for r in grown.status(spark).collect()} == want
    table = D.covariate_shift(reference, current, period="p", rows_per_slice=rows_per_slice)
    names = [c for c in table.columns if c != "p"]
    rows = lambda df: sorted((str(r["p"]), *(str(r[c]) for c in names)) for r in df.collect())
    assert rows(grown.table(spark)) == rows(table)


def test_a_period_is_read_once_when_added(spark):
    made = spark.sparkContext.accumulator(0)

    def seen(x):
        made.add(1)
        return x

    once = lambda p: panel_rows(spark, [p]).withColumn("x", F.udf(seen, "double").asNondeterministic()("x"))
    grown = DriftTimeline(new_path(spark, "grown"), "p").start(once(0), ["x", "n"], [])
    assert made.value == 300
    grown.add(once(1))
    assert made.value == 600


def test_adding_a_period_reads_no_other_one(spark):
    """Periods added before and the reference table may be gone; a period that comes again replaces its own files only."""
    reference, current = panel_rows(spark, [0]), panel_rows(spark, [1, 2])
    path = new_path(spark, "grown")
    grown = DriftTimeline(path, "p").start(reference)
    grown.add(current.filter("p = 1"))
    files = lambda p: {f: os.path.getmtime(f) for f in glob.glob(f"{path}/periods/*/period={p}/*")}
    before = files(1)
    for name in glob.glob(f"{path}/periods/counts/period=1/*.parquet"):
        with open(name, "wb") as file:
            file.write(b"not parquet")
    kept = files(1)
    grown.add(current.filter("p = 2"))
    grown.add(current.filter("p = 2"))
    assert files(1) == kept and set(kept) == set(before)
    assert {r["p"] for r in grown.status(spark).collect()} == {"1", "2"}


def test_concept_by_period_equals_the_two_table_form(spark):
    draw = random.Random(5)
    rows = [(p, int((s := draw.random()) + draw.gauss(0, 0.1 * p) > 0.5), s, int(s > 0.5)) for p in range(4) for _ in range(400)]
    scored = spark.createDataFrame(rows, "p int, y int, s double, yhat int")
    first = scored.filter("p = 0")
    found = {r["p"]: r for r in R.concept_by_period(first, scored.filter("p > 0"), "p", "y", "s", "yhat").collect()}
    for p in (1, 2, 3):
        want = R.concept_drift(first, scored.filter(F.col("p") == p), "y", "s", "yhat").first()
        assert (round(found[p]["max_decay"] * 100, 2), found[p]["severity"], found[p]["alert"]) == (want["max_decay"], want["severity"], want["alert"])
