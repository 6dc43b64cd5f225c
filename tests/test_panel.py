"""Panels, what-if changes, split plans."""

import pandas as pd
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import panel as P, profile as Q, temporal as T, whatif as W, set_sketches as Z
from tidemark.operators.shape import ORDINAL_LABELS, align_features, code_label


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(11)
    rows = [(int(e), m, "Yes" if rng.random() < 0.2 else "No") for m in range(6) for e in rng.choice(60, 45, replace=False)]
    pdf = pd.DataFrame(rows, columns=["e", "m", "left"])
    return pdf, spark.createDataFrame(pdf).cache()


def test_cohort_movement(panel):
    pdf, df = panel
    sets = {m: set(p.e) for m, p in pdf.groupby("m")}
    for r in P.cohort_movement(df, "e", F.col("m")).collect():
        now, before = sets[r["period"]], sets[r["period"] - 1]
        assert (r["retained"], r["joined"], r["departed"]) == (len(now & before), len(now - before), len(before - now))
        assert r["retention_rate"] == pytest.approx(len(now & before) / len(before))


def test_retention_is_exact(panel):
    pdf, df = panel
    active = pdf[pdf.left == "No"].groupby("m").size()
    got = P.retention_sample(df, "e", 0.85, groups=["m"], label="left", seed=3).groupBy("m").count().collect()
    assert {r["m"]: r["count"] for r in got} == {m: int(n * 0.85) for m, n in active.items()}
    assert P.retention_sample(df, "e", 1.0, groups=["m"], label="left").count() == active.sum()
    assert P.retention_sample(df, "e", 0.0, groups=["m"], label="left").count() == 0


def test_scenario_rates():
    assert P.scenario_rate(0.85, "normal") == 0.85
    assert P.scenario_rate(0.93, "recession") == 0.95
    assert P.scenario_rate(0.70, "growth") == 0.75
    with pytest.raises(ValueError):
        P.scenario_rate(0.8, "baseline")


def test_age_cohort(spark):
    df = spark.createDataFrame([(5.0, 5.0, 40), (0.0, 3.0, 22), (2.5, None, 30)], "tenure double, role double, age int")
    got = P.age_cohort(df, "tenure", capped=["role", "absent"], age="age", month=12).collect()
    assert [r["tenure"] for r in got] == [5.1, 0.1, 2.6]
    assert got[0]["role"] == 5.1 and got[1]["role"] == 0.1 and all(r["role"] >= 0 for r in got)
    assert [r["age"] for r in got] == [41, 23, 31]
    assert P.age_cohort(df, "tenure", age="age", month=5).first()["age"] == 40


def test_keys(spark):
    old = spark.range(5, 15).select(F.col("id").alias("k"))
    new = spark.createDataFrame([(c,) for c in "abcdefg"], "name string")
    got = [r["k"] for r in P.next_keys(new, old, "k", "name").collect()]
    assert sorted(got) == list(range(15, 22))
    assert sorted(r["k"] for r in P.ensure_keys(new, "k", "name").collect()) == list(range(1, 8))
    assert P.ensure_keys(old, "k", "k") is old


def test_numbering_in_place(spark):
    """Null and repeated values on many partitions, some of them empty: keys without gaps, rows unchanged, nothing exchanged."""
    rows = [(i, None if i % 3 else "same", "x" * 50) for i in range(1000)]
    df = spark.createDataFrame(rows, "i int, name string, wide string").repartitionByRange(7, "i").filter("i < 100 OR i > 700").withColumn("_keep", F.lit(1))
    found = P.numbered(df, "k", 40)
    got = found.collect()
    assert sorted(r["k"] for r in got) == list(range(41, 41 + df.count())) and found.columns == ["i", "name", "wide", "_keep", "k"]
    assert sorted((r["i"], r["name"]) for r in got if r["name"]) == sorted((i, n) for i, n, _ in rows if n and (i < 100 or i > 700))
    plan = found._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[0]
    exchanged = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]
    scans = [line for line in plan.splitlines() if "ReadSchema" in line and "wide" in line]
    assert len(scans) == 1 and all("wide" not in line for line in exchanged)
    again = P.next_keys(df.withColumn("k", F.lit(None).cast("long")), spark.createDataFrame([(5,), (None,)], "k long"), "k").select("k").collect()
    assert sorted(r["k"] for r in again) == list(range(6, 6 + len(got)))
    assert P.ensure_keys(df, "i") is df and sorted(r["n"] for r in P.ensure_keys(df, "n").collect()) == list(range(1, 1 + len(got)))
    assert P.numbered(df.limit(0), "k").count() == 0


def test_mixed_sample(spark):
    real = spark.range(100).select(F.col("id").alias("k"))
    extra = spark.range(1000, 1500).select(F.col("id").alias("k"))
    got = {r["origin"]: r["count"] for r in P.mixed_sample(real, extra, "k").groupBy("origin").count().collect()}
    assert got == {"real": 100, "extra": 50}


def test_what_if(spark):
    df = spark.createDataFrame([(i, 100 * i + 1, "High", "No") for i in range(2000)], "k long, pay long, sat string, over string")
    assert [r["pay"] for r in W.scale_numeric(df, "pay", 0.02).limit(1).collect()] == [int(1 * 1.02)]
    lowered = W.lower_ordinal(df, "sat", -0.3, "k").filter("sat = 'Medium'").count()
    assert 500 < lowered < 700
    assert W.lower_ordinal(df, "sat", 0.3, "k").filter("sat <> 'High'").count() == 0
    assert 200 < W.raise_flag(df, "over", 0.15, "k").filter("over = 'Yes'").count() < 400
    again = W.raise_flag(df.repartition(9), "over", 0.15, "k")
    assert again.exceptAll(W.raise_flag(df, "over", 0.15, "k")).count() == 0


def test_risk(spark):
    df = spark.createDataFrame([("Low", "Yes", 1000, 0.5), ("High", "No", 9000, 5.0)], "sat string, over string, pay long, years double")
    risk = W.risk_score(W.scenario_base("growth"), satisfaction_low=F.col("sat") == "Low", overtime=F.col("over") == "Yes", income=F.col("pay"), tenure=F.col("years"))
    got = [r[0] for r in df.select(risk).collect()]
    assert got == pytest.approx([0.18 + 0.25 + 0.15 + 0.20 + 0.15, 0.18])
    high = W.risk_score(0.9, satisfaction_low=F.lit(True))
    assert df.select(high).first()[0] == 0.95
    assert W.scenario_base("Toxic Culture Shift") == pytest.approx(0.36)


def test_schedule_touches_its_periods_only(spark):
    df = spark.createDataFrame([(i, i % 4, 1000.0, "High", "No") for i in range(400)], "k long, m int, pay double, sat string, over string")
    got = W.apply_schedule(df, F.col("m"), [None, {"scale": 0.1}, {"downgrade": -1.0}, {"flag": 1.0}], key="k", numeric="pay", ordinal="sat", flag="over")
    seen = {(r["m"], r["pay"], r["sat"], r["over"]) for r in got.collect()}
    assert seen == {(0, 1000.0, "High", "No"), (1, 1100.0, "High", "No"), (2, 1000.0, "Medium", "No"), (3, 1000.0, "High", "Yes")}


def test_split_plans(spark):
    df = spark.createDataFrame([(p,) for p in range(10, 17)], "p int")
    # Seven periods from 10 on; rolling with two splits trains on floor(7 / 3) of them at most.
    for strategy, n, width in (("expanding", 5, 7), ("rolling", 2, 2)):
        rows = T.split_plan(df, F.col("p"), n, strategy).collect()
        for i in range(1, n + 1):
            train = sorted(r["period"] for r in rows if r["split"] == i and r["role"] == "train")
            assert train == list(range(max(10, 10 + i - width), 10 + i))
            assert [r["period"] for r in rows if r["split"] == i and r["role"] == "test"] == [10 + i]
    with pytest.raises(ValueError):
        T.split_plan(df, F.col("p"), 7)
    with pytest.raises(ValueError):
        T.split_plan(df, F.col("p"), 2, "sliding")


def test_continuity(spark):
    same = spark.createDataFrame([(e, m) for e in range(10) for m in range(4)], "e int, m int")
    fresh = spark.createDataFrame([(e * 4 + m, m) for e in range(10) for m in range(4)], "e int, m int")
    assert Q.entity_continuity(same, "e", F.col("m")).first()["continuity_score"] == 1.0
    got = Q.entity_continuity(fresh, "e", F.col("m")).first()
    assert got["continuity_score"] == 0.0 and got["interpretation"] == "LOW"
    assert Q.entity_continuity(same.filter("m = 0"), "e", F.col("m")).first()["continuity_score"] is None


def test_continuity_passes_each_row_on_once(spark):
    rows = [(1, 1), (1, 2), (2, 2), (None, 2), (2, None)]
    df = spark.createDataFrame(rows, "e int, p int")
    found = Q.entity_continuity(df, "e", F.col("p"))
    assert "Expand" not in found._jdf.queryExecution().optimizedPlan().toString()
    r = found.first()
    # 1 - (2 - 5/2) / (5 - 5/2) = 1.2, at most 1.
    assert (r["unique_entities"], r["total_rows"], r["periods"], r["continuity_score"]) == (2, 5, 2, 1.0)
    r = Q.entity_continuity(df.limit(0), "e", F.col("p")).first()
    assert (r["unique_entities"], r["total_rows"], r["periods"], r["continuity_score"]) == (0, 0, 0, None)


def test_density_integrates_to_one(spark):
    rng = np.random.default_rng(2)
    old, new = (spark.createDataFrame(pd.DataFrame({"x": rng.normal(m, 1, 300)})) for m in (0, 2))
    got = Q.density_curve(old, new, "x").toPandas()
    for _, part in got.groupby("side"):
        part = part.sort_values("x")
        assert len(part) == 200 and np.trapezoid(part["density"], part["x"]) == pytest.approx(1, abs=0.01)


@pytest.mark.parametrize("shape", ["normal", "outlier", "ties"])
def test_density_equals_the_plain_sum(spark, shape):
    rng = np.random.default_rng(6)
    x = {"normal": rng.normal(50, 9, 900), "outlier": np.append(rng.normal(0, 1, 500), [400.0, -90.0]), "ties": rng.integers(0, 4, 700).astype(float)}[shape]
    got = Q.density_curve(spark.createDataFrame(pd.DataFrame({"x": x})), spark.createDataFrame([(1.0,), (None,)], "x double"), "x").toPandas()
    got = got.sort_values("point")
    width = len(x) ** -0.2 * x.std(ddof=1)
    grid = np.linspace(x.min() - 3 * width, x.max() + 3 * width, 200)
    plain = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / width) ** 2).sum(1) / (width * np.sqrt(2 * np.pi) * len(x))
    assert set(got["side"]) == {"old"} and np.allclose(got["x"], grid, rtol=1e-12, atol=1e-9)
    assert np.abs(got["density"] - plain).max() < 1e-9 * plain.max() and (got["density"] >= 0).all()


def test_sketched_movement_within_its_bound(spark):
    rng = np.random.default_rng(8)
    rows = [(int(p), int(e)) for p in range(4) for e in rng.choice(20_000, 8_000 + 1_500 * p, replace=False)] + [(9, 1), (9, None), (None, 3)]
    df = spark.createDataFrame(rows, "p int, e long").repartition(6)
    held = {p: {e for q, e in rows if q == p and e is not None} for p in (0, 1, 2, 3, 9)}
    exact = lambda a, b: (len(held[a] & held[b]), len(held[b] - held[a]), len(held[a] - held[b]), len(held[b]), len(held[a] | held[b]))
    for digits, most in ((9, 0.15), (12, 0.05), (15, 1e-9)):
        found = Z.sketched_movement(Z.period_sketches(df, "e", F.col("p"), digits), digits=digits).collect()
        assert {(r["earlier"], r["later"]) for r in found} == {(a, b) for a in held for b in held if a < b}
        for r in found:
            a, b = r["earlier"], r["later"]
            for name, n in zip(("retained", "joined", "departed", "head_count", "together"), exact(a, b)):
                assert abs(r[name] - n) <= r["bound"] + 1e-9 and abs(r[name] - n) <= most * len(held[a] | held[b]) + 1e-9


def test_sketches_merge_and_pairs_may_be_named(spark):
    df = spark.createDataFrame([(p, e) for p in range(6) for e in range(p * 10, p * 10 + 40)], "p int, e long")
    months = Z.period_sketches(df, "e", F.col("p"))
    pairs = spark.createDataFrame([(5, 0), (1, 1)], "earlier int, later int")
    found = {(r["earlier"], r["later"]): (r["retained"], r["joined"], r["departed"]) for r in Z.sketched_movement(months, pairs).collect()}
    assert found == {(5, 0): (0, 40, 40), (1, 1): (40, 0, 0)}
    halves = Z.merged_sketches(months, F.floor(F.col("period") / 3))
    assert {r["period"]: r["n"] for r in halves.selectExpr("period", "theta_sketch_estimate(sketch) AS n").collect()} == {0: 60, 1: 60}


def test_alignment_and_codes(spark):
    df = spark.createDataFrame([(1, "x")], "a long, c string")
    got = align_features(df, ["b", "a"], ["c", "d"])
    assert got.columns == ["b", "a", "c", "d"] and tuple(got.first()) == (0, 1, "x", "Unknown")
    codes = spark.createDataFrame([(1,), (5,), (6,), (None,)], "k int").select(code_label(F.col("k"), ORDINAL_LABELS["Education"])).collect()
    assert [r[0] for r in codes] == ["Below College", "Doctor", None, None]
