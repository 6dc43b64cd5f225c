"""Exact metrics against brute force, ties and empty classes included."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import metrics as M
from tidemark.operators import temporal as T
from tidemark.plans import report as R


def auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    if not len(pos) or not len(neg):
        return None
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(7)
    n = 900
    y = rng.integers(0, 2, n)
    # A third of all rows share one score.
    s = np.where(rng.random(n) < 0.34, 0.5, np.round(rng.random(n) * 0.7 + y * 0.3, 2))
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", "c"], n, p=[0.7, 0.2, 0.1]), "y": y, "s": s, "yhat": (s >= 0.55).astype(int)})
    return pdf, spark.createDataFrame(pdf).repartition(6).cache()


@pytest.mark.parametrize("rows_per_slice", [M.ROWS_PER_SLICE, 60])
def test_metrics_per_group(scored, rows_per_slice):
    pdf, df = scored
    for r in M.classification_metrics(df, ["g"], "y", "s", "yhat", rows_per_slice).collect():
        p = pdf[pdf.g == r["g"]]
        tp, fp = ((p.y == 1) & (p.yhat == 1)).sum(), ((p.y == 0) & (p.yhat == 1)).sum()
        fn = ((p.y == 1) & (p.yhat == 0)).sum()
        assert r["roc_auc"] == pytest.approx(auc(p.y.to_numpy(), p.s.to_numpy()), abs=1e-12)
        assert (r["tp"], r["fp"], r["fn"]) == (tp, fp, fn)
        assert r["precision"] == pytest.approx(tp / (tp + fp)) and r["recall"] == pytest.approx(tp / (tp + fn))
        assert r["f1_score"] == pytest.approx(2 * tp / (2 * tp + fp + fn))


def test_undefined_metrics(spark):
    df = spark.createDataFrame([("one", 1, 0.3, 0), ("one", 1, 0.4, 0), ("none", 0, 0.2, 0)], "g string, y int, s double, p int")
    got = {r["g"]: r for r in M.classification_metrics(df, ["g"], "y", "s", "p").collect()}
    assert got["one"]["roc_auc"] is None and got["one"]["precision"] == 0 and got["none"]["recall"] == 0


def test_labels_of_any_spelling(spark):
    df = spark.createDataFrame([("Yes", 0.9, 1), ("no", 0.1, 0), ("1", 0.8, 1), ("false", 0.3, 0), ("maybe", 0.5, 1)], "y string, s double, p int")
    got = M.classification_metrics(df, [], "y", "s", "p").first()
    assert got["n_samples"] == 4 and got["roc_auc"] == 1.0


def test_report_matches_the_published_example(spark):
    """Counts 407/196/115/164 give the known report."""
    counts = [(0, 0, 407), (0, 1, 196), (1, 0, 115), (1, 1, 164)]
    df = spark.createDataFrame(counts, "y int, p int, n int").select("y", "p", F.explode(F.sequence(F.lit(1), "n")))
    got = {r["class"]: r for r in M.classification_report(df, "y", "p").collect()}
    assert got["1"]["precision"] == pytest.approx(0.45555555555555555) and got["1"]["f1_score"] == pytest.approx(0.513302034428795)
    assert got["0"]["recall"] == pytest.approx(0.6749585406301825) and got["accuracy"]["precision"] == pytest.approx(0.6473922902494331)
    assert got["macro avg"]["f1_score"] == pytest.approx(0.6184287949921752) and got["weighted avg"]["precision"] == pytest.approx(0.6771600594260694)
    matrix = M.confusion_matrix(df, "y", "p").orderBy("label").collect()
    assert [tuple(r) for r in matrix] == [(0, 407, 196), (1, 115, 164)]


def test_concept_drift(spark):
    rows = [(y, s, int(s > 0.5)) for y, s in [(1, 0.9), (1, 0.8), (0, 0.2), (0, 0.1)]]
    worse = [(1, 0.9, 1), (1, 0.2, 0), (0, 0.8, 1), (0, 0.1, 0)]
    ref, cur = (spark.createDataFrame(r, "y int, s double, p int") for r in (rows, worse))
    same = R.concept_drift(ref, ref, "y", "s", "p").first()
    assert same["max_decay"] == 0 and same["severity"] == "LOW" and not same["alert"]
    got = R.concept_drift(ref, cur, "y", "s", "p").first()
    assert got["alert"] and got["severity"] == "HIGH" and got["decay_recall"] == 50.0
    assert R.concept_drift(ref.drop("y"), cur, "y", "s", "p").count() == 0


def test_decay_is_zero_when_nothing_was_there(spark):
    df = spark.createDataFrame([(0.0, 0.4), (0.5, 0.4), (0.5, 0.6)], "a double, b double")
    got = [r[0] for r in df.select(M.metric_decay(F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([0.0, 0.2, -0.2])


def test_trend(spark):
    for slope, want in ((-0.02, "ALERT"), (0.02, "IMPROVING"), (0.001, "STABLE")):
        df = spark.createDataFrame([(i, 0.7 + slope * i) for i in range(5)], "period_index long, roc_auc double")
        got = T.performance_trend(df).first()
        assert got["slope"] == pytest.approx(slope) and got["trend"] == want


def test_decay_by_period(scored):
    _, df = scored
    got = T.performance_by_period(df, "g", "y", "s", "yhat").orderBy("period").collect()
    assert got[0]["auc_decay_pct"] == 0 and [r["period_index"] for r in got] == [0, 1, 2]
    assert got[1]["auc_decay_pct"] == pytest.approx((got[0]["roc_auc"] - got[1]["roc_auc"]) / got[0]["roc_auc"] * 100)


def test_scored_rows_are_read_once(spark):
    """The cut points come from the counts per score, not from the rows again."""
    draw = np.random.default_rng(8)
    y, s = draw.integers(0, 2, 400), draw.integers(0, 90, 400) / 90
    made = spark.sparkContext.accumulator(0)

    def seen(x):
        made.add(1)
        return x

    df = spark.createDataFrame([(int(a), float(b), int(b > 0.5)) for a, b in zip(y, s)], "y int, s double, yhat int")
    df = df.withColumn("s", F.udf(seen, "double").asNondeterministic()("s"))
    got = M.classification_metrics(df, [], "y", "s", "yhat", rows_per_slice=20).first()
    assert got["roc_auc"] == pytest.approx(auc(y, s)) and made.value == 400
