"""Streams against the batch results, with late rows."""

import datetime as dt
import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import drift as D
from tidemark.operators.metrics import classification_metrics
from tidemark.operators.profile import category_distribution
from tidemark.sources.tables import new_path
from tidemark.streaming import decay as Y, distances as K, monitor as M, scoring as S, windows as W


def rows(day, values, kind="a"):
    return [(dt.datetime(2024, 1, day, 12), float(v), kind) for v in values]


SCHEMA = "ts timestamp, x double, kind string"


@pytest.fixture(scope="module")
def reference(spark):
    return spark.createDataFrame(rows(1, range(100)) + rows(1, range(0, 100, 3), "b"), SCHEMA)


def feed(spark, batches):
    """One file per batch, read one per trigger."""
    path = new_path(spark, "feed")
    seen = set()
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        for name in sorted(set(glob.glob(f"{path}/*.parquet")) - seen):
            # The source reads in order of modification time.
            os.utime(name, (1_700_000_000 + i * 60, 1_700_000_000 + i * 60))
            seen.add(name)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(path)


def test_windowed_psi_equals_batch_and_drops_late_rows(spark, reference):
    days = {2: range(0, 100, 2), 3: range(50, 100), 4: range(30)}
    late = rows(2, [99.0] * 500)
    # A watermark takes effect one batch later, so one batch lies between day 8 and the late rows.
    stream = feed(spark, [rows(2, days[2]), rows(3, days[3]), rows(8, [1.0]), rows(8, [2.0]), late, rows(4, days[4]), rows(12, [1.0])])
    sketch = M.ReferenceSketch(reference, ["x"])
    out = new_path(spark, "psi")
    psi = M.windowed_psi(stream, sketch, "ts")
    query = S.append_stream(psi, out, new_path(spark, "cp"), available_now=True)
    query.awaitTermination()
    found = {r["d"]: r for r in spark.read.parquet(out).withColumn("d", F.dayofmonth("window_start")).collect()}
    for day in (2, 3):
        cur = spark.createDataFrame(rows(day, days[day]), SCHEMA)
        want = D.population_stability(reference, cur, ["x"]).first()["psi"]
        assert found[day]["n_rows"] == len(days[day]) and found[day]["psi"] == pytest.approx(round(want, 4), abs=1e-4)
    assert 4 not in found and 12 not in found
    assert found[3]["severity"] == "HIGH"


def test_category_monitor(spark, reference):
    shares = category_distribution(reference, ["kind"])
    stream = feed(spark, [rows(2, range(10)) + rows(2, range(10), "new"), rows(9, [1.0])])
    out = new_path(spark, "shift")
    M.start_category_monitor(stream, shares, ["kind"], "ts", out, new_path(spark, "cp"), available_now=True).awaitTermination()
    found = spark.read.parquet(out).collect()
    assert len(found) == 1
    base = {r["category"]: r["proportion"] for r in shares.collect()}
    want = max(abs(0.5 - base["a"]), 0.5, base["b"])
    assert found[0]["max_proportion_change"] == pytest.approx(want, abs=1e-4) and found[0]["severity"] == "HIGH"


def runs(spark, store, batches, prepare):
    """One run of the stream per batch, all from one checkpoint."""
    path, checkpoint = new_path(spark, "feed"), new_path(spark, "cp")
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        query = store.start(prepare(spark.readStream.schema(SCHEMA).parquet(path)), checkpoint, available_now=True)
        query.awaitTermination()
        assert query.exception() is None
    return store


def days(df):
    return sorted((r["window_start"].day, r["n_rows"]) for r in df.collect())


def test_windows_close_once_and_open_ones_can_be_read(spark, reference):
    sketch = M.ReferenceSketch(reference, ["x"])
    store = M.psi_store(new_path(spark, "psi"), sketch)
    prepare = lambda events: M.binned_events(events, sketch, "ts")
    runs(spark, store, [rows(2, range(50)), rows(2, range(50, 100)) + rows(3, [1, 2]), rows(6, [5]), rows(2, [7] * 9) + rows(5, [8, 9]), rows(6, [6]), [(None, 1.0, "a")]], prepare)
    assert days(store.closed(spark)) == [(2, 100), (3, 2)]
    assert days(store.flushed(spark)) == [(2, 100), (3, 2), (5, 2), (6, 2)]
    assert days(store.late(spark)) == [(2, 9)]
    found = {r["window_start"].day: r for r in M.judged_windows(store.flushed(spark), sketch).collect()}
    for day, values in ((2, range(100)), (5, [8, 9])):
        want = D.population_stability(reference, spark.createDataFrame(rows(day, values), SCHEMA), ["x"]).first()["psi"]
        assert found[day]["psi"] == pytest.approx(round(want, 4), abs=1e-4)


def test_a_repeated_batch_replaces_its_own_output(spark):
    store = W.WindowStore(new_path(spark, "w"), ["kind"], {"total": W.Measure(F.sum("x"))}, lateness="1 hour")
    batches = [W.stamped(spark.createDataFrame(r, SCHEMA), "ts") for r in (rows(1, [1, 2]) + rows(2, [5], "b"), rows(2, [7], "b") + rows(1, [100]), rows(4, [1]))]
    for i, again in ((0, 0), (1, 1), (1, 1), (2, 2), (2, 2)):
        store.fold(batches[i], again)
    assert {(r["window_start"].day, r["kind"], r["total"], r["n_rows"]) for r in store.flushed(spark).collect()} == {(1, "a", 3.0, 2), (2, "b", 12.0, 2), (4, "a", 1.0, 1)}
    assert days(store.late(spark)) == [(1, 1)] and days(store.closed(spark)) == [(1, 2), (2, 2)]
    store.fold(batches[2].limit(0), 3)
    assert days(store.flushed(spark)) == [(1, 2), (2, 2), (4, 1)]


def test_infinite_reference_values_give_no_index(spark):
    reference = spark.createDataFrame(rows(1, [*range(50), float("inf")]), SCHEMA)
    sketch = M.ReferenceSketch(reference, ["x"])
    store = runs(spark, M.psi_store(new_path(spark, "psi"), sketch), [rows(2, range(9000, 9050))], lambda e: M.binned_events(e, sketch, "ts"))
    found = M.judged_windows(store.flushed(spark), sketch).first()
    assert found["psi"] is None and found["severity"] is None and found["n_rows"] == 50


def test_a_shift_raises_the_index_on_streams(spark, reference):
    sketch = M.ReferenceSketch(reference, ["x"])
    store = runs(spark, M.psi_store(new_path(spark, "psi"), sketch), [rows(2, range(100)) + rows(3, range(40, 140)) + rows(4, range(80, 180))], lambda e: M.binned_events(e, sketch, "ts"))
    found = [r["psi"] for r in M.judged_windows(store.flushed(spark), sketch).orderBy("window_start").collect()]
    assert found == sorted(found) and found[1] > 0.25


@pytest.mark.parametrize("shape", ["normal", "ties", "shifted", "tails"])
def test_sketched_distances_stay_within_the_bound(spark, shape):
    draw = np.random.default_rng(len(shape))
    ref = draw.normal(0, 1, 20_000)
    cur = {"normal": draw.normal(0.1, 1.2, 12_000), "ties": draw.integers(-3, 3, 12_000), "shifted": draw.normal(3, 1, 12_000), "tails": draw.standard_t(3, 12_000)}[shape]
    if shape == "ties":
        ref = draw.integers(-2, 4, 20_000)
    reference, current = (spark.createDataFrame([(dt.datetime(2024, 1, 2), float(v), "a") for v in side], SCHEMA).repartition(5) for side in (ref, cur))
    path = new_path(spark, "reference")
    K.reference_sketches(reference, ["x"]).write.parquet(path)
    store = K.sketch_store(new_path(spark, "s"))
    for i, part in enumerate(current.randomSplit([0.5, 0.5], 3)):
        store.fold(K.long_events(part, ["x"], "ts"), i)
    found = K.sketched_distances(store.flushed(spark), K.read_reference(spark, path)).first()
    ks = D.numeric_drift(reference, current, ["x"]).first()
    assert found["n_rows"] == 12_000 and abs(found["ks_statistic"] - ks["ks_statistic"]) <= found["ks_bound"] < 0.02
    span = (max(ref.max(), cur.max()) - min(ref.min(), cur.min())) / (ref.max() - ref.min())
    assert abs(found["wasserstein_distance"] - ks["wasserstein_distance"]) <= found["ks_bound"] * span
    assert found["wasserstein_distance"] == pytest.approx(ks["wasserstein_distance"], rel=0.05, abs=0.005)


def test_infinite_values_have_a_statistic_but_no_area(spark):
    reference = spark.createDataFrame(rows(1, range(100)), SCHEMA)
    store = K.sketch_store(new_path(spark, "s"))
    store.fold(K.long_events(spark.createDataFrame(rows(2, [float("inf")] * 50 + [float("nan")]), SCHEMA), ["x"], "ts"), 0)
    found = K.sketched_distances(store.flushed(spark), K.reference_sketches(reference, ["x"])).first()
    assert (found["n_rows"], found["wasserstein_distance"]) == (50, None) and found["ks_statistic"] == pytest.approx(1.0, abs=0.02)


def test_late_labels_and_decay(spark):
    start = dt.datetime(2024, 1, 1)
    scores = [(i, start + dt.timedelta(days=i % 3, hours=i % 24), ((i * 37) % 1000) / 1000 + 0.0005, int((i * 37) % 1000 >= 500)) for i in range(900)] + [(9999, start, 0.5, None), (9998, start, 1.5, 1)]
    good = lambda i: (i * 37) % 1000 >= 500 if i % 3 == 0 else (i * 91) % 1000 >= 400
    labels = [(i, "yes" if good(i) else "no", start + dt.timedelta(days=i % 3 + i % 9, hours=i % 24)) for i in [*range(900), 9999, 9998]]
    waves = [(lambda day: day < 3), (lambda day: 3 <= day < 6), (lambda day: day >= 6)]
    paths, checkpoint = [new_path(spark, n) for n in ("scores", "labels")], new_path(spark, "cp")
    score_schema, label_schema = "id long, ts timestamp, score double, said int", "id long, label string, known timestamp"
    store = Y.metric_store(new_path(spark, "m"), "label", "score", "said")
    for k, wave in enumerate(waves):
        spark.createDataFrame(scores if k == 0 else [], score_schema).coalesce(1).write.mode("append").parquet(paths[0])
        spark.createDataFrame([r for r in labels if wave((r[2] - start).days)], label_schema).coalesce(1).write.mode("append").parquet(paths[1])
        streams = [spark.readStream.schema(s).parquet(p) for s, p in zip((score_schema, label_schema), paths)]
        met = Y.binned_scores(Y.with_labels(*streams, "id", "ts", "known"), "label", "score", "said")
        store.start(met, checkpoint, available_now=True).awaitTermination()
    found = {r["window_start"].day: r for r in Y.decay_by_window(Y.window_metrics(store.flushed(spark))).collect()}
    in_time = [(s[1].day, "yes" if good(s[0]) else "no", s[2], s[3]) for s in scores[:900] if s[0] % 9 <= 7]
    exact = classification_metrics(spark.createDataFrame(in_time, "day int, label string, score double, said int"), ["day"], "label", "score", "said")
    for r in exact.collect():
        got = found[r["day"]]
        assert got["n_samples"] == r["n_samples"]
        assert [got[m] for m in ("roc_auc", "f1_score", "precision", "recall")] == pytest.approx([r[m] for m in ("roc_auc", "f1_score", "precision", "recall")])
    assert (found[1]["max_decay"], found[1]["alert"]) == (0.0, False) and found[2]["alert"] and found[2]["severity"] == "HIGH"
