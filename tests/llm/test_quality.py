import zlib

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import quality

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.learn(docs, labels)
    rows = quality.scored(docs, model).select("doc_id", "score").collect()
    good = {r.doc_id: r.quality for r in labels.collect()}
    held = [(r.score, good[r.doc_id]) for r in rows if r.doc_id in good and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([(s >= 0.3) == (q == 1) for s, q in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows) and len(rows) == docs.count()
    again = quality.scored(docs.repartition(5), quality.learn(docs.repartition(3), labels)).select("doc_id", "score").collect()
    assert {r.doc_id: round(r.score, 9) for r in again} == {r.doc_id: round(r.score, 9) for r in rows}
    # Labels of the held-out fold change nothing.
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.allclose(quality.learn(docs, flipped).weights[0], model.weights[0])


def test_risk_recovers_negatives_without_negative_labels():
    draw = np.random.default_rng(0)
    good, bad = draw.normal(1.5, 1, (4000, 3)), draw.normal(-1.5, 1, (4000, 3))
    unlabelled = np.concatenate([good[1000:3000], bad[:1000]])
    model = quality.fit_pu(good[:1000], unlabelled, 2 / 3)
    assert (model.scores(good[3000:]) >= 0.5).mean() > 0.95 and (model.scores(bad[1000:]) < 0.5).mean() > 0.95


def test_edge_cases(spark):
    long = "good words of prose here " * 40_000
    rows = [(1, None, None, None, None), (2, "", "x", "y", 0), (3, "a b", "x", "y", 1), (3, "a b", "x", "y", 1), (None, "z", None, None, 1), (6, long, "x", "y", 1)]
    docs = spark.createDataFrame(rows, COLUMNS)
    labels = spark.createDataFrame([(1, 1, 0), (3, 1, None), (3, None, None), (6, 0, 0), (6, 0, 0), (None, 1, 1), (99, 0, 0)], "doc_id bigint, quality int, toxic int")
    clash = docs.withColumn("score", F.lit("x")).withColumn("trusted", F.lit(1)).withColumn("drawn", F.lit(1))
    got = quality.scored(clash, quality.learn(clash, labels)).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert quality.good_documents(docs, labels).columns == docs.columns
    none = quality.learn(docs, labels.limit(0))
    assert all(r.score == 0.5 for r in quality.scored(docs, none).collect())
    assert quality.good_documents(docs.limit(0), labels).count() == 0
