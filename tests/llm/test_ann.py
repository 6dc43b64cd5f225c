import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import ann


def brute(rows, k=10, every=100):
    """query id -> [(score, id)] over all valid rows."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    out = {}
    for n in np.flatnonzero(ids % every == 0):
        d = x - x[n]
        near = sorted((s, i) for s, i in zip(np.sqrt((d * d).sum(1)).tolist(), ids.tolist()) if i != ids[n])
        out[int(ids[n])] = near[:k]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_and_exact_scores(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    true = brute([(r.vec_id, r.embedding) for r in table.collect()])
    got = answers(ann.nearest_neighbours(table))
    assert set(got) == set(true)
    assert np.mean([len({i for _, i in got[q]} & {i for _, i in true[q]}) / 10 for q in true]) >= 0.95
    for q, found in got.items():
        assert found == sorted(found)
        scores = dict((i, s) for s, i in true[q])
        assert all(scores[i] == s for s, i in found if i in scores)


def test_full_visit_equals_brute_force_with_hot_vectors(spark):
    draw = np.random.default_rng(2)
    x = draw.normal(size=(700, 8)).round(1)
    x[:250] = x[0]
    ids = draw.permutation(700)
    table = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id bigint, embedding array<double>")
    got = answers(ann.nearest_neighbours(table, recall=1.0, probes=100_000, leaf_rows=16, block_rows=40))
    assert got == brute(list(zip(ids.tolist(), x.tolist())))


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (100, [1.0, 0.0]), (200, None), (300, []), (400, [nan, 1.0]), (500, [inf, 1.0]), (600, [0.0, 0.0]),
            (700, [None, 1.0]), (None, [1.0, 1.0]), (800, [1.0, 2.0, 3.0]), (5, [0.0, -0.0]), (7, [3.0, 0.0]), (9, [1.0, -0.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("leaf", F.lit("x")).withColumn("score", F.lit(1))
    assert answers(ann.nearest_neighbours(table)) == {0: [(0.0, 9), (0.0, 100), (2.0, 7)], 100: [(0.0, 0), (0.0, 9), (2.0, 7)]}
    assert ann.nearest_neighbours(table.limit(0)).count() == 0
    assert ann.nearest_neighbours(table.limit(1)).count() == 0


def test_best_bin_first_visits_every_leaf_once():
    x = np.random.default_rng(1).normal(size=(500, 6))
    tree = ann.Tree(x, leaf_rows=20)
    for v in x[:5]:
        order = list(tree.visits(v))
        assert sorted(order) == list(range(tree.leaves))
        assert order[0] == tree.assign(v[None])[0]
