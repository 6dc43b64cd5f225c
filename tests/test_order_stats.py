"""Running totals, quantiles and hash ranks against brute force, sliced and unsliced."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions.scalars import hash_hex
from tidemark.operators import order_stats as O


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([np.full(1000, 7.25), rng.lognormal(3, 2, 1500), -rng.random(500)])
    groups = np.where(rng.random(3000) < 0.4, "a", "b")
    pdf = pd.DataFrame({"g": groups, "x": values})
    return pdf, spark.createDataFrame(pdf).repartition(5).cache()


def brute(pdf):
    out = []
    for g, part in pdf.groupby("g"):
        counts = part.groupby("x").size().sort_index()
        cum = counts.cumsum()
        prev = [None] + list(counts.index[:-1])
        out += [(g, v, int(n), int(c), int(counts.sum()), p) for v, n, c, p in zip(counts.index, counts, cum, prev)]
    return sorted(out)


@pytest.mark.parametrize("rows_per_slice", [O.ROWS_PER_SLICE, 300, 20])
def test_running_totals(spark, skewed, rows_per_slice):
    pdf, df = skewed
    cells = df.groupBy("g", F.col("x").alias("value")).agg(F.count("*").alias("n"))
    cuts = O.column_cuts(df, "x", rows_per_slice)
    assert (len(cuts) > 0) == (rows_per_slice < 3000)
    ranked = O.running_totals(O.with_slice(cells, "value", cuts), ["g"], "value", ["n"])
    got = sorted(tuple(r) for r in ranked.select("g", "value", "n", "cum_n", "total_n", "prev_value").collect())
    assert got == brute(pdf)


def test_slices_balance_the_work(spark, skewed):
    _, df = skewed
    cuts = O.column_cuts(df, "x", 100)
    sizes = [r["n"] for r in df.groupBy(O.slice_of(F.col("x"), cuts).alias("s")).agg(F.count_distinct("x").alias("n")).collect()]
    assert max(sizes) < 400 and len(sizes) > 10


def test_slice_of_matches_searchsorted(spark):
    cuts = sorted(np.random.default_rng(1).normal(size=37).tolist())
    values = np.concatenate([np.random.default_rng(2).normal(size=200) * 2, cuts])
    df = spark.createDataFrame(pd.DataFrame({"x": values}))
    got = df.select("x", O.slice_of(F.col("x"), cuts).alias("s")).collect()
    assert all(r["s"] == np.searchsorted(cuts, r["x"], side="right") for r in got)


@pytest.mark.parametrize("rows_per_slice", [O.ROWS_PER_SLICE, 50])
def test_exact_quantiles(skewed, rows_per_slice):
    pdf, df = skewed
    got = {r["g"]: r for r in O.exact_quantiles(df, ["g"], "x", {"q1": 0.25, "median": 0.5, "q9": 0.9}, rows_per_slice).collect()}
    for g, part in pdf.groupby("g"):
        want = np.quantile(part["x"], [0.25, 0.5, 0.9])
        assert np.allclose([got[g]["q1"], got[g]["median"], got[g]["q9"]], want)


def md5_rank(keys, seed):
    order = sorted(keys, key=lambda k: (hashlib.md5(f"{k}|{seed}".encode()).hexdigest(), k))
    return {k: i + 1 for i, k in enumerate(order)}


@pytest.mark.parametrize("digits", [1, 3])
def test_hash_ranked_and_first(spark, digits):
    keys = list(range(1, 801))
    df = spark.createDataFrame([(k, "hot" if k % 3 else f"g{k % 9}") for k in keys], "k long, g string")
    ranked = O.hash_ranked(df, ["g"], hash_hex(F.col("k"), seed=9), ["k"], digits).collect()
    by_group = {}
    for k in keys:
        by_group.setdefault("hot" if k % 3 else f"g{k % 9}", []).append(k)
    want = {k: r for group in by_group.values() for k, r in md5_rank(group, 9).items()}
    assert {r["k"]: r["rank"] for r in ranked} == want
    assert all(r["group_rows"] == len(by_group[r["g"]]) for r in ranked)
    first = O.hash_first(df, ["g"], hash_hex(F.col("k"), seed=9), ["k"], F.floor(F.col("group_rows") * 0.3), digits).collect()
    assert {r["k"] for r in first} == {k for g in by_group.values() for k in g if want[k] <= int(len(g) * 0.3)}


def test_results_do_not_depend_on_partitions(spark):
    df = spark.range(500).select(F.col("id").alias("k"))
    one, many = (
        {r["k"] for r in O.hash_first(df.repartition(n), [], hash_hex(F.col("k"), seed=1), ["k"], F.lit(123)).collect()}
        for n in (1, 7)
    )
    assert one == many and len(one) == 123


def test_null_groups_and_repeated_keys_are_drawn_exactly(spark):
    rows = [(k % 400, None if k % 10 < 3 else "a" if k % 2 else "b", k) for k in range(1000)]
    df = spark.createDataFrame(rows, "k long, g string, n long")
    sizes = {g: sum(r[1] == g for r in rows) for g in (None, "a", "b")}
    got = O.hash_first(df, ["g"], hash_hex(F.col("k"), seed=2), ["k"], F.floor(F.col("group_rows") * 0.45)).collect()
    assert {g: sum(r.g == g for r in got) for g in sizes} == {g: int(n * 0.45) for g, n in sizes.items()}
    assert len({r.n for r in got}) == len(got)
    assert O.hash_ranked(df, ["g"], hash_hex(F.col("n")), ["n"]).count() == 1000
    hot = df.withColumn("k", F.lit(1))
    assert O.hash_first(hot, [], hash_hex(F.col("k")), ["k"], F.lit(333)).count() == 333


def test_lead_digits_follow_the_rows():
    assert [O.lead_digits(n) for n in (0, 100_000, 100_001, 1_600_001, 10**12)] == [0, 0, 1, 2, 6]


def test_rows_of_few_keys_stay_where_they_lie(spark):
    """Marking by cut-offs joins a written table of known size: the rows are not dealt to one task per key."""
    rows = spark.range(0, 30000, 1, 6).select("id", F.when(F.col("id") % 3 != 0, F.col("id") % 2).alias("g"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
    try:
        placed = O.with_cutoffs(rows, ["g"], hash_hex(F.col("id")), ["id"], [F.floor(F.col("group_rows") * 0.2)])
        plan = placed._jdf.queryExecution().executedPlan().toString()
        marked = placed.groupBy("g").agg(F.count_if(F.col("place") <= F.col("cut_0")).alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert {r["g"]: r["n"] for r in marked} == {None: 2000, 0: 2000, 1: 2000}
