import math

import pytest
from pyspark.sql import functions as F

from tidemark.llm import curriculum

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def fair(sizes):
    """Targets by sharing the excess again and again. sizes: source -> words, in the order of the sources."""
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(sizes)}
    target, full, left = dict.fromkeys(sizes, 0.0), set(), 1.5 * sum(sizes.values())
    while left > 1e-9:
        some = [s for s in sizes if s not in full]
        total = sum(weight[s] for s in some)
        if not some:
            break
        for s in some:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in some:
            if target[s] > 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                full.add(s)
    return target


def test_targets_and_taken(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    rows = curriculum.mixture(docs).collect()
    source = {r.doc_id: r.source for r in docs.collect()}
    size = {r.doc_id: len((r.text or "").encode().split()) for r in docs.collect()}
    assert {r.doc_id: r["size"] for r in rows} == size
    sizes = {s: sum(size[i] for i in size if source[i] == s) for s in sorted(set(source.values()))}
    target = fair(sizes)
    for s in sizes:
        own = [r for r in rows if source[r.doc_id] == s]
        assert {r.source_size for r in own} == {sizes[s]}
        assert all(r.target == pytest.approx(target[s], abs=1e-5) for r in own)
        assert abs(sum(r.taken for r in own) - target[s]) <= max(r["size"] for r in own) / 2 + 1e-6
    assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in rows)
    assert sorted(map(tuple, curriculum.mixture(docs.repartition(7)).collect()), key=str) == sorted(map(tuple, rows), key=str)


def test_arrival_inverts_the_demand(spark):
    """Integrating the schedule up to the position gives the demand back."""
    df = spark.range(101).select((F.col("id") / 100).alias("u"))
    for w, knots in curriculum.SCHEDULES.items():
        area = lambda t: sum((min(b, t) - a) * (x + x + (y - x) / (b - a) * (min(b, t) - a)) / 2 for (a, x), (b, y) in zip(knots, knots[1:]) if t > a)
        for r in df.select("u", curriculum.arrival(F.lit(w), F.col("u")).alias("t")).collect():
            assert 0 <= r.t <= 1 and area(r.t) / area(1.0) == pytest.approx(r.u, abs=1e-9)


def test_edge_cases(spark):
    rows = [(1, None, "e", None, None), (2, "", "e", "a", 1), (3, "one two", "e", "b", 1), (3, "one two", "e", "b", 1), (None, "x y z", "e", "b", 1),
            (5, "w " * 9000, None, None, 1), (6, "solo", "e", "", 1)]
    docs = spark.createDataFrame(rows, COLUMNS).withColumn("size", F.lit("clash")).withColumn("target", F.lit(0)).withColumn("shift", F.lit(0))
    got = curriculum.mixture(docs).collect()
    assert sorted((str(r.doc_id), r["size"]) for r in got) == sorted([("1", 0), ("2", 0), ("3", 2), ("3", 2), ("None", 3), ("5", 9000), ("6", 1)])
    assert all(r.taken <= 2 * r["size"] for r in got)
    assert curriculum.mixture(docs.limit(0)).count() == 0
    drawn = curriculum.drawn(docs.select(docs.columns[:5]))
    assert drawn.columns == docs.columns[:5]
    taken = {}
    for r in got:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    words = {}
    for r in drawn.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len((r.text or "").split())
    assert {i: n for i, n in words.items() if n} == {i: n for i, n in taken.items() if n}


def test_only_empty_texts(spark):
    docs = spark.createDataFrame([(1, None, "e", "a", 0), (2, "", "e", "b", 0)], COLUMNS)
    assert all(r.taken == 0 and r.target == 0 and not math.isnan(r.target) for r in curriculum.mixture(docs).collect())
