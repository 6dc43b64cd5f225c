import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import simhash
from tidemark.llm.components import components

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def plain(text, width=4):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(prints, radius=4):
    """doc_id -> smallest doc_id reachable, by comparing all pairs."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def test_fingerprint_equals_the_definition(spark, tiny):
    texts = [r.text for r in spark.read.parquet(f"{tiny}/documents.parquet").limit(40).collect()]
    for text in [*texts, "", " \t\n", "One", "a b c d", "a b c d e", "É é x y Z", "a a a a a a a a"]:
        assert simhash.fingerprint(text.encode()) == plain(text)
    assert spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0] % 2**64 == simhash.fingerprint(b"A b  C d\n")


def test_components_equal_all_pairs(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    expected = grouped({r.doc_id: plain(r.text or "") for r in docs.collect()})
    assert {r.doc_id: r.component_id for r in rows} == expected


@pytest.mark.parametrize("bucket_rows,segments", [(2048, None), (50, None), (2048, 8)])
def test_links_lose_nothing(spark, bucket_rows, segments, monkeypatch):
    """Dense balls, chains and unrelated values, in whole and in split buckets."""
    if segments:
        monkeypatch.setattr(simhash, "_segments", lambda *_: segments)
    draw = np.random.default_rng(5)
    base = draw.integers(0, 2**63, 8, dtype=np.uint64)
    flips = lambda n: np.bitwise_or.reduce(np.uint64(1) << draw.integers(0, 64, n).astype(np.uint64))
    values = {int(b ^ flips(k)) for b in base[:3] for k in (1, 2, 3, 5, 6) for _ in range(25)}
    walk = base[4]
    for _ in range(40):
        walk = walk ^ flips(4)
        values.add(int(walk))
    values |= {int(x) for x in draw.integers(0, 2**63, 300, dtype=np.uint64)}
    values = sorted(values)
    fps = spark.createDataFrame([(v - 2**64 if v >> 63 else v,) for v in values], "fp bigint")
    edges = simhash.near_links(fps, bucket_rows=bucket_rows, pivot_count=16)
    got = {r.node % 2**64: r.root % 2**64 for r in components(edges).collect()}
    expected = grouped({v: v for v in values})
    # Roots are smallest as signed numbers; compare the partitions.
    classes = lambda of: {frozenset(v for v in of if of[v] == r) for r in set(of.values())}
    assert classes({v: got.get(v, v) for v in values}) == classes(expected)


def test_long_chain(spark):
    edges = spark.range(300).selectExpr("id as a", "id + 1 as b")
    assert {r.root for r in components(edges).collect()} == {0}


def test_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(50_000))
    rows = [(1, None, None, None, None), (2, "", "x", "y", 0), (3, "same words here today", "en", None, 1),
            (4, "same words here today", "en", None, 1), (4, "same words here today", "en", None, 1),
            (None, "quite another line of words", None, None, None), (6, long, "en", "s", 1)]
    docs = spark.createDataFrame(rows, COLUMNS).withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit(0)).withColumn("root", F.lit(1))
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 1), (2, 1), (3, 3), (4, 3), (4, 3), (None, None), (6, 6)], key=str)
    kept = simhash.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 3, None, 6], key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.kept_documents(docs.limit(0)).count() == 0


def test_kept_rows_are_told_apart_without_ids(spark):
    """Unrelated texts stay though they lack a doc_id or share one; near copies go, with or without an id."""
    line = lambda name, n=60: " ".join(f"{name}{i * i % 97}" for i in range(n))
    rows = [(None, line("a"), "en", "s", 1), (None, line("b"), "en", "s", 1), (None, line("c"), "en", "s", 1), (None, line("c"), "en", "s", 1),
            (7, line("d"), "en", "s", 1), (7, line("e"), "en", "s", 1), (8, line("b"), "en", "s", 1), (9, line("a").upper(), "en", "s", 1), (7, line("d"), "fr", "s", 1)]
    docs = spark.createDataFrame(rows, COLUMNS)
    kept = simhash.kept_documents(docs).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted([("8", line("b")), ("9", line("a").upper()), ("None", line("c")), ("7", line("d")), ("7", line("e"))])
    copies = spark.range(500).selectExpr("cast(null as bigint) as doc_id", "concat('text ', id % 5, ' w', id % 5 * 31, ' x y z') as text")
    prints = {fp for (fp,) in simhash.fingerprints(copies).select("fp").distinct().collect()}
    assert len(prints) == 5 and len(set(grouped({p: p % 2**64 for p in prints}).values())) == simhash.kept_documents(copies).count() == 5
