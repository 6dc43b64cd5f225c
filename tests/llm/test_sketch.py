import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import sketch

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def shingles(text):
    words = text.encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def made(text, **options):
    return sketch.sketch(sketch.shingle_hashes(text, sketch.Words()), **options)


def test_threshold_keeps_every_hash_below():
    text = " ".join(f"w{i}" for i in range(5000))
    hashes = sketch.shingle_hashes(text, sketch.Words())
    assert len(hashes) == 4996
    s = sketch.sketch(hashes)
    assert s.bound == 2**62 and (s.hashes == hashes[hashes <= 2**62]).all()
    assert sketch.Sketch.parse(str(s)).bound == s.bound and (sketch.Sketch.parse(str(s)).hashes == s.hashes).all()


def test_one_bound_for_texts_of_any_size(spark, tiny):
    found = sketch.edited_pairs(spark.read.parquet(f"{tiny}/documents.parquet")).collect()
    assert {sketch.Sketch.parse(f).bound for r in found for f in (r.fingerprint, r.edited_fingerprint)} == {2**62}


def test_error_by_text_size():
    """Mean absolute errors stay below those of the README."""
    draw, words = np.random.default_rng(5), sketch.Words()
    for n, most in ((30, 0.13), (100, 0.075), (400, 0.04), (2000, 0.02)):
        errors = []
        for _ in range(300):
            a = [f"w{i}" for i in draw.integers(0, 10**6, n)]
            cut = int(draw.integers(0, n))
            b = a[:cut] + [f"x{i}" for i in draw.integers(0, 10**6, n - cut)]
            x, y = shingles(" ".join(a)), shingles(" ".join(b))
            errors.append(abs(sketch.likeness(made(" ".join(a)), made(" ".join(b))) - len(x & y) / len(x | y)))
        assert np.mean(errors) < most


def test_pairs_without_a_kept_hash():
    bare = [t for t in (f"a{i} b" for i in range(100)) if not len(made(t).hashes)]
    assert sketch.likeness(made(bare[0]), made(bare[0])) == 1.0 and sketch.likeness(made(bare[0]), made(bare[1])) == 0.0
    assert sketch.likeness(made(bare[0]), made("")) == 0.0 and sketch.likeness(made(" "), made("")) == 1.0
    merged = sketch.merge(made(bare[0]), made(bare[1]))
    assert sketch.likeness(merged, merged) == 0.0 and sketch.containment(merged, merged) is None
    assert sketch.Sketch.parse(str(merged)).whole is None


def test_estimates_follow_the_exact_values():
    draw = np.random.default_rng(3)
    words = [f"w{i}" for i in range(3000)]
    long = [words[i] for i in draw.integers(0, 3000, 40_000)]
    for part in (400, 4000, 20_000):
        inner = long[5000 : 5000 + part] + [words[i] for i in draw.integers(0, 3000, part // 3)]
        a, b = " ".join(inner), " ".join(long)
        exact = len(shingles(a) & shingles(b)) / len(shingles(a))
        assert sketch.containment(made(a), made(b)) == pytest.approx(exact, abs=0.12)
        joint = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
        assert sketch.likeness(made(a), made(b)) == pytest.approx(joint, abs=0.08)


def test_merge_is_the_sketch_of_both():
    a, b = (" ".join(f"{c}{i}" for i in range(3000)) for c in "ab")
    merged = sketch.merge(made(a), made(b))
    both = np.union1d(sketch.shingle_hashes(a, sketch.Words()), sketch.shingle_hashes(b, sketch.Words()))
    assert (merged.hashes == both[both <= np.uint64(merged.bound)]).all()


@pytest.mark.parametrize("slice_bytes", [1 << 30, 20_000])
def test_pairs_equal_a_plain_walk(spark, tiny, slice_bytes):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    got = {r.doc_id: r for r in sketch.edited_pairs(docs, slice_bytes=slice_bytes).collect()}
    assert len(got) == len(rows)
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        part = len(text) // 4
        new = text[: len(text) - part] + following[:part]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        a, b, c = (made(t) for t in (text, new, following))
        assert (r.fingerprint, r.edited_fingerprint) == (str(a), str(b))
        assert (r.near_edited, r.near_next) == (sketch.likeness(a, b), sketch.likeness(a, c))


def test_edge_cases(spark):
    rows = [(4, None, None, None, None), (2, "", "x", "y", 0), (3, "a b c d", "x", "y", 1), (3, "a b c d", "x", "y", 1), (None, "z z z z", None, None, 1), (9, "é ü " * 30_000, "x", "y", 1)]
    docs = spark.createDataFrame(rows, COLUMNS).withColumn("slice", F.lit("clash")).withColumn("extra", F.lit(1)).withColumn("to", F.lit(1))
    for size in (1 << 30, 10):
        got = sketch.edited_pairs(docs, slice_bytes=size).collect()
        assert sorted(((str(r.doc_id), r.n_chars) for r in got)) == sorted([("4", 0), ("2", 0), ("3", 7), ("3", 7), ("None", 7), ("9", 120_000)])
        last = next(r for r in got if r.doc_id == 9)
        new = ("é ü " * 30_000)[:90_000] + "z z z z"
        assert last.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
    one = sketch.edited_pairs(docs.filter("doc_id = 9")).first()
    assert 0 <= one.near_edited <= 1 and one.near_next == 1.0
    assert sketch.edited_pairs(docs.limit(0)).count() == 0
    assert sketch.fingerprints(docs).count() == 6


def test_short_text_against_an_unrelated_long_one():
    words = sketch.Words()
    long = sketch.sketch(sketch.shingle_hashes(" ".join(f"l{i}" for i in range(50_000)), words))
    found = [sketch.containment(sketch.sketch(sketch.shingle_hashes(" ".join(f"s{k}x{i}" for i in range(10)), words)), long) for k in range(200)]
    assert set(found) == {None, 0.0} and found.count(None) > 20
    assert sketch.containment(sketch.sketch(sketch.shingle_hashes(" ", words)), long) == 1.0
