import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tidemark.llm import manifest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def tree(digests):
    """The root, and of each node its (left, right) siblings level by level."""
    ways, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for i, p in enumerate(at):
            run = level[p - p % 3 : p - p % 3 + 3]
            ways[i].append(("".join(run[: p % 3]), "".join(run[p % 3 + 1 :])))
            at[i] = p // 3
        level = [h(*level[i : i + 3]) for i in range(0, len(level), 3)]
    return level[0], ways


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"])))


def brute(rows):
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[s] = tree([leaf(r) for r in by[s]])
    root, above = tree([trees[s][0] for s in sources])
    out = []
    for s, outer in zip(sources, above):
        for r, way in zip(by[s], trees[s][1]):
            way = way + outer
            proof = h(*(x for step in way for x in step))
            changed = dict(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and r["text"] is not None:
                changed["text"] = r["text"].replace("\n", "")
            found = leaf(changed)
            for left, right in way:
                found = h(left, found, right)
            out.append((r["doc_id"], leaf(r), trees[s][0], root, proof, found, found == root))
    return out


def rows_of(sizes):
    rows = []
    for s, n in sizes.items():
        rows += [{"doc_id": i * 7 % n + 1000 * len(rows), "text": f"é{i}\nx\n" if i % 3 else f"{i}", "lang": None if i % 5 else "en", "source": s, "n_chars": i} for i in range(n)]
    return rows


ODD = [
    {"doc_id": None, "text": None, "lang": None, "source": None, "n_chars": None},
    {"doc_id": None, "text": None, "lang": None, "source": None, "n_chars": None},
    {"doc_id": None, "text": "a\n", "lang": "", "source": None, "n_chars": 2},
    {"doc_id": 5, "text": "", "lang": "-", "source": "", "n_chars": 0},
    {"doc_id": 5, "text": "\n", "lang": "-", "source": "", "n_chars": 0},
    {"doc_id": -3, "text": "日\n" * 5000, "lang": "x", "source": "ﬀ", "n_chars": 2**60},
    {"doc_id": 2**62 + 1, "text": "\n", "lang": "x", "source": "😀", "n_chars": 1},
]


def asked(spark, rows, **how):
    docs = spark.createDataFrame([tuple(r[c.split()[0]] for c in COLUMNS.split(", ")) for r in rows], COLUMNS)
    docs = docs.withColumns({c: F.lit("x") for c in ("tree", "rank", "digest", "n", "block", "group", "path", "at")})
    return [tuple(r[c] for c in NAMES) for r in manifest.manifest(docs, **how).collect()]


@pytest.mark.parametrize("height", [1, 2])
def test_equals_plain_trees(spark, height):
    rows = rows_of({"a": 1, "b": 3, "c": 4, "d": 9, "e": 10, "f": 28, "hot": 300, **{f"s{i}": 2 for i in range(12)}}) + ODD
    assert Counter(asked(spark, rows, height=height)) == Counter(brute(rows))


def test_repeated_row_on_a_third(spark):
    rows = rows_of({"a": 200}) + [ODD[3]] * 100
    assert Counter(asked(spark, rows, height=2)) == Counter(brute(rows))


def test_tampering_is_found_and_nothing_else(spark):
    rows = rows_of({"a": 50, "b": 2})
    by = {r["doc_id"]: r for r in rows}
    for found in asked(spark, rows):
        r = by[found[0]]
        assert found[-1] == (zlib.crc32(str(found[0]).encode()) % 2 == 1 or "\n" not in r["text"])


def test_small_tables(spark):
    one = [ODD[5]]
    assert asked(spark, one) == brute(one)
    assert asked(spark, one)[0][4] == h()
    assert asked(spark, []) == []


def test_hot_source_is_many_superblocks(spark):
    leaves = spark.range(3000).selectExpr("'hot' as tree", "id as doc_id", "sha2(cast(id as string), 256) as digest")
    dealt = manifest.Forest(manifest.ranked(leaves, [F.col("doc_id")], "t"), manifest.Shape(3, 3)).rounds[0][0]
    sizes = [r["count"] for r in dealt.groupBy("block").count().collect()]
    assert max(sizes) == 27 and len(sizes) == 112
    assert dealt.filter("rank <> doc_id or n <> 3000").count() == 0
