import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import ngram

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def model(rows, order, mu):
    """Recursive definition of the smoothed probabilities, and the unigram base."""
    train = [tokens(t) for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 5 != 1]
    counts = [Counter() for _ in range(order + 1)]
    for words in train:
        stream = [b"", *words]
        for n in range(1, order + 1):
            for i in range(n - 1 if n > 1 else 1, len(stream)):
                counts[n][tuple(stream[i - n + 1 : i + 1])] += 1
    total, kinds = sum(counts[1].values()), len(counts[1])

    def chance(history, w):
        if not history:
            return (counts[1][(w,)] + 0.5) / (total + 0.5 * (kinds + 1))
        c = counts[len(history)][history]
        if not c:
            return chance(history[1:], w)
        return (counts[len(history) + 1][(*history, w)] + mu * chance(history[1:], w)) / (c + mu)

    def score(text):
        stream, out = [b"", *tokens(text)], 0.0
        for i in range(1, len(stream)):
            out += math.log10(chance(tuple(stream[max(0, i - order + 1) : i]), stream[i]))
        return out

    base = lambda text: sum(math.log10(chance((), w)) for w in tokens(text))
    known = lambda text: sum(counts[1][(w,)] > 0 for w in tokens(text))
    return chance, score, base, known, total, counts


@pytest.mark.parametrize("order,block_tokens,bucket_bytes", [(2, 500_000, 12 << 20), (2, 700, 5000), (3, 3000, 20_000), (4, 900, 50_000)])
def test_equals_the_definition(spark, tiny, order, block_tokens, bucket_bytes):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{tiny}/documents.parquet").limit(60).collect()]
    long = " ".join(f"W{i % 977}" for i in range(30_000))
    rows += [(1001, None), (1002, ""), (None, "The the THE É é"), (1003, long), (7, rows[0][1]), (7, rows[0][1])]
    docs = spark.createDataFrame([(i, t, "x", None, 1) for i, t in rows], COLUMNS).withColumn("block", F.lit("b")).withColumn("learned", F.lit(5))
    mu = 3.0
    got = ngram.scored(docs, order, mu, block_tokens, bucket_bytes).collect()
    chance, score, base, known, total, counts = model(rows, order, mu)
    key = lambda r: (str(r[0]), round(r[-1], 5))
    expected = sorted(((i, i is not None and zlib.crc32(str(i).encode()) % 5 == 1, len(tokens(t)), known(t), total, base(t), score(t)) for i, t in rows), key=key)
    got = sorted((tuple(r) for r in got), key=key)
    assert len(got) == len(expected)
    for g, e in zip(got, expected):
        assert g[:5] == e[:5]
        assert g[5] == pytest.approx(e[5], rel=1e-9) and g[6] == pytest.approx(e[6], rel=1e-9)
    # Each state's probabilities sum to one, with one unknown word.
    words = [w for (w,) in counts[1]]
    for history in [(), *list(counts[1])[:5], *(list(counts[2])[:3] if order > 2 else [])]:
        assert sum(chance(history, w) for w in [*words, b"never seen"]) == pytest.approx(1.0)


def test_no_training_and_empty(spark):
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    docs = spark.createDataFrame([(only, "a b", None, None, None)], COLUMNS)
    row = ngram.scored(docs).first()
    assert row.held_out and (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0)
    assert row.base_score == 0.0 and row.score == 0.0
    assert ngram.scored(docs.limit(0)).count() == 0
