import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import packing
from tidemark.llm.queries import tokenizer

TOKENIZER = tokenizer()
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD = [
    "don't stop it's 'quoted' ÀÉÎ œuvre ßtraße µm ª 12ab3 a1,b2;;c <|endoftext|>X <|ENDOFTEXT|> İstanbul ΣΑΣ naïve \x1c\x1d y\x85z 日本語 😀!!",
    "×÷÷a ÷ ×", "a\x00b \x7f", "ab́c d́", "12,345.67%$# a.b...c", "É K Å ſs", " \t\n", "x" * 5000,
]


def test_ids_equal_the_tokenizer(tiny, spark):
    whole, tokens = Tokenizer.from_file(TOKENIZER), packing.Tokens(TOKENIZER, room=500)
    texts = [r.text for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()]
    for text in [*texts, *ODD]:
        assert np.frombuffer(tokens.ids(text.encode()), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(20))
def test_fullest_equals_all_subsets(seed):
    draw = random.Random(seed)
    counts = {draw.randint(1, 40): draw.randint(1, 3) for _ in range(5)}
    room = draw.randint(1, 120)
    items = [x for x, n in counts.items() for _ in range(n)]
    best = max((s for k in range(len(items) + 1) for c in itertools.combinations(items, k) if (s := sum(c)) <= room), default=0)
    chosen = packing.fullest(room, counts)
    assert sum(chosen) == best and not Counter(chosen) - Counter(counts)


def test_patterns_use_everything_once():
    draw = random.Random(1)
    histogram = Counter(draw.choice([draw.randint(1, 100), 50, 7]) for _ in range(3000))
    used = Counter()
    for bin_, times in packing.patterns(histogram, 100):
        assert sum(bin_) <= 100
        for x in bin_:
            used[x] += times
    assert used == histogram
    assert sum(t for _, t in packing.patterns(histogram, 100)) <= 1.01 * sum(x * n for x, n in histogram.items()) / 100


def test_round_trip(spark, tiny):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{tiny}/documents.parquet").limit(80).collect()]
    rows += [(5001, None), (5002, ""), (5002, ""), (None, "a b"), (5003, "tick tock " * 9000), (5004, " ".join(ODD))]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], COLUMNS).withColumn("length", F.lit("x")).withColumn("rank", F.lit(1))
    got = packing.packed(docs, TOKENIZER).collect()
    whole = Tokenizer.from_file(TOKENIZER)
    expected = Counter()
    total = 0
    for i, t in rows:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        total += len(ids)
        for n, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            expected[(i, n, start, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) == -(-total // 4096)
    assert packing.packed(docs.limit(0), TOKENIZER).count() == 0


def test_hot_length_is_ranked_over_slices(spark):
    cut = spark.range(5000).selectExpr("id as doc_id", "0 as piece", "0L as start", "if(id % 3 = 0, 9L, id % 5 + 1) as length", "id as ids_crc32")
    rows = packing.ranked(cut, slice_rows=100).collect()
    by = defaultdict(list)
    for r in rows:
        by[r["length"]].append(r["rank"])
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
