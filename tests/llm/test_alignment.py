import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import alignment
from tidemark.llm.packing import byte_letters
from tidemark.llm.queries import tokenizer

A, B = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    " ", "  a  b\n\t x  ", "<s> </s><unk> <0x41> <|endoftext|>", "a\x00b don't we'll", "日本語 😀!! ÀÉÎ", "x" * 9_000, " " * 3_000, "\n\n  \n",
    "a \n b\n  c   d  e\x85 f\x1c g　h 　 i", "tick " * 4_000, "a▁b", "▁", "ends ", "١٢٣ 🏳️‍🌈 é́",
]


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain(text, both):
    """The groups of a text as lists of ids, straight from both libraries."""
    a, b = both
    letters = {v: k for k, v in byte_letters().items()}
    ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
    ids_b = b.encode(text) if text else []
    bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    whole = (" " + text).encode()
    if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return []
    groups, x, y, end_a, end_b = [], [], [], 0, 0
    i = j = 0
    while i < len(ids_a) or j < len(ids_b):
        if end_a <= end_b and i < len(ids_a):
            x.append(ids_a[i])
            end_a, i = end_a + len(bytes_a[i]), i + 1
        else:
            y.append(ids_b[j])
            end_b, j = end_b + len(bytes_b[j]), j + 1
        if end_a == end_b:
            groups.append((x, y))
            x, y = [], []
    return groups


def brute(rows, both):
    found = [(i, plain(t or "", both)) for i, t in rows]
    links = [Counter((x, y) for xs, ys in groups for x in xs for y in ys) for _, groups in found]
    counts = Counter(pair for held in links for pair in held)
    top = defaultdict(int)
    for (x, _), n in counts.items():
        top[x] = max(top[x], n)
    out = Counter()
    for (i, groups), held in zip(found, links):
        spelled = ";".join(f"{','.join(map(str, xs))}|{','.join(map(str, ys))}" for xs, ys in groups)
        digest = hashlib.sha256(spelled.encode()).hexdigest() if groups else ""
        best = sum(n for (x, y), n in held.items() if counts[x, y] == top[x])
        total = sum(n * counts[pair] for pair, n in held.items())
        out[i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(held.values()), best, total, digest] += 1
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(0, 400)), st.sets(st.integers(0, 400))), max_size=5), st.sampled_from([1, 2, 32]))
def test_common_ends_equal_set_intersections(lists, stride):
    texts = [tuple(np.array(sorted(s), np.int64) for s in pair) for pair in lists]
    for (a, b), (i, j) in zip(texts, alignment.common_ends(texts)):
        assert a[i].tolist() == b[j].tolist() == np.intersect1d(a, b).tolist()
    for a, b in texts:
        assert alignment.gallop(a, b, max(2, stride)).tolist() == np.searchsorted(b, a).tolist()


def test_gallop_far_apart():
    long = np.arange(0, 3_000_000, 3)
    short = np.array([2, 3, 4, 299_997, 2_999_997, 2_999_998])
    assert alignment.gallop(short, long).tolist() == np.searchsorted(long, short).tolist()


@pytest.mark.parametrize("wide", [0, 4, 4096])
def test_linked_equals_all_pairs(wide):
    draw = random.Random(wide)
    for _ in range(50):
        sizes = [(draw.randint(1, 9), draw.randint(1, 9)) for _ in range(draw.randint(0, 20))]
        a = np.array([draw.randrange(5) for p, _ in sizes for _ in range(p)], np.uint32)
        b = np.array([draw.randrange(5) for _, q in sizes for _ in range(q)], np.uint32)
        ends_a, ends_b = (np.cumsum([s[k] for s in sizes], dtype=np.int64) - 1 for k in (0, 1))
        want, at, to = Counter(), 0, 0
        for p, q in sizes:
            want.update((int(x), int(y)) for x in a[at : at + p] for y in b[to : to + q])
            at, to = at + p, to + q
        codes, times = alignment.linked(a, b, ends_a, ends_b, wide)
        assert {(c >> 32, c & 0xFFFFFFFF): t for c, t in zip(codes.tolist(), times.tolist())} == want
        assert (np.diff(codes) > 0).all()


def test_chunks_give_the_ids_of_whole_texts(both, spark, tiny):
    draw = random.Random(2)
    parts = [" ", " ", "a", "e", "'s", "t", "\n", ".", "1", "é", "日", "😀", " ", "\x1c", "　", "in", "the ", "\t"]
    texts = ["".join(draw.choice([*parts, chr(draw.randrange(32, 0x3000))]) for _ in range(draw.randint(1, 60))) for _ in range(3000)]
    texts = [t for t in [*texts, *ODD, *(r.text for r in spark.read.parquet(f"{tiny}/documents.parquet").collect())] if t and "▁" not in t]
    for text, (a, b) in zip(texts, alignment.Pair(A, B).encoded(texts)):
        assert a.tolist() == both[0].encode(" " + text, add_special_tokens=False).ids and b.tolist() == both[1].encode(text)


@pytest.mark.parametrize("block_bytes", [2_000, 1 << 24])
def test_equals_brute_force(spark, tiny, both, block_bytes):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{tiny}/documents.parquet").limit(60).collect()]
    rows += [(None, None), (7, ""), (7, "a b"), (7, "a b"), (None, "a b"), *enumerate(ODD, 1000)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], COLUMNS).repartition(3).withColumns({c: F.lit("x") for c in ("block", "pair", "docs", "links", "count")})
    got = Counter(tuple(r[c] for c in NAMES) for r in alignment.aligned(docs, A, B, block_bytes).collect())
    assert got == brute(rows, both)


def test_texts_without_tokens_only(spark):
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", None, None, None)], COLUMNS)
    assert sorted(tuple(r[c] for c in NAMES) for r in alignment.aligned(docs, A, B).collect()) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
    assert alignment.aligned(docs.limit(0), A, B).count() == 0
