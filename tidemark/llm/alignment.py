"""Which tokens of two tokenizers cover the same stretches of a text."""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.packing import byte_letters
from tidemark.llm.text import documents, sliced
from tidemark.sources.tables import materialized

#: A chunk begins at a space behind anything but white space, where both tokenizers begin a new token:
#: the byte-level rules cut before it, and no piece of the other vocabulary holds a space mark behind another character.
_CHUNK = re.compile(r" (?:[^ ]+|(?<=\s) )*")
_ROOM = 300_000
#: Fixed value: the rules by which byte-level vocabularies of this kind cut a text before merging.
_RULES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_level(path: str) -> tuple[dict[bytes, int], list[bytes]]:
    """Ids by token bytes, and the token bytes by id, of a byte-level vocabulary whose ids follow the order of its merges."""
    with open(path, encoding="utf-8") as file:
        tokenizer = json.load(file)
    vocabulary, rules = tokenizer["model"]["vocab"], tokenizer["pre_tokenizer"]
    made = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in tokenizer["model"]["merges"]]
    if tokenizer["normalizer"] or rules["type"] != "ByteLevel" or not rules["use_regex"] or rules["add_prefix_space"] or made != sorted(made):
        raise ValueError("a byte-level vocabulary with ids in the order of its merges is needed")
    letters = {letter: byte for byte, letter in byte_letters().items()}
    by_id = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        by_id[i] = bytes(map(letters.__getitem__, token))
    return {token: i for i, token in enumerate(by_id) if token}, by_id


def gallop(short: np.ndarray, long: np.ndarray, stride: int = 32) -> np.ndarray:
    """For each number of short, ascending, the first place in long, ascending, whose number is not smaller.

    Doubling steps from a finger bracket the place, a binary search finds it. Every
    stride-th number is searched first, and its place is the finger of the numbers
    behind it, so a search costs the logarithm of the gap between neighbours.
    """
    n = len(long)
    low = np.repeat(gallop(short[::stride], long), stride)[: len(short)] if len(short) > stride else np.zeros(len(short), np.int64)
    high, step, ahead = low.copy(), 1, np.arange(len(short))
    while len(ahead):
        ahead = ahead[high[ahead] < n]
        ahead = ahead[long[high[ahead]] < short[ahead]]
        low[ahead] = high[ahead] + 1
        high[ahead] += step
        step *= 2
    np.minimum(high, n, out=high)
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) // 2
        less = long[middle] < short[open_]
        low[open_[less]] = middle[less] + 1
        high[open_[~less]] = middle[~less]
        open_ = open_[low[open_] < high[open_]]
    return low


def common_ends(texts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text's two ascending lists of ends, the ranks in both of the ends that they share.

    Of each text the shorter list drives the search. The lists of all texts are laid
    end to end, each text behind the last end of the one before, and searched at once.
    """
    if not texts:
        return []
    sides = [(a, b) if len(a) <= len(b) else (b, a) for a, b in texts]
    lasts = np.array([max(a[-1] if len(a) else -1, b[-1] if len(b) else -1) + 1 for a, b in texts], np.int64)
    shifts = np.cumsum(lasts) - lasts
    short, long = (np.concatenate([pair[i] + shift for pair, shift in zip(sides, shifts)]) for i in (0, 1))
    places = gallop(short, long)
    met = places < len(long)
    met[met] = long[places[met]] == short[met]
    from_short, from_long = (np.cumsum([0, *(len(pair[i]) for pair in sides)]) for i in (0, 1))
    hits, found = np.flatnonzero(met), []
    bounds = np.searchsorted(hits, from_short)
    for k, (a, b) in enumerate(texts):
        ranks = hits[bounds[k] : bounds[k + 1]]
        pair = ranks - from_short[k], places[ranks] - from_long[k]
        found.append(pair if len(a) <= len(b) else pair[::-1])
    return found


def linked(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, wide: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """(codes, times): the distinct id pairs that share a group, as a << 32 | b ascending, and how many links each has.

    The ranks' differences give the tokens of each group. Of a group with more
    than wide links the distinct ids are paired, with their counts multiplied, so
    a long stretch without a common end costs its distinct pairs only.
    """
    p, q = np.diff(ends_a, prepend=-1), np.diff(ends_b, prepend=-1)
    from_a, from_b = ends_a + 1 - p, ends_b + 1 - q
    large = np.flatnonzero(p * q > wide)
    per_token = np.where(p * q > wide, 0, q).repeat(p)
    first = np.repeat(from_b, p) - (np.cumsum(per_token) - per_token)
    pair_b = b[np.arange(int(per_token.sum())) + np.repeat(first, per_token)]
    codes, times = np.unique(np.repeat(a, per_token).astype(np.int64) << 32 | pair_b, return_counts=True)
    if not len(large):
        return codes, times
    parts = [(codes, times)]
    for g in large:
        x, nx = np.unique(a[from_a[g] : from_a[g] + p[g]], return_counts=True)
        y, ny = np.unique(b[from_b[g] : from_b[g] + q[g]], return_counts=True)
        parts.append(((x.astype(np.int64)[:, None] << 32 | y).ravel(), (nx[:, None] * ny).ravel()))
    codes, place = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    times = np.zeros(len(codes), np.int64)
    np.add.at(times, place, np.concatenate([t for _, t in parts]))
    return codes, times


class Pair:
    """Both tokenizers of a Python worker. Chunks met before are looked up, the new ones of a batch are encoded together."""

    def __init__(self, path_a: str, path_b: str):
        import tiktoken
        from sentencepiece import SentencePieceProcessor

        vocabulary, self.bytes_a = byte_level(path_a)
        self.a = tiktoken.Encoding("a", pat_str=_RULES, mergeable_ranks=vocabulary, special_tokens={})
        self.b = m = SentencePieceProcessor(model_file=path_b)
        pieces = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        self.bytes_b = [bytes([int(x[1:-1], 16)]) if m.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(pieces)]
        self.mark = m.piece_to_id("▁")
        if any("▁" in x.lstrip("▁") for x in pieces) or m.normalize("a  b ") != "▁a▁▁b▁":
            raise ValueError("a vocabulary whose pieces hold no space mark behind other characters is needed, and one that keeps spaces")
        self.lengths_a, self.lengths_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        # Ids as text, each with what stands behind it inside a group and at its side's end.
        numbers = [[b"%d" % i for i in range(len(x))] for x in (pieces, self.bytes_a)]
        self.written = np.array([x + end for ids, ends in zip(reversed(numbers), ((b",", b"|"), (b",", b";"))) for end in ends for x in ids], object)
        self.young: dict[str, tuple[bytes, bytes]] = {}
        self.old: dict[str, tuple[bytes, bytes]] = {}

    def _encode(self, chunks: list[str]) -> None:
        ids_a = map(self.a.encode_ordinary, chunks)
        # The vocabulary puts the first space back; a chunk of nothing but it is the mark alone.
        ids_b = [x or [self.mark] for x in self.b.encode([c[1:] for c in chunks], num_threads=1)]
        for chunk, x, y in zip(chunks, ids_a, ids_b):
            self.young[chunk] = pack(f"<{len(x)}I", *x), pack(f"<{len(y)}I", *y)

    def encoded(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of space + text by a, of text by b; none for an empty text or one whose bytes either side changes."""
        cut = [_CHUNK.findall(" " + text) if text else [] for text in texts]
        new = {}
        for chunk in set().union(*cut):
            if chunk not in self.young:
                if chunk in self.old:
                    self.young[chunk] = self.old[chunk]
                else:
                    new[chunk] = None
        self._encode(list(new))
        nothing = np.zeros(0, np.uint32), np.zeros(0, np.uint32)
        for text, chunks in zip(texts, cut):
            found = [self.young[c] for c in chunks]
            a, b = (np.frombuffer(b"".join(part), "<u4") for part in zip(*found)) if found else nothing
            yield (a, b) if text and self._same(" " + text, a, b) else nothing
        if len(self.young) >= _ROOM:
            self.old, self.young = self.young, {}

    def _same(self, text: str, a: np.ndarray, b: np.ndarray) -> bool:
        whole = text.encode()
        return b"".join([self.bytes_a[i] for i in a.tolist()]) == whole and b"".join([self.bytes_b[i] for i in b.tolist()]) == whole

    def groups(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each text, the ranks of the tokens of a and of b that end together."""
        return common_ends([(np.cumsum(self.lengths_a[a]), np.cumsum(self.lengths_b[b])) for a, b in texts])

    def spelled(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> bytes:
        """`a1,a2|b1;a3|b2,b3`: the ids of each group, those of a first."""
        p, q, na, nb = np.diff(ends_a, prepend=-1), np.diff(ends_b, prepend=-1), len(self.bytes_a), len(self.bytes_b)
        order = np.empty(len(a) + len(b), np.int64)
        entry_a, entry_b = a.astype(np.int64), b.astype(np.int64) + 2 * na
        entry_a[ends_a] += na
        entry_b[ends_b] += nb
        order[np.arange(len(a)) + np.repeat(ends_b + 1 - q, p)] = entry_a
        order[np.arange(len(b)) + np.repeat(ends_a + 1, q)] = entry_b
        return b"".join(self.written[order].tolist())[:-1]


_LOADED: dict[tuple[str, str], Pair] = {}


def loaded(path_a: str, path_b: str) -> Pair:
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = Pair(path_a, path_b)
    return _LOADED[path_a, path_b]


_DOC = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
_WRITTEN = f"block bigint, {_DOC}, links binary, pair bigint, docs bigint"


def blocks(docs: DataFrame, path_a: str, path_b: str, block_bytes: int = 16 << 20) -> DataFrame:
    """Aligned documents, in blocks of about block_bytes of text, and the id pairs of each block, in one pass.

    A document's row has its links: the places of its pairs in the ascending list
    of the block's pairs as steps, and the times of each, compressed. A pair's row
    has the pair as a << 32 | b and in how many documents of the block it is linked.
    """
    names = [c.split()[0] for c in _WRITTEN.split(", ")]
    kinds = [pa.int64(), *[pa.int64()] * 5, pa.string(), pa.binary(), pa.int64(), pa.int64()]

    def batch(columns: list, n: int) -> pa.RecordBatch:
        return pa.record_batch([pa.nulls(n, t) if c is None else pa.array(c, t) for c, t in zip(columns, kinds)], names)

    def flushed(block: int, rows: list[tuple], links: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        pairs, place, docs_ = np.unique(np.concatenate([codes for codes, _ in links]), return_inverse=True, return_counts=True)
        at, packed = 0, []
        for codes, times in links:
            steps = np.diff(place[at : at + len(codes)], prepend=0)
            packed.append(zlib.compress(np.concatenate([steps, times]).astype("<u4").tobytes(), 1))
            at += len(codes)
        for start in range(0, len(rows), 1000):
            part = list(zip(*rows[start : start + 1000]))
            yield batch([[block] * len(part[0]), *part, packed[start : start + 1000], None, None], len(part[0]))
        for start in range(0, len(pairs), 10_000):
            part = pairs[start : start + 10_000]
            yield batch([np.full(len(part), block), *[None] * 7, part, docs_[start : start + 10_000]], len(part))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = loaded(path_a, path_b)
        block, held, rows, links = TaskContext.get().partitionId() << 32, 0, [], []
        for part in sliced(batches, 64):
            texts = part.column("text").to_pylist()
            ids = list(both.encoded(texts))
            for doc_id, text, (a, b), (ends_a, ends_b) in zip(part.column("doc_id").to_pylist(), texts, ids, both.groups(ids)):
                codes, times = linked(a, b, ends_a, ends_b)
                digest = hashlib.sha256(both.spelled(a, b, ends_a, ends_b)).hexdigest() if len(a) else ""
                rows.append((doc_id, len(a), len(b), len(ends_a), int(times.sum()), digest))
                links.append((codes, times))
                held += len(text)
                if held >= block_bytes:
                    yield from flushed(block, rows, links)
                    block, held, rows, links = block + 1, 0, [], []
        if rows:
            yield from flushed(block, rows, links)

    return documents(docs).mapInArrow(work, _WRITTEN)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(pair, count, best): in how many documents each pair is linked, and whether its a has no pair with more."""
    counts = pairs.groupBy("pair").agg(F.sum("docs").alias("count"))
    counts = materialized(counts.select("pair", "count", F.shiftright("pair", 32).alias("a")), "pair-counts")
    top = counts.groupBy("a").agg(F.max("count").alias("top"))
    return counts.join(top, "a").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))


def aligned(docs: DataFrame, path_a: str, path_b: str, block_bytes: int = 16 << 20) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every whole text.

    Tokens of both sides that end at the same byte cut a text into groups; every
    token of a links to every token of b in its group. n_best are the links whose
    pair of ids is linked in as many documents as any pair of that a, count_sum
    adds up the counts of the links' pairs.

    Documents are aligned once, in blocks. What goes through the exchange is one
    row per distinct pair of a block, which is summed up per pair and joined back;
    a block then meets its pairs and looks its documents' links up. A block and its
    distinct pairs fit in a task, whatever a pair's share of the corpus.

    Null and empty texts, and texts whose bytes a tokenizer changes, have zeros and
    an empty digest. A document is a row: repeated rows count each, null ids are
    rows like any other, other columns are left behind, an empty table gives an empty one.
    """
    cut = materialized(blocks(docs, path_a, path_b, block_bytes), "aligned")
    pairs = cut.filter("pair is not null").select("block", "pair", "docs")
    answered = pairs.select(F.col("block").alias("of"), "pair").join(pair_counts(pairs), "pair")
    held = cut.filter("links is not null").drop("pair", "docs")
    out = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def looked_up(rows: pa.Table, known: pa.Table) -> pa.Table:
        known = known.take(pc.sort_indices(known["pair"])) if known.num_rows else known
        counts, best = known["count"].to_numpy(), known["best"].to_numpy()
        found = []
        for packed in rows["links"].to_pylist():
            steps, times = np.frombuffer(zlib.decompress(packed), "<u4").astype(np.int64).reshape(2, -1)
            place = np.cumsum(steps)
            found.append((int(times @ best[place]), int(times @ counts[place])))
        n_best, count_sum = zip(*found)
        rows = rows.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))
        return rows.select(out)

    schema = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    return held.groupBy("block").cogroup(answered.groupBy("of")).applyInArrow(looked_up, schema)
