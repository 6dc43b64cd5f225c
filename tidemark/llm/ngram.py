"""Language-model scores from a weighted backoff automaton over smoothed n-grams."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.text import documents, raw, sliced
from tidemark.sources.tables import materialized

#: The end of a document, which is also the history its first word follows. No word is empty.
END = b""
_BASE = np.uint64(0x9E3779B97F4A7C15)


def in_training() -> F.Column:
    """Documents to learn from: the checksum of doc_id modulo 5 is not 1; a null doc_id is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 != 1, F.lit(True))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)


def packed(values: np.ndarray) -> bytes:
    """An array of numbers with the bytes of one place side by side, compressed: small numbers cost little."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return planes.T.copy().view(kind).ravel()


def _joined(words: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"\n".join(words))


def _split(data: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(data).split(b"\n")


_BLOCK = "block bigint, doc_ids array<bigint>, training array<boolean>, sizes array<int>, ids binary, words binary, counts binary"


def blocks(docs: DataFrame, block_tokens: int) -> DataFrame:
    """One row per block of about block_tokens tokens: its documents as word numbers, its words, their training counts.

    Words are numbered as they come, so frequent ones have small numbers. Every
    text ends with END. A document is never split.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 32, 0

        def row():
            words = list(vocabulary)
            ids = np.concatenate(held)
            sizes = [len(x) for x in held]
            counts = np.bincount(ids[np.repeat(training, sizes)], minlength=len(words)).astype(np.int32)
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary())
            values = (base + made, doc_ids, training, sizes, packed(ids), _joined(words), packed(counts))
            return pa.record_batch([pa.array([v], t) for v, t in zip(values, kinds)], ["block", "doc_ids", "training", "sizes", "ids", "words", "counts"])

        def fresh():
            table = defaultdict()
            table.default_factory = table.__len__
            return table, [], [], [], 0

        vocabulary, held, doc_ids, training, tokens = fresh()
        for batch in sliced(batches, 128):
            for doc_id, learned, text in zip(batch.column("doc_id").to_pylist(), batch.column("learned").to_pylist(), raw(batch.column("text"))):
                words = text.lower().split()
                words.append(END)
                held.append(np.array([vocabulary[w] for w in words], np.int32))
                doc_ids.append(doc_id)
                training.append(learned)
                tokens += len(words)
                if tokens >= block_tokens:
                    yield row()
                    made += 1
                    vocabulary, held, doc_ids, training, tokens = fresh()
        if held:
            yield row()

    rows = documents(docs)
    return rows.withColumn("learned", in_training()).mapInArrow(work, _BLOCK)


class Block:
    """The n-grams of a block. Arrays of order n hold one entry per distinct n-gram of the block."""

    def __init__(self, row: dict, order: int):
        self.words = _split(row["words"])
        self.ids = unpacked(row["ids"], np.int32).astype(np.int64)
        self.sizes = np.array(row["sizes"], np.int64)
        self.training = np.array(row["training"], bool)
        self.doc_ids = row["doc_ids"]
        size, end = len(self.words), self.words.index(END)
        # Every document with END before it, in one stream; at holds the place of each document's first token.
        starts = np.cumsum(self.sizes + 1) - self.sizes
        stream = np.full(len(self.ids) + len(self.sizes), end, np.int64)
        real = np.ones(len(stream), bool)
        real[starts - 1] = False
        stream[real] = self.ids
        learned = np.repeat(self.training, self.sizes + 1)
        self.end, self.grams, self.hashes = end, [], _word_hashes(self.words)
        index, valid, own = stream, np.ones(len(stream), bool), self.hashes
        first = ~real
        for n in range(2, order + 1):
            # An n-gram ends at i if an (n-1)-gram ends at i-1 and i does not begin a document.
            valid = np.concatenate([[False], valid[:-1]]) & ~first
            at = np.flatnonzero(valid)
            keys, back = np.unique(index[at - 1] * size + stream[at], return_inverse=True)
            prefix, word = keys // size, keys % size
            suffix = np.empty(len(keys), np.int64)
            suffix[back] = index[at]
            own = _mixed(own[prefix] * _BASE + self.hashes[word])
            counts = np.bincount(back[learned[at]], minlength=len(keys))
            self.grams.append({"prefix": prefix, "word": word, "suffix": suffix, "hash": own, "counts": counts})
            index = np.full(len(stream), -1, np.int64)
            index[at] = back


_REQUEST = "bucket int, block bigint, keys binary, counts binary"
_REPLY = "n int, bucket int, block bigint, counts binary"


def _rows(names: list[str], kinds: tuple, rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds], names)


def _places(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """56-bit keys, their order by bucket and key, and where each bucket ends."""
    keys = hashes >> np.uint64(8)
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    return keys, np.lexsort((keys, bucket)), np.cumsum(np.bincount(bucket, minlength=buckets))


def _requests(block: int, ends: np.ndarray, keys, counts: np.ndarray) -> pa.RecordBatch:
    """A row per bucket that the block asks; keys(a, b) packs the keys at places a to b."""
    rows = [(b, block, keys(e - k, e), packed(counts[e - k : e])) for b, (e, k) in enumerate(zip(ends.tolist(), np.diff(ends, prepend=0).tolist())) if k]
    return _rows(["bucket", "block", "keys", "counts"], (pa.int32(), pa.int64(), pa.binary(), pa.binary()), rows)


def _word_requests(stored: DataFrame, buckets: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = _split(row["words"])
                _, order, ends = _places(_word_hashes(words), buckets)
                words = [words[i] for i in order]
                yield _requests(row["block"], ends, lambda a, b: _joined(words[a:b]), unpacked(row["counts"], np.int32)[order])

    return stored.select("block", "words", "counts").mapInArrow(work, _REQUEST)


def _gram_requests(stored: DataFrame, n: int, buckets: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                gram = Block(row, n).grams[-1]
                keys, order, ends = _places(gram["hash"], buckets)
                keys = keys[order]
                # Sorted keys are sent as their differences.
                yield _requests(row["block"], ends, lambda a, b: packed(np.diff(keys[a:b], prepend=np.uint64(0))), gram["counts"][order].astype(np.int32))

    return stored.mapInArrow(work, _REQUEST)


def _answered(requests: DataFrame, n: int) -> DataFrame:
    """For each request the corpus counts of its keys, in its order; for words also a row of block -1 with N and V of the bucket."""

    def words(table: pa.Table) -> pa.Table:
        total: dict[bytes, int] = {}
        rows = table.to_pylist()
        split = [(_split(r["keys"]), unpacked(r["counts"], np.int32).tolist()) for r in rows]
        for keys, counts in split:
            for k, c in zip(keys, counts):
                total[k] = total.get(k, 0) + c
        out = [(n, r["bucket"], r["block"], packed(np.array([total[k] for k in keys], np.int64))) for r, (keys, _) in zip(rows, split)]
        known = [c for c in total.values() if c]
        out.append((n, rows[0]["bucket"], -1, packed(np.array([sum(known), len(known)], np.int64))))
        return reply(out)

    def grams(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys = [np.cumsum(unpacked(r["keys"], np.uint64)) for r in rows]
        distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
        own = np.concatenate([unpacked(r["counts"], np.int32) for r in rows])
        total = np.bincount(back, weights=own, minlength=len(distinct)).astype(np.int64)[back]
        ends = np.cumsum([len(k) for k in keys])
        return reply([(n, r["bucket"], r["block"], packed(total[e - len(k) : e])) for r, k, e in zip(rows, keys, ends)])

    def reply(rows: list[tuple]) -> pa.Table:
        return pa.Table.from_batches([_rows(["n", "bucket", "block", "counts"], (pa.int32(), pa.int32(), pa.int64(), pa.binary()), rows)])

    return requests.groupBy("bucket").applyInArrow(words if n == 1 else grams, _REPLY)


class Automaton:
    """States are the n-grams, shorter than order, that the training texts hold; state 0 is the empty history.

    A state has arcs for the words that followed it in training. For any other
    word it fails to the state of its history without the oldest word, at the cost
    of its backoff weight. Weights are the smoothed probabilities
    (count + mu * shorter) / (history + mu), which leave mu / (history + mu) to
    what did not follow, so each state's probabilities sum to one.
    """

    def __init__(self, block: Block, totals: list[np.ndarray], n_tokens: int, n_words: int, mu: float):
        self.size = size = len(block.words)
        chance = (totals[0] + 0.5) / (n_tokens + 0.5 * (n_words + 1))
        self.unigram = np.log10(chance)
        # Number of the state of each n-gram, by order; 0 where training does not hold it.
        states, base = [], 1
        for c in totals[: len(block.grams)]:
            states.append(np.where(c > 0, np.arange(base, base + len(c)), 0))
            base += len(c)
        self.fail, self.cost = [0] * base, [0.0] * base
        back = lambda c: np.log10(mu / (c + mu))
        self._put(states[0], np.zeros(size, np.int64), back(totals[0]))
        self.arcs: dict[int, tuple[float, int]] = {}
        history, chances = totals[0], chance
        for i, (gram, c) in enumerate(zip(block.grams, totals[1:])):
            chances = (c + mu * chances[gram["suffix"]]) / (history[gram["prefix"]] + mu)
            inner = i + 1 < len(block.grams)
            if inner:
                self._put(states[i + 1], states[i][gram["suffix"]], back(c))
            seen = c > 0
            after = (states[i + 1] if inner else states[i][gram["suffix"]])[seen]
            source = states[i][gram["prefix"]][seen]
            keys = (source * size + gram["word"][seen]).tolist()
            self.arcs.update(zip(keys, zip(np.log10(chances[seen]).tolist(), after.tolist())))
            history = c
        self.start = int(states[0][block.end])
        self.single = states[0].tolist()

    def _put(self, states: np.ndarray, fail: np.ndarray, cost: np.ndarray) -> None:
        for s, f, c in zip(states.tolist(), fail.tolist(), cost.tolist()):
            if s:
                self.fail[s], self.cost[s] = f, c

    def score(self, ids: list[int]) -> float:
        """log10 probability of a text in one pass from left to right."""
        size, arc, fail, cost, single, unigram = self.size, self.arcs.get, self.fail, self.cost, self.single, self._unigram
        state, total = self.start, 0.0
        for w in ids:
            while state:
                found = arc(state * size + w)
                if found is not None:
                    total += found[0]
                    state = found[1]
                    break
                total += cost[state]
                state = fail[state]
            else:
                total += unigram[w]
                state = single[w]
        return total

    @property
    def unigram(self) -> np.ndarray:
        return np.array(self._unigram)

    @unigram.setter
    def unigram(self, values: np.ndarray) -> None:
        self._unigram = values.tolist()


_SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def scored(docs: DataFrame, order: int = 2, mu: float = 500.0, block_tokens: int = 500_000, bucket_bytes: int = 12 << 20) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every whole text (null: empty).

    All n-grams of all training texts count; none are pruned, and the model is
    never in one place. Documents are cut into blocks, and the n-grams of a block,
    each once, are sent as sorted arrays to buckets by hash. A bucket adds up the
    training counts from all blocks, so a frequent n-gram is one entry per block,
    and answers every block with the totals of what it asked for. The block then
    builds the part of the automaton that its own texts can reach and walks
    through them. Sizes of buckets and blocks are bounds on memory and change no
    result. Words are counted exactly; longer n-grams by 56-bit hash.

    Repeated rows count as often as they are given. With no training text every
    token is unknown. An empty table gives an empty table.
    """
    total = documents(docs).agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0))).first()[0]
    buckets = max(1, -(-total // bucket_bytes))
    stored = materialized(blocks(docs, block_tokens), "blocks")
    words = materialized(_answered(_word_requests(stored, buckets), 1), "word-counts")
    sums = [unpacked(r[0], np.int64) for r in words.filter("block = -1").select("counts").collect()]
    n_tokens, n_words = (int(sum(s[i] for s in sums)) for i in (0, 1))
    replies = words.filter("block >= 0")
    for n in range(2, order + 1):
        replies = replies.union(_answered(_gram_requests(stored, n, buckets), n))

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        block = Block(row, order)
        answers = sorted(right.select(["n", "bucket", "counts"]).to_pylist(), key=lambda r: (r["n"], r["bucket"]))
        totals = []
        for n in range(1, order + 1):
            got = np.concatenate([unpacked(r["counts"], np.int64) for r in answers if r["n"] == n])
            _, order_, _ = _places(block.hashes if n == 1 else block.grams[n - 2]["hash"], buckets)
            total = np.empty_like(got)
            total[order_] = got
            totals.append(total)
        automaton = Automaton(block, totals, n_tokens, n_words, mu)
        ends = np.cumsum(block.sizes)
        known = np.add.reduceat(totals[0][block.ids] > 0, ends - block.sizes, dtype=np.int64)
        bases = np.add.reduceat(automaton.unigram[block.ids], ends - block.sizes)
        ids = block.ids.tolist()
        scores = [automaton.score(ids[e - k : e]) for e, k in zip(ends.tolist(), block.sizes.tolist())]
        return pa.table(
            [pa.array(block.doc_ids, pa.int64()), pa.array(~block.training), pa.array(block.sizes), pa.array(known), pa.array([n_tokens] * len(scores), pa.int64()), pa.array(bases), pa.array(scores, pa.float64())],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return stored.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(work, _SCORES)
