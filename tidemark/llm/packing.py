"""Packing token sequences by minimum bin slack."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.text import documents, raw, sliced
from tidemark.sources.tables import materialized

#: Chunks that the tokenizer's own rules cut the same way as this pattern: ASCII without
#: apostrophes, and the precomposed Latin-1 letters.
_PLAIN = re.compile(r"[\x21-\x26\x28-\x7ea-zà-öø-ÿ]+")
_PIECES = re.compile(r"[a-zà-öø-ÿ]+|[0-9]|[^a-zà-öø-ÿ0-9]+")


def byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write each byte as a printable character: itself, or the next from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Kept(dict):
    """Answers kept for the next time, in two generations: when the young one is full, it becomes the old one.

    What is asked for again moves back into the young one, so frequent keys stay.
    """

    def __init__(self, answer, room: int):
        super().__init__()
        self.answer, self.room, self.old = answer, room, {}

    def __missing__(self, key: bytes) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.answer(key)
        if len(self) >= self.room:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Tokens:
    """Token ids of whole texts, white space cut first; a chunk met again is looked up.

    White space never lies inside a token of this vocabulary, so the ids of a text
    are those of its chunks. Ids are unsigned 32-bit little-endian numbers throughout.
    """

    def __init__(self, path: str, room: int = 400_000):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.letters = byte_letters()
        # A run of lower-case letters, a digit or a run of other characters is a chunk of one piece.
        self.chunks = Kept(self._chunk, room)

    def _piece(self, piece: bytes) -> bytes:
        letters = piece.decode() if piece.isascii() else piece.decode("latin-1").translate(self.letters)
        return struct.pack(f"<{len(found)}I", *[t.id for t in found]) if (found := self.whole.model.tokenize(letters)) else b""

    def _chunk(self, chunk: bytes) -> bytes:
        if chunk.isalpha():
            return self._piece(chunk) if chunk.islower() else self.chunks[chunk.lower()]
        if chunk[-1:] in (b",", b".") and chunk[:-1].isalpha():
            return self.chunks[chunk[:-1].lower()] + self.chunks[chunk[-1:]]
        text = chunk.decode()
        lower = text.lower()
        if "<|" in text or not _PLAIN.fullmatch(lower) or len(lower) != len(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        pieces = _PIECES.findall(lower)
        if len(pieces) == 1 and lower == text:
            return self._piece(chunk)
        return b"".join([self.chunks[p.encode()] for p in pieces])

    def ids(self, text: bytes) -> bytes:
        return b"".join(map(self.chunks.__getitem__, text.split()))


_LOADED: dict[str, Tokens] = {}


def loaded(path: str) -> Tokens:
    """The tokenizer of this Python worker, which keeps its table from task to task."""
    if path not in _LOADED:
        _LOADED[path] = Tokens(path)
    return _LOADED[path]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end: int = 1) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the token ids of each text and the end id, cut after every capacity ids.

    A null or empty text is its end id alone.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, last = loaded(tokenizer), struct.pack("<I", end)
        for batch in sliced(batches):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), raw(batch.column("text"))):
                ids = tokens.ids(text) + last
                for i, start in enumerate(range(0, len(ids) // 4, capacity)):
                    part = ids[4 * start : 4 * (start + capacity)]
                    rows.append((doc_id, i, start, len(part) // 4, zlib.crc32(part)))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return documents(docs).mapInArrow(work, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def fullest(room: int, counts: dict[int, int]) -> list[int]:
    """Lengths, out of counts[length] of each, whose sum comes closest to room from below.

    Subset sums as bits of one number: taking a length shifts the reachable sums.
    A length that is there k times enters as 1, 2, 4, ... copies. The search ends
    when room itself is reached.
    """
    full = (1 << room + 1) - 1
    reach, steps = 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, copies = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            take = min(copies, left)
            steps.append((length, take, reach))
            reach |= reach << length * take & full
            left, copies = left - take, copies * 2
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, []
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            chosen += [length] * take
            at -= length * take
    return chosen


def patterns(histogram: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """(lengths, times): bins by minimum bin slack, equal bins counted together.

    Each bin takes the longest length left and the fullest combination beside it.
    The combination is then removed as often as the counts allow, which is what
    the search would find again, so there are no more patterns than about the
    number of lengths, whatever the number of pieces.
    """
    left = {x: n for x, n in histogram.items() if n}
    out = []
    while left:
        first = max(left)
        rest = left | {first: left[first] - 1}
        bin_ = [first, *fullest(capacity - first, {x: n for x, n in rest.items() if n})]
        uses = {x: bin_.count(x) for x in bin_}
        times = min(left[x] // n for x, n in uses.items())
        out.append((bin_, times))
        for x, n in uses.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
    return out


def _plan(spark: SparkSession, histogram: dict[int, int], capacity: int) -> DataFrame:
    """Where the pieces of a length go: ranks low to high - 1 go to sequences from base on, per_bin to each, at the offsets given."""
    rows, base, used = [], 0, dict.fromkeys(histogram, 0)
    for bin_, times in patterns(histogram, capacity):
        at, places = 0, {}
        for x in bin_:
            places.setdefault(x, []).append(at)
            at += x
        for x, offsets in places.items():
            rows.append((x, used[x], used[x] + len(offsets) * times, base, offsets))
            used[x] += len(offsets) * times
        base += times
    return spark.createDataFrame(rows, "length bigint, low bigint, high bigint, base bigint, offsets array<bigint>")


def ranked(cut: DataFrame, slice_rows: int = 50_000) -> DataFrame:
    """cut with a gapless rank, from 0, among the pieces of the same length.

    Ranks are counted within hash slices of a length and shifted by the sizes of
    the slices before, so a length that many pieces share is not one task.
    """
    total = cut.count()
    slices = max(1, -(-total // slice_rows))
    dealt = cut.withColumn("slice", F.expr(f"cast(pmod(xxhash64(doc_id, piece, start, ids_crc32), {slices}) as int)"))
    sizes = dealt.groupBy("length", "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("length", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    inside = Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "ids_crc32")
    ranks = dealt.withColumn("place", F.row_number().over(inside) - 1)
    return ranks.join(shifts, ["length", "slice"]).withColumn("rank", F.col("place") + F.col("shift")).drop("slice", "place", "shift")


def packed(docs: DataFrame, tokenizer: str, capacity: int = 4096, end: int = 1) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): every piece at its place in a sequence.

    Only the histogram of lengths, at most capacity rows, reaches the driver and
    comes back as a plan of the same order, so the plan may be broadcast whatever
    the table's size. Repeated rows are pieces of their own. An empty table packs into nothing.
    """
    cut = materialized(pieces(docs, tokenizer, capacity, end), "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = _plan(cut.sparkSession, histogram, capacity)
    rows, p = ranked(cut).alias("r"), F.broadcast(plan).alias("p")
    found = rows.join(p, F.expr("r.length = p.length and r.rank >= p.low and r.rank < p.high"))
    nth = F.expr("r.rank - p.low")
    return found.select(
        "r.doc_id", "r.piece", "r.start", "r.length", "r.ids_crc32",
        (F.col("p.base") + F.floor(nth / F.size("p.offsets"))).cast("bigint").alias("sequence_id"),
        F.element_at("p.offsets", (nth % F.size("p.offsets") + 1).cast("int")).alias("offset"),
    )
