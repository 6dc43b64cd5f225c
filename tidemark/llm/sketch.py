"""Threshold-scaled document fingerprints."""

from __future__ import annotations

import hashlib
from base64 import b64decode, b64encode
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.text import sliced
from tidemark.sources.tables import materialized

_TOP = (1 << 64) - 1
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: every bit of a hash depends on all of the sum."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words(dict):
    """Hashes of words, kept for the next texts; emptied when full."""

    def __init__(self, room: int = 200_000):
        super().__init__()
        self.room = room

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.room:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingle_hashes(text: str, words: Words, width: int = 5) -> np.ndarray:
    """Distinct hashes, ascending, of all word shingles of a whole text; fewer words than width are one shingle."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    w = np.array([words[t] for t in tokens], np.uint64)
    n = max(1, len(w) - width + 1)
    h = np.zeros(n, np.uint64)
    for i in range(min(width, len(w))):
        h = h * _BASE + w[i : i + n]
    return np.unique(_mixed(h))


@dataclass
class Sketch:
    """All shingle hashes of a document up to bound, and the sum of all its hashes, which tells equal from unequal sets.

    A document without words has the sum 0. The sum of a merged sketch is not known.
    """

    bound: int
    hashes: np.ndarray
    whole: int | None = None

    def __str__(self) -> str:
        whole = "" if self.whole is None else f"{self.whole:x}"
        return f"{self.bound:x}:{whole}:{b64encode(self.hashes.astype('>u8').tobytes()).decode()}"

    @classmethod
    def parse(cls, text: str) -> Sketch:
        bound, whole, rest = text.split(":")
        return cls(int(bound, 16), np.frombuffer(b64decode(rest), ">u8").astype(np.uint64), int(whole, 16) if whole else None)

    def below(self, bound: int) -> np.ndarray:
        return self.hashes if bound >= self.bound else self.hashes[self.hashes <= np.uint64(bound)]


def sketch(hashes: np.ndarray, fraction: float = 1 / 4) -> Sketch:
    """Every hash below the fraction of all, whatever the number of hashes."""
    bound = min(int(fraction * 2**64), _TOP)
    return Sketch(bound, hashes[hashes <= np.uint64(bound)], int(hashes.sum(dtype=np.uint64)))


def merge(a: Sketch, b: Sketch) -> Sketch:
    """The sketch of both documents' shingles together."""
    bound = min(a.bound, b.bound)
    return Sketch(bound, np.union1d(a.below(bound), b.below(bound)), a.whole if a.whole == b.whole else None)


def likeness(a: Sketch, b: Sketch) -> float:
    """Estimated share of common shingles (Jaccard).

    Where neither has a hash below the common bound, which happens to texts of few
    words, it is 1 if the sums of all hashes are known and equal, as of two texts
    without words or of equal short ones, else 0.
    """
    bound = min(a.bound, b.bound)
    x, y = a.below(bound), b.below(bound)
    both = len(np.intersect1d(x, y, assume_unique=True))
    union = len(x) + len(y) - both
    return both / union if union else float(a.whole is not None and a.whole == b.whole)


def containment(a: Sketch, b: Sketch) -> float | None:
    """Estimated part of a's shingles that b holds, however unequal their sizes. A text without words is in any other.

    None where a has words but none of its hashes lies below the common bound: nothing can be said then.
    """
    bound = min(a.bound, b.bound)
    x = a.below(bound)
    if not len(x):
        return 1.0 if a.whole == 0 else None
    return len(np.intersect1d(x, b.below(bound), assume_unique=True)) / len(x)


def fingerprints(docs: DataFrame, fraction: float = 1 / 4, width: int = 5) -> DataFrame:
    """(doc_id, fingerprint) of every whole text (null: empty). Equal texts have equal fingerprints."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in sliced(batches):
            made = [str(sketch(shingle_hashes(t, words, width), fraction)) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(made, pa.string())], ["doc_id", "fingerprint"])

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return narrow.mapInArrow(work, "doc_id bigint, fingerprint string")


def edit(text: str, following: str) -> str:
    """text with its last quarter replaced by as much of the beginning of following."""
    part = len(text) // 4
    return text[: len(text) - part] + following[:part]


def edited_pairs(docs: DataFrame, fraction: float = 1 / 4, width: int = 5, slice_bytes: int = 8 << 20) -> DataFrame:
    """Each document beside its edited text and the next document by ascending doc_id; the last one's next is the first.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, contained_edited (the part of the edited text's
    shingles that the document holds, null where the sketches cannot tell).

    The table is dealt once, into ranges of doc_id. A range's first document also
    goes to the range before it, where it follows the last one, so neighbours are
    always in one task, which reads its range as a stream. Ids are first ranged
    alone to find the ranges' first ids, one per range on the driver.

    Null texts are empty. Null ids come first, equal ids are ordered by text, and
    repeated rows follow each other. A single document is its own next. An empty
    table gives an empty table.
    """
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = narrow.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    ids = narrow.select("doc_id").repartitionByRange(max(1, -(-total // slice_bytes)), "doc_id")
    firsts = materialized(ids.groupBy(F.spark_partition_id().alias("range")).agg(F.min("doc_id").alias("first"), F.max(F.col("doc_id").isNull()).alias("open")), "ranges").collect()
    nulls = any(r.open for r in firsts)
    heads = np.array(sorted(r["first"] for r in firsts if r["first"] is not None), np.int64)

    @F.pandas_udf("array<int>")
    def ranges(doc_id: pd.Series) -> pd.Series:
        """The range of an id; for a range's first id also the range before, as -1 - range."""
        out = []
        for i in doc_id.astype("Int64"):
            at = 0 if i is pd.NA else max(0, int(np.searchsorted(heads, i, "right")) - 1)
            first = i is pd.NA or (i == heads[at] and not (nulls and at == 0))
            out.append([at, -1 - (at - 1) % max(len(heads), 1)] if first else [at])
        return pd.Series(out)

    dealt = narrow.withColumn("to", F.explode(ranges("doc_id")))
    dealt = dealt.select(F.when(F.col("to") < 0, -1 - F.col("to")).otherwise(F.col("to")).alias("slice"), (F.col("to") < 0).alias("extra"), "doc_id", "text")
    dealt = dealt.repartition(max(1, len(heads)), "slice").sortWithinPartitions("slice", "extra", F.col("doc_id").asc_nulls_first(), "text")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "contained_edited"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.float64()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        made = lambda text: sketch(shingle_hashes(text, words, width), fraction)
        held = None
        for batch in sliced(batches):
            rows = []
            for at, extra, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("slice", "extra", "doc_id", "text"))):
                if held is not None and held[0] == at:
                    own = made(text)
                    _, before, old, print_ = held
                    new = edit(old, text)
                    changed = made(new)
                    sha = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
                    rows.append((before, len(old), sha, str(print_), str(changed), likeness(print_, changed), likeness(print_, own), containment(changed, print_)))
                    held = None if extra else (at, doc_id, text, own)
                elif not extra:
                    held = (at, doc_id, text, made(text))
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return dealt.mapInArrow(work, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, contained_edited double")
