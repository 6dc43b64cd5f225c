"""SimHash near-duplicates, compared through tables of distances to pivots."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.components import components
from tidemark.llm.text import apart, documents, raw, sliced
from tidemark.sources.tables import materialized

#: Set bits of each byte value, lowest bit first.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes, width: int = 4) -> int:
    """The 64-bit SimHash of a UTF-8 text over its word shingles, repeats counted."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        hashes = np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[: len(words) - width + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, ends[width - 1 :].tolist())], np.uint64)
    # How often each byte value stands at each of the eight places gives the count of every bit.
    places = hashes.view(np.uint8).reshape(-1, 8).astype(np.int64) + np.arange(0, 2048, 256)
    ones = np.bincount(places.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int(np.packbits(2 * ones.ravel() > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = 4, row: str | None = None) -> DataFrame:
    """(doc_id, fp), and the binary column row if one is named: one row per document; the whole text counts."""
    more = [row] if row else []

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = np.array([fingerprint(x, width) for x in raw(batch.column("text"))], np.uint64)
            kept = [batch.column(c) for c in more]
            yield pa.record_batch([batch.column("doc_id"), pa.array(found.view(np.int64)), *kept], ["doc_id", "fp", *more])

    return documents(docs, *more).mapInArrow(work, ", ".join(["doc_id bigint", "fp bigint", *(f"`{c}` binary" for c in more)]))


def pivots(fps: DataFrame, count: int) -> np.ndarray:
    """The reference fingerprints: those with the smallest hash, so that reruns take the same."""
    rows = fps.select("fp", F.xxhash64(F.lit(1), "fp").alias("h")).orderBy("h", "fp").limit(count).collect()
    return np.array([r.fp for r in rows], np.int64).view(np.uint64)


def segment_masks(segments: int, radius: int) -> list[int]:
    """Bit masks of all choices of segments - radius segments out of the 64 bits cut into segments.

    Two fingerprints with at most radius differing bits agree on one mask at least.
    """
    cuts = [round(64 * i / segments) for i in range(segments + 1)]
    parts = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(segments)]
    return [sum(c) for c in combinations(parts, segments - radius)]


def _segments(distinct: int, radius: int) -> int:
    """So many that a bucket holds a few unrelated fingerprints on average. Any number gives the same links."""
    n = radius + 2
    while n < 64 and 64 * (n - radius) / n < np.log2(max(distinct, 2)):
        n += 1
    return n


def near_links(fps: DataFrame, radius: int = 4, pivot_count: int = 32, bucket_rows: int = 2048) -> DataFrame:
    """Edges (a, b) that connect all fingerprints within radius bits of each other.

    fps: distinct column fp. Distances to pivots crowd around 32 and are no key to
    join by, so fingerprints first meet in buckets of equal segments, which miss
    no link. In a bucket, rows are compared by their pivot distances: a pair goes
    as soon as one coordinate differs by more than radius, which the triangle
    inequality allows, and the survivors are verified bit by bit. A bucket of more
    than bucket_rows rows is dealt out as pairs of parts. Of the links found in a
    batch a spanning forest is returned, so a dense group gives no quadratic output.
    """
    table = pivots(fps, pivot_count)
    masks = segment_masks(_segments(fps.count(), radius), radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*(F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m).cast("bigint")).alias("part")) for i, m in enumerate(signed)))
    keyed = fps.select("fp", F.explode(keys).alias("k")).select("k.mask", "k.part", "fp")
    large = keyed.groupBy("mask", "part").agg(F.ceil(F.count("*") / bucket_rows).cast("int").alias("parts")).filter("parts > 1")
    own = F.expr("cast(pmod(xxhash64(fp), parts) as int)")
    dealt = keyed.join(large, ["mask", "part"], "left").fillna(1, ["parts"]).withColumn("own", own)
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    dealt = dealt.select("mask", "part", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "fp")
    order = ["mask", "part", "p", "q"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in (*order, "fp")])
            if held is not None:
                rows = np.concatenate([held, rows], axis=1)
            last = np.flatnonzero((rows[:4] != rows[:4, -1:]).any(0))
            cut = int(last[-1]) + 1 if len(last) else 0
            held = rows[:, cut:]
            if cut:
                yield from _edges(rows[:, :cut], table, radius)
        if held is not None:
            yield from _edges(held, table, radius)

    return dealt.repartition(*order).sortWithinPartitions(*order, "fp").mapInArrow(work, "a bigint, b bigint").distinct()


def _edges(rows: np.ndarray, table: np.ndarray, radius: int) -> Iterator[pa.RecordBatch]:
    """Rows of whole buckets, sorted: row i meets row i + step while both are of one bucket."""
    fp = rows[4].view(np.uint64)
    fresh = np.ones(len(fp), bool)
    fresh[1:] = (rows[:4, 1:] != rows[:4, :-1]).any(0)
    bucket = np.cumsum(fresh)
    alone = np.bincount(bucket)[bucket] < 2
    fp, bucket = fp[~alone], bucket[~alone]
    distance = np.bitwise_count(fp[:, None] ^ table[None, :]).astype(np.int8)
    found, held, step = [], 0, 1
    at = np.arange(len(fp) - 1)
    while len(at := at[at + step < len(fp)]) and len(at := at[bucket[at] == bucket[at + step]]):
        left = at
        for j in range(distance.shape[1]):
            left = left[np.abs(distance[left, j] - distance[left + step, j]) <= radius]
        left = left[np.bitwise_count(fp[left] ^ fp[left + step]) <= radius]
        if len(left):
            found.append((left, left + step))
            held += len(left)
        if held > 500_000:
            found = [_forest(found, len(fp))]
            held = len(found[0][0])
        step += 1
    if found:
        a, b = _forest(found, len(fp))
        yield pa.record_batch([pa.array(fp[a].view(np.int64)), pa.array(fp[b].view(np.int64))], ["a", "b"])


def _forest(pairs: list[tuple[np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(root, node) for every node that the pairs connect to a smaller one."""
    a, b = (np.concatenate(x) for x in zip(*pairs))
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, root[a], low)
        np.minimum.at(after, root[b], low)
        after = after[after]
        if (after == root).all():
            break
        root = after
    nodes = np.flatnonzero(root != np.arange(n))
    return root[nodes], nodes


def _rooted(classes: DataFrame, radius: int, pivot_count: int) -> DataFrame:
    """(fp, first, root): each class of equal fingerprints with the fingerprint that stands for its component."""
    edges = near_links(classes.select("fp"), radius, pivot_count)
    roots = components(edges).select(F.col("node").alias("fp"), "root")
    return classes.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, width: int = 4, radius: int = 4, pivot_count: int = 32) -> DataFrame:
    """(doc_id, fp, component_id): each document with the smallest doc_id it reaches over links.

    Documents link when their fingerprints differ in at most radius bits. Equal
    fingerprints are one class, compared once, so copies cost nothing. An empty
    or null text has fingerprint zero and links like any other. Documents with a
    null doc_id take part; their component is the smallest id known in it, null if
    there is none. Repeated rows come back as often as they are given. An empty
    table gives an empty table.
    """
    prints = materialized(fingerprints(docs, width), "simhash")
    classes = materialized(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    rooted = _rooted(classes, radius, pivot_count)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def _row_key(docs: DataFrame) -> Column:
    """A digest of the whole row: rows have one key only if they are equal, whatever doc_id they lack or share."""
    text = F.col("text").cast("string")
    others = [F.col(c) for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.to_json(F.struct(*others)) if others else F.lit("")
    known = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    return F.unhex(F.sha2(F.concat(known, F.lit("|"), rest, F.coalesce(F.concat(F.lit("|"), text), F.lit(""))), 256))


@apart
def kept_documents(docs: DataFrame, width: int = 4, radius: int = 4, pivot_count: int = 32) -> DataFrame:
    """docs with one row of each group of near duplicates: that of the smallest doc_id, null ids last.

    Groups are those of near_duplicates, but rows are told apart by all they hold
    and not by doc_id: different texts without a doc_id, or under the same one,
    each stay if their groups differ. Rows that a group's smallest doc_id shares
    are taken by the smallest digest of the row, so reruns keep the same. Equal
    rows are first made one, task by task, so a row repeated any number of times
    is no load on one task.
    """
    row = "simhash_row"
    keyed = docs.withColumn(row, _row_key(docs))
    prints = fingerprints(keyed, width, row)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", row)).alias("first")
    classes = materialized(prints.groupBy("fp").agg(first), "simhash-classes")
    kept = _rooted(classes, radius, pivot_count).groupBy("root").agg(F.min("first").alias("first")).select(F.col(f"first.{row}").alias(row))
    return keyed.dropDuplicates([row]).join(kept, row, "left_semi").select(docs.columns)
