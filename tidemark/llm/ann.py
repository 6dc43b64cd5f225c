"""Nearest neighbours through a hierarchical k-means tree, searched best bin first."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.sources.tables import materialized


@dataclass
class Node:
    centers: np.ndarray | None = None
    children: list[Node] = field(default_factory=list)
    leaf: int = -1


class Tree:
    """A k-means tree: every inner node cuts its vectors into at most `branch` clusters."""

    def __init__(self, vectors: np.ndarray, branch: int = 8, leaf_rows: int = 64, rounds: int = 8, seed: int = 3):
        self.draw, self.leaves = np.random.default_rng(seed), 0
        self.root = self._grow(vectors, branch, leaf_rows, rounds)

    def _grow(self, x: np.ndarray, branch: int, leaf_rows: int, rounds: int) -> Node:
        distinct = np.unique(x, axis=0) if len(x) > leaf_rows else x
        if len(x) <= leaf_rows or len(distinct) < 2:
            self.leaves += 1
            return Node(leaf=self.leaves - 1)
        centers = distinct[self.draw.choice(len(distinct), min(branch, len(distinct)), replace=False)]
        for _ in range(rounds):
            nearest = _nearest(x, centers)
            counts = np.bincount(nearest, minlength=len(centers))
            sums = np.zeros_like(centers)
            np.add.at(sums, nearest, x)
            centers = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centers)
        nearest = _nearest(x, centers)
        used = np.unique(nearest)
        if len(used) < 2:
            self.leaves += 1
            return Node(leaf=self.leaves - 1)
        return Node(centers[used], [self._grow(x[nearest == u], branch, leaf_rows, rounds) for u in used])

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector, by the nearest center at every level."""
        out, work = np.zeros(len(x), np.int64), [(self.root, np.arange(len(x)))]
        while work:
            node, rows = work.pop()
            if node.centers is None:
                out[rows] = node.leaf
            elif len(rows):
                nearest = _nearest(x[rows], node.centers)
                work += [(child, rows[nearest == i]) for i, child in enumerate(node.children)]
        return out

    def visits(self, x: np.ndarray) -> Iterator[int]:
        """All leaves, best bin first: the queue holds unopened branches by the distance of x to their centers."""
        queue, order = [(0.0, 0, self.root)], 1
        while queue:
            _, _, node = heapq.heappop(queue)
            while node.centers is not None:
                distance = ((node.centers - x) ** 2).sum(1)
                best = int(distance.argmin())
                for i, child in enumerate(node.children):
                    if i != best:
                        heapq.heappush(queue, (float(distance[i]), order, child))
                        order += 1
                node = node.children[best]
            yield node.leaf


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return ((centers**2).sum(1)[None, :] - 2 * x @ centers.T).argmin(1)


def _matrix(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), "<f8").reshape(len(rows), -1)


def valid_vectors(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, vec, vkey) of the rows that take part; vec as bytes of doubles, vkey a digest equal for equal vectors.

    Null, empty and zero vectors, those with null or non-finite components and
    null ids stay out, and so do vectors of another length than the most common one.
    """
    rows = table.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("v", lambda c: c != 0)
    rows = rows.filter(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    rows = rows.filter(F.size("v") == (length.n if length else 0))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("v")
            if not len(column):
                continue
            # Adding 0.0 makes the two zeros equal.
            flat = (column.flatten().to_numpy(zero_copy_only=False) + 0.0).astype("<f8").reshape(len(column), -1)
            vec = [v.tobytes() for v in flat]
            keys = [hashlib.blake2b(v, digest_size=16).digest() for v in vec]
            yield pa.record_batch([batch.column("vec_id"), pa.array(vec, pa.binary()), pa.array(keys, pa.binary())], ["vec_id", "vec", "vkey"])

    return rows.mapInArrow(work, "vec_id bigint, vec binary, vkey binary")


def classes(rows: DataFrame, keep: int, salts: int = 16) -> DataFrame:
    """One row per distinct vector with its `keep` smallest ids, ascending: no more can ever be among the nearest.

    Rows of one vector are first thinned out in salted parts, so a vector that very many rows share is no hot key.
    """
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(salts))
    thin = lambda df, *keys: df.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy("vec_id"))).filter(F.col("n") <= keep).drop("n")
    parts = thin(rows.dropDuplicates(["vkey", "vec_id"]).withColumn("salt", salt), "vkey", "salt").drop("salt")
    return thin(parts, "vkey").groupBy("vkey").agg(F.first("vec").alias("vec"), F.sort_array(F.collect_list("vec_id")).alias("ids"))


def _sample(rows: DataFrame, wanted: int, total: int, seed: int) -> list:
    """About wanted rows, the same on every run."""
    share = min(1.0, wanted / max(total, 1))
    drawn = rows.filter(F.expr(f"pmod(xxhash64({seed}, vkey), 1000000) < {share * 1_000_000}")).select("vkey", "vec").collect()
    return sorted(drawn, key=lambda r: bytes(r.vkey))


def _merged(rows: DataFrame, keep: int) -> DataFrame:
    """The `keep` nearest classes per query class, out of what the blocks found."""
    nearest = Window.partitionBy("qkey").orderBy("score", F.col("ids")[0])
    return rows.withColumn("n", F.row_number().over(nearest)).filter(F.col("n") <= keep).drop("n")


_FOUND = "qkey binary, score double, ids array<bigint>"
_FOUND_ARROW = pa.schema([("qkey", pa.binary()), ("score", pa.float64()), ("ids", pa.list_(pa.int64()))])


def _best(queries: list[tuple[bytes, np.ndarray]], x: np.ndarray, ids: list[list[int]], keep: int) -> Iterator[pa.RecordBatch]:
    """For each query the keep nearest rows of x by distance, then smallest id."""
    first = np.array([i[0] for i in ids], np.int64)
    for key, q in queries:
        difference = x - q
        score = np.sqrt((difference * difference).sum(1))
        some = np.arange(len(x))
        if len(x) > keep:
            some = np.flatnonzero(score <= np.partition(score, keep - 1)[keep - 1])
        some = some[np.lexsort((first[some], score[some]))][:keep]
        yield pa.record_batch([pa.array([key] * len(some), pa.binary()), pa.array(score[some]), pa.array([ids[i] for i in some], pa.list_(pa.int64()))], schema=_FOUND_ARROW)


def calibrated_visits(table: DataFrame, tree: Tree, probes: list, keep: int, recall: float) -> int:
    """How many leaves a search has to visit for the probes' true neighbours to be reached with the given recall.

    The probes, a bounded number, are compared with all rows. Visits are then
    widened leaf by leaf in the order of each probe's queue until the share of
    true neighbours in visited leaves is reached.
    """
    if not probes:
        return 1
    vectors = _matrix([r.vec for r in probes])
    named = [(bytes(r.vkey), v) for r, v in zip(probes, vectors)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, leaf = _matrix(batch.column("vec").to_pylist()), batch.column("leaf").to_pylist()
            yield from _best(named, x, [[i[0], leaf[n]] for n, i in enumerate(batch.column("ids").to_pylist())], keep)

    true = _merged(table.select("vec", "leaf", "ids").mapInArrow(work, _FOUND), keep)
    wanted: dict[bytes, list[int]] = {}
    for r in true.collect():
        wanted.setdefault(bytes(r.qkey), []).append(r.ids[1])
    reached = np.zeros(tree.leaves + 1)
    for key, q in named:
        rank = {leaf: i for i, leaf in enumerate(tree.visits(q))}
        for leaf in wanted.get(key, []):
            reached[rank[leaf]] += 1
    share = np.cumsum(reached) / max(reached.sum(), 1)
    return int(np.argmax(share >= recall)) + 1


def nearest_neighbours(
    table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", k: int = 10, every: int = 100,
    fit_rows: int = 20_000, probes: int = 256, recall: float = 0.98, leaf_rows: int = 64, block_rows: int = 4096,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for every vector whose id is divisible by `every`.

    The tree is fitted on about fit_rows distinct vectors and every row is put in
    one of its leaves; leaves grow with the table and are searched in blocks of
    about block_rows rows. Each query visits as many leaves, best bin first, as
    the calibration on about `probes` probes against all rows asks for, and goes
    on until they hold k + 1 distinct vectors. Equal vectors are one class with
    its k + 1 smallest ids, so copies are compared once and returned in order of
    their ids. The score is the Euclidean distance in doubles. Vectors that
    valid_vectors() leaves out take no part; repeated ids count once per vector.
    With fewer candidates than k all are returned; an empty table gives no rows.
    """
    keep = k + 1
    rows = materialized(valid_vectors(table, id_column, vector_column), "vectors")
    distinct = materialized(classes(rows, keep), "vector-classes")
    total = distinct.count()
    sample = _sample(distinct, fit_rows, total, 1)
    if not sample:
        sample = distinct.select("vkey", "vec").limit(fit_rows).collect()
    tree = Tree(_matrix([r.vec for r in sample]) if sample else np.zeros((0, 1)), leaf_rows=leaf_rows)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = tree.assign(_matrix(batch.column("vec").to_pylist()))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf.astype(np.int32))], [*batch.schema.names, "leaf"])

    indexed = materialized(distinct.mapInArrow(place, "vkey binary, vec binary, ids array<bigint>, leaf int"), "vector-index")
    sizes = {r.leaf: r["count"] for r in indexed.groupBy("leaf").count().collect()}
    visits = calibrated_visits(indexed, tree, _sample(indexed, probes, total, 2), keep, recall)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, vec in zip(batch.column("vkey").to_pylist(), batch.column("vec").to_pylist()):
                leaves, held = [], 0
                for leaf in tree.visits(np.frombuffer(vec, "<f8")):
                    if len(leaves) >= visits and held >= keep:
                        break
                    leaves.append(leaf)
                    held += sizes.get(leaf, 0)
                leaves = [x for x in leaves if sizes.get(x)]
                if leaves:
                    yield pa.record_batch([pa.array([key] * len(leaves), pa.binary()), pa.array([vec] * len(leaves), pa.binary()), pa.array(leaves, pa.int32())], ["qkey", "qvec", "leaf"])

    asked = rows.filter(F.col("vec_id") % every == 0)
    query_classes = indexed.join(asked.select("vkey").distinct(), "vkey", "left_semi")
    routed = query_classes.select("vkey", "vec").mapInArrow(route, "qkey binary, qvec binary, leaf int")
    # A leaf larger than block_rows is dealt into blocks, which all its queries visit; its queries are dealt likewise.
    blocks = table.sparkSession.createDataFrame([(leaf, -(-n // block_rows)) for leaf, n in sizes.items()], "leaf int, blocks int")
    members = indexed.join(blocks, "leaf").select("leaf", F.expr("cast(pmod(xxhash64(vkey), blocks) as int)").alias("block"), "vec", "ids")
    routed = routed.join(blocks, "leaf").select("leaf", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), "qkey", "qvec")
    held_queries = routed.groupBy("leaf", "block").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("parts"))
    routed = routed.join(held_queries, ["leaf", "block"]).withColumn("part", F.expr("cast(pmod(xxhash64(qkey), parts) as int)")).drop("parts")
    members = members.join(held_queries, ["leaf", "block"]).withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).drop("parts")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _FOUND_ARROW.empty_table()
        queries = list(zip(left.column("qkey").to_pylist(), _matrix(left.column("qvec").to_pylist())))
        found = _best(queries, _matrix(right.column("vec").to_pylist()), right.column("ids").to_pylist(), keep)
        return pa.Table.from_batches(found, schema=_FOUND_ARROW)

    keys = ["leaf", "block", "part"]
    found = _merged(routed.groupBy(*keys).cogroup(members.groupBy(*keys)).applyInArrow(search, _FOUND), keep)
    each = F.transform("ids", lambda i: F.struct(F.col("score").alias("score"), i.alias("vec_id")))
    lists = found.select("qkey", each.alias("near")).groupBy("qkey").agg(F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, keep).alias("near"))
    queries = asked.select(F.col("vkey").alias("qkey"), F.col("vec_id").alias("query_id")).distinct()
    own = F.slice(F.filter("near", lambda s: s["vec_id"] != F.col("query_id")), 1, k)
    answered = queries.join(lists, "qkey").select("query_id", F.posexplode(own).alias("at", "hit"))
    return answered.select("query_id", (F.col("at") + 1).alias("rank"), "hit.vec_id", "hit.score")
