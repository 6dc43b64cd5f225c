"""A Merkle manifest of a table: what was in it, provable row by row."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.sources.tables import materialized

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf_digest(**changed: Column) -> Column:
    """H of the fields, each as its UTF-8 byte count, a colon and its value, a null as a dash; changed replaces fields."""
    parts = []
    for name in FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def tampered_digest() -> Column:
    """The leaf of a row whose text lost its line ends, where the row is one to tamper with and its text has some; else null."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(chosen & F.contains("text", F.lit("\n")), leaf_digest(text=F.replace("text", F.lit("\n"), F.lit(""))))


def reduced(digests: list[str], rounds: int | None, fan: int) -> list[list[str]]:
    """All levels above and with digests: as many rounds as named, or until one node remains."""
    levels = [digests]
    while len(levels) <= rounds if rounds is not None else len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(*below[i : i + fan]) for i in range(0, len(below), fan)])
    return levels


def steps(levels: list[list[str]], place: int, fan: int) -> str:
    """The siblings of a node on its way up these levels, as `left.right/` a level."""
    out = []
    for level in levels[:-1]:
        first = place - place % fan
        out.append(f"{''.join(level[first:place])}.{''.join(level[place + 1 : first + fan])}/")
        place //= fan
    return "".join(out)


def folded(leaf: str, path: str) -> str:
    """The root that a leaf and its path lead to."""
    for step in path.split("/")[:-1]:
        left, right = step.split(".")
        leaf = digest(left, leaf, right)
    return leaf


def proof_digest(path: str) -> str:
    """H of all siblings of a path, from the leaf's to the root's, left to right."""
    return digest(path.replace(".", "").replace("/", ""))


@dataclass(frozen=True)
class Shape:
    """Runs of fan nodes become one; a superblock is fan ** height consecutive nodes of a tree."""

    fan: int
    height: int

    @property
    def size(self) -> int:
        return self.fan**self.height

    def units(self, rows: pd.DataFrame) -> Iterator[tuple[tuple, list, list[list[str]]]]:
        """(tree and block), its rows by rank, and its levels, of every superblock in rows."""
        rows = rows.sort_values(["tree", "rank"], kind="stable", na_position="first")
        for key, unit in groupby(rows.itertuples(index=False), lambda r: (r.tree, r.block)):
            held = list(unit)
            whole = held[0].n <= self.size
            yield key, held, reduced([r.digest for r in held], None if whole else self.height, self.fan)

    def ways(self, rows: pd.DataFrame, outer: pd.DataFrame) -> Iterator[tuple]:
        """Every row beside the outer row of its superblock and its whole path: the local siblings, then the outer ones."""
        known = {(r.tree, r.block): r for r in outer.itertuples(index=False)}
        for key, held, levels in self.units(rows):
            for i, r in enumerate(held):
                yield r, known[key], steps(levels, i, self.fan) + known[key].path


class Forest:
    """Trees of nodes (tree, rank, digest, n), reduced superblock by superblock.

    A tree's nodes are ranked from 0 to n - 1. A round reduces each superblock by
    height levels to one node, or a tree that is one superblock to its root; the
    nodes are those of the next round. Trees that have come down to one node are
    finished. Superblocks are dealt out to groups by hash: a group holds about one
    full superblock, or many small trees.
    """

    def __init__(self, nodes: DataFrame, shape: Shape):
        self.shape = shape
        self.rounds, self.finished = [self._dealt(nodes)], []
        while True:
            tops = materialized(self._tops(self.rounds[-1][0]), "subtrees")
            self.finished.append(tops.filter("n = 1"))
            if not tops.filter("n > 1").take(1):
                break
            self.rounds.append(self._dealt(tops.filter("n > 1")))

    def roots(self) -> DataFrame:
        """(tree, digest) of every tree."""
        return reduce(DataFrame.union, self.finished).select("tree", "digest")

    def _dealt(self, nodes: DataFrame) -> tuple[DataFrame, Column]:
        """nodes with their superblock and the group that it is dealt to, and the rule that deals."""
        groups = max(1, -(-nodes.count() // self.shape.size))
        rule = F.pmod(F.xxhash64("tree", "block"), F.lit(groups)).cast("int")
        return nodes.withColumn("block", F.floor(F.col("rank") / self.shape.size)).withColumn("group", rule), rule

    def _tops(self, dealt: DataFrame) -> DataFrame:
        shape = self.shape

        def work(rows: pd.DataFrame) -> pd.DataFrame:
            made = [(tree, block, levels[-1][0], -(-held[0].n // shape.size)) for (tree, block), held, levels in shape.units(rows)]
            return pd.DataFrame(made, columns=["tree", "rank", "digest", "n"])

        narrow = dealt.select("group", "tree", "rank", "block", "digest", "n")
        return narrow.groupBy("group").applyInPandas(work, "tree string, rank bigint, digest string, n bigint")

    def outer(self, above: DataFrame) -> DataFrame:
        """(tree, block, path) of every superblock of the first round: the way on from the node that it became.

        above has (tree, path) of each tree's root. Rounds are gone through from the
        top: a round's nodes are cogrouped with the ways of their superblocks.
        """
        shape, paths = self.shape, None

        def work(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame([(r.tree, r.rank, path) for r, _, path in shape.ways(rows, outer)], columns=["tree", "block", "path"])

        above = above.select(F.col("tree").alias("of"), "path")
        for i in reversed(range(len(self.rounds))):
            done = self.finished[i].join(above, F.col("tree").eqNullSafe(F.col("of"))).select("tree", F.col("rank").alias("block"), "path")
            if paths is not None:
                done = done.union(self.cogrouped(i + 1, paths).applyInPandas(work, "tree string, block bigint, path string"))
            paths = done
        return paths

    def cogrouped(self, i: int, outer: DataFrame, *more: str):
        """The nodes of round i, with the columns named, beside the outer rows of their superblocks."""
        dealt, rule = self.rounds[i]
        return dealt.select("group", "tree", "rank", "block", "digest", "n", *more).groupBy("group").cogroup(outer.withColumn("group", rule).groupBy("group"))


def ranked(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """rows with rank, from 0 within their tree, and n, their tree's count.

    rows are written in ranges of tree and order. A range's rows of one tree are
    numbered in the place where they lie and shifted by the counts of the ranges
    before, so a tree that holds most rows is not one task. Equal rows are told
    apart by their place in the rows given, which must come from a written table.
    """
    told = rows.withColumn("tie", F.monotonically_increasing_id())
    order = [F.col("tree").asc_nulls_first(), *order, F.col("tie")]
    laid = told.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    laid = materialized(laid.drop("tie"), name).withColumn("range", F.shiftright("at", 33))
    runs = laid.groupBy("tree", "range").agg(F.min("at").alias("first"), F.count("*").alias("here"))
    all_, before = Window.partitionBy("tree"), Window.partitionBy("tree").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col("tree").alias("of"), F.col("range").alias("in"), F.col("first") - F.coalesce(F.sum("here").over(before), F.lit(0)), F.sum("here").over(all_)).toDF("of", "in", "zero", "n")
    met = laid.join(runs, laid["tree"].eqNullSafe(runs["of"]) & (laid["range"] == runs["in"]))
    return met.withColumn("rank", F.col("at") - F.col("zero")).drop("of", "in", "zero", "at", "range")


def manifest(docs: DataFrame, fan: int = 3, height: int = 6) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row, and whether it can still be proven.

    Every row is a leaf: H of its fields. The leaves of a source, by ascending
    doc_id, make its tree; every fan consecutive nodes become their H while several
    remain. The sources' roots, null first, make the tree above. A row's proof are
    its siblings on the way to the root. Every second row, by its id's crc32, is
    read again with the line ends of its text gone, and each row's leaf, tampered
    or not, is folded with its original proof: verified says whether the root results.

    Leaves are hashed in the JVM; Python sees digests only. First all subtrees are
    reduced bottom up, superblock by superblock, then the leaves and the outer
    nodes on their superblocks' ways are cogrouped by superblock, where the local
    reduction is finished, proofs are joined and folded together. The number of
    passes is the logarithm of the largest source to the base fan ** height. Only
    the root reaches the driver.

    Null ids come first and are not tampered with; null texts stay null; equal ids
    are ordered by their leaves; equal rows are leaves of their own. Other columns
    are left behind. An empty table gives an empty one.
    """
    leaves = docs.select(F.col("source").cast("string").alias("tree"), F.col("doc_id").cast("bigint").alias("doc_id"), leaf_digest().alias("digest"), tampered_digest().alias("tampered"))
    leaves = materialized(leaves, "leaves")
    shape, order = Shape(fan, height), [F.col("doc_id").asc_nulls_first(), F.col("digest")]
    # Ids pass through pandas as text, since a null would turn a column of numbers into floats.
    trees = Forest(ranked(leaves, order, "leaves-in-order").withColumn("doc_id", F.col("doc_id").cast("string")), shape)
    tops = materialized(trees.roots().withColumnRenamed("tree", "source").withColumn("tree", F.lit("")), "subroots")
    sources = materialized(ranked(tops, [F.col("source").asc_nulls_first()], "subroots-in-order"), "sources")
    whole = Forest(sources, shape)
    found = whole.roots().first()
    root = found["digest"] if found else ""
    start = docs.sparkSession.createDataFrame([("", "")], "tree string, path string")

    def above(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(r.source, r.digest, path) for r, _, path in shape.ways(rows, outer)], columns=["tree", "subroot", "path"])

    tops = materialized(whole.cogrouped(0, whole.outer(start), "source").applyInPandas(above, "tree string, subroot string, path string"), "ways")
    subroots = tops.select(F.col("tree").alias("of"), "subroot")
    outer = trees.outer(tops.select("tree", "path")).join(subroots, F.col("tree").eqNullSafe(F.col("of"))).drop("of")

    def proven(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        made = []
        for r, block, path in shape.ways(rows, outer):
            again = folded(r.tampered or r.digest, path)
            made.append((r.doc_id, r.digest, block.subroot, root, proof_digest(path), again, again == root))
        return pd.DataFrame(made, columns=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    schema = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return trees.cogrouped(0, outer, "doc_id", "tampered").applyInPandas(proven, schema).withColumn("doc_id", F.col("doc_id").cast("bigint"))
