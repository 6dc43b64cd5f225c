"""A global shuffle into shards, in two passes over the disk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.sources.tables import new_path


def record_bytes(text: str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) plus 8."""
    return F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("bigint") + 8


def write_shards(docs: DataFrame, path: str, shards: int = 24, seed: int = 17, bucket_bytes: int = 8 << 20) -> None:
    """Write all rows of docs to path in shards 0 to shards - 1, in one global random order.

    First pass: a seeded hash of doc_id and text scatters the rows uniformly into
    buckets of about bucket_bytes, which a task can hold. Second pass: each bucket
    is put in hash order, so that a repeated task starts from the same array, and
    permuted by Spark's shuffle function, a seeded Fisher-Yates; a row's place in
    the global order is its place in the bucket after all rows of the buckets
    before. Shards are equal ranges of that order, so their counts are at most one
    apart, and a bucket is written to one or two shards.

    A written row holds the given row as record, so column names cannot clash, and
    slot, gapless from 0 in its shard. Only the bucket counts, one row per bucket,
    meet in one task. Null ids and texts and repeated rows are rows like any other;
    rows equal in both doc_id and text share a bucket. The order follows from the
    seed and the number of shuffle partitions. An empty table writes an empty one.
    """
    key = F.xxhash64(F.lit(seed), "doc_id", "text")
    total, rows = docs.agg(F.coalesce(F.sum(record_bytes()), F.lit(0)), F.count("*")).first()
    buckets = max(1, -(-total // bucket_bytes))
    scattered = docs.select(F.struct(*(F.col(c) for c in docs.columns)).alias("record"), key.alias("draw")).withColumn("bucket", F.pmod("draw", F.lit(buckets)).cast("int"))
    counts = scattered.groupBy("bucket").agg(F.count("*").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    gathered = scattered.groupBy("bucket").agg(F.collect_list(F.struct("draw", "record")).alias("held"))
    permuted = gathered.sortWithinPartitions("bucket").select("bucket", F.shuffle(F.sort_array("held"), seed).alias("held"))
    placed = permuted.join(offsets, "bucket").select("offset", F.posexplode("held").alias("at", "row"))
    position = F.col("offset") + F.col("at")
    shard = F.expr(f"cast((offset + at) * {shards} div {max(rows, 1)} as int)")
    out = placed.select(F.col("row.record").alias("record"), position.alias("position"), shard.alias("shard"))
    slot = F.expr(f"position - (shard * {rows} + {shards - 1}) div {shards}")
    out.select("record", slot.cast("bigint").alias("slot"), "shard").write.partitionBy("shard").parquet(path)


def sharded(docs: DataFrame, shards: int = 24, seed: int = 17, bucket_bytes: int = 8 << 20) -> DataFrame:
    """(record, slot, shard) as write_shards wrote them to a fresh path of the shared folder."""
    path = new_path(docs.sparkSession, "shards")
    write_shards(docs, path, shards, seed, bucket_bytes)
    record = docs.select(F.struct(*(F.col(c) for c in docs.columns)).alias("record")).schema
    return docs.sparkSession.read.schema(record.add("slot", "long").add("shard", "integer")).parquet(path)
