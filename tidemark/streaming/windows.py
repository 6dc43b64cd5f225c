"""Event-time windows over a stream, kept as mergeable state in written tables.

Structured Streaming's own windowed aggregate never emits the windows that are
open when the data end, and says nothing about the rows it drops as late. Here
each micro-batch is summed up once in the JVM; the sums are merged into the state
of the open windows, windows that the watermark has passed are emitted once, and
late rows are counted beside them. What is open can be read at any time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

TIME = "_time"


@dataclass(frozen=True)
class Measure:
    """A mergeable aggregate: over rows, and over earlier results of itself in the column named."""

    rows: Column
    merged: Callable[[str], Column] = F.sum


def stamped(df: DataFrame, time: str) -> DataFrame:
    """df with its event time as a timestamp; rows without one belong to no window."""
    return df.withColumn(TIME, F.col(time).cast("timestamp")).filter(F.col(TIME).isNotNull())


class WindowStore:
    """Sums per tumbling window and key under path, one folder of small files per micro-batch.

    Batch k reads the open windows and the watermark that batch k - 1 left and
    writes its own; a repeated batch reads the same and replaces its own output, so
    a window is emitted once whatever is lost. The state is one row per open
    window and key. A row is late when its window has been emitted before its
    batch. The watermark is the newest event time of all batches before, less lateness.
    """

    def __init__(self, path: str, keys: Sequence[str], measures: dict[str, Measure], length: str = "1 day", lateness: str = "1 day"):
        self.path, self.keys, self.measures, self.length, self.lateness = path, list(keys), dict(measures), length, lateness

    def start(self, rows: DataFrame, checkpoint: str, available_now: bool = False) -> StreamingQuery:
        """rows: a stream with TIME, the keys and what the measures read."""
        writer = rows.writeStream.foreachBatch(self.fold).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def fold(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = self._read(spark, "progress", batch_id - 1).first()["watermark"] if batch_id else None
        late = F.lit(False) if before is None else F.col("window_end") <= F.lit(before)
        windowed = batch.withColumn("_window", F.window(TIME, self.length)).withColumns({"window_start": F.col("_window.start"), "window_end": F.col("_window.end")})
        summed = windowed.groupBy("window_start", "window_end", *self.keys, late.alias("late")).agg(
            F.count("*").alias("n_rows"), F.max(TIME).alias("newest"), *[m.rows.alias(name) for name, m in self.measures.items()],
        )
        # The batch is read once; everything below reads its sums.
        self._write(summed, "sums", batch_id)
        summed = self._read(spark, "sums", batch_id)
        newest = F.expr(f"max(newest) - INTERVAL {self.lateness}")
        watermark = F.max(F.greatest(F.lit(before).cast("timestamp"), F.col("w"))).alias("watermark")
        self._write(summed.agg(newest.alias("w")).agg(watermark), "progress", batch_id)
        after = self._read(spark, "progress", batch_id).first()["watermark"]
        self._write(summed.filter("late").groupBy("window_start").agg(F.sum("n_rows").alias("n_rows")), "late", batch_id)
        held = summed.filter("NOT late").drop("late", "newest")
        if batch_id:
            held = held.unionByName(self._read(spark, "open", batch_id - 1))
        merged = held.groupBy("window_start", "window_end", *self.keys).agg(
            F.sum("n_rows").alias("n_rows"), *[m.merged(name).alias(name) for name, m in self.measures.items()],
        )
        passed = F.lit(False) if after is None else F.col("window_end") <= F.lit(after)
        self._write(merged.filter(passed), "closed", batch_id)
        self._write(merged.filter(~passed), "open", batch_id)

    def _write(self, df: DataFrame, part: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{part}/batch={batch_id}")

    def _read(self, spark: SparkSession, part: str, batch_id: int) -> DataFrame:
        return spark.read.parquet(f"{self.path}/{part}/batch={batch_id}")

    def closed(self, spark: SparkSession) -> DataFrame:
        """(window_start, window_end, keys, n_rows, measures) of the windows that the watermark has passed."""
        return spark.read.parquet(f"{self.path}/closed").drop("batch")

    def flushed(self, spark: SparkSession) -> DataFrame:
        """All windows: the closed ones, and those that are open after the last batch as they stand."""
        last = spark.read.parquet(f"{self.path}/progress").agg(F.max("batch")).first()[0]
        return self.closed(spark).unionByName(self._read(spark, "open", last))

    def late(self, spark: SparkSession) -> DataFrame:
        """(window_start, n_rows): rows left out because their window had been emitted."""
        return spark.read.parquet(f"{self.path}/late").groupBy("window_start").agg(F.sum("n_rows").alias("n_rows"))
