"""Drift of an event stream against a fixed reference, per tumbling window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.scalars import ratio, round_even
from tidemark.functions.sqltext import per_feature
from tidemark.operators.drift import (
    PSI_BINS, bin_counts, bin_of_feature, category_severity, finite_bounds, first_lacking, long_categorical, long_numeric,
    numeric_severity, psi_of_counts,
)
from tidemark.streaming.windows import TIME, Measure, WindowStore, stamped


class ReferenceSketch:
    """Bounds and bin counts of a reference table.

    Built by two aggregations; per monitored column it keeps `bins` counts, so
    it stays a handful of numbers whatever the size of the reference. A column
    whose range is not finite has no bins and no index.
    """

    def __init__(self, reference: DataFrame, numeric: Sequence[str], bins: int = PSI_BINS):
        self.numeric, self.bins = list(numeric), bins
        long = long_numeric(reference, self.numeric)
        bounds = long.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi")).collect()
        self.bounds = finite_bounds({r["feature"]: r for r in bounds})
        counted = long.withColumn("bin", self.bin()).groupBy("feature").agg(
            F.count("*").alias("n"), *[F.count_if(F.col("bin") == k).alias(f"b{k}") for k in range(bins)]
        )
        self.counts = {r["feature"]: (r["n"], [r[f"b{k}"] for k in range(bins)]) for r in counted.collect()}

    def bin(self) -> Column:
        return bin_of_feature(self.bounds, self.bins)

    def psi(self) -> Column:
        """The index from cur_k and rows_cur, NULL for a feature without a finite range."""
        return F.when(F.expr(per_feature(dict.fromkeys(self.bounds, "true"), "false")), psi_of_counts(self.bins))

    def with_reference(self, counted: DataFrame) -> DataFrame:
        """counted, rows with a feature, beside the reference's counts rows_ref and ref_k."""
        reference = {f"ref_{k}": self.constant(lambda e, k=k: e[1][k]) for k in range(self.bins)}
        return counted.withColumns(reference | {"rows_ref": self.constant(lambda e: e[0])})

    def constant(self, pick) -> Column:
        return F.expr(per_feature({f: f"{pick(entry)}L" for f, entry in self.counts.items()}, "0L"))


def windowed_psi(events: DataFrame, sketch: ReferenceSketch, time: str, length: str = "1 day", late: str = "1 day") -> DataFrame:
    """PSI and severity per window and feature. Rows later than the watermark are dropped.

    The state is one row of bin counts per open window and feature.
    """
    stamped = events.withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", late)
    long = long_numeric(stamped, sketch.numeric, F.col("_time")).withColumn("bin", sketch.bin())
    counted = long.withColumn("n_cur", F.lit(1).cast("bigint")).withColumn("n_ref", F.lit(0).cast("bigint"))
    summed = counted.groupBy(F.window("_time", length).alias("window"), "feature").agg(
        F.sum("n_cur").alias("rows_cur"), *bin_counts(sketch.bins)
    )
    return judged_windows(summed.withColumns({"window_start": F.col("window.start"), "n_rows": F.col("rows_cur")}), sketch)


def psi_store(path: str, sketch: ReferenceSketch, length: str = "1 day", lateness: str = "1 day") -> WindowStore:
    """Windows that keep the bin counts of each feature. Feed it `binned_events`, read it with `judged_windows`."""
    measures = {f"cur_{k}": Measure(F.count_if(F.col("bin") == k)) for k in range(sketch.bins)}
    return WindowStore(path, ["feature"], {"rows_cur": Measure(F.count("*"))} | measures, length, lateness)


def binned_events(events: DataFrame, sketch: ReferenceSketch, time: str) -> DataFrame:
    return long_numeric(stamped(events, time), sketch.numeric, F.col(TIME)).withColumn("bin", sketch.bin())


def judged_windows(windows: DataFrame, sketch: ReferenceSketch) -> DataFrame:
    """(window_start, feature, n_rows, psi, severity) of windows with bin counts."""
    judged = sketch.with_reference(windows).withColumn("psi", sketch.psi())
    return judged.select(
        "window_start", "feature", "n_rows", round_even(F.col("psi"), 4).alias("psi"),
        F.when(F.col("psi").isNotNull(), numeric_severity(F.col("psi"), F.lit(None).cast("double"))).alias("severity"),
    )


def windowed_categories(events: DataFrame, columns: Sequence[str], time: str, length: str = "1 day", late: str = "1 day") -> DataFrame:
    """Category counts per closed window; feed the batches to `category_shift_of_windows`."""
    stamped = events.withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", late)
    long = long_categorical(stamped, columns, F.col("_time"))
    return long.groupBy(F.window("_time", length).alias("window"), "feature", "category").agg(
        F.count("*").alias("n_cur")
    ).select(F.col("window.start").alias("window_start"), "feature", "category", "n_cur")


def category_shift_of_windows(counts: DataFrame, reference_shares: DataFrame) -> DataFrame:
    """Largest share change per window and feature against (feature, category, proportion) rows.

    Reference categories that a window lacks count with their own share, of which
    the largest matters. Ranked by share, the first rank that the window does not
    hold names it, so no window meets all categories.
    """
    ranked = reference_shares.select("feature", "category", "proportion").withColumn(
        "place", F.row_number().over(Window.partitionBy("feature").orderBy(F.desc("proportion"), "category"))
    )
    keys = ["window_start", "feature"]
    sizes = counts.groupBy(*keys).agg(F.sum("n_cur").alias("n_rows"))
    cells = counts.join(ranked, ["feature", "category"], "left").join(sizes, keys)
    change = F.abs(ratio(F.col("n_cur"), F.col("n_rows")) - F.coalesce("proportion", F.lit(0.0)))
    worst = cells.groupBy(*keys).agg(F.max(change).alias("present"))
    worst = worst.join(first_lacking(cells.filter("place IS NOT NULL").select(*keys, "place"), keys), keys, "left").fillna({"place": 1})
    lacking = ranked.select("feature", "place", F.col("proportion").alias("lacking"))
    worst = worst.join(lacking, ["feature", "place"], "left").withColumn(
        "max_proportion_change", F.greatest("present", F.coalesce("lacking", F.lit(0.0)))
    )
    return worst.select(
        "window_start", "feature", round_even(F.col("max_proportion_change"), 4).alias("max_proportion_change"),
        category_severity(F.col("max_proportion_change")).alias("severity"),
    )


def start_category_monitor(
    events: DataFrame, reference_shares: DataFrame, columns: Sequence[str], time: str, path: str, checkpoint: str,
    length: str = "1 day", late: str = "1 day", available_now: bool = False,
):
    """Append closed windows' category shift to a table.

    A window closes in one micro-batch, so each batch holds whole windows. The
    batch id is the folder name: a repeated batch replaces its own output.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        found = category_shift_of_windows(batch, reference_shares)
        found.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    counts = windowed_categories(events, columns, time, length, late)
    writer = counts.writeStream.outputMode("append").foreachBatch(store).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
