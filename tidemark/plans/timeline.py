"""A drift timeline that grows period by period from stored counts."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import drift as D
from tidemark.operators.order_stats import cuts_by_feature
from tidemark.plans.report import timeline_status
from tidemark.sources.tables import materialized

#: Distinct values of the reference and a period that one slice of a sorted column should hold.
CELLS_PER_SLICE = 200_000

_PROFILE = "feature string, rows bigint, lo double, hi double"
_RESULT = (
    "feature string, type string, psi double, ks_statistic double, ks_pvalue double, max_proportion_change double, severity string, alert boolean"
)


class DriftTimeline:
    """Drift of periods against one reference, kept under path.

    reference/ holds the reference as counts: per (feature, value), and per
    (feature, category) with its rank. They are made once; the reference table is not read again. periods/
    holds the counts of each period and its rows of the drift table, in a folder of
    its own, so a period that comes again replaces what it left, and nothing else.
    """

    def __init__(self, path: str, period: str):
        self.path, self.period = path, period

    def start(self, reference: DataFrame, numeric: Sequence[str] | None = None, categorical: Sequence[str] | None = None, rows_per_slice: int = CELLS_PER_SLICE) -> DriftTimeline:
        """Count the reference. Only bounds, a few numbers per column, reach the driver."""
        auto_numeric, auto_categorical = D.feature_columns(reference, [self.period])
        numeric, categorical = list(auto_numeric if numeric is None else numeric), list(auto_categorical if categorical is None else categorical)
        values = D.long_numeric(reference, numeric).groupBy("feature", "value").agg(F.count("*").alias("n_ref"))
        values.write.mode("overwrite").parquet(f"{self.path}/reference/values")
        D.ranked_categories(reference, categorical).write.mode("overwrite").parquet(f"{self.path}/reference/categories")
        spark = reference.sparkSession
        known = spark.read.schema(values.schema).parquet(f"{self.path}/reference/values")
        profile = known.groupBy("feature").agg(F.sum("n_ref").alias("rows"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        profile.write.mode("overwrite").parquet(f"{self.path}/reference/profile")
        spark.createDataFrame([(json.dumps([numeric, categorical, rows_per_slice]),)], "value string").write.mode("overwrite").text(f"{self.path}/reference/columns")
        return self

    def add(self, rows: DataFrame) -> None:
        """Count the periods that rows hold and compare them with the reference.

        rows must hold all rows of their periods. Only their counts go on from here;
        periods added before are not read.
        """
        spark = rows.sparkSession
        numeric, categorical, *kept = json.loads(spark.read.text(f"{self.path}/reference/columns").first()[0])
        counts = materialized(D.period_counts(rows, numeric, categorical, self.period), "period-counts")
        self._replace(counts, "counts")
        of = lambda part: spark.read.parquet(f"{self.path}/reference/{part}")
        profile = {r["feature"]: r for r in spark.read.schema(_PROFILE).parquet(f"{self.path}/reference/profile").collect()}
        numbers, texts = counts.filter("value IS NOT NULL").drop("category"), counts.filter("category IS NOT NULL").drop("value")
        # The slices follow what is sorted: the values of the reference and of these periods.
        cells = of("values").select("feature", "value").unionByName(numbers.select("feature", "value"))
        sizes = {r["feature"]: r["count"] for r in cells.groupBy("feature").count().collect()}
        cuts = cuts_by_feature(cells, sizes, kept[0] if kept else CELLS_PER_SLICE)
        numbers = D.numeric_drift_of_counts(of("values"), numbers, profile, cuts)
        texts = D.categorical_drift_of_counts(of("categories"), texts)
        found = D.reported_numeric(numbers, [F.col("period")], []).unionByName(D.reported_categorical(texts, [F.col("period")], []))
        self._replace(found.withColumn("alert", F.col("severity") != "LOW"), "drift")

    def table(self, spark: SparkSession) -> DataFrame:
        """The drift table of all periods added; the period is text."""
        return spark.read.schema(f"{_RESULT}, period string").parquet(f"{self.path}/periods/drift").withColumnRenamed("period", self.period)

    def status(self, spark: SparkSession, concept: DataFrame | None = None) -> DataFrame:
        """One row per period as drift_timeline gives; concept may hold (period, alert) rows."""
        return timeline_status(self.table(spark), self.period, concept)

    def _replace(self, df: DataFrame, part: str) -> None:
        """Write the periods of df as partitions; those of other periods stay."""
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(f"{self.path}/periods/{part}")
