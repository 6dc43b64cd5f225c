"""Run records: one row per training run in an append-only table, and JSON history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

CLASS_METRICS = "struct<precision:double,recall:double,f1_score:double,support:bigint>"
RUN_SCHEMA = (
    "run_id string, dataset_version string, timestamp timestamp, roc_auc double, "
    f"class_0 {CLASS_METRICS}, class_1 {CLASS_METRICS}, accuracy double, "
    "confusion_matrix array<array<bigint>>, best_params map<string,string>"
)

# The shape of a run's JSON document.
_REPORT_ROW = T.StructType([T.StructField(n, T.DoubleType()) for n in ("precision", "recall", "f1-score", "support")])
DOCUMENT_SCHEMA = T.StructType([
    T.StructField("dataset_version", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("classification_report", T.StructType([
        T.StructField("0", _REPORT_ROW), T.StructField("1", _REPORT_ROW), T.StructField("accuracy", T.DoubleType()),
    ])),
    T.StructField("roc_auc", T.DoubleType()),
    T.StructField("confusion_matrix", T.ArrayType(T.ArrayType(T.LongType()))),
])
COMPARED = ("roc_auc", "f1_score", "precision", "recall")


def append_run(run: DataFrame, path: str) -> None:
    run.write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str, schema: str = RUN_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def latest_run(runs: DataFrame) -> DataFrame:
    """The run with the newest timestamp: one aggregate, no sort."""
    whole = F.struct(*runs.columns)
    return runs.agg(F.max_by(whole, F.struct("timestamp", "run_id")).alias("r")).select("r.*")


def read_history(spark: SparkSession, folder: str) -> DataFrame:
    """Run documents (one JSON object per file, spread over lines) with their file name."""
    read = spark.read.schema(DOCUMENT_SCHEMA).option("multiLine", True).json(folder)
    name = F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1)
    report = F.col("classification_report.1")
    return read.select(
        name.alias("file"), "dataset_version", "timestamp", "roc_auc",
        report.getField("f1-score").alias("f1_score"), report["precision"].alias("precision"), report["recall"].alias("recall"),
    )


def compare_with_latest(runs: DataFrame, chosen: Column) -> DataFrame:
    """Value of the latest run and its difference to each chosen run, per metric; absent reads 0."""
    latest = latest_run(runs).select(F.struct(*COMPARED).alias("latest")).scalar()
    wide = runs.filter(chosen).withColumn("latest", latest)
    rows = F.explode(F.array(*[
        F.struct(
            F.lit(m).alias("metric"),
            F.coalesce(F.col("latest").getField(m), F.lit(0.0)).alias("latest"),
            (F.coalesce(F.col("latest").getField(m), F.lit(0.0)) - F.coalesce(F.col(m), F.lit(0.0))).alias("delta"),
        ) for m in COMPARED
    ]))
    return wide.select("run_id", rows.alias("r")).select("run_id", "r.*")
