"""Writing predictions, drift reports and dataset versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

VERSION_PATTERN = r"version=(\d+)"


def write_predictions(scored: DataFrame, key: str, path: str, fmt: str = "csv") -> None:
    """Overwrite the prediction table: id, class, probability."""
    out = scored.select(key, "prediction", "probability")
    writer = out.write.mode("overwrite")
    writer.csv(path, header=True) if fmt == "csv" else writer.format(fmt).save(path)


def write_report(table: DataFrame, path: str) -> None:
    """Drift table as JSON lines, one object per feature."""
    table.write.mode("overwrite").json(path)


def report_document(table: DataFrame, summary: DataFrame) -> DataFrame:
    """The report as one JSON text: summary fields and the list of features.

    The list has one entry per monitored column.
    """
    entries = F.array_sort(F.collect_list(F.struct("feature", *[c for c in table.columns if c != "feature"])))
    features = table.agg(entries.alias("f")).scalar()
    whole = summary.withColumn("covariate_shift", features)
    return whole.select(F.to_json(F.struct(*whole.columns)).alias("document"))


def next_version(spark: SparkSession, path: str) -> int:
    """Highest version folder + 1, or 1. Lists folder names, reads no rows."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return 1
    names = [(s.getPath().getName(),) for s in fs.listStatus(root)]
    if not names:
        return 1
    found = F.regexp_extract("name", VERSION_PATTERN, 1)
    listed = spark.createDataFrame(names, "name string").select(F.when(found != "", found.cast("int")).alias("v"))
    return (listed.agg(F.coalesce(F.max("v"), F.lit(0)).alias("v")).first()["v"]) + 1


def write_version(df: DataFrame, path: str) -> int:
    """Write the next dataset version as partition version=N."""
    version = next_version(df.sparkSession, path)
    df.write.mode("errorifexists").parquet(f"{path}/version={version}")
    return version
