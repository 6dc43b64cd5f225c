"""Reading tables, and the shared folder that written tables go to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, types as T


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Headered CSV with declared types: no inference pass over the data."""
    return spark.read.csv(path, header=True, schema=schema, mode="PERMISSIVE")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, from spark.checkpoint.dir.

    A session of one machine that names none, as in tests, gets a temporary
    folder set as its checkpoint folder. On a cluster that would scatter the
    files over the executors' own disks, so there it is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialized(df: DataFrame, name: str) -> DataFrame:
    """Write rows that several later jobs read, and read them back.

    The lineage ends at the written files, which survive a lost executor.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
