"""Scoring a stream of JSON records with a fitted model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.model import score
from tidemark.operators.shape import align_features
from tidemark.sources.contract import RecordContract


def scored_stream(
    records: DataFrame, column: str, contract: RecordContract, model: Model, key: str,
    numeric: Sequence[str], categorical: Sequence[str],
) -> tuple[DataFrame, DataFrame]:
    """(scored good records, quarantined records). Stateless, so it works on streams and tables."""
    good, bad = contract.split(records, column)
    aligned = align_features(good, [key, *numeric], categorical)
    return score(model, aligned, [key]), bad


def append_stream(df: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append rows to a parquet table; the checkpoint folder makes it exactly-once."""
    writer = df.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
