"""Reading documents inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Words are runs of anything but space and the five ASCII line and tab characters,
#: which are exactly the separators of bytes.split().
WORD = r"[^\x20\x09-\x0D]+"


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def renamed(df: DataFrame) -> DataFrame:
    """df with every column that is none of a document's under a name of its own."""
    return df.toDF(*(c if c in COLUMNS else f"other_{i}" for i, c in enumerate(df.columns)))


def apart(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A function from documents to documents that keeps their columns, made safe against columns of any name.

    Further columns go through under names of their own, so one called like a helper
    column of the function, or like text in other letters, comes back as it was.
    """

    @wraps(stage)
    def run(docs: DataFrame, *args, **options) -> DataFrame:
        return stage(renamed(docs), *args, **options).toDF(*docs.columns)

    return run


def documents(df: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (null: empty), and the named columns; others are left behind."""
    if len({c.lower() for c in df.columns}) < len(df.columns):
        df = renamed(df)
    text = F.coalesce(df["text"].cast("string"), F.lit("")).alias("text")
    return df.select(df["doc_id"].cast("bigint").alias("doc_id"), text, *(df[c] for c in more))


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that a task holds few documents as Python objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def raw(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column."""
    return column.cast(pa.binary()).to_pylist()
