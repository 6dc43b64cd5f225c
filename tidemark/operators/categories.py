"""Codes of categories as a table, however many there are."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.sqltext import name
from tidemark.operators.drift import ranked_categories
from tidemark.sources.tables import new_path

#: Frequent categories of a column with a place of their own in the vector, and the buckets that the rest shares.
KNOWN = 1000
HASHED = 256


class CategoryCodes(Transformer, MLReadable, MLWritable):
    """Adds c_index, the place of a category in the vector of its column, for every column c_text.

    The places come from a table by join, so no vocabulary is held on the driver or
    in the model. A category that the table lacks gets the place behind the last,
    which an encoder with handleInvalid="keep" and dropLast turns into the zero
    vector. Works on tables and streams. Saved with its table.
    """

    table = Param(Params._dummy(), "table", "folder of (feature, category, place) rows", TypeConverters.toString)
    sizes = Param(Params._dummy(), "sizes", "vector size by column, as JSON", TypeConverters.toString)
    fills = Param(Params._dummy(), "fills", "place of a missing value by column, as JSON, for rows written with their places", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, table: str | None = None, sizes: str | None = None, fills: str | None = None):
        super().__init__()
        self._setDefault(fills="{}")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        fills = json.loads(self.getOrDefault(self.fills))
        for c, size in json.loads(self.getOrDefault(self.sizes)).items():
            # With its size stated, the encoder need not look for the largest place.
            nominal = {"ml_attr": {"type": "nominal", "name": f"{c}_index", "num_vals": size}}
            if c in fills and self.place_column(c) in df.columns:
                met, place = df, F.coalesce(F.col(name(self.place_column(c))), F.lit(fills[c]))
            else:
                met, place = self._met(df, c, F.col(name(f"{c}_text"))), F.coalesce("_place", F.lit(size))
            df = met.select(*[F.col(name(x)) for x in df.columns], place.cast("double").alias(f"{c}_index", metadata=nominal))
        return df

    def _codes(self, df: DataFrame) -> DataFrame:
        return df.sparkSession.read.schema("feature string, category string, place bigint").parquet(self.getOrDefault(self.table))

    def _met(self, df: DataFrame, c: str, category: Column) -> DataFrame:
        """df with _place, the place of its category in column c."""
        found = self._codes(df).filter(F.col("feature") == c).select(F.col("category").alias("_category"), F.col("place").alias("_place"))
        return df.join(found, category == F.col("_category"), "left")

    def place_column(self, c: str) -> str:
        """The column of written places. It names the table, so other codes do not take its places for theirs."""
        return f"_{c}_in_{self.getOrDefault(self.table).rstrip('/').rsplit('/', 1)[-1]}"

    def with_places(self, df: DataFrame) -> DataFrame:
        """df with a column of places per column of categories, NULL where the category is: written once, they spare every later pass the join."""
        for c, size in json.loads(self.getOrDefault(self.sizes)).items():
            known = F.col(name(c)).cast("string")
            place = F.when(known.isNotNull(), F.coalesce("_place", F.lit(size))).cast("int").alias(self.place_column(c))
            df = self._met(df, c, known).select(*[F.col(name(x)) for x in df.columns], place)
        return df

    def filled(self, df: DataFrame, modes: Sequence[dict[str, str]]) -> list[CategoryCodes]:
        """These codes once per set of modes, for rows with places; the places of all modes are looked up together."""
        sizes = json.loads(self.getOrDefault(self.sizes))
        wanted = sorted({mode for m in modes for mode in m.values()})
        found = {(r["feature"], r["category"]): r["place"] for r in self._codes(df).filter(F.col("category").isin(wanted)).collect()}
        return [self.copy({self.fills: json.dumps({c: found.get((c, m[c]), size) for c, size in sizes.items()})}) for m in modes]

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, codes: CategoryCodes):
        super().__init__()
        self.codes = codes

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.codes, path, self.sparkSession)
        self.sparkSession.read.parquet(self.codes.getOrDefault(self.codes.table)).write.parquet(f"{path}/codes")


class _Reader(MLReader):
    def load(self, path: str) -> CategoryCodes:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        codes = CategoryCodes()
        codes._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(codes, metadata)
        return codes._set(table=f"{path}/codes")


def category_codes(df: DataFrame, columns: Sequence[str], known: int = KNOWN, hashed: int = HASHED) -> CategoryCodes:
    """Codes from the categories of df, the most frequent first.

    The known most frequent ones of a column have a place each. If there are more,
    the rest is dealt by hash into so many more places. The table holds every
    category, so what was never seen is told from what is rare. One number per
    column, its count of categories, reaches the driver.
    """
    path = new_path(df.sparkSession, "codes")
    rare = F.lit(known) + F.pmod(F.xxhash64("category"), F.lit(max(hashed, 1)))
    place = F.when(F.col("place") <= known, F.col("place") - 1).otherwise(rare if hashed else F.lit(None))
    ranked_categories(df, columns).select("feature", "category", place.cast("bigint").alias("place")).write.parquet(path)
    counts = {r["feature"]: r["n"] for r in df.sparkSession.read.parquet(path).groupBy("feature").agg(F.count("*").alias("n")).collect()}
    # The encoder asks for two places at least; nothing takes those that are too many.
    sizes = {c: max(2, counts.get(c, 0) if counts.get(c, 0) <= known else known + hashed) for c in columns}
    return CategoryCodes(table=path, sizes=json.dumps(sizes))
