"""How the operators are bound to the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.sources.tables import read_table

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CATEGORICAL = ["l_returnflag", "l_linestatus"]
SPLIT_YEAR = 1998


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, folder, name)


def line_years(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Line items shipped before SPLIT_YEAR (reference) and from then on (current): the whole table.

    The bound on the date column reaches the parquet scan as a pushed filter.
    """
    before, after = halves(table(spark, folder, "lineitem"), "l_shipdate")
    columns = [*NUMERIC, *CATEGORICAL]
    return before.select(columns), after.select(columns)


def halves(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    day = F.lit(f"{SPLIT_YEAR}-01-01").cast("timestamp_ntz")
    return df.filter(F.col(column) < day), df.filter(F.col(column) >= day)


def injected(current: DataFrame) -> DataFrame:
    """The current lines with a price rise, a discount shift and most flags turned to R."""
    flag = F.when(F.col("l_quantity") > 15, "R").otherwise(F.col("l_returnflag"))
    return current.withColumns({
        "l_extendedprice": F.col("l_extendedprice") * 1.5, "l_discount": F.col("l_discount") + 0.05, "l_returnflag": flag,
    })


def order_panel(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the year as period and an urgent/high label."""
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
        F.year("o_orderdate").cast("bigint").alias("period"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Yes").otherwise("No").alias("urgent"),
    )


def scored_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with a label, a score, a class and the ship year."""
    score = F.col("l_quantity") / 50 + F.when(F.col("l_returnflag") == "R", 0.2).otherwise(0.0)
    lines = table(spark, folder, "lineitem")
    return lines.select(
        F.year("l_shipdate").cast("bigint").alias("period"),
        F.when(F.col("l_returnflag") == "R", "Yes").otherwise("No").alias("label"),
        score.alias("score"), (score >= 0.6).cast("int").alias("prediction"),
    )


def event_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").withColumn("day", F.to_date("ts"))


def typed(df: DataFrame) -> DataFrame:
    """Whole numbers as BIGINT and fractions as DOUBLE, so both engines agree on types."""
    whole = (T.ByteType, T.ShortType, T.IntegerType)
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, whole):
            out.append(F.col(f.name).cast("bigint").alias(f.name))
        elif isinstance(f.dataType, (T.FloatType, T.DecimalType)):
            out.append(F.col(f.name).cast("double").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE column, for comparison only."""
    out: list[Column] = []
    for f in df.schema.fields:
        c = F.col(f.name)
        out.append(F.round(c, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else c)
    return df.select(*out)
