"""Type-normalization queries on text made from the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.bindings import rounded, table, typed
from tidemark.operators import normalize as N


def messy_orders(spark, d):
    """Orders with text columns as they come from loose files."""
    o = table(spark, d, "orders")
    key = F.col("o_orderkey")
    code = F.col("o_orderpriority").substr(1, 1)
    mixed = (
        F.when(key % 4 == 0, F.col("o_orderpriority")).when(key % 4 == 1, code)
        .when(key % 4 == 2, F.format_string("%d.5", key % 100)).when(key % 12 == 3, "true")
        .when(key % 12 == 7, F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    return o.select(
        "o_orderkey", "o_orderstatus",
        mixed.alias("mixed"),
        F.when(key % 5 != 0, F.format_string("  %d ", F.col("o_custkey"))).alias("padded"),
        F.when(key % 3 == 0, "1d").when(key % 3 == 1, "12").otherwise("1e3").alias("suffixed"),
        F.when(key % 7 != 0, F.col("o_totalprice")).alias("price"),
        (key % 2 == 0).alias("even"),
        F.when(key % 10 == 0, F.lit(float("nan"))).otherwise(F.col("o_custkey") * 0.5).alias("half"),
    )


def mixed_types(spark, d):
    found = N.detect_mixed_types(messy_orders(spark, d))
    return found.select("column", F.concat_ws(",", "classes").alias("classes"))


def value_classes(spark, d):
    return N.value_classes(messy_orders(spark, d))


def categorical_text(spark, d):
    m = messy_orders(spark, d)
    text = lambda c, na=None: N.categorical_column(F.col(c), m.schema[c].dataType, na)
    return m.select("o_orderkey", text("o_orderkey").alias("key_text"), text("even").alias("even_text"),
                    text("mixed", N.CATEGORICAL_NA).alias("mixed_text"), text("o_orderstatus").alias("status_text"))


def numeric_coercion(spark, d):
    m = messy_orders(spark, d)
    number = lambda c: N.numeric_column(F.col(c), m.schema[c].dataType).alias(c)
    return m.select("o_orderkey", *[number(c) for c in ("mixed", "padded", "suffixed", "price", "half")])


def numeric_fill_strategies(spark, d):
    m = messy_orders(spark, d).select("price", N.numeric_column(F.col("half"), messy_orders(spark, d).schema["half"].dataType).alias("half"))
    out = None
    for strategy in N.NUMERIC_STRATEGIES:
        filled = N.fill_numeric(m, ["price", "half"], strategy)
        row = filled.agg(F.count("price").alias("n_price"), F.sum("price").alias("sum_price"), F.count("half").alias("n_half"), F.sum("half").alias("sum_half"))
        row = row.select(F.lit(strategy).alias("strategy"), "*")
        out = row if out is None else out.unionByName(row)
    return rounded(out, 2)


def column_kinds(spark, d):
    return typed(N.column_type_table(messy_orders(spark, d)))


def normalize_frame(spark, d):
    return rounded(N.normalize_frame(messy_orders(spark, d), exclude=["o_orderstatus"]), 4)


def normalize_for_ml(spark, d):
    shaped = N.normalize_for_ml(messy_orders(spark, d), target="even")
    return rounded(shaped.select("o_orderkey", "even", "padded", "half"), 4)


def consistency_issues(spark, d):
    m = messy_orders(spark, d)
    second = m.drop("half").withColumn("suffixed", F.lit("12")).withColumn("extra", F.lit(1)).withColumn("o_orderkey", F.col("o_orderkey").cast("string"))
    return N.consistency_issues(m, second)


def normalization_report(spark, d):
    return typed(N.normalization_report(messy_orders(spark, d), exclude=["o_orderstatus"]))


QUERIES = {
    "mixed_types": mixed_types,
    "value_classes": value_classes,
    "categorical_text": categorical_text,
    "numeric_coercion": numeric_coercion,
    "numeric_fill_strategies": numeric_fill_strategies,
    "column_kinds": column_kinds,
    "normalize_frame": normalize_frame,
    "normalize_for_ml": normalize_for_ml,
    "consistency_issues": consistency_issues,
    "normalization_report": normalization_report,
}

_MESSY = """WITH m AS (SELECT o_orderkey, o_orderstatus,
  CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority WHEN o_orderkey % 4 = 1 THEN substr(o_orderpriority, 1, 1) WHEN o_orderkey % 4 = 2 THEN (o_orderkey % 100) || '.5'
   WHEN o_orderkey % 12 = 3 THEN 'true' WHEN o_orderkey % 12 = 7 THEN strftime(o_orderdate, '%Y-%m-%d') END AS mixed,
  CASE WHEN o_orderkey % 5 <> 0 THEN '  ' || o_custkey || ' ' END AS padded,
  CASE WHEN o_orderkey % 3 = 0 THEN '1d' WHEN o_orderkey % 3 = 1 THEN '12' ELSE '1e3' END AS suffixed,
  CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS price, o_orderkey % 2 = 0 AS even,
  CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey * 0.5::DOUBLE END AS half FROM orders)"""
_MIXED_CLASS = """CASE WHEN o_orderkey % 4 = 0 THEN 'str' WHEN o_orderkey % 4 = 1 THEN 'int' WHEN o_orderkey % 4 = 2 THEN 'float' WHEN o_orderkey % 12 = 3 THEN 'bool' WHEN o_orderkey % 12 = 7 THEN 'timestamp' END"""
_CLASSES = f""" cl AS (SELECT 'o_orderkey' AS "column", 'int' AS class FROM m UNION ALL SELECT 'o_orderstatus', 'str' FROM m UNION ALL SELECT 'mixed', {_MIXED_CLASS} FROM m
  UNION ALL SELECT 'padded', CASE WHEN padded IS NOT NULL THEN 'int' END FROM m
  UNION ALL SELECT 'suffixed', CASE WHEN suffixed = '1d' THEN 'str' WHEN suffixed = '12' THEN 'int' ELSE 'float' END FROM m
  UNION ALL SELECT 'price', CASE WHEN price IS NOT NULL THEN 'float' END FROM m UNION ALL SELECT 'even', 'bool' FROM m
  UNION ALL SELECT 'half', CASE WHEN half IS NOT NULL THEN 'float' END FROM m)"""
_NUMBERS = """CASE WHEN o_orderkey % 4 = 1 OR o_orderkey % 4 = 2 THEN CAST(mixed AS DOUBLE) END AS mixed, CAST(trim(padded) AS DOUBLE) AS padded,
  CASE WHEN suffixed <> '1d' THEN CAST(suffixed AS DOUBLE) END AS suffixed, price, half"""

SQL = {
    "mixed_types": f"""{_MESSY}, {_CLASSES} SELECT "column", string_agg(class, ',' ORDER BY class) AS classes FROM (SELECT DISTINCT "column", class FROM cl WHERE class IS NOT NULL)
        GROUP BY 1 HAVING count(*) > 1""",
    "value_classes": f"""{_MESSY}, {_CLASSES} SELECT "column", class, count(*) AS n FROM cl WHERE class IS NOT NULL GROUP BY 1, 2""",
    "categorical_text": f"""{_MESSY} SELECT o_orderkey, o_orderkey::VARCHAR AS key_text, CASE WHEN even THEN 'True' ELSE 'False' END AS even_text, coalesce(mixed, 'missing') AS mixed_text,
        o_orderstatus AS status_text FROM m""",
    "numeric_coercion": f"{_MESSY} SELECT o_orderkey, {_NUMBERS} FROM m",
    "numeric_fill_strategies": f"""{_MESSY} SELECT 'keep' AS strategy, count(price) AS n_price, round(sum(price), 2) AS sum_price, count(half) AS n_half, round(sum(half), 2) AS sum_half FROM m
        UNION ALL SELECT 'zero', count(*), round(sum(coalesce(price, 0)), 2), count(*), round(sum(coalesce(half, 0)), 2) FROM m
        UNION ALL SELECT 'mean', count(*), round(sum(coalesce(price, (SELECT avg(price) FROM m))), 2), count(*), round(sum(coalesce(half, (SELECT avg(half) FROM m))), 2) FROM m""",
    "column_kinds": f"""{_MESSY} SELECT * FROM (SELECT 'o_orderkey' AS "column", 'numeric' AS kind, count(*) AS n_values, 0::BIGINT AS n_unparsed FROM m
        UNION ALL SELECT 'o_orderstatus', 'categorical', count(*), count(*) FROM m
        UNION ALL SELECT 'mixed', 'categorical', count(mixed), count(mixed) FILTER (o_orderkey % 4 NOT IN (1, 2)) FROM m
        UNION ALL SELECT 'padded', 'numeric', count(padded), 0 FROM m
        UNION ALL SELECT 'suffixed', 'categorical', count(*), count(*) FILTER (suffixed = '1d') FROM m
        UNION ALL SELECT 'price', 'numeric', count(price), 0 FROM m UNION ALL SELECT 'even', 'categorical', count(*), count(*) FROM m
        UNION ALL SELECT 'half', 'numeric', count(half), 0 FROM m)""",
    "normalize_frame": f"""{_MESSY} SELECT o_orderkey, o_orderstatus, mixed, round(CAST(trim(padded) AS DOUBLE), 4) AS padded, suffixed, round(price, 4) AS price,
        CASE WHEN even THEN 'True' ELSE 'False' END AS even, round(half, 4) AS half FROM m""",
    "normalize_for_ml": f"{_MESSY} SELECT o_orderkey, even, CAST(trim(padded) AS DOUBLE) AS padded, round(half, 4) AS half FROM m",
    "consistency_issues": f"""{_MESSY}, {_CLASSES}, first_ AS (SELECT "column", string_agg(DISTINCT class, ',' ORDER BY class) AS c FROM cl WHERE class IS NOT NULL GROUP BY 1),
        second_ AS (SELECT "column", string_agg(DISTINCT class, ',' ORDER BY class) AS c FROM (
          SELECT * FROM cl WHERE "column" NOT IN ('half', 'suffixed') UNION ALL SELECT 'suffixed', 'int' FROM m UNION ALL SELECT 'extra', 'int' FROM m) WHERE class IS NOT NULL GROUP BY 1)
        SELECT coalesce(a."column", b."column") AS "column", CASE WHEN b."column" IS NULL THEN 'missing_in_second' WHEN a."column" IS NULL THEN 'missing_in_first' ELSE 'type_mismatch' END AS issue,
        a.c AS classes1, b.c AS classes2 FROM first_ a FULL JOIN second_ b ON a."column" = b."column" WHERE a.c IS DISTINCT FROM b.c""",
    "normalization_report": f"""{_MESSY} SELECT 'o_orderkey' AS "column", 'bigint' AS type_before, 'bigint' AS type_after, count(*) AS n_values, 0::BIGINT AS n_changed, 0::BIGINT AS n_lost, FALSE AS was_mixed, FALSE AS type_changed FROM m
        UNION ALL SELECT 'mixed', 'string', 'string', count(mixed), 0, 0, TRUE, FALSE FROM m
        UNION ALL SELECT 'padded', 'string', 'double', count(padded), count(padded), 0, FALSE, TRUE FROM m
        UNION ALL SELECT 'suffixed', 'string', 'string', count(*), 0, 0, TRUE, FALSE FROM m
        UNION ALL SELECT 'price', 'double', 'double', count(price), 0, 0, FALSE, FALSE FROM m
        UNION ALL SELECT 'even', 'boolean', 'string', count(*), count(*), 0, FALSE, TRUE FROM m
        UNION ALL SELECT 'half', 'double', 'double', count(half), 0, 0, FALSE, FALSE FROM m""",
}
