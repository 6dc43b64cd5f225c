"""Shaping, membership and period-slice queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.bindings import order_panel, rounded, table, typed
from tidemark.operators import shape as S


def drop_columns(spark, d):
    return typed(S.drop_present(table(spark, d, "customer"), ["c_name", "c_custkey", "absent"]))


def label_binary(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "Yes").when(F.col("o_orderstatus") == "O", "no").otherwise("maybe").alias("label"))
    return typed(S.with_label(o, "label", "flag"))


def labelled_rows(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "Yes").when(F.col("o_orderstatus") == "O", "No").alias("label"))
    return typed(S.labelled_rows(o, "label"))


def align_features(spark, d):
    c = table(spark, d, "customer")
    return typed(S.align_features(c, ["c_acctbal", "c_custkey", "tenure"], ["c_mktsegment", "region"]))


def code_labels(spark, d):
    o = table(spark, d, "orders")
    code = F.col("o_orderpriority").substr(1, 1).cast("int")
    return o.select("o_orderkey", S.code_label(code, S.ORDINAL_LABELS["Education"]).alias("education"),
                    S.code_label(code, S.ORDINAL_LABELS["JobSatisfaction"]).alias("satisfaction"))


def period_slices(spark, d):
    """First, last and one middle period, told apart by a tag."""
    p = order_panel(spark, d).select("o_orderkey", "period")
    tag = lambda df, t: df.withColumn("slice", F.lit(t))
    return S.union_rows(tag(S.edge_period(p, "period"), "first"), tag(S.edge_period(p, "period", last=True), "last"), tag(S.period_slice(p, "period", 1998), "1998"))


def period_members(spark, d):
    p = order_panel(spark, d).select("o_orderkey", "period")
    wanted = p.groupBy("period").agg(F.count("*").alias("n")).filter("period IN (1996, 1998)")
    return S.in_periods(p, "period", wanted)


def active_rows(spark, d):
    return S.active_rows(order_panel(spark, d).select("o_orderkey", "urgent"), "urgent")


def new_entities(spark, d):
    """Customers who ordered from 1998 on but not before."""
    p = order_panel(spark, d)
    late, early = (p.filter(c).select("o_custkey").distinct() for c in ("period >= 1998", "period < 1998"))
    return late.join(early, "o_custkey", "left_anti")


def shared_entities(spark, d):
    """Customers who ordered both before 1998 and from then on."""
    p = order_panel(spark, d)
    late, early = (p.filter(c).select("o_custkey") for c in ("period >= 1998", "period < 1998"))
    return late.intersect(early)


def panel_union(spark, d):
    """Two column sets stacked by name, absent columns NULL."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"), F.col("s_nationkey").cast("bigint").alias("nation"))
    return rounded(S.union_rows(c, s), 4)


QUERIES = {
    "drop_columns": drop_columns,
    "label_binary": label_binary,
    "labelled_rows": labelled_rows,
    "align_features": align_features,
    "code_labels": code_labels,
    "period_slices": period_slices,
    "period_members": period_members,
    "active_rows": active_rows,
    "new_entities": new_entities,
    "shared_entities": shared_entities,
    "panel_union": panel_union,
}

SQL = {
    "drop_columns": "SELECT c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "label_binary": """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Yes' WHEN 'O' THEN 'no' ELSE 'maybe' END AS label,
        CASE o_orderstatus WHEN 'F' THEN 1::BIGINT WHEN 'O' THEN 0 END AS flag FROM orders""",
    "labelled_rows": "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1::BIGINT ELSE 0 END AS label FROM orders WHERE o_orderstatus IN ('F', 'O')",
    "align_features": "SELECT c_acctbal, c_custkey, 0::BIGINT AS tenure, c_mktsegment, 'Unknown' AS region FROM customer",
    "code_labels": """SELECT o_orderkey, list_extract(['Below College', 'College', 'Bachelor', 'Master', 'Doctor'], substr(o_orderpriority, 1, 1)::INT) AS education,
        list_extract(['Low', 'Medium', 'High', 'Very High'], substr(o_orderpriority, 1, 1)::INT) AS satisfaction FROM orders""",
    "period_slices": """SELECT o_orderkey, year(o_orderdate) AS period, 'first' AS slice FROM orders WHERE year(o_orderdate) = (SELECT min(year(o_orderdate)) FROM orders)
        UNION ALL SELECT o_orderkey, year(o_orderdate), 'last' FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)
        UNION ALL SELECT o_orderkey, year(o_orderdate), '1998' FROM orders WHERE year(o_orderdate) = 1998""",
    "period_members": "SELECT o_orderkey, year(o_orderdate) AS period FROM orders WHERE year(o_orderdate) IN (1996, 1998)",
    "active_rows": "SELECT o_orderkey, 'No' AS urgent FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')",
    "new_entities": "SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) >= 1998 AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) < 1998)",
    "shared_entities": "SELECT o_custkey FROM orders WHERE year(o_orderdate) >= 1998 INTERSECT SELECT o_custkey FROM orders WHERE year(o_orderdate) < 1998",
    "panel_union": """SELECT c_custkey AS key, round(c_acctbal, 4) AS balance, c_mktsegment AS segment, NULL::BIGINT AS nation FROM customer
        UNION ALL SELECT s_suppkey, round(s_acctbal, 4), NULL, s_nationkey FROM supplier""",
}
