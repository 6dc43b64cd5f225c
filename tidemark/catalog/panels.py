"""Panel and what-if queries and their SQL. Draws use the md5 of a key in both engines."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.bindings import event_rows, order_panel, rounded, table, typed
from tidemark.operators import panel as P
from tidemark.operators import set_sketches as Z
from tidemark.operators import whatif as W

STEPS = {"1-URGENT": "2-HIGH", "2-HIGH": "3-MEDIUM", "3-MEDIUM": "4-NOT SPECIFIED", "4-NOT SPECIFIED": "5-LOW", "5-LOW": "5-LOW"}


def retention_sample(spark, d):
    return P.retention_sample(order_panel(spark, d).select("o_orderkey", "urgent"), "o_orderkey", 0.85, label="urgent", scenario="growth", seed=7).select("o_orderkey")


def retention_sample_by_group(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return P.retention_sample(rows, "o_orderkey", 0.85, groups=["o_orderstatus"], scenario="recession", seed=7)


def retention_sample_missing_group(spark, d):
    """NULL is a group like any other."""
    rows = table(spark, d, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("F")).alias("status"))
    return P.retention_sample(rows, "o_orderkey", 0.85, groups=["status"], seed=7)


def retention_sample_repeated_key(spark, d):
    """Customers repeat among orders; the count is exact all the same."""
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey")
    return P.retention_sample(rows, "o_custkey", 0.85, seed=7).agg(F.count("*").alias("n_rows"), F.count_distinct("o_orderkey").alias("n_orders"))


def age_cohort(spark, d):
    p = table(spark, d, "part")
    rows = p.select(
        "p_partkey", (F.col("p_size") * 0.37).alias("tenure"), F.when(F.col("p_partkey") % 3 != 0, F.col("p_retailprice") / 300 - 3).alias("in_role"), F.col("p_size").alias("age"),
    )
    return rounded(typed(P.age_cohort(rows, "tenure", capped=["in_role"], age="age", month=12)), 4)


def period_stamp(spark, d):
    panel = order_panel(spark, d).select("period").distinct()
    return panel.select("period", P.period_stamp("2024-01-01", F.col("period") - 1995).alias("stamp"))


def next_keys(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", "s_name")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), "c_name")
    return P.next_keys(s.withColumn("key", F.lit(None).cast("bigint")), c, "key", "s_suppkey").select("s_suppkey", "key")


def keys_in_place(spark, d):
    """Keys for all line items behind those of the orders: one each, without gaps, on rows that stay as they are."""
    top = table(spark, d, "orders").select(F.col("o_orderkey").alias("key"))
    found = P.next_keys(table(spark, d, "lineitem"), top, "key")
    return rounded(found.agg(
        F.count("*").alias("n_rows"), F.count_distinct("key").alias("n_keys"), F.min("key").alias("low"), F.max("key").alias("high"),
        F.sum("l_extendedprice").alias("total"),
    ), 2)


def ensure_keys(spark, d):
    return P.ensure_keys(table(spark, d, "customer").select("c_name"), "key", "c_name")


def cohort_movement(spark, d):
    return rounded(typed(P.cohort_movement(table(spark, d, "orders"), "o_custkey", F.year("o_orderdate"))))


def cohort_movement_pairs(spark, d):
    """Customers kept, won and lost between any two years, from one sketch a year."""
    found = Z.sketched_movement(Z.period_sketches(table(spark, d, "orders"), "o_custkey", F.year("o_orderdate").cast("bigint")))
    return found.drop("bound")


def cohort_movement_daily(spark, d):
    return rounded(typed(P.cohort_movement(event_rows(spark, d), "user_id", F.col("day"))))


def mixed_sample(spark, d):
    real = table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"))
    extra = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"))
    return rounded(P.mixed_sample(real, extra, "key", seed=3), 4)


def scale_numeric(spark, d):
    return W.scale_numeric(table(spark, d, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", 0.15)


def lower_ordinal(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return W.lower_ordinal(rows, "o_orderpriority", -0.2, "o_orderkey", seed=11, steps=STEPS)


def downgrade_levels(spark, d):
    rows = table(spark, d, "orders")
    levels = {"1-URGENT": "Very High", "2-HIGH": "High", "3-MEDIUM": "Medium", "5-LOW": "Low"}
    pairs = [F.lit(x) for p in levels.items() for x in p]
    level = F.try_element_at(F.create_map(*pairs), "o_orderpriority")
    return rows.select("o_orderkey", W.downgrade(F.coalesce(level, F.lit("Other"))).alias("level"))


def raise_flag(spark, d):
    return W.raise_flag(order_panel(spark, d).select("o_orderkey", "urgent"), "urgent", 0.15, "o_orderkey", seed=11)


def _risk_rows(spark, d):
    return order_panel(spark, d).select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus", "period")


def risk_label(spark, d):
    rows = _risk_rows(spark, d)
    risk = W.risk_score(
        W.scenario_base("growth"), satisfaction_low=F.col("o_orderpriority") == "5-LOW", overtime=F.col("o_orderstatus") == "P",
        income=F.col("o_totalprice") / 20, tenure=F.lit(2001) - F.col("period"),
    )
    return rounded(W.with_risk(rows, risk, "o_orderkey", seed=5).select("o_orderkey", "risk", "drawn_label"))


def scenario_risk(spark, d):
    rows = _risk_rows(spark, d)
    risk = W.risk_score(
        W.scenario_base("Toxic Culture Shift"), satisfaction_low=F.col("o_orderpriority") == "5-LOW", overtime=F.col("o_orderstatus") == "P",
        income=F.col("o_totalprice") / 20, headhunted=F.col("o_orderpriority").substr(1, 1).cast("int") >= W.HEADHUNTED_RATING,
    )
    return rounded(W.with_risk(rows, risk, "o_orderkey", seed=5).select("o_orderkey", "risk", "drawn_label"))


def scenario_overwrites(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_acctbal", F.lit(0).alias("satisfaction"), F.lit(0).alias("hike"), F.lit("").alias("overtime"))
    rows = W.redraw_category(rows, "satisfaction", W.TOXIC_JOB_SATISFACTION, "c_custkey", seed="s")
    rows = W.redraw_category(rows, "overtime", W.RESIGNATION_OVERTIME, "c_custkey", seed="o")
    rows = W.redraw_range(rows, "hike", 0, W.RECESSION_HIKE_BELOW, "c_custkey", seed="h")
    return typed(W.scale_numeric(rows, "c_acctbal", W.RECESSION_INCOME_FACTOR - 1))


def drift_schedule(spark, d):
    panel = order_panel(spark, d).select("o_orderkey", "o_totalprice", "o_orderpriority", "urgent", "period")
    schedule = [None, {"scale": 0.02}, {"scale": 0.02, "downgrade": -0.1}, {"downgrade": -0.15, "flag": 0.1}, {"flag": 0.15}, {"downgrade": -0.2}]
    shifted = W.apply_schedule(panel, F.col("period") - 1995, schedule, key="o_orderkey", numeric="o_totalprice", ordinal="o_orderpriority", flag="urgent", seed="d", steps=STEPS)
    return rounded(shifted, 4)


QUERIES = {
    "retention_sample": retention_sample,
    "retention_sample_by_group": retention_sample_by_group,
    "retention_sample_missing_group": retention_sample_missing_group,
    "retention_sample_repeated_key": retention_sample_repeated_key,
    "age_cohort": age_cohort,
    "period_stamp": period_stamp,
    "next_keys": next_keys,
    "ensure_keys": ensure_keys,
    "keys_in_place": keys_in_place,
    "cohort_movement": cohort_movement,
    "cohort_movement_daily": cohort_movement_daily,
    "cohort_movement_pairs": cohort_movement_pairs,
    "mixed_sample": mixed_sample,
    "scale_numeric": scale_numeric,
    "lower_ordinal": lower_ordinal,
    "downgrade_levels": downgrade_levels,
    "raise_flag": raise_flag,
    "risk_label": risk_label,
    "scenario_risk": scenario_risk,
    "scenario_overwrites": scenario_overwrites,
    "drift_schedule": drift_schedule,
}


def draw(key: str, seed: str) -> str:
    return f"(('0x' || substr(md5({key} || '|{seed}'), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def order_of(key: str, seed: str = "") -> str:
    return f"md5({key} || '|{seed}')"


_DOWN = "CASE o_orderpriority WHEN '1-URGENT' THEN '2-HIGH' WHEN '2-HIGH' THEN '3-MEDIUM' WHEN '3-MEDIUM' THEN '4-NOT SPECIFIED' ELSE '5-LOW' END"


def movement_sql(source: str, entity: str, period: str) -> str:
    return f"""WITH e AS (SELECT DISTINCT {entity} AS e, {period} AS p FROM {source}), i AS (SELECT p, row_number() OVER (ORDER BY p) AS k FROM (SELECT DISTINCT p FROM e)),
        x AS (SELECT e.e, i.k FROM e JOIN i ON i.p = e.p),
        r AS (SELECT i.p AS period, (SELECT count(*) FROM x a JOIN x b ON a.e = b.e AND b.k = a.k - 1 WHERE a.k = i.k) AS retained, (SELECT count(*) FROM x WHERE k = i.k) AS head_count,
          (SELECT count(*) FROM x WHERE k = i.k - 1) AS earlier FROM i WHERE i.k > 1)
        SELECT period, retained, head_count - retained AS joined, earlier - retained AS departed, head_count, round(retained / earlier, 6) AS retention_rate, head_count - earlier AS head_gap FROM r"""


SQL = {
    "retention_sample": f"""WITH a AS (SELECT o_orderkey, row_number() OVER (ORDER BY {order_of("o_orderkey", "7")}, o_orderkey) AS k, count(*) OVER () AS n FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH'))
        SELECT o_orderkey FROM a WHERE k <= floor(n * greatest(0.75::DOUBLE, 0.85::DOUBLE - 0.05::DOUBLE))""",
    "retention_sample_by_group": f"""WITH a AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {order_of("o_orderkey", "7")}, o_orderkey) AS k,
        count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders) SELECT o_orderkey, o_orderstatus FROM a WHERE k <= floor(n * least(0.95::DOUBLE, 0.85::DOUBLE + 0.05::DOUBLE))""",
    "retention_sample_missing_group": f"""WITH o AS (SELECT o_orderkey, nullif(o_orderstatus, 'F') AS status FROM orders),
        a AS (SELECT *, row_number() OVER (PARTITION BY status ORDER BY {order_of("o_orderkey", "7")}, o_orderkey) AS k, count(*) OVER (PARTITION BY status) AS n FROM o)
        SELECT o_orderkey, status FROM a WHERE k <= floor(n * 0.85::DOUBLE)""",
    "retention_sample_repeated_key": "SELECT CAST(floor(count(*) * 0.85::DOUBLE) AS BIGINT) AS n_rows, CAST(floor(count(*) * 0.85::DOUBLE) AS BIGINT) AS n_orders FROM orders",
    "age_cohort": """WITH r AS (SELECT p_partkey, round_even(p_size * 0.37::DOUBLE + 1 / 12, 1) AS tenure, CASE WHEN p_partkey % 3 <> 0 THEN round_even(p_retailprice / 300 - 3 + 1 / 12, 1) END AS ir, p_size + 1 AS age FROM part)
        SELECT p_partkey, round(tenure, 4) AS tenure, round(CASE WHEN ir IS NULL THEN greatest(tenure, 0) ELSE greatest(least(ir, tenure), 0) END, 4) AS in_role, age::BIGINT AS age FROM r""",
    "period_stamp": "SELECT DISTINCT year(o_orderdate) AS period, CAST(DATE '2024-01-01' + CAST(30 * (year(o_orderdate) - 1995) AS INT) AS DATE) AS stamp FROM orders",
    "next_keys": f"SELECT s_suppkey, (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY {order_of('s_suppkey')}, s_suppkey) AS key FROM supplier",
    "keys_in_place": """SELECT count(*) AS n_rows, count(*) AS n_keys, (SELECT max(o_orderkey) FROM orders) + 1 AS low, (SELECT max(o_orderkey) FROM orders) + count(*) AS high,
        round(sum(l_extendedprice), 2) AS total FROM lineitem""",
    "ensure_keys": f"SELECT c_name, row_number() OVER (ORDER BY {order_of('c_name')}, c_name) AS key FROM customer",
    "cohort_movement": movement_sql("orders", "o_custkey", "year(o_orderdate)"),
    "cohort_movement_pairs": """WITH h AS (SELECT DISTINCT year(o_orderdate) AS p, o_custkey AS e FROM orders), y AS (SELECT DISTINCT p FROM h), pairs AS (SELECT a.p AS earlier, b.p AS later FROM y a JOIN y b ON a.p < b.p),
        s AS (SELECT earlier, later, e, max(CASE WHEN h.p = earlier THEN 1 ELSE 0 END) AS was, max(CASE WHEN h.p = later THEN 1 ELSE 0 END) AS here FROM pairs JOIN h ON h.p IN (earlier, later) GROUP BY 1, 2, 3)
        SELECT earlier, later, count(*) FILTER (was = 1 AND here = 1) AS retained, count(*) FILTER (was = 0) AS joined, count(*) FILTER (here = 0) AS departed, count(*) FILTER (here = 1) AS head_count, count(*) AS together
        FROM s GROUP BY 1, 2""",
    "cohort_movement_daily": movement_sql("events", "user_id", "CAST(ts AS DATE)"),
    "mixed_sample": f"""WITH x AS (SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY {order_of("c_custkey", "3")}, c_custkey) AS k, count(*) OVER () AS n FROM customer)
        SELECT s_suppkey AS key, round(s_acctbal, 4) AS balance, 'real' AS origin FROM supplier
        UNION ALL SELECT c_custkey, round(c_acctbal, 4), 'extra' FROM x WHERE k <= floor(n * least(0.3::DOUBLE, (SELECT count(*) FROM supplier) / 1000.0::DOUBLE))""",
    "scale_numeric": "SELECT c_custkey, CAST(trunc(c_acctbal * (1 + 0.15::DOUBLE)) AS BIGINT) AS c_acctbal FROM customer",
    "lower_ordinal": f"SELECT o_orderkey, CASE WHEN {draw('o_orderkey', '11')} < 0.2::DOUBLE THEN {_DOWN} ELSE o_orderpriority END AS o_orderpriority FROM orders",
    "downgrade_levels": """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'High' WHEN '2-HIGH' THEN 'Medium' WHEN '3-MEDIUM' THEN 'Low' WHEN '5-LOW' THEN 'Low' ELSE 'Other' END AS level FROM orders""",
    "raise_flag": f"SELECT o_orderkey, CASE WHEN {draw('o_orderkey', '11')} < 0.15::DOUBLE OR o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Yes' ELSE 'No' END AS urgent FROM orders",
    "risk_label": f"""WITH r AS (SELECT o_orderkey, least(0.95::DOUBLE, greatest(0, 0.18::DOUBLE + CASE WHEN o_orderpriority = '5-LOW' THEN 0.25::DOUBLE ELSE 0 END + CASE WHEN o_orderstatus = 'P' THEN 0.15::DOUBLE ELSE 0 END
        + CASE WHEN o_totalprice / 20 < 3500 THEN 0.2::DOUBLE ELSE 0 END + CASE WHEN 2001 - year(o_orderdate) < 1 THEN 0.15::DOUBLE ELSE 0 END)) AS risk FROM orders)
        SELECT o_orderkey, round(risk, 6) AS risk, CASE WHEN {draw("o_orderkey", "5")} < risk THEN 'Yes' ELSE 'No' END AS drawn_label FROM r""",
    "scenario_risk": f"""WITH r AS (SELECT o_orderkey, least(0.95::DOUBLE, greatest(0, 0.12::DOUBLE * 3 + CASE WHEN o_orderpriority = '5-LOW' THEN 0.25::DOUBLE ELSE 0 END + CASE WHEN o_orderstatus = 'P' THEN 0.15::DOUBLE ELSE 0 END
        + CASE WHEN o_totalprice / 20 < 3500 THEN 0.2::DOUBLE ELSE 0 END + CASE WHEN substr(o_orderpriority, 1, 1)::INT >= 3 THEN 0.4::DOUBLE ELSE 0 END)) AS risk FROM orders)
        SELECT o_orderkey, round(risk, 6) AS risk, CASE WHEN {draw("o_orderkey", "5")} < risk THEN 'Yes' ELSE 'No' END AS drawn_label FROM r""",
    "scenario_overwrites": f"""SELECT c_custkey, CAST(trunc(c_acctbal * (1 + (0.8::DOUBLE - 1))) AS BIGINT) AS c_acctbal, CASE WHEN {draw("c_custkey", "s")} < 0.6::DOUBLE THEN 1::BIGINT ELSE 2 END AS satisfaction,
        CAST(floor({draw("c_custkey", "h")} * 5) AS BIGINT) AS hike, CASE WHEN {draw("c_custkey", "o")} < 0.8::DOUBLE THEN 'Yes' ELSE 'No' END AS overtime FROM customer""",
    "drift_schedule": f"""WITH o AS (SELECT *, year(o_orderdate) AS period, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Yes' ELSE 'No' END AS urgent,
          CASE year(o_orderdate) WHEN 1997 THEN 0.1::DOUBLE WHEN 1998 THEN 0.15::DOUBLE WHEN 2000 THEN 0.2::DOUBLE ELSE 0 END AS down, CASE year(o_orderdate) WHEN 1998 THEN 0.1::DOUBLE WHEN 1999 THEN 0.15::DOUBLE ELSE 0 END AS up FROM orders)
        SELECT o_orderkey, round(CASE WHEN period IN (1996, 1997) THEN trunc(o_totalprice * (1 + 0.02::DOUBLE)) ELSE o_totalprice END, 4) AS o_totalprice,
        CASE WHEN {draw("o_orderkey", "dordinal")} < down THEN {_DOWN} ELSE o_orderpriority END AS o_orderpriority, CASE WHEN {draw("o_orderkey", "dflag")} < up THEN 'Yes' ELSE urgent END AS urgent, period FROM o""",
}
