"""Profile queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.bindings import event_rows, halves, injected, line_years, order_panel, rounded, table, typed
from tidemark.operators import profile as P


def category_distribution(spark, d):
    orders = table(spark, d, "orders")
    return rounded(P.category_distribution(orders, ["o_orderstatus", "o_orderpriority"]))


def mean_change(spark, d):
    ref, cur = line_years(spark, d)
    found = P.mean_change(ref, injected(cur), ["l_extendedprice", "l_discount", "l_quantity", "not_there"])
    return rounded(found, 4)


def compare_columns(spark, d):
    ref, cur = line_years(spark, d)
    return rounded(P.compare_columns(ref, injected(cur), ["l_extendedprice", "l_returnflag", "l_linestatus", "l_quantity"]), 4)


def aligned_distribution(spark, d):
    orders = table(spark, d, "orders")
    ref, cur = halves(orders, "o_orderdate")
    # Each side lacks a category of the other.
    ref = ref.replace("5-LOW", "4-NOT SPECIFIED", ["o_orderpriority"])
    cur = cur.replace("1-URGENT", "2-HIGH", ["o_orderpriority"])
    return rounded(P.aligned_distribution(ref, cur, "o_orderpriority"))


def summary_statistics(spark, d):
    ref, cur = line_years(spark, d)
    return rounded(P.summary_statistics(ref, injected(cur), "l_extendedprice"), 4)


def period_summary(spark, d):
    panel = order_panel(spark, d)
    return typed(P.period_summary(panel, F.col("period"), "o_custkey", "urgent", "o_totalprice", F.col("o_orderpriority") == "5-LOW"))


def entity_continuity(spark, d):
    return rounded(P.entity_continuity(event_rows(spark, d), "user_id", F.col("day")))


def simple_continuity(spark, d):
    return rounded(P.simple_continuity(table(spark, d, "orders"), "o_custkey"))


def label_stability(spark, d):
    events = event_rows(spark, d).withColumn("is_error", (F.col("event_type") == "error").cast("int"))
    return rounded(P.label_stability(events, F.col("day"), "is_error"))


def baseline_deviation(spark, d):
    ref, cur = line_years(spark, d)
    return rounded(P.baseline_deviation(injected(cur), ref, "l_extendedprice"), 4)


def density_curve(spark, d):
    orders = table(spark, d, "orders")
    ref, cur = halves(orders, "o_orderdate")
    found = P.density_curve(ref, cur, "o_totalprice")
    return typed(found.select("side", "point", F.round("x", 2).alias("x"), F.round(F.col("density") * 1e6, 5).alias("density_ppm")))


def distinct_periods(spark, d):
    return P.distinct_periods(event_rows(spark, d), F.col("day"))


QUERIES = {
    "category_distribution": category_distribution,
    "mean_change": mean_change,
    "compare_columns": compare_columns,
    "aligned_distribution": aligned_distribution,
    "summary_statistics": summary_statistics,
    "period_summary": period_summary,
    "entity_continuity": entity_continuity,
    "simple_continuity": simple_continuity,
    "label_stability": label_stability,
    "baseline_deviation": baseline_deviation,
    "density_curve": density_curve,
    "distinct_periods": distinct_periods,
}

_LINES = """WITH r AS (SELECT * FROM lineitem WHERE year(l_shipdate) < 1998),
 c AS (SELECT * REPLACE (l_extendedprice * 1.5::DOUBLE AS l_extendedprice, l_discount + 0.05::DOUBLE AS l_discount,
   CASE WHEN l_quantity > 15 THEN 'R' ELSE l_returnflag END AS l_returnflag) FROM lineitem WHERE year(l_shipdate) >= 1998)"""


def _mean(column: str) -> str:
    return f"""SELECT '{column}' AS feature, (SELECT avg({column}) FROM r) AS a, (SELECT avg({column}) FROM c) AS b"""


def _share(column: str) -> str:
    return f"""SELECT '{column}' AS feature, 'categorical' AS type, coalesce(r.k, c.k) AS category,
     round(coalesce(r.n, 0) / (SELECT count(*) FROM r), 4) AS "old", round(coalesce(c.n, 0) / (SELECT count(*) FROM c), 4) AS "new", NULL::DOUBLE AS drift_pct
     FROM (SELECT {column} AS k, count(*) AS n FROM r GROUP BY 1) r FULL JOIN (SELECT {column} AS k, count(*) AS n FROM c GROUP BY 1) c ON r.k = c.k"""


SQL = {
    "category_distribution": """SELECT feature, category, n, round(n / sum(n) OVER (PARTITION BY feature), 6) AS proportion FROM (
        SELECT 'o_orderstatus' AS feature, o_orderstatus AS category, count(*) AS n FROM orders GROUP BY 2
        UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2)""",
    "mean_change": f"""{_LINES}, m AS ({_mean("l_extendedprice")} UNION ALL {_mean("l_discount")} UNION ALL {_mean("l_quantity")})
        SELECT feature, round(a, 4) AS mean_old, round(b, 4) AS mean_new, round(CASE WHEN a = 0 THEN 0 ELSE (b - a) / a * 100 END, 4) AS drift_pct FROM m
        UNION ALL SELECT 'not_there', NULL, NULL, NULL""",
    "compare_columns": f"""{_LINES}, m AS ({_mean("l_extendedprice")} UNION ALL {_mean("l_quantity")})
        SELECT feature, 'numeric' AS type, NULL AS category, round(a, 4) AS "old", round(b, 4) AS "new", round(CASE WHEN a = 0 THEN 0 ELSE (b - a) / a * 100 END, 4) AS drift_pct FROM m
        UNION ALL {_share("l_returnflag")} UNION ALL {_share("l_linestatus")}""",
    "aligned_distribution": """WITH r AS (SELECT CASE WHEN o_orderpriority = '5-LOW' THEN '4-NOT SPECIFIED' ELSE o_orderpriority END AS k FROM orders WHERE year(o_orderdate) < 1998),
        c AS (SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN '2-HIGH' ELSE o_orderpriority END AS k FROM orders WHERE year(o_orderdate) >= 1998)
        SELECT coalesce(a.k, b.k) AS category, round(a.p, 6) AS base, round(b.p, 6) AS actual FROM
        (SELECT k, count(*) / (SELECT count(*) FROM r) AS p FROM r GROUP BY k) a FULL JOIN (SELECT k, count(*) / (SELECT count(*) FROM c) AS p FROM c GROUP BY k) b ON a.k = b.k""",
    "summary_statistics": f"""{_LINES} SELECT 'old' AS side, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS std, round(min(l_extendedprice), 4) AS min,
        round(median(l_extendedprice), 4) AS median, round(max(l_extendedprice), 4) AS max FROM r UNION ALL
        SELECT 'new', round(avg(l_extendedprice), 4), round(stddev_samp(l_extendedprice), 4), round(min(l_extendedprice), 4), round(median(l_extendedprice), 4), round(max(l_extendedprice), 4) FROM c""",
    "period_summary": """SELECT year(o_orderdate) AS period, count(*) AS n_rows, round_even(avg(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END), 3) AS label_rate,
        round_even(avg(o_totalprice), 3) AS mean_measure, round_even(avg(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END), 3) AS category_share FROM orders GROUP BY 1""",
    "entity_continuity": """WITH t AS (SELECT count(DISTINCT user_id) AS u, count(*) AS n, count(DISTINCT CAST(ts AS DATE)) AS p FROM events),
        s AS (SELECT *, 1 - (u - n / p) / nullif(n - n / p, 0) AS raw FROM t)
        SELECT u AS unique_entities, n AS total_rows, p AS periods, round(greatest(0, least(1, raw)), 6) AS continuity_score, CASE WHEN raw > 0.7 THEN 'HIGH' ELSE 'LOW' END AS interpretation FROM s""",
    "simple_continuity": "SELECT round(1 - count(DISTINCT o_custkey) / count(*), 6) AS continuity FROM orders",
    "label_stability": """WITH p AS (SELECT CAST(ts AS DATE) AS day, avg(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS rate FROM events GROUP BY 1),
        s AS (SELECT avg(rate) AS m, stddev_samp(rate) AS s FROM p)
        SELECT round(m, 6) AS mean, round(s, 6) AS std, round(s / m, 6) AS cv, CASE WHEN s < 0.05 THEN 'STABLE' ELSE 'VOLATILE' END AS interpretation FROM s""",
    "baseline_deviation": f"""{_LINES}, s AS (SELECT avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS s, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi,
        (SELECT avg(l_extendedprice) FROM r) AS base FROM c)
        SELECT round(m, 4) AS mean, round(s, 4) AS std, round(lo, 4) AS min, round(hi, 4) AS max, round(abs(m - base) / base, 4) AS deviation,
        CASE WHEN abs(m - base) / base < 0.1 THEN 'REALISTIC' ELSE 'UNREALISTIC' END AS interpretation FROM s""",
    "density_curve": """WITH rows_ AS (SELECT CASE WHEN year(o_orderdate) < 1998 THEN 'old' ELSE 'new' END AS side, o_totalprice AS v FROM orders),
        s AS (SELECT side, count(*) AS n, min(v) AS lo, max(v) AS hi, pow(count(*), -0.2) * stddev_samp(v) AS w FROM rows_ GROUP BY side),
        g AS (SELECT side, n, w, k, lo - 3 * w + k * (hi - lo + 6 * w) / 199 AS x FROM (SELECT *, unnest(range(0, 200)) AS k FROM s))
        SELECT g.side, g.k AS point, round(any_value(g.x), 2) AS x, round(sum(exp(-0.5 * pow((g.x - r.v) / g.w, 2))) / (any_value(g.w) * sqrt(2 * pi()) * any_value(g.n)) * 1e6, 5) AS density_ppm
        FROM g JOIN rows_ r ON r.side = g.side GROUP BY g.side, g.k""",
    "distinct_periods": "SELECT count(DISTINCT CAST(ts AS DATE)) AS n_periods FROM events",
}
