"""Drift queries and their independent SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.bindings import (
    CATEGORICAL, NUMERIC, SPLIT_YEAR, event_rows, halves, injected, line_years, order_panel, rounded, scored_lines, table, typed,
)
from tidemark.operators import drift as D
from tidemark.operators.shape import edge_period
from tidemark.plans import report as R
from tidemark.plans import timeline as T
from tidemark.sources.sinks import report_document
from tidemark.sources.tables import new_path


def population_stability(spark, d):
    ref, cur = line_years(spark, d)
    return rounded(D.population_stability(ref, cur, NUMERIC))


def population_stability_shifted(spark, d):
    ref, cur = line_years(spark, d)
    return rounded(D.population_stability(ref, injected(cur), NUMERIC))


def population_stability_unbounded(spark, d):
    """A reference with an infinite value has no bins and so no index."""
    ref, cur = line_years(spark, d)
    ref = ref.withColumn("l_tax", F.when(F.col("l_quantity") == 1, F.lit(float("inf"))).otherwise(F.col("l_tax")))
    return rounded(D.population_stability(ref, cur, NUMERIC))


def two_sample_ks(spark, d):
    ref, cur = line_years(spark, d)
    found = D.numeric_drift(ref, injected(cur), NUMERIC)
    return rounded(found.select("feature", "rows_ref", "rows_cur", "ks_statistic"))


def ks_pvalue(spark, d):
    orders = table(spark, d, "orders")
    ref, cur = halves(orders, "o_orderdate")
    found = D.numeric_drift(ref, cur, ["o_totalprice", "o_custkey"])
    return rounded(found.select("feature", "ks_statistic", "ks_pvalue"), 5)


def ks_pvalue_exact(spark, d):
    """Account balances of each nation's customers against the suppliers': exact p-values, one per nation."""
    suppliers = table(spark, d, "supplier").select(F.col("s_acctbal").alias("balance"))
    customers = table(spark, d, "customer").select(F.col("c_acctbal").alias("balance"), F.col("c_nationkey").cast("bigint").alias("period"))
    found = D.numeric_drift_by_period(suppliers, customers, "period", ["balance"], pvalue="exact")
    return rounded(found.select("period", "feature", "ks_statistic", "ks_pvalue"), 5)


def wasserstein_distance(spark, d):
    events = event_rows(spark, d)
    ref = events.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    cur = events.filter(F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz"))
    found = D.numeric_drift(ref, cur, ["value", "user_id"])
    return rounded(found.select("feature", "wasserstein_distance"), 5)


def numeric_severity(spark, d):
    ref, cur = line_years(spark, d)
    found = D.covariate_shift(ref, injected(cur), numeric=NUMERIC, categorical=[])
    return found.select("feature", "severity", "alert")


def side_moments(spark, d):
    ref, cur = line_years(spark, d)
    found = D.covariate_shift(ref, cur, numeric=NUMERIC, categorical=[])
    return found.select("feature", "mean_reference", "mean_current", "std_reference", "std_current")


def category_change(spark, d):
    ref, cur = line_years(spark, d)
    return rounded(D.categorical_drift(ref, injected(cur), CATEGORICAL))


def category_shares(spark, d):
    ref, cur = line_years(spark, d)
    return rounded(D.category_shares(ref, injected(cur), CATEGORICAL).select(
        "feature", "category", "share_reference", "share_current"
    ))


def category_severity(spark, d):
    ref, cur = line_years(spark, d)
    found = D.covariate_shift(ref, injected(cur), numeric=[], categorical=CATEGORICAL)
    return found.select("feature", "max_proportion_change", "severity", "alert")


def covariate_shift(spark, d):
    ref, cur = line_years(spark, d)
    return D.covariate_shift(ref, cur, numeric=NUMERIC, categorical=CATEGORICAL)


def covariate_shift_injected(spark, d):
    ref, cur = line_years(spark, d)
    return D.covariate_shift(ref, injected(cur), numeric=NUMERIC, categorical=CATEGORICAL)


def concept_drift(spark, d):
    lines = scored_lines(spark, d)
    ref, cur = lines.filter(F.col("period") < SPLIT_YEAR), lines.filter(F.col("period") >= SPLIT_YEAR)
    return R.concept_drift(ref, cur, "label", "score", "prediction")


def drift_summary(spark, d):
    ref, cur = line_years(spark, d)
    cur = injected(cur)
    found = D.covariate_shift(ref, cur, numeric=NUMERIC, categorical=CATEGORICAL)
    return typed(R.drift_summary(found, ref, cur))


def top_drifted(spark, d):
    ref, cur = line_years(spark, d)
    return D.top_drifted(D.covariate_shift(ref, injected(cur), numeric=NUMERIC, categorical=CATEGORICAL), 3)


def first_last_drift(spark, d):
    panel = order_panel(spark, d).select("period", "o_totalprice", "o_orderstatus", "o_orderpriority")
    return R.first_last_drift(panel, "period")


def _yearly_lines(spark, d):
    """Lines of 1995 as reference; later ones with dearer and more returned lines from 1999 on."""
    lines = table(spark, d, "lineitem").withColumn("period", F.year("l_shipdate").cast("bigint"))
    ref = lines.filter(F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
    cur = lines.filter(F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
    late = F.col("period") >= 1999
    return ref, cur.withColumns({
        "l_extendedprice": F.when(late, F.col("l_extendedprice") * 1.5).otherwise(F.col("l_extendedprice")),
        "l_returnflag": F.when(late & (F.col("l_quantity") > 15), "R").otherwise(F.col("l_returnflag")),
    })


def drift_timeline(spark, d):
    ref, cur = _yearly_lines(spark, d)
    return typed(R.drift_timeline(ref, cur, "period", numeric=NUMERIC, categorical=CATEGORICAL))


def _yearly_scores(spark, d):
    """Scored lines whose score says nothing any more from 1999 on."""
    lines = table(spark, d, "lineitem").withColumn("period", F.year("l_shipdate").cast("bigint"))
    good = F.col("l_quantity") / 50 + F.when(F.col("l_returnflag") == "R", 0.2).otherwise(0.0)
    score = F.when(F.col("period") >= 1999, F.col("l_discount") * 10).otherwise(good)
    scored = lines.select("period", F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"), score.alias("score"))
    return scored.withColumn("prediction", (F.col("score") >= 0.6).cast("int"))


def drift_timeline_grown(spark, d):
    """The timeline grown from stored counts, one year coming twice, with the metric loss of a model per year."""
    ref, cur = _yearly_lines(spark, d)
    grown = T.DriftTimeline(new_path(spark, "timeline"), "period").start(ref.drop("period"), NUMERIC, CATEGORICAL)
    year = F.col("period")
    grown.add(cur.filter((year == 1997) & (F.col("l_quantity") > 40)))
    for chosen in (year == 1996, year == 1997, year >= 1998):
        grown.add(cur.filter(chosen))
    scored = _yearly_scores(spark, d)
    concept = R.concept_by_period(scored.filter(year < 1996), scored.filter(year >= 1996), "period", "label", "score", "prediction")
    found = grown.status(spark, concept.withColumn("period", year.cast("string")))
    return typed(found.withColumn("period", year.cast("bigint")))


def concept_by_year(spark, d):
    scored = _yearly_scores(spark, d)
    return rounded(R.concept_by_period(scored.filter(F.col("period") < 1996), scored.filter(F.col("period") >= 1996), "period", "label", "score", "prediction"))


def monitor_report(spark, d):
    """Drop ids, normalize, compare, save as JSON and read the saved report back."""
    panel = order_panel(spark, d)
    ref, cur = edge_period(panel, "period"), edge_period(panel, "period", last=True)
    saved, _ = R.monitor(
        ref, cur, new_path(spark, "report"), target="urgent", drop=["period", "o_orderkey", "o_custkey"],
    )
    return saved


def report_text(spark, d):
    """The report as one JSON document."""
    ref, cur = line_years(spark, d)
    found = D.covariate_shift(ref, cur, numeric=NUMERIC, categorical=CATEGORICAL)
    return report_document(found, R.drift_summary(found, ref, cur))


# ---------------------------------------------------------------- SQL

LINES = """
 rows_ AS (SELECT CASE WHEN year(l_shipdate) < 1998 THEN 'r' ELSE 'c' END AS side,
   CAST(l_quantity AS DOUBLE) AS l_quantity, CAST(l_extendedprice AS DOUBLE) AS l_extendedprice,
   CAST(l_discount AS DOUBLE) AS l_discount, CAST(l_tax AS DOUBLE) AS l_tax, l_returnflag, l_linestatus
  FROM lineitem)"""
SHIFTED_LINES = """
 rows_ AS (SELECT CASE WHEN year(l_shipdate) < 1998 THEN 'r' ELSE 'c' END AS side, CAST(l_quantity AS DOUBLE) AS l_quantity,
   CASE WHEN year(l_shipdate) < 1998 THEN l_extendedprice ELSE l_extendedprice * 1.5::DOUBLE END AS l_extendedprice,
   CASE WHEN year(l_shipdate) < 1998 THEN l_discount ELSE l_discount + 0.05::DOUBLE END AS l_discount, l_tax,
   CASE WHEN year(l_shipdate) >= 1998 AND l_quantity > 15 THEN 'R' ELSE l_returnflag END AS l_returnflag, l_linestatus
  FROM lineitem)"""


def long_sql(features: list[str], keys: str = "side") -> str:
    parts = [f"SELECT {keys}, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM rows_ WHERE {f} IS NOT NULL" for f in features]
    return " long_ AS (" + " UNION ALL ".join(parts) + ")"


def text_sql(features: list[str], keys: str = "side") -> str:
    parts = [f"SELECT {keys}, '{f}' AS feature, CAST({f} AS VARCHAR) AS category FROM rows_ WHERE {f} IS NOT NULL" for f in features]
    return " text_ AS (" + " UNION ALL ".join(parts) + ")"


PSI = """
 bounds AS (SELECT feature, CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo,
   CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi FROM long_ WHERE side = 'r' GROUP BY feature),
 sizes AS (SELECT feature, count(*) FILTER (side = 'r') AS nr, count(*) FILTER (side = 'c') AS nc FROM long_ GROUP BY feature),
 spine AS (SELECT feature, lo, hi, unnest(range(0, 10)) AS k FROM bounds),
 hits AS (SELECT s.feature, s.k, count(l.value) FILTER (l.side = 'r') AS r, count(l.value) FILTER (l.side = 'c') AS c
   FROM spine s LEFT JOIN long_ l ON l.feature = s.feature AND l.value >= s.lo + ((s.hi - s.lo) / 10) * s.k
    AND ((s.k < 9 AND l.value < s.lo + ((s.hi - s.lo) / 10) * (s.k + 1)) OR (s.k = 9 AND l.value <= s.hi)) GROUP BY s.feature, s.k),
 psi_ AS (SELECT h.feature, sum(((c + 1e-6) / (nc + 1e-5) - (r + 1e-6) / (nr + 1e-5))
    * ln(((c + 1e-6) / (nc + 1e-5)) / ((r + 1e-6) / (nr + 1e-5)))) AS psi FROM hits h JOIN sizes z ON z.feature = h.feature GROUP BY h.feature)"""
CDF = """
 cells AS (SELECT feature, value, count(*) FILTER (side = 'r') AS r, count(*) FILTER (side = 'c') AS c FROM long_ GROUP BY feature, value),
 cum AS (SELECT feature, value, sum(r) OVER w AS fr, sum(c) OVER w AS fc, sum(r) OVER (PARTITION BY feature) AS nr,
   sum(c) OVER (PARTITION BY feature) AS nc, lead(value) OVER w AS nxt FROM cells WINDOW w AS (PARTITION BY feature ORDER BY value)),
 ks_ AS (SELECT feature, CAST(max(nr) AS BIGINT) AS nr, CAST(max(nc) AS BIGINT) AS nc, max(abs(fr / nr - fc / nc)) AS d,
   coalesce(sum(abs(fr / nr - fc / nc) * (nxt - value)), 0) AS area FROM cum GROUP BY feature),
 spans AS (SELECT feature, max(value) - min(value) AS span FROM long_ WHERE side = 'r' GROUP BY feature),
 lam AS (SELECT k.*, s.span, greatest(1, round_even(k.nr::DOUBLE * k.nc / (k.nr + k.nc), 0)) AS sz FROM ks_ k JOIN spans s ON s.feature = k.feature),
 lams AS (SELECT *, sqrt(sz) * d + 1 / (6 * sqrt(sz)) + (sqrt(sz) * d - 1) / (4 * sz) AS l FROM lam),
 dist AS (SELECT feature, nr, nc, d, CASE WHEN span > 0 THEN area / span ELSE 0 END AS w, CASE WHEN l < 0.2 THEN 1.0::DOUBLE ELSE
   greatest(0, least(1, 2 * list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * k * k * l * l))))) END AS p FROM lams)"""
MOMENTS = """
 moments AS (SELECT feature, avg(value) FILTER (side = 'r') AS mr, avg(value) FILTER (side = 'c') AS mc,
   stddev_samp(value) FILTER (side = 'r') AS sr, stddev_samp(value) FILTER (side = 'c') AS sc FROM long_ GROUP BY feature)"""
SHARES = """
 tally AS (SELECT feature, category, count(*) FILTER (side = 'r') AS r, count(*) FILTER (side = 'c') AS c FROM text_ GROUP BY feature, category),
 shares AS (SELECT feature, category, r, c, sum(r) OVER (PARTITION BY feature) AS nr, sum(c) OVER (PARTITION BY feature) AS nc,
   r / sum(r) OVER (PARTITION BY feature) AS pr, c / sum(c) OVER (PARTITION BY feature) AS pc FROM tally),
 change_ AS (SELECT feature, max(abs(pc - pr)) AS m, CAST(max(nr) AS BIGINT) AS nr, CAST(max(nc) AS BIGINT) AS nc FROM shares GROUP BY feature)"""


def shift_sql(rows: str, numeric: list[str], categorical: list[str]) -> str:
    """CTE list ending in shift_, the drift table."""
    return f"""WITH {rows}, {long_sql(numeric)}, {text_sql(categorical)}, {PSI}, {CDF}, {MOMENTS}, {SHARES},
 numbers AS (SELECT p.feature, 'numeric' AS type, round_even(psi, 4) AS psi, round_even(d, 4) AS ks_statistic, round_even(p, 4) AS ks_pvalue,
   round_even(w, 4) AS wasserstein_distance, NULL::DOUBLE AS max_proportion_change, round_even(mr, 2) AS mean_reference,
   round_even(mc, 2) AS mean_current, round_even(sr, 2) AS std_reference, round_even(sc, 2) AS std_current,
   CASE WHEN (psi >= 0.25 OR p < 0.05) AND psi >= 0.5 THEN 'HIGH' WHEN psi >= 0.25 OR p < 0.05 THEN 'MEDIUM' ELSE 'LOW' END AS severity
  FROM psi_ p JOIN dist d ON d.feature = p.feature JOIN moments m ON m.feature = p.feature),
 texts AS (SELECT feature, 'categorical' AS type, NULL::DOUBLE AS psi, NULL::DOUBLE AS ks_statistic, NULL::DOUBLE AS ks_pvalue,
   NULL::DOUBLE AS wasserstein_distance, round_even(m, 4) AS max_proportion_change, NULL::DOUBLE AS mean_reference, NULL::DOUBLE AS mean_current,
   NULL::DOUBLE AS std_reference, NULL::DOUBLE AS std_current,
   CASE WHEN m > 0.30 THEN 'HIGH' WHEN m > 0.15 THEN 'MEDIUM' ELSE 'LOW' END AS severity FROM change_),
 shift_ AS (SELECT *, severity <> 'LOW' AS alert FROM (SELECT * FROM numbers UNION ALL SELECT * FROM texts))"""


YEARS_OF_ORDERS = """
 rows_ AS (SELECT CASE WHEN year(o_orderdate) = (SELECT min(year(o_orderdate)) FROM orders) THEN 'r' ELSE 'c' END AS side,
   o_totalprice, o_orderstatus, o_orderpriority FROM orders WHERE year(o_orderdate) IN
   ((SELECT min(year(o_orderdate)) FROM orders), (SELECT max(year(o_orderdate)) FROM orders)))"""
SHIFT_COLUMNS = (
    "feature, type, psi, ks_statistic, ks_pvalue, wasserstein_distance, max_proportion_change, "
    "mean_reference, mean_current, std_reference, std_current, severity, alert"
)

SCORED_SQL = """
 scored AS (SELECT year(l_shipdate) AS period, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
   l_quantity / 50 + CASE WHEN l_returnflag = 'R' THEN 0.2::DOUBLE ELSE 0 END AS s,
   CASE WHEN l_quantity / 50 + CASE WHEN l_returnflag = 'R' THEN 0.2::DOUBLE ELSE 0 END >= 0.6 THEN 1 ELSE 0 END AS yhat FROM lineitem)"""


def metrics_sql(source: str, key: str) -> str:
    """CTEs ending in metrics_(key, n, auc, f1, prec, rec, tn, fp, fn, tp) over `source`(key, y, s, yhat)."""
    return f"""
 steps AS (SELECT {key}, s, sum(y) AS pos, sum(1 - y) AS neg FROM {source} GROUP BY {key}, s),
 ranks AS (SELECT {key}, pos, neg, sum(neg) OVER (PARTITION BY {key} ORDER BY s) - neg / 2 AS below FROM steps),
 areas AS (SELECT {key}, CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * below)::DOUBLE / (sum(pos)::DOUBLE * sum(neg)::DOUBLE) END AS auc FROM ranks GROUP BY {key}),
 counts AS (SELECT {key}, count(*) AS n, count(*) FILTER (y = 0 AND yhat = 0) AS tn, count(*) FILTER (y = 0 AND yhat = 1) AS fp,
   count(*) FILTER (y = 1 AND yhat = 0) AS fn, count(*) FILTER (y = 1 AND yhat = 1) AS tp FROM {source} GROUP BY {key}),
 metrics_ AS (SELECT c.*, a.auc, coalesce(tp / nullif(tp + fp, 0), 0)::DOUBLE AS prec, coalesce(tp / nullif(tp + fn, 0), 0)::DOUBLE AS rec,
   coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)::DOUBLE AS f1 FROM counts c JOIN areas a ON a.{key} = c.{key})"""


CONCEPT_SQL = f"""WITH {SCORED_SQL}, two AS (SELECT CASE WHEN period < 1998 THEN 'r' ELSE 'c' END AS side, y, s, yhat FROM scored),
 {metrics_sql("two", "side")},
 pair AS (SELECT r.auc AS ra, r.f1 AS rf, r.prec AS rp, r.rec AS rr, c.auc AS ca, c.f1 AS cf, c.prec AS cp, c.rec AS cr
   FROM metrics_ r JOIN metrics_ c ON r.side = 'r' AND c.side = 'c'),
 loss AS (SELECT *, CASE WHEN ra > 0 THEN (ra - ca) / ra ELSE 0 END AS da, CASE WHEN rf > 0 THEN (rf - cf) / rf ELSE 0 END AS df,
   CASE WHEN rp > 0 THEN (rp - cp) / rp ELSE 0 END AS dp, CASE WHEN rr > 0 THEN (rr - cr) / rr ELSE 0 END AS dr FROM pair),
 worst AS (SELECT *, greatest(da, df, dp, dr) AS m FROM loss)"""

TIMELINE_SQL = f"""WITH src AS (SELECT year(l_shipdate) AS period, l_quantity,
   CASE WHEN year(l_shipdate) >= 1999 THEN l_extendedprice * 1.5::DOUBLE ELSE l_extendedprice END AS l_extendedprice, l_discount, l_tax,
   CASE WHEN year(l_shipdate) >= 1999 AND l_quantity > 15 THEN 'R' ELSE l_returnflag END AS l_returnflag, l_linestatus FROM lineitem),
 later AS (SELECT DISTINCT period FROM src WHERE period > 1995),
 rows_ AS (SELECT 'c' AS side, * FROM src WHERE period > 1995 UNION ALL
   SELECT 'r' AS side, l.period, s.* EXCLUDE (period) FROM src s CROSS JOIN later l WHERE s.period = 1995),
 long_raw AS (SELECT * FROM ({long_sql(NUMERIC, "side, period")[len(" long_ AS ("):-1]})),
 long_ AS (SELECT side, period || '/' || feature AS feature, value FROM long_raw),
 text_raw AS (SELECT * FROM ({text_sql(CATEGORICAL, "side, period")[len(" text_ AS ("):-1]})),
 text_ AS (SELECT side, period || '/' || feature AS feature, category FROM text_raw),
 {PSI}, {CDF}, {SHARES},
 flags AS (SELECT CAST(split_part(p.feature, '/', 1) AS BIGINT) AS period, round_even(psi, 4) AS psi, NULL::DOUBLE AS m, psi >= 0.25 OR p < 0.05 AS alert
   FROM psi_ p JOIN dist d ON d.feature = p.feature
  UNION ALL SELECT CAST(split_part(feature, '/', 1) AS BIGINT), NULL, round_even(m, 4), m > 0.15 FROM change_),
 agg AS (SELECT period, count(*) AS features, count(*) FILTER (alert) AS covariate_alerts, max(psi) AS max_psi, max(m) AS max_share_change FROM flags GROUP BY period)"""


QUERIES = {
    "population_stability": population_stability,
    "population_stability_shifted": population_stability_shifted,
    "population_stability_unbounded": population_stability_unbounded,
    "two_sample_ks": two_sample_ks,
    "ks_pvalue": ks_pvalue,
    "ks_pvalue_exact": ks_pvalue_exact,
    "wasserstein_distance": wasserstein_distance,
    "numeric_severity": numeric_severity,
    "side_moments": side_moments,
    "category_change": category_change,
    "category_shares": category_shares,
    "category_severity": category_severity,
    "covariate_shift": covariate_shift,
    "covariate_shift_injected": covariate_shift_injected,
    "concept_drift": concept_drift,
    "drift_summary": drift_summary,
    "top_drifted": top_drifted,
    "first_last_drift": first_last_drift,
    "drift_timeline": drift_timeline,
    "drift_timeline_grown": drift_timeline_grown,
    "concept_by_year": concept_by_year,
    "monitor_report": monitor_report,
    "report_text": report_text,
}

_YEARLY = f"""scored AS (SELECT *, CASE WHEN s >= 0.6 THEN 1 ELSE 0 END AS yhat FROM (SELECT year(l_shipdate) AS year_, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
   CASE WHEN year(l_shipdate) >= 1999 THEN l_discount * 10 ELSE l_quantity / 50 + CASE WHEN l_returnflag = 'R' THEN 0.2::DOUBLE ELSE 0 END END AS s FROM lineitem)),
 {metrics_sql("scored", "year_")},
 decays AS (SELECT m.year_, greatest({", ".join(f"CASE WHEN o.{n} > 0 THEN (o.{n} - m.{n}) / o.{n} ELSE 0 END" for n in ("auc", "f1", "prec", "rec"))}) AS max_decay
   FROM metrics_ m JOIN metrics_ o ON o.year_ = 1995 AND m.year_ > 1995)"""

SQL = {
    "drift_timeline_grown": f"""{TIMELINE_SQL}, {_YEARLY} SELECT agg.*, max_decay > 0.05 AS concept_alert,
        CASE WHEN covariate_alerts > 5 OR max_decay > 0.05 THEN 'CRITICAL' WHEN covariate_alerts > 0 THEN 'WARNING' ELSE 'STABLE' END AS overall_status,
        covariate_alerts > 5 OR max_decay > 0.05 AS retrain FROM agg JOIN decays ON decays.year_ = agg.period""",
    "concept_by_year": f"""WITH {_YEARLY} SELECT year_ AS period, round(max_decay, 6) AS max_decay, CASE WHEN max_decay > 0.1 THEN 'HIGH' WHEN max_decay > 0.05 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
        max_decay > 0.05 AS alert FROM decays""",
    "population_stability": f"WITH {LINES}, {long_sql(NUMERIC)}, {PSI} SELECT feature, round(psi, 6) AS psi FROM psi_",
    "population_stability_shifted": f"WITH {SHIFTED_LINES}, {long_sql(NUMERIC)}, {PSI} SELECT feature, round(psi, 6) AS psi FROM psi_",
    "population_stability_unbounded": f"WITH {LINES}, {long_sql(NUMERIC)}, {PSI} SELECT feature, CASE WHEN feature <> 'l_tax' THEN round(psi, 6) END AS psi FROM psi_",
    "two_sample_ks": f"WITH {SHIFTED_LINES}, {long_sql(NUMERIC)}, {CDF} SELECT feature, nr AS rows_ref, nc AS rows_cur, round(d, 6) AS ks_statistic FROM dist",
    "ks_pvalue": f"""WITH rows_ AS (SELECT CASE WHEN year(o_orderdate) < 1998 THEN 'r' ELSE 'c' END AS side, o_totalprice, o_custkey FROM orders), {long_sql(["o_totalprice", "o_custkey"])}, {CDF}
        SELECT feature, round(d, 5) AS ks_statistic, round(p, 5) AS ks_pvalue FROM dist""",
    "wasserstein_distance": f"""WITH rows_ AS (SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'r' ELSE 'c' END AS side, value, user_id FROM events),
        {long_sql(["value", "user_id"])}, {CDF} SELECT feature, round(w, 5) AS wasserstein_distance FROM dist""",
    "numeric_severity": f"{shift_sql(SHIFTED_LINES, NUMERIC, CATEGORICAL)} SELECT feature, severity, alert FROM shift_ WHERE type = 'numeric'",
    "side_moments": f"WITH {LINES}, {long_sql(NUMERIC)}, {MOMENTS} SELECT feature, round_even(mr, 2) AS mean_reference, round_even(mc, 2) AS mean_current, round_even(sr, 2) AS std_reference, round_even(sc, 2) AS std_current FROM moments",
    "category_change": f"WITH {SHIFTED_LINES}, {text_sql(CATEGORICAL)}, {SHARES} SELECT feature, round(m, 6) AS max_proportion_change, nr AS rows_ref, nc AS rows_cur FROM change_",
    "category_shares": f"WITH {SHIFTED_LINES}, {text_sql(CATEGORICAL)}, {SHARES} SELECT feature, category, round(pr, 6) AS share_reference, round(pc, 6) AS share_current FROM shares",
    "category_severity": f"{shift_sql(SHIFTED_LINES, NUMERIC, CATEGORICAL)} SELECT feature, max_proportion_change, severity, alert FROM shift_ WHERE type = 'categorical'",
    "covariate_shift": f"{shift_sql(LINES, NUMERIC, CATEGORICAL)} SELECT {SHIFT_COLUMNS} FROM shift_",
    "covariate_shift_injected": f"{shift_sql(SHIFTED_LINES, NUMERIC, CATEGORICAL)} SELECT {SHIFT_COLUMNS} FROM shift_",
    "concept_drift": f"""{CONCEPT_SQL} SELECT round_even(ra, 4) AS roc_auc_reference, round_even(rf, 4) AS f1_score_reference, round_even(rp, 4) AS precision_reference,
        round_even(rr, 4) AS recall_reference, round_even(ca, 4) AS roc_auc_current, round_even(cf, 4) AS f1_score_current, round_even(cp, 4) AS precision_current,
        round_even(cr, 4) AS recall_current, round_even(da * 100, 2) AS decay_roc_auc, round_even(df * 100, 2) AS decay_f1_score, round_even(dp * 100, 2) AS decay_precision,
        round_even(dr * 100, 2) AS decay_recall, round_even(m * 100, 2) AS max_decay,
        CASE WHEN m > 0.10 THEN 'HIGH' WHEN m > 0.05 THEN 'MEDIUM' ELSE 'LOW' END AS severity, m > 0.05 AS alert FROM worst""",
    "drift_summary": f"""{shift_sql(SHIFTED_LINES, NUMERIC, CATEGORICAL)}, one AS (SELECT count(*) AS total_features_monitored, count(*) FILTER (alert) AS covariate_alerts FROM shift_)
        SELECT *, (SELECT count(*) FROM rows_ WHERE side = 'r') AS reference_size, (SELECT count(*) FROM rows_ WHERE side = 'c') AS current_size,
        FALSE AS concept_drift_detected, CASE WHEN covariate_alerts > 5 THEN 'CRITICAL' WHEN covariate_alerts > 0 THEN 'WARNING' ELSE 'STABLE' END AS overall_status FROM one""",
    "top_drifted": f"""{shift_sql(SHIFTED_LINES, NUMERIC, CATEGORICAL)} SELECT feature, coalesce(psi, max_proportion_change) AS drift_score, severity FROM shift_
        ORDER BY drift_score DESC NULLS LAST, feature LIMIT 3""",
    "first_last_drift": f"{shift_sql(YEARS_OF_ORDERS, ['o_totalprice'], ['o_orderstatus', 'o_orderpriority'])} SELECT {SHIFT_COLUMNS} FROM shift_",
    "drift_timeline": f"""{TIMELINE_SQL} SELECT *, FALSE AS concept_alert, CASE WHEN covariate_alerts > 5 THEN 'CRITICAL' WHEN covariate_alerts > 0 THEN 'WARNING' ELSE 'STABLE' END AS overall_status,
        covariate_alerts > 5 AS retrain FROM agg""",
    "monitor_report": f"{shift_sql(YEARS_OF_ORDERS, ['o_totalprice'], ['o_orderstatus', 'o_orderpriority'])} SELECT {SHIFT_COLUMNS} FROM shift_",
}
