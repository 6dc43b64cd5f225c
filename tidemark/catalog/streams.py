"""Streaming queries: file streams over the given tables, run to the end of the data."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from tidemark.catalog.bindings import rounded, table, typed
from tidemark.catalog.models import NUMERIC, banded_customers
from tidemark.operators.drift import numeric_drift_by_period
from tidemark.operators.model import fit_forest
from tidemark.operators.profile import category_distribution
from tidemark.sources.contract import RecordContract
from tidemark.sources.tables import new_path
from tidemark.streaming import decay as Y
from tidemark.streaming import distances as K
from tidemark.streaming import monitor as M
from tidemark.streaming import scoring as S

FIELDS = {
    "c_custkey": T.LongType(), "balance": T.DoubleType(), "n_orders": T.LongType(), "total_price": T.DoubleType(),
    "largest": T.DoubleType(), "nation": T.StringType(), "band": T.StringType(),
}
CUSTOMER_CONTRACT = RecordContract(FIELDS, {"n_orders": 0, "total_price": 0.0, "largest": 0.0, "nation": "Unknown", "band": "o"})
REFERENCE_END = "2024-01-08"


def event_stream(spark, d):
    events = table(spark, d, "events")
    return spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(d)


def reference_events(spark, d):
    return table(spark, d, "events").filter(F.col("ts") < F.lit(REFERENCE_END).cast("timestamp_ntz"))


def finish(query):
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def stream_scoring(spark, d):
    """Customer records arrive as JSON text; good ones are scored and appended."""
    rows = banded_customers(spark, d)
    model = fit_forest(rows, "label", NUMERIC, ["nation", "band"], trees=10, depth=5, tried="all")
    inbox, out, checkpoint = (new_path(spark, n) for n in ("inbox", "scored", "checkpoint"))
    text = F.to_json(F.struct(*FIELDS))
    rows.select(F.when(F.col("c_custkey") % 50 == 0, "{broken").otherwise(text).alias("value")).write.text(inbox)
    records = spark.readStream.schema("value string").text(inbox)
    scored, _ = S.scored_stream(records, "value", CUSTOMER_CONTRACT, model, "c_custkey", NUMERIC, ["nation", "band"])
    finish(S.append_stream(scored, out, checkpoint, available_now=True))
    return typed(spark.read.schema(scored.schema).parquet(out))


def stream_quarantine(spark, d):
    """The same records as a stream of rejects, by reason."""
    inbox, out, checkpoint = (new_path(spark, n) for n in ("inbox", "rejected", "checkpoint"))
    customers = table(spark, d, "customer")
    text = F.to_json(F.struct(F.when(F.col("c_custkey") % 7 != 0, F.col("c_custkey")).alias("c_custkey"), F.col("c_acctbal").alias("balance")))
    customers.select(F.when(F.col("c_custkey") % 50 == 0, "{broken").otherwise(text).alias("value")).write.text(inbox)
    _, bad = CUSTOMER_CONTRACT.split(spark.readStream.schema("value string").text(inbox), "value")
    finish(S.append_stream(bad, out, checkpoint, available_now=True))
    stored = spark.read.schema(bad.schema).parquet(out)
    return stored.groupBy(F.concat_ws(",", "problems").alias("reason")).agg(F.count("*").alias("n"))


def arrivals(spark, d, store, rows):
    """Events arrive in three runs from one checkpoint: the first two weeks, the rest, and at last the delayed ones."""
    inbox, checkpoint, events = new_path(spark, "inbox"), new_path(spark, "checkpoint"), table(spark, d, "events")
    delayed, early = F.col("event_id") % 50 == 0, F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    for part in (~delayed & early, ~delayed & ~early, delayed):
        events.filter(part).write.mode("append").parquet(inbox)
        finish(store.start(rows(spark.readStream.schema(events.schema).parquet(inbox)), checkpoint, available_now=True))
    return store


def _psi_windows(spark, d):
    sketch = M.ReferenceSketch(reference_events(spark, d), ["value", "user_id"])
    return sketch, arrivals(spark, d, M.psi_store(new_path(spark, "psi"), sketch), lambda events: M.binned_events(events, sketch, "ts"))


def stream_psi(spark, d):
    """PSI per day of event values against the first week, the last open days included."""
    sketch, store = _psi_windows(spark, d)
    found = M.judged_windows(store.flushed(spark), sketch)
    return typed(found.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd")))


def stream_late_rows(spark, d):
    """Cells of delayed events whose day had been emitted before they came."""
    late = _psi_windows(spark, d)[1].late(spark)
    return late.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd"))


def stream_distances(spark, d):
    """Sketched KS distances per day against a saved reference, held against the exact ones."""
    path, columns = new_path(spark, "reference"), ["value", "user_id"]
    reference, events = reference_events(spark, d), table(spark, d, "events")
    K.reference_sketches(reference, columns).write.parquet(path)
    store = arrivals(spark, d, K.sketch_store(new_path(spark, "sketches"), lateness="40 days"), lambda e: K.long_events(e, columns, "ts"))
    found = K.sketched_distances(store.flushed(spark), K.read_reference(spark, path)).withColumn("day", F.to_date("window_start"))
    exact = numeric_drift_by_period(reference, events.withColumn("day", F.to_date("ts")), "day", columns)
    both = found.join(exact.select("day", "feature", F.col("ks_statistic").alias("exact"), "rows_cur"), ["day", "feature"])
    within = F.abs(F.col("ks_statistic") - F.col("exact")) <= F.col("ks_bound")
    return both.select(F.date_format("day", "yyyy-MM-dd").alias("window_start"), "feature", "n_rows", F.round("exact", 6).alias("ks_exact"), within.alias("within_bound"))


def stream_decay(spark, d):
    """Metrics per day of scores whose labels come up to eight days later, a week being waited for, and their decay."""
    events, value = table(spark, d, "events"), F.col("value")
    scores = events.select("event_id", "ts", (value / (value + 20)).alias("score"), (value >= 20).cast("int").alias("prediction"))
    labels = events.select("event_id", (value + F.col("event_id") % 7 * 5 + F.dayofmonth("ts") / 3 >= 40).cast("int").alias("label"), (F.col("ts") + F.make_dt_interval(F.expr("event_id % 9"))).alias("known"))
    inboxes = [new_path(spark, n) for n in ("scores", "labels")]
    for df, inbox in zip((scores, labels), inboxes):
        df.write.parquet(inbox)
    streams = [spark.readStream.schema(df.schema).parquet(inbox) for df, inbox in zip((scores, labels), inboxes)]
    met = Y.with_labels(*streams, "event_id", "ts", "known")
    store = Y.metric_store(new_path(spark, "metrics"), "label", "score", "prediction")
    finish(store.start(Y.binned_scores(met, "label", "score", "prediction"), new_path(spark, "checkpoint"), available_now=True))
    found = Y.decay_by_window(Y.window_metrics(store.flushed(spark)))
    return rounded(typed(found.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd"))))


def stream_category_shift(spark, d):
    """Largest share change per day of event types against the first week; closed days only."""
    shares = category_distribution(reference_events(spark, d), ["event_type"])
    out, checkpoint = new_path(spark, "shift"), new_path(spark, "checkpoint")
    finish(M.start_category_monitor(event_stream(spark, d), shares, ["event_type"], "ts", out, checkpoint, available_now=True))
    stored = spark.read.parquet(out)
    return stored.select(F.date_format("window_start", "yyyy-MM-dd").alias("window_start"), "feature", "max_proportion_change", "severity")


QUERIES = {
    "stream_scoring": stream_scoring,
    "stream_quarantine": stream_quarantine,
    "stream_psi": stream_psi,
    "stream_late_rows": stream_late_rows,
    "stream_distances": stream_distances,
    "stream_decay": stream_decay,
    "stream_category_shift": stream_category_shift,
}

_DAYS = "days AS (SELECT *, CAST(ts AS DATE) AS day FROM events), closed AS (SELECT * FROM days WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events))"


#: Delayed events count where their day was still open when they came: the watermark is that of the events before.
_ARRIVED = """days AS (SELECT *, CAST(ts AS DATE) AS day FROM events), w AS (SELECT max(ts) - INTERVAL 1 DAY AS watermark FROM events WHERE event_id % 50 <> 0),
    late AS (SELECT * FROM days WHERE event_id % 50 = 0 AND day + INTERVAL 1 DAY <= (SELECT watermark FROM w)),
    closed AS (SELECT * FROM days WHERE event_id NOT IN (SELECT event_id FROM late))"""
_METRIC_NAMES = ("roc_auc", "f1_score", '"precision"', "recall")


def _exact_ks(column: str) -> str:
    return f"""(WITH r AS (SELECT {column}::DOUBLE AS v FROM events WHERE ts < TIMESTAMP '2024-01-08'), days AS (SELECT CAST(ts AS DATE) AS day, {column}::DOUBLE AS v FROM events),
      k AS (SELECT day, v, sum(a) AS a, sum(b) AS b FROM (SELECT day, v, 1 AS a, 0 AS b FROM days UNION ALL SELECT d.day, r.v, 0, 1 FROM r CROSS JOIN (SELECT DISTINCT day FROM days) d) GROUP BY day, v),
      c AS (SELECT day, sum(a) OVER w / sum(a) OVER (PARTITION BY day) AS fa, sum(b) OVER w / sum(b) OVER (PARTITION BY day) AS fb, a FROM k WINDOW w AS (PARTITION BY day ORDER BY v))
      SELECT day, '{column}' AS feature, CAST(sum(a) AS BIGINT) AS n_rows, max(abs(fa - fb)) AS ks FROM c GROUP BY day)"""


def _psi(column: str) -> str:
    return f"""(WITH ref AS (SELECT {column}::DOUBLE AS v FROM events WHERE ts < TIMESTAMP '2024-01-08'), b AS (SELECT min(v) AS lo, max(v) AS hi, count(*) AS nr FROM ref),
      e AS (SELECT k, lo + ((hi - lo) / 10) * k AS a, CASE WHEN k = 9 THEN hi ELSE lo + ((hi - lo) / 10) * (k + 1) END AS z, nr FROM (SELECT *, unnest(range(0, 10)) AS k FROM b)),
      rc AS (SELECT k, any_value(a) AS a, any_value(z) AS z, any_value(nr) AS nr, count(v) AS r FROM e LEFT JOIN ref ON v >= a AND (v < z OR (k = 9 AND v <= z)) GROUP BY k),
      dn AS (SELECT day, count(*) AS nc FROM closed GROUP BY day),
      cc AS (SELECT dn.day, rc.k, dn.nc, rc.nr, rc.r, count(c.{column}) AS c FROM dn CROSS JOIN rc LEFT JOIN closed c ON c.day = dn.day AND c.{column} >= rc.a AND (c.{column} < rc.z OR (rc.k = 9 AND c.{column} <= rc.z))
        GROUP BY dn.day, rc.k, dn.nc, rc.nr, rc.r)
      SELECT day, '{column}' AS feature, nc AS n_rows, sum(((c + 1e-6) / (nc + 1e-5) - (r + 1e-6) / (nr + 1e-5)) * ln(((c + 1e-6) / (nc + 1e-5)) / ((r + 1e-6) / (nr + 1e-5)))) AS psi FROM cc GROUP BY day, nc)"""


SQL = {
    "stream_scoring": """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 1::BIGINT ELSE 0 END AS prediction,
        CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0::DOUBLE ELSE 0 END AS probability FROM customer WHERE c_custkey % 50 <> 0""",
    "stream_quarantine": """SELECT CASE WHEN c_custkey % 50 = 0 THEN 'not decodable' ELSE 'missing c_custkey' END AS reason, count(*) AS n FROM customer WHERE c_custkey % 50 = 0 OR c_custkey % 7 = 0 GROUP BY 1""",
    "stream_late_rows": f"WITH {_ARRIVED} SELECT strftime(day, '%Y-%m-%d') AS window_start, count(value) + count(user_id) AS n_rows FROM late GROUP BY day",
    "stream_distances": f"""SELECT strftime(day, '%Y-%m-%d') AS window_start, feature, n_rows, round(ks, 6) AS ks_exact, true AS within_bound
        FROM ({_exact_ks("value")} UNION ALL {_exact_ks("user_id")})""",
    "stream_decay": f"""WITH s AS (SELECT CAST(ts AS DATE) AS day, least(floor(value / (value + 20) * 1000), 999) AS bin, value >= 20 AS said, value + event_id % 7 * 5 + extract(day FROM ts) / 3 >= 40 AS truth
          FROM events WHERE event_id % 9 <= 7 AND value / (value + 20) BETWEEN 0 AND 1),
        b AS (SELECT day, bin, count(*) FILTER (truth) AS pos, count(*) FILTER (NOT truth) AS neg, count(*) FILTER (truth AND said) AS tp, count(*) FILTER (NOT truth AND said) AS fp, count(*) FILTER (truth AND NOT said) AS fn FROM s GROUP BY day, bin),
        c AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY day ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM b),
        m AS (SELECT day, CAST(sum(pos) + sum(neg) AS BIGINT) AS n_samples, sum(pos * (below + neg / 2)) / nullif(sum(pos)::DOUBLE * sum(neg), 0) AS roc_auc, coalesce(2 * sum(tp) / nullif(2 * sum(tp) + sum(fp) + sum(fn), 0), 0) AS f1_score,
          coalesce(sum(tp) / nullif(sum(tp) + sum(fp), 0), 0) AS "precision", coalesce(sum(tp) / nullif(sum(tp) + sum(fn), 0), 0) AS recall FROM c GROUP BY day),
        f AS (SELECT m.*, greatest({", ".join(f"CASE WHEN o.{n} > 0 THEN (o.{n} - m.{n}) / o.{n} WHEN o.{n} IS NOT NULL THEN 0 END" for n in _METRIC_NAMES)}) AS max_decay FROM m, (SELECT * FROM m ORDER BY day LIMIT 1) o)
        SELECT strftime(day, '%Y-%m-%d') AS window_start, n_samples, {", ".join(f"round({n}, 6) AS {n}" for n in _METRIC_NAMES)}, round(max_decay, 6) AS max_decay,
          CASE WHEN max_decay > 0.1 THEN 'HIGH' WHEN max_decay > 0.05 THEN 'MEDIUM' ELSE 'LOW' END AS severity, coalesce(max_decay > 0.05, false) AS alert FROM f""",
    "stream_psi": f"""WITH {_ARRIVED}, p AS ({_psi("value")} UNION ALL {_psi("user_id")})
        SELECT strftime(day, '%Y-%m-%d') AS window_start, feature, n_rows, round_even(psi, 4) AS psi, CASE WHEN psi >= 0.5 THEN 'HIGH' WHEN psi >= 0.25 THEN 'MEDIUM' ELSE 'LOW' END AS severity FROM p""",
    "stream_category_shift": f"""WITH {_DAYS}, ref AS (SELECT event_type AS k, count(*) / (SELECT count(*) FROM events WHERE ts < TIMESTAMP '2024-01-08') AS p FROM events WHERE ts < TIMESTAMP '2024-01-08' GROUP BY 1),
        n AS (SELECT day, count(*) AS n FROM closed GROUP BY day), ks AS (SELECT k FROM ref UNION SELECT DISTINCT event_type FROM events),
        s AS (SELECT n.day, ks.k, coalesce(any_value(ref.p), 0) AS p, count(c.event_type) / any_value(n.n) AS q FROM n CROSS JOIN ks LEFT JOIN ref ON ref.k = ks.k LEFT JOIN closed c ON c.day = n.day AND c.event_type = ks.k GROUP BY n.day, ks.k),
        m AS (SELECT day, max(abs(q - p)) AS m FROM s GROUP BY day)
        SELECT strftime(day, '%Y-%m-%d') AS window_start, 'event_type' AS feature, round_even(m, 4) AS max_proportion_change, CASE WHEN m > 0.30 THEN 'HIGH' WHEN m > 0.15 THEN 'MEDIUM' ELSE 'LOW' END AS severity FROM m""",
}
