"""Monitoring queries: batch twins checked by SQL, and the same functions run as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossgrid.operators.windows import day_over_day, share_of_total
from lossgrid.plans.provisioning import process_portfolio
from lossgrid.plans.q_stress import with_currency
from lossgrid.plans.registry import SQL_ONLY, query
from lossgrid.sources.schemas import LOAN_DDL
from lossgrid.sources.scratch import fresh_path
from lossgrid.streaming import runs as S
from lossgrid.streaming import telemetry as T

SQL_ONLY["timed"] = """
SELECT t.*, time_bucket(INTERVAL '5 minutes', ts) AS w5, time_bucket(INTERVAL '1 hour', ts) AS wh, e.user_id
FROM {telemetry} t JOIN (SELECT event_id, user_id FROM {events}) e USING (event_id)
"""


def _events(t):
    return T.as_telemetry(t.events)


def _rate_sql(w: str, keys: str) -> str:
    return f"""SELECT {w} AS window_start, {keys}, count(*) AS completions, 100.0E0*count(*) FILTER (status='success')/count(*) AS success_rate
       FROM {{timed}} GROUP BY ALL""".replace("GROUP BY ALL", f"GROUP BY {w}, {keys}")


@query("success_rate_5m", _rate_sql("w5", "agent"), ratio="success_rate")
def _(t):
    return T.flat(T.success_rate(_events(t), ["agent"]))


@query(
    "success_rate_total",
    """SELECT w5 AS window_start, count(*) AS completions, 100.0E0*count(*) FILTER (status='success')/count(*) AS success_rate
       FROM {timed} GROUP BY w5""",
    ratio="success_rate",
)
def _(t):
    return T.flat(T.success_rate(_events(t), []))


@query("success_rate_by_task", _rate_sql("wh", "task_id"), ratio="success_rate")
def _(t):
    return T.flat(T.success_rate(_events(t), ["task_id"], "1 hour"))


@query(
    "duration_avg",
    "SELECT w5 AS window_start, agent, avg(duration_seconds) AS avg_duration, count(*) AS n FROM {timed} GROUP BY w5, agent",
    ratio="avg_duration",
)
def _(t):
    return T.flat(T.duration_avg(_events(t), ["agent"]))


@query(
    "duration_p95_p99",
    """SELECT wh AS window_start, quantile_cont(duration_seconds, 0.95) AS p95, quantile_cont(duration_seconds, 0.99) AS p99, count(*) AS n
       FROM {timed} GROUP BY wh""",
    ratio="p95 p99",
)
def _(t):
    return T.duration_quantiles(_events(t), "1 hour")


def _error_sql(keys: str) -> str:
    return f"""SELECT w5 AS window_start, {keys}, count(*)/300.0E0 AS error_rate, count(*) FILTER (severity='critical')/300.0E0 AS critical_rate
       FROM {{timed}} WHERE status='failed' GROUP BY w5, {keys}"""


@query("error_rate", _error_sql("agent"), ratio="error_rate critical_rate")
def _(t):
    return T.flat(T.error_rate(_events(t), ["agent"]))


@query("error_rate_by_severity", _error_sql("severity"), ratio="error_rate critical_rate")
def _(t):
    return T.flat(T.error_rate(_events(t), ["severity"]))


SQL_ONLY["islands"] = """
SELECT agent, min(wh) AS pending_since, max(wh) AS last_window, count(*) AS windows
FROM (SELECT agent, wh, CAST(epoch(wh) AS BIGINT)//3600 - row_number() OVER (PARTITION BY agent ORDER BY wh) AS island
      FROM (SELECT DISTINCT agent, wh FROM {timed} WHERE status='failed') d) q GROUP BY agent, island
"""


@query("error_rate_sustained", "SELECT agent, pending_since, last_window, windows FROM {islands} WHERE windows>=2")
def _(t):
    rates = T.flat(T.error_rate(_events(t), ["agent"], "1 hour", 3600.0))
    return T.sustained(rates, "agent", 0.0, 3600, 2)


@query(
    "throughput",
    """SELECT time_bucket(INTERVAL '1 minute', ts) - CAST(k AS INT) * INTERVAL '1 minute' AS window_start, agent, CAST(sum(records_processed) AS BIGINT) AS records,
         sum(records_processed)/300.0E0 AS records_per_second FROM {timed}, (VALUES (0),(1),(2),(3),(4)) o(k) GROUP BY 1, 2""",
    ratio="records_per_second",
)
def _(t):
    return T.flat(T.throughput(_events(t), "5 minutes", "1 minute", 300.0))


@query(
    "throughput_1m",
    """SELECT time_bucket(INTERVAL '1 minute', ts) AS window_start, agent, CAST(sum(records_processed) AS BIGINT) AS records,
         sum(records_processed)/60.0E0 AS records_per_second FROM {timed} GROUP BY 1, 2""",
    ratio="records_per_second",
)
def _(t):
    return T.flat(T.throughput(_events(t), "1 minute", None, 60.0))


def _trend_sql(minutes: int) -> str:
    """Windows of ``minutes`` that begin every half window."""
    slide = f"INTERVAL '{minutes // 2} minutes'"
    return f"""SELECT window_start, CASE WHEN count(*)>=2 THEN {minutes * 60}.0E0*regr_slope(duration_seconds, x) END AS trend, count(*) AS n FROM (
         SELECT duration_seconds, window_start, (epoch_us(ts) - epoch_us(window_start))/1e6 AS x FROM (
           SELECT duration_seconds, ts, time_bucket({slide}, ts) - CAST(k AS INT)*{slide} AS window_start FROM {{timed}}, (VALUES (0),(1)) o(k)) a) b
       GROUP BY window_start"""


def _trend(minutes: int):
    return lambda t: T.flat(T.trend_slope(_events(t), f"{minutes} minutes", f"{minutes // 2} minutes", minutes * 60.0))


query("trend_slope", _trend_sql(60), ratio="trend")(_trend(60))
query("trend_slope_30m", _trend_sql(30), money="trend")(_trend(30))
query("trend_slope_10m", _trend_sql(10), money="trend")(_trend(10))


@query(
    "offset_change",
    """WITH w AS (SELECT wh, sum(duration_seconds) AS total, count(*) AS n FROM {timed} GROUP BY wh)
       SELECT a.wh AS window_start, a.total, a.n, b.total AS previous_total, b.n AS previous_n, 100.0E0*(a.n-b.n)/b.n AS n_change_pct
       FROM w a JOIN w b ON a.wh = b.wh + INTERVAL '1 day'""",
    ratio="total previous_total n_change_pct",
)
def _(t):
    return T.offset_change(_events(t), "1 hour", "1 day")


SLA = 200.0


@query(
    "sla_compliance",
    f"SELECT task_id, count(*) AS n, 100.0E0*count(*) FILTER (duration_seconds<={SLA})/count(*) AS compliance, count(*) FILTER (duration_seconds>{SLA}) AS breaches FROM {{timed}} GROUP BY task_id",
    ratio="compliance",
)
def _(t):
    return T.sla_compliance(_events(t), SLA, ["task_id"])


@query(
    "sla_compliance_total",
    f"SELECT count(*) AS n, 100.0E0*count(*) FILTER (duration_seconds<={SLA})/count(*) AS compliance, count(*) FILTER (duration_seconds>{SLA}) AS breaches FROM {{timed}}",
    ratio="compliance",
)
def _(t):
    return T.sla_compliance(_events(t), SLA)


@query(
    "sla_breaches_1h",
    "SELECT wh AS window_start, task_id, count(*) FILTER (duration_seconds>9000) AS breaches, (9000-max(duration_seconds))/60.0E0 AS minutes_to_breach FROM {timed} GROUP BY wh, task_id",
    ratio="minutes_to_breach",
)
def _(t):
    return T.flat(T.sla_breaches(_events(t), 9000.0))


@query(
    "ecl_by_currency",
    """SELECT CASE CAST(substr(loan_id,2) AS BIGINT)%5 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' WHEN 2 THEN 'GBP' WHEN 3 THEN 'CAD' ELSE 'AUD' END AS currency,
         sum(calculated_ecl) AS total_ecl, 100.0E0*sum(calculated_ecl)/sum(calculated_ead) AS coverage FROM {results} GROUP BY 1""",
    money="total_ecl",
    ratio="coverage",
)
def _(t):
    from lossgrid.functions.expr import pct

    return with_currency(t.results).groupBy("currency").agg(
        F.sum("calculated_ecl").alias("total_ecl"), pct(F.sum("calculated_ecl"), F.sum("calculated_ead")).alias("coverage")
    )


@query(
    "stage_share_live",
    "SELECT calculated_stage, count(*) AS n, count(*)/sum(count(*)) OVER () AS share, 100.0E0*count(*)/sum(count(*)) OVER () AS percent FROM {results} GROUP BY 1",
    ratio="share percent",
)
def _(t):
    return share_of_total(t.results, "calculated_stage")


def _alert_sql() -> str:
    metrics = """SELECT wh, 100.0E0*count(*) FILTER (status='success')/count(*) AS success_rate, count(*) FILTER (status='failed')/3600.0E0 AS error_rate,
      count(*) FILTER (severity='critical')/3600.0E0 AS critical_rate, max(duration_seconds) AS max_duration, sum(records_processed)/3600.0E0 AS records_per_second FROM {timed} GROUP BY wh"""
    return " UNION ALL ".join(
        f"SELECT wh AS window_start, '{a}' AS alert, '{s}' AS severity, CAST({m} AS DOUBLE) AS observed, CAST({v} AS DOUBLE) AS threshold FROM ({metrics}) q{i} WHERE {m}{op}{v}"
        for i, (a, m, op, v, s) in enumerate(T.ALERT_RULES)
    )


@query("threshold_alerts", _alert_sql(), ratio="observed threshold")
def _(t):
    return T.flat(T.threshold_alerts(_events(t)))


def _held_sql() -> str:
    metrics = """SELECT w5, 100.0E0*count(*) FILTER (records_processed IS NOT NULL AND duration_seconds>=0 AND task_id IS NOT NULL)/count(*) AS data_quality,
      max(duration_seconds) AS max_duration, count(*) FILTER (status='failed')/300.0E0 AS error_rate, sum(records_processed)/300.0E0 AS records_per_second,
      count(records_processed)/CAST(count(*) AS DOUBLE) AS audit_share FROM {timed} GROUP BY w5"""
    broken = " UNION ALL ".join(
        f"SELECT w5, '{a}' AS alert, '{s}' AS severity, CAST({m} AS DOUBLE) AS observed, CAST({v} AS DOUBLE) AS threshold, {hold} AS hold FROM m WHERE {m}{op}{v}"
        for a, m, op, v, hold, s in T.HELD_RULES
    )
    return f"""WITH m AS ({metrics}), b AS ({broken}),
      r AS (SELECT *, epoch(w5) - 300*row_number() OVER (PARTITION BY alert ORDER BY w5) AS run FROM b),
      p AS (SELECT *, min(w5) OVER (PARTITION BY alert, run) AS pending_since FROM r)
      SELECT w5 AS window_start, alert, severity, observed, threshold, pending_since FROM p WHERE w5 >= pending_since + hold * INTERVAL '1 minute'"""


@query("held_alerts", _held_sql(), ratio="observed threshold")
def _(t):
    return T.held_alerts(_events(t))


def _daily_sql() -> str:
    metrics = """SELECT coalesce(a.day, c.day) AS day, abs(100.0E0*(a.ecl-b.ecl)/b.ecl) AS ecl_change_pct, abs(a.s2-b.s2) AS stage2_change_pts,
        abs(100.0E0*(a.volume-b.volume)/b.volume) AS volume_change_pct, c.accuracy
      FROM d a JOIN d b ON a.day = b.day + CAST(1 AS INT) FULL JOIN c ON a.day = c.day"""
    fired = " UNION ALL ".join(
        f"SELECT day, '{a}' AS alert, '{s}' AS severity, CAST({m} AS DOUBLE) AS observed, CAST({v} AS DOUBLE) AS threshold FROM m WHERE {m}{op}{v}"
        for a, m, op, v, s in T.DAILY_RULES
    )
    return f"""WITH d AS (SELECT origination_date AS day, sum(calculated_ecl) AS ecl, count(*) AS volume,
        100.0E0*count(*) FILTER (calculated_stage='STAGE_2')/count(*) AS s2 FROM {{results}} GROUP BY 1),
      c AS (SELECT origination_date AS day, 100.0E0*count(*) FILTER (predicted_stage=original_stage)/count(*) AS accuracy
        FROM {{predictions}} JOIN {{results}} USING (loan_id) GROUP BY 1),
      m AS ({metrics}) {fired}"""


@query("daily_alerts", _daily_sql(), ratio="observed threshold")
def _(t):
    return T.daily_alerts(day_over_day(t.results), T.daily_accuracy(t.predictions, t.results))


@query(
    "latency_p95_alert",
    "SELECT window_start, p95, 'medium' AS severity FROM (SELECT wh AS window_start, quantile_cont(duration_seconds, 0.95) AS p95 FROM {timed} GROUP BY wh) q WHERE p95>30",
    ratio="p95",
)
def _(t):
    return T.latency_alerts(T.duration_quantiles(_events(t), "1 hour"), 30.0)


@query(
    "compliance_ratios",
    """SELECT agent, 100.0E0*count(records_processed)/count(*) AS audit_completeness, 100.0E0*count(*) FILTER (severity<>'critical')/count(*) AS lineage_coverage,
         100.0E0*count(*) FILTER (status='success')/count(*) AS pass_rate FROM {timed} GROUP BY agent""",
    ratio="audit_completeness lineage_coverage pass_rate",
)
def _(t):
    return T.compliance_ratios(_events(t))


@query(
    "cost_per_record",
    "SELECT agent, 100.0E0*sum(duration_seconds)/sum(records_processed) AS cost_per_record FROM {timed} GROUP BY agent",
    ratio="cost_per_record",
)
def _(t):
    return T.cost_ratios(_events(t)).select("agent", "cost_per_record")


@query(
    "records_per_mb",
    "SELECT agent, sum(records_processed)/sum(duration_seconds) AS records_per_mb FROM {timed} GROUP BY agent",
    ratio="records_per_mb",
)
def _(t):
    return T.cost_ratios(_events(t)).select("agent", "records_per_mb")


@query(
    "telemetry_summary",
    """SELECT count(*) AS total_queries, count(*) FILTER (status='success') AS successful_queries, count(*) FILTER (status='failed') AS failed_queries,
         coalesce(avg(duration_seconds) FILTER (duration_seconds>0), 0) AS avg_duration_seconds, coalesce(max(duration_seconds) FILTER (duration_seconds>0), 0) AS max_duration_seconds,
         coalesce(avg(records_processed/duration_seconds) FILTER (duration_seconds>0 AND records_processed>0), 0) AS avg_throughput,
         CAST(coalesce(sum(records_processed), 0) AS BIGINT) AS total_records, 100.0E0*count(*) FILTER (severity='critical')/count(*) AS critical_pct,
         100.0E0*count(*) FILTER (severity='warning')/count(*) AS warning_pct, min(duration_seconds) AS min_duration_seconds, count(DISTINCT task_id) AS task_kinds
       FROM {timed} WHERE ts > (SELECT max(ts) FROM {timed}) - INTERVAL '1 hour'""",
    ratio="avg_duration_seconds max_duration_seconds avg_throughput critical_pct warning_pct min_duration_seconds",
)
def _(t):
    return T.telemetry_summary(_events(t))


def _increase_sql(w: str) -> str:
    return f"""SELECT agent, {w} AS window_start, CAST(coalesce(sum(CASE WHEN v<p THEN v ELSE v-p END), 0) AS BIGINT) AS increase, count(*) AS samples
       FROM (SELECT agent, {w}, CAST(records_processed AS BIGINT) AS v, lag(CAST(records_processed AS BIGINT)) OVER (PARTITION BY agent, {w} ORDER BY ts, event_id) AS p FROM {{timed}}) q
       GROUP BY agent, {w}"""


@query("counter_increase_1h", _increase_sql("wh"))
def _(t):
    return T.counter_increase(_events(t))


@query("counter_increase_5m", _increase_sql("w5"))
def _(t):
    return T.counter_increase(_events(t), "5 minutes")


SQL_ONLY["sessions"] = """
SELECT user_id, sn AS session_no, min(ts) AS session_start, max(ts) AS last_event, count(*) AS n
FROM (SELECT *, CAST(sum(CASE WHEN p IS NULL OR ts - p >= INTERVAL '30 minutes' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS sn
      FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM {timed}) a) b GROUP BY user_id, sn
"""


@query("sessions_by_gap", "SELECT user_id, session_no, session_start, last_event, n FROM {sessions}")
def _(t):
    return T.sessions_by_gap(_events(t))


# -- the same functions as streams -------------------------------------------


#: How late an event may come before its window's state is dropped.
LATENESS = "10 minutes"


def _stream(t):
    return T.as_telemetry(S.event_stream(t.spark, t.sf_dir))


@query("stream_tumbling", _rate_sql("w5", "agent"), ratio="success_rate")
def _(t):
    stream = _stream(t).withWatermark("event_time", LATENESS)
    return T.flat(S.run_available(T.success_rate(stream, ["agent"]), "tumbling", "update", keys=["window", "agent"]))


@query(
    "stream_sliding",
    """SELECT time_bucket(INTERVAL '30 minutes', ts) - CAST(k AS INT) * INTERVAL '30 minutes' AS window_start, agent, CAST(sum(records_processed) AS BIGINT) AS records,
         sum(records_processed)/3600.0E0 AS records_per_second FROM {timed}, (VALUES (0),(1)) o(k) GROUP BY 1, 2""",
    ratio="records_per_second",
)
def _(t):
    stream = _stream(t).withWatermark("event_time", LATENESS)
    sliding = T.throughput(stream, "1 hour", "30 minutes", 3600.0)
    return T.flat(S.run_available(sliding, "sliding", "update", keys=["window", "agent"]))


@query(
    "stream_session",
    "SELECT user_id, session_start, last_event + INTERVAL '30 minutes' AS session_end, n FROM {sessions}",
)
def _(t):
    stream = _stream(t).withWatermark("event_time", "1 hour")
    done = S.run_available(T.session_windows(stream), "sessions", "complete", S.LOCAL_SESSION_MERGE)
    return done.select(
        "user_id",
        F.col("window.start").cast("timestamp_ntz").alias("session_start"),
        F.col("window.end").cast("timestamp_ntz").alias("session_end"),
        "n",
    )


@query(
    "stream_closed_windows",
    """SELECT w5 AS window_start, agent, count(*) AS completions, 100.0E0*count(*) FILTER (status='success')/count(*) AS success_rate FROM {timed}
       GROUP BY w5, agent HAVING w5 + INTERVAL '5 minutes' <= (SELECT max(ts) FROM {timed}) - INTERVAL '10 minutes'""",
    ratio="success_rate",
)
def _(t):
    stream = _stream(t).withWatermark("event_time", "10 minutes")
    return T.flat(S.run_available(T.success_rate(stream, ["agent"]), "closed", "append"))


SQL_ONLY["closed_sessions"] = """
SELECT user_id, session_start, last_event + INTERVAL '30 minutes' AS session_end, n FROM {sessions}
WHERE last_event + INTERVAL '30 minutes' <= (SELECT date_trunc('milliseconds', max(ts)) FROM {timed}) - INTERVAL '1 hour'
"""


@query("stream_closed_sessions", "SELECT user_id, session_start, session_end, n FROM {closed_sessions}")
def _(t):
    stream = _stream(t).withWatermark("event_time", "1 hour")
    done = S.run_available(T.session_windows(stream), "closed-sessions", "append", S.LOCAL_SESSION_MERGE)
    bounds = {f"session_{b}": F.col(f"window.{b}").cast("timestamp_ntz") for b in ("start", "end")}
    return done.withColumns(bounds).select("user_id", "session_start", "session_end", "n")


@query(
    "stream_offset_change",
    """WITH w AS (SELECT wh, sum(duration_seconds) AS total, count(*) AS n FROM {timed} GROUP BY wh)
       SELECT a.wh AS window_start, a.total, a.n, b.total AS previous_total, b.n AS previous_n, 100.0E0*(a.n-b.n)/b.n AS n_change_pct
       FROM w a JOIN w b ON a.wh = b.wh + INTERVAL '1 day'
       WHERE a.wh + INTERVAL '1 hour' <= (SELECT date_trunc('milliseconds', max(ts)) FROM {timed}) - INTERVAL '10 minutes'""",
    ratio="total previous_total n_change_pct",
)
def _(t):
    return S.run_available(T.offset_change_stream(_stream(t), _stream(t), "1 hour", "1 day", LATENESS), "offset", "append")


@query(
    "stream_duration_quantiles",
    "SELECT wh AS window_start, count(duration_seconds) AS n, true AS p95_in_rank, true AS p99_in_rank FROM {timed} GROUP BY wh",
)
def _(t):
    stream = _stream(t).withWatermark("event_time", LATENESS)
    sketches = S.run_available(T.duration_sketches(stream), "sketches", "update", keys=["window"])
    return T.quantiles_in_rank(T.merged_quantiles(sketches, "1 hour"), _events(t), "1 hour")


#: The events in so many arrivals by their time; copies come one arrival later, held back rows two.
ARRIVALS, ARRIVAL_DELAY = 6, "2 days"

SQL_ONLY["arrived"] = f"""
WITH s AS (SELECT event_id, ts, least({ARRIVALS - 1}, CAST(floor({ARRIVALS} * (epoch_us(ts) - lo) / CAST(hi - lo AS DOUBLE)) AS INT)) AS k
           FROM {{events}}, (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM {{events}}) z),
a AS (SELECT event_id, ts, CASE WHEN event_id % 11 = 0 THEN least(k + 2, {ARRIVALS - 1}) ELSE k END AS arrival FROM s
      UNION ALL SELECT event_id, ts, k + 1 FROM s WHERE event_id % 7 = 0 AND event_id % 11 <> 0 AND k < {ARRIVALS - 1}),
m AS (SELECT arrival, max(max(ts)) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM a GROUP BY arrival)
SELECT a.*, coalesce(ts <= date_trunc('milliseconds', newest) - INTERVAL '2 days', false) AS late FROM a JOIN m USING (arrival)
"""


def _arrivals(t):
    """Every event in the order of its time, some again and some only later."""
    ends = t.events.agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))).alias("lo"), F.max(F.unix_micros(F.col("ts").cast("timestamp"))).alias("hi"))
    lo, hi = (ends.select(c).scalar() for c in ("lo", "hi"))
    part = F.floor((F.unix_micros("event_time") - lo) * ARRIVALS / (hi - lo).cast("double")).cast("int")
    rows = T.with_event_time(t.events).withColumn("k", F.least(F.lit(ARRIVALS - 1), part)).select("event_id", "event_time", "k")
    held = F.col("event_id") % 11 == 0
    when = F.when(held, F.array(F.least(F.col("k") + 2, F.lit(ARRIVALS - 1)))).when(
        (F.col("event_id") % 7 == 0) & (F.col("k") < ARRIVALS - 1), F.array("k", F.col("k") + 1)
    )
    rows = rows.select("event_id", "event_time", F.explode(F.coalesce(when, F.array("k"))).alias("arrival"))
    return [rows.where(F.col("arrival") == k) for k in range(ARRIVALS)]


def _after_arrivals(t):
    return S.run_arrivals(_arrivals(t), lambda rows: S.deduplicated(rows, "event_id", ARRIVAL_DELAY), "late")


@query(
    "stream_late_arrivals",
    "SELECT event_id, min(arrival) AS arrival FROM {arrived} WHERE NOT late GROUP BY event_id",
)
def _(t):
    return _after_arrivals(t)[0].select("event_id", "arrival")


@query(
    "stream_late_dropped",
    """SELECT CAST(r.k AS INT) AS arrival, count(event_id) AS rows_in, count(event_id) FILTER (late) AS dropped_late
       FROM (SELECT unnest([0, 1, 2, 3, 4, 5]) AS k) r LEFT JOIN {arrived} a ON a.arrival = r.k GROUP BY r.k""",
)
def _(t):
    progress = _after_arrivals(t)[1]
    counts = [(k, sum(int(b["numInputRows"]) for b in batches), S.dropped_late(batches)) for k, batches in enumerate(progress)]
    return t.spark.createDataFrame(counts, "arrival int, rows_in long, dropped_late long")


@query("stream_late_dedup", "SELECT event_id, agent, duration_seconds FROM {telemetry}")
def _(t):
    twice = _stream(t).unionByName(_stream(t))
    unique = S.deduplicated(twice, "event_id", "1 hour")
    return S.run_available(unique.select("event_id", "agent", "duration_seconds"), "dedup", "append")


@query(
    "stream_sustained_alerts",
    """SELECT agent, pending_since + INTERVAL '1 hour' AS fired_at, CAST(2 AS BIGINT) AS windows FROM {islands}
       WHERE windows>=2 AND pending_since + INTERVAL '2 hours' <= (SELECT max(ts) FROM {timed} WHERE status='failed') - INTERVAL '10 minutes'""",
)
def _(t):
    alerts = S.sustained_error_alerts(_stream(t), 3600, 1, 2, "10 minutes")
    done = S.run_available(alerts, "alerts", "append", S.ROCKSDB)
    return done.select("agent", F.col("fired_at").cast("timestamp_ntz").alias("fired_at"), "windows")


@query(
    "stream_stage_share",
    "SELECT calculated_stage, count(*) AS n, 100.0E0*count(*)/sum(count(*)) OVER () AS percent FROM {results} GROUP BY 1",
    ratio="percent",
)
def _(t):
    landing = fresh_path(t.spark, "landing")
    t.loans.repartition(8).write.parquet(landing)
    return S.running_shares(landing, t.spark, LOAN_DDL, process_portfolio, "calculated_stage")


@query(
    "stream_portfolio_ingest",
    "SELECT loan_id, calculated_stage, calculated_ecl FROM {results}",
    ratio="calculated_ecl",
)
def _(t):
    landing = fresh_path(t.spark, "landing")
    t.loans.repartition(8).write.parquet(landing)
    process = lambda df: process_portfolio(df).select("loan_id", "calculated_stage", "calculated_ecl")
    return S.ingest_portfolio(landing, t.spark, LOAN_DDL, process)
