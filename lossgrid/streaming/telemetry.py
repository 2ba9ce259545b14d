"""Windowed monitoring.  Every function takes events with an ``event_time`` column and
works on a batch frame and on a stream alike; only :mod:`lossgrid.streaming.runs`
knows about sinks and triggers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossgrid.functions.expr import pct, share
from lossgrid.operators.scale import (
    distributed_lag,
    distributed_running_sums,
    exact_quantiles,
)


def with_event_time(events: DataFrame, column: str = "ts") -> DataFrame:
    """Watermarks need an instant, so the naive source time is read as UTC."""
    return events.withColumn("event_time", F.col(column).cast("timestamp"))


def as_telemetry(events: DataFrame) -> DataFrame:
    """Raw events as task telemetry (agent, task, status, severity, duration, records)."""
    failed = F.col("event_type") == "error"
    return with_event_time(
        events.select(
            "event_id",
            "ts",
            "user_id",
            F.concat(F.lit("agent_"), (F.col("user_id") % 6).cast("string")).alias("agent"),
            F.col("event_type").alias("task_id"),
            F.when(failed, "failed").otherwise("success").alias("status"),
            F.when(failed & (F.col("event_id") % 3 == 0), "critical").when(failed, "warning").otherwise("info").alias("severity"),
            F.col("value").alias("duration_seconds"),
            F.regexp_extract("props", "[0-9]+", 0).cast("int").alias("records_processed"),
        )
    )


def windowed(events: DataFrame, size: str, slide: str | None, keys: Sequence[str], *aggs: Column) -> DataFrame:
    w = F.window("event_time", size, slide) if slide else F.window("event_time", size)
    return events.groupBy(w.alias("window"), *keys).agg(*aggs)


def flat(df: DataFrame) -> DataFrame:
    """Window bounds as plain (zone-free) columns."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), *rest)


# -- rates and durations -----------------------------------------------------


def _failed() -> Column:
    return F.col("status") == "failed"


def success_rate(events: DataFrame, keys: Sequence[str], size: str = "5 minutes") -> DataFrame:
    return windowed(
        events, size, None, keys,
        F.count("*").alias("completions"),
        pct(F.count_if(~_failed()), F.count("*")).alias("success_rate"),
    )


def duration_avg(events: DataFrame, keys: Sequence[str], size: str = "5 minutes") -> DataFrame:
    return windowed(
        events, size, None, keys, F.avg("duration_seconds").alias("avg_duration"), F.count("*").alias("n")
    )


def duration_quantiles(events: DataFrame, size: str, keys: Sequence[str] = (), probs=(0.95, 0.99)) -> DataFrame:
    """Exact p95/p99 per window (batch)."""
    starts = events.select(F.window("event_time", size)["start"].cast("timestamp_ntz").alias("window_start"), *keys, "duration_seconds")
    q = exact_quantiles(starts, ["duration_seconds"], probs, by=["window_start", *keys])
    return q.groupBy("window_start", *keys).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"p{int(round(p * 100))}") for p in probs], F.max("n").alias("n")
    )


#: Size of a quantile sketch, and by how much the rank of what it answers can be off (a share of the rows).
SKETCH_K, SKETCH_ERROR = 1000, 0.01


def duration_sketches(events: DataFrame, size: str = "5 minutes", keys: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """A mergeable quantile sketch of the durations of every window: for streams, whose state it bounds."""
    return windowed(events, size, None, keys, F.kll_sketch_agg_double("duration_seconds", F.lit(k)).alias("sketch"))


def merged_quantiles(sketches: DataFrame, size: str, keys: Sequence[str] = (), probs=(0.95, 0.99), k: int = SKETCH_K) -> DataFrame:
    """Quantiles over longer windows, from the sketches of the short ones inside them."""
    longer = F.window(F.col("window.start"), size).alias("window")
    merged = sketches.groupBy(longer, *keys).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))
    return flat(
        merged.select(
            "window", *keys, F.kll_sketch_get_n_double("sketch").alias("n"),
            *[F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(f"p{int(round(p * 100))}") for p in probs],
        )
    )


def quantiles_in_rank(
    quantiles: DataFrame, events: DataFrame, size: str, probs=(0.95, 0.99), error: float = SKETCH_ERROR
) -> DataFrame:
    """``window_start``, ``n`` and for each quantile whether its true rank is within ``error`` of the one asked for."""
    names = {p: f"p{int(round(p * 100))}" for p in probs}
    starts = events.select(F.window("event_time", size)["start"].cast("timestamp_ntz").alias("window_start"), "duration_seconds")
    both = starts.join(quantiles.select("window_start", *names.values()), "window_start")
    d = F.col("duration_seconds")
    n = F.count("duration_seconds")
    counts = both.groupBy("window_start").agg(
        n.alias("n"),
        *[
            ((F.count_if(d <= F.col(c)) >= (p - error) * n) & (F.count_if(d < F.col(c)) <= (p + error) * n)).alias(f"{c}_in_rank")
            for p, c in names.items()
        ],
    )
    return counts


def error_rate(events: DataFrame, keys: Sequence[str], size: str = "5 minutes", seconds: float = 300.0) -> DataFrame:
    """Failures per second by the keys (agent, severity or none)."""
    return windowed(
        events.where(_failed()), size, None, keys,
        (F.count("*") / seconds).alias("error_rate"),
        (F.count_if(F.col("severity") == "critical") / seconds).alias("critical_rate"),
    )


def sustained(rates: DataFrame, key: str, limit: float, step_seconds: int, runs: int) -> DataFrame:
    """Islands of at least ``runs`` consecutive windows above the limit, per key.

    Works on closed window rows (one per window and key), so the ordered pass is
    over the calendar and not over events.
    """
    from pyspark.sql import Window

    above = rates.where(F.col("error_rate") > limit).withColumn(
        "_i", F.floor(F.unix_timestamp(F.col("window_start").cast("timestamp")) / step_seconds)
    )
    island = F.col("_i") - F.row_number().over(Window.partitionBy(key).orderBy("_i"))
    return (
        above.withColumn("_island", island)
        .groupBy(key, "_island")
        .agg(
            F.min("window_start").alias("pending_since"),
            F.max("window_start").alias("last_window"),
            F.count("*").alias("windows"),
        )
        .where(F.col("windows") >= runs)
        .drop("_island")
    )


def throughput(events: DataFrame, size: str, slide: str | None, seconds: float) -> DataFrame:
    return windowed(
        events, size, slide, ["agent"],
        F.sum(F.col("records_processed").cast("long")).alias("records"),
        (F.sum(F.col("records_processed").cast("long")) / seconds).alias("records_per_second"),
    )


def trend_slope(events: DataFrame, size: str, slide: str, seconds: float) -> DataFrame:
    """Least-squares slope of duration over time, scaled to the window length.

    Time is measured from the window start: large epoch values would cost digits.
    """
    with_window = events.select(F.window("event_time", size, slide).alias("window"), "event_time", "duration_seconds")
    x = (F.unix_micros("event_time") - F.unix_micros(F.col("window.start"))) / 1e6
    return with_window.select("window", x.alias("x"), "duration_seconds").groupBy("window").agg(
        (F.regr_slope("duration_seconds", "x") * seconds).alias("trend"), F.count("*").alias("n")
    )


def offset_change(events: DataFrame, size: str, offset: str) -> DataFrame:
    """Window totals beside the totals one offset earlier (equality join on the shifted start)."""
    now = flat(windowed(events, size, None, [], F.sum("duration_seconds").alias("total"), F.count("*").alias("n")))
    before = now.select(
        (F.col("window_start") + F.expr(f"interval {offset}")).alias("window_start"),
        F.col("total").alias("previous_total"),
        F.col("n").alias("previous_n"),
    )
    change = F.try_divide(F.col("n") - F.col("previous_n"), F.col("previous_n").cast("double")) * 100.0
    return now.join(before, "window_start").withColumn("n_change_pct", change)


def offset_change_stream(events: DataFrame, again: DataFrame, size: str, offset: str, delay: str) -> DataFrame:
    """The same as a join of two streams: closed windows meet the ones that closed an offset earlier.

    Both sides are windowed aggregates under a watermark.  Times are tied by a range as well as by equality, so that a
    window is forgotten once the one it could meet has passed.
    """

    def totals(stream: DataFrame, prefix: str) -> DataFrame:
        rows = stream.withWatermark("event_time", delay)
        sums = windowed(rows, size, None, [], F.sum("duration_seconds").alias("total"), F.count("*").alias("n"))
        # the time of a window carries the watermark on to the join
        return sums.select(
            F.col("window.start").alias(f"{prefix}_start"), F.window_time("window").alias(f"{prefix}_time"),
            F.col("total").alias(f"{prefix}_total"), F.col("n").alias(f"{prefix}_n"),
        )

    back = f"interval {offset}"
    tie = f"now_start = then_start + {back} AND now_time >= then_time + {back} AND now_time <= then_time + {back}"
    both = totals(events, "now").join(totals(again, "then"), F.expr(tie))
    change = F.try_divide(F.col("now_n") - F.col("then_n"), F.col("then_n").cast("double")) * 100.0
    return both.select(
        F.col("now_start").cast("timestamp_ntz").alias("window_start"), F.col("now_total").alias("total"), F.col("now_n").alias("n"),
        F.col("then_total").alias("previous_total"), F.col("then_n").alias("previous_n"), change.alias("n_change_pct"),
    )


# -- service levels and alerts -----------------------------------------------


def sla_compliance(events: DataFrame, limit_seconds: float, keys: Sequence[str] = ()) -> DataFrame:
    met = F.col("duration_seconds") <= limit_seconds
    grouped = events.groupBy(*keys) if keys else events.groupBy()
    return grouped.agg(
        F.count("*").alias("n"), pct(F.count_if(met), F.count("*")).alias("compliance"), F.count_if(~met).alias("breaches")
    )


def sla_breaches(events: DataFrame, limit_seconds: float, size: str = "1 hour") -> DataFrame:
    return windowed(
        events, size, None, ["task_id"],
        F.count_if(F.col("duration_seconds") > limit_seconds).alias("breaches"),
        ((limit_seconds - F.max("duration_seconds")) / 60.0).alias("minutes_to_breach"),
    )


#: alert, metric, comparison, limit, severity
ALERT_RULES = (
    ("success_rate_low", "success_rate", "<", 95.0, "critical"),
    ("error_rate_high", "error_rate", ">", 0.0005, "high"),
    ("critical_errors", "critical_rate", ">", 0.0, "critical"),
    ("processing_time_high", "max_duration", ">", 450.0, "high"),
    ("throughput_low", "records_per_second", "<", 0.05, "medium"),
)


def threshold_alerts(events: DataFrame, rules=ALERT_RULES, size: str = "1 hour", seconds: float = 3600.0) -> DataFrame:
    """Firing alerts per window: the rule table is literal, so one pass evaluates all rules."""
    metrics = windowed(
        events, size, None, [],
        pct(F.count_if(~_failed()), F.count("*")).alias("success_rate"),
        (F.count_if(_failed()) / seconds).alias("error_rate"),
        (F.count_if(F.col("severity") == "critical") / seconds).alias("critical_rate"),
        F.max("duration_seconds").alias("max_duration"),
        (F.sum(F.col("records_processed").cast("long")) / seconds).alias("records_per_second"),
    )
    checks = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(metric) > limit if op == ">" else F.col(metric) < limit,
                    F.struct(
                        F.lit(alert).alias("alert"), F.lit(sev).alias("severity"),
                        F.col(metric).cast("double").alias("observed"), F.lit(float(limit)).alias("threshold"),
                    ),
                )
                for alert, metric, op, limit, sev in rules
            ]
        )
    )
    return metrics.select("window", F.explode(checks).alias("a")).select("window", "a.*")


#: alert, metric, comparison, limit, minutes it has to hold, severity (fixed values)
HELD_RULES = (
    ("data_quality_low", "data_quality", "<", 95.0, 0, "critical"),
    ("processing_time_high", "max_duration", ">", 7200.0, 5, "high"),
    ("processing_window_breach", "max_duration", ">", 9000.0, 0, "critical"),
    ("error_rate_high", "error_rate", ">", 0.1, 10, "high"),
    ("throughput_low", "records_per_second", "<", 100.0, 10, "medium"),
    ("audit_trail_incomplete", "audit_share", "<", 1.0, 0, "critical"),
)

#: alert, metric, limit of a day; the first three are changes against the day before (fixed values)
DAILY_RULES = (
    ("ecl_variation_high", "ecl_change_pct", ">", 10.0, "medium"),
    ("staging_anomaly", "stage2_change_pts", ">", 5.0, "medium"),
    ("volume_anomaly", "volume_change_pct", ">", 20.0, "medium"),
    ("model_accuracy_low", "accuracy", "<", 85.0, "high"),
)


def _breaches(alert: str, metric: str, op: str, limit: float, severity: str, **more: Column) -> Column:
    value = F.col(metric).cast("double")
    return F.when(
        value > limit if op == ">" else value < limit,
        F.struct(
            F.lit(alert).alias("alert"), F.lit(severity).alias("severity"), value.alias("observed"),
            F.lit(float(limit)).alias("threshold"), *[c.alias(name) for name, c in more.items()],
        ),
    )


def _fired(metrics: DataFrame, key: str, checks: Sequence[Column]) -> DataFrame:
    return metrics.select(key, F.explode(F.array_compact(F.array(*checks))).alias("a")).select(key, "a.*")


def held_alerts(events: DataFrame, rules=HELD_RULES, minutes: int = 5) -> DataFrame:
    """Alerts per window that fire once their condition has held for the rule's time, in windows without a gap.

    ``pending_since`` is the first window of the run.  Only windows are sorted, never events.
    """
    seconds, n = minutes * 60.0, F.count("*")
    sound = F.col("records_processed").isNotNull() & (F.col("duration_seconds") >= 0) & F.col("task_id").isNotNull()
    metrics = flat(
        windowed(
            events, f"{minutes} minutes", None, [],
            pct(F.count_if(sound), n).alias("data_quality"),
            F.max("duration_seconds").alias("max_duration"),
            (F.count_if(_failed()) / seconds).alias("error_rate"),
            (F.sum(F.col("records_processed").cast("long")) / seconds).alias("records_per_second"),
            share(F.count("records_processed"), n).alias("audit_share"),
        )
    )
    checks = [_breaches(a, m, op, v, s, hold=F.lit(hold)) for a, m, op, v, hold, s in rules]
    broken = _fired(metrics, "window_start", checks)
    at = F.unix_timestamp(F.col("window_start").cast("timestamp"))
    run = at - F.row_number().over(Window.partitionBy("alert").orderBy("window_start")) * F.lit(minutes * 60)
    since = F.min("window_start").over(Window.partitionBy("alert", "_run"))
    return (
        broken.withColumn("_run", run)
        .withColumn("pending_since", since)
        .where(F.col("window_start") >= F.col("pending_since") + F.make_dt_interval(mins=F.col("hold")))
        .drop("_run", "hold")
    )


def daily_alerts(changes: DataFrame, hits: DataFrame, rules=DAILY_RULES) -> DataFrame:
    """Alerts per day from day-over-day changes and daily model accuracy; changes count in both directions."""
    moves = {c: F.abs(c) for c in ("ecl_change_pct", "stage2_change_pts", "volume_change_pct")}
    metrics = changes.select("day", *moves).withColumns(moves).join(hits.select("day", "accuracy"), "day", "full")
    return _fired(metrics, "day", [_breaches(*rule) for rule in rules])


def daily_accuracy(predictions: DataFrame, results: DataFrame, day: str = "origination_date") -> DataFrame:
    """Share of right predictions per day of the loans they are about."""
    dated = predictions.select("loan_id", "original_stage", "predicted_stage").join(results.select("loan_id", day), "loan_id")
    right = F.count_if(F.col("predicted_stage") == F.col("original_stage"))
    return dated.groupBy(F.col(day).alias("day")).agg(pct(right, F.count("*")).alias("accuracy"))


def latency_alerts(quantiles: DataFrame, limit: float) -> DataFrame:
    return quantiles.where(F.col("p95") > limit).select("window_start", "p95", F.lit("medium").alias("severity"))


def compliance_ratios(events: DataFrame) -> DataFrame:
    """Audit completeness, lineage coverage and pass rate per agent."""
    n = F.count("*")
    return events.groupBy("agent").agg(
        pct(F.count("records_processed"), n).alias("audit_completeness"),
        pct(F.count_if(F.col("severity") != "critical"), n).alias("lineage_coverage"),
        pct(F.count_if(~_failed()), n).alias("pass_rate"),
    )


def cost_ratios(events: DataFrame) -> DataFrame:
    """Cost per record (duration as cost) and records per MB (one MB per duration unit)."""
    cost, records = F.sum("duration_seconds"), F.sum(F.col("records_processed").cast("long"))
    return events.groupBy("agent").agg(
        (F.try_divide(cost, records.cast("double")) * 100.0).alias("cost_per_record"),
        share(records, cost).alias("records_per_mb"),
    )


def telemetry_summary(events: DataFrame, hours: int = 1) -> DataFrame:
    """Statistics of the queries of the last hour before the newest event."""
    newest = events.agg(F.max("event_time").alias("m")).scalar()
    recent = events.where(F.col("event_time") > newest - F.expr(f"interval {hours} hours"))
    d, r, n = F.col("duration_seconds"), F.col("records_processed"), F.count("*")
    return recent.agg(
        n.alias("total_queries"),
        F.count_if(~_failed()).alias("successful_queries"),
        F.count_if(_failed()).alias("failed_queries"),
        F.coalesce(F.avg(F.when(d > 0, d)), F.lit(0.0)).alias("avg_duration_seconds"),
        F.coalesce(F.max(F.when(d > 0, d)), F.lit(0.0)).alias("max_duration_seconds"),
        F.coalesce(F.avg(F.when((d > 0) & (r > 0), r / d)), F.lit(0.0)).alias("avg_throughput"),
        F.coalesce(F.sum(r.cast("long")), F.lit(0)).alias("total_records"),
        pct(F.count_if(F.col("severity") == "critical"), n).alias("critical_pct"),
        pct(F.count_if(F.col("severity") == "warning"), n).alias("warning_pct"),
        F.min("duration_seconds").alias("min_duration_seconds"),
        F.count_distinct("task_id").alias("task_kinds"),
    )


# -- ordered event computations ----------------------------------------------


def counter_increase(events: DataFrame, size: str = "1 hour") -> DataFrame:
    """Growth of a counter per agent and window, with resets counted from zero."""
    base = events.select(
        "agent", "event_id", "event_time", F.col("records_processed").cast("long").alias("value"),
        F.window("event_time", size)["start"].cast("timestamp_ntz").alias("window_start"),
    )
    # a busy agent's window may lie in many slices of the sorted rows
    part, before = ["agent", "window_start"], F.col("before")
    lagged = distributed_lag(base, part, ["event_time", "event_id"], {"before": "value"})
    grown = F.when(F.col("value") < before, F.col("value")).otherwise(F.col("value") - before)
    return lagged.withColumn("grown", grown).groupBy(*part).agg(
        F.coalesce(F.sum("grown"), F.lit(0)).alias("increase"), F.count("*").alias("samples")
    )


def sessions_by_gap(events: DataFrame, gap_seconds: int = 1800) -> DataFrame:
    """Per-user sessions without a per-user task: distributed previous-event and running session number."""
    base = events.select("user_id", "event_id", "event_time")
    lagged = distributed_lag(base, ["user_id"], ["event_time", "event_id"], {"prev_time": "event_time"})
    apart = F.unix_micros("event_time") - F.unix_micros("prev_time") >= gap_seconds * 1_000_000
    opened = lagged.withColumn("_new", F.coalesce(apart, F.lit(True)).cast("long"))
    numbered = distributed_running_sums(opened, ["user_id"], ["event_time", "event_id"], {"n_new": F.col("_new")})
    return (
        numbered.withColumn("session_no", F.col("n_new_before") + F.col("_new"))
        .groupBy("user_id", "session_no")
        .agg(
            F.min("event_time").cast("timestamp_ntz").alias("session_start"),
            F.max("event_time").cast("timestamp_ntz").alias("last_event"),
            F.count("*").alias("n"),
        )
    )


def session_windows(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Built-in session windows, for streams."""
    return events.groupBy(F.session_window("event_time", gap).alias("window"), "user_id").agg(F.count("*").alias("n"))
