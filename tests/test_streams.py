"""Streams read the events table as one file or as a folder of part files."""

from conftest import SF
from pyspark.sql import functions as F

from lossgrid.plans.registry import load_all
from lossgrid.sources.tables import Tables
from lossgrid.streaming import telemetry as T


def test_part_files_equal_one_file(spark, tmp_path):
    spark.read.parquet(f"{SF}/events.parquet").repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    query = load_all()["stream_tumbling"]
    parts = query.run(spark, str(tmp_path))
    whole = query.run(spark, SF)
    assert parts.count() > 0
    assert parts.exceptAll(whole).count() == 0 and whole.exceptAll(parts).count() == 0


def test_stream_tables_are_not_shared(spark, tmp_path):
    assert Tables.of(spark, str(tmp_path)) is not Tables.of(spark, SF)


def _events(spark, rows):
    at = F.to_timestamp("at")
    return spark.createDataFrame(rows, "event_id string, at string").select("event_id", at.alias("event_time"))


def test_late_copies_and_late_news(spark):
    from lossgrid.streaming import runs as S

    arrivals = [
        _events(spark, [("a", "2024-01-01 10:00:00"), ("b", "2024-01-01 10:01:00")]),
        _events(spark, [("a", "2024-01-01 10:00:00"), ("c", "2024-01-01 14:00:00")]),  # a copy in time
        # the watermark is 13:00: a late copy, a late new row, one in time
        _events(spark, [("a", "2024-01-01 10:00:00"), ("d", "2024-01-01 10:30:00"), ("e", "2024-01-01 13:30:00")]),
    ]
    kept, seen = S.run_arrivals(arrivals, lambda rows: S.deduplicated(rows, "event_id", "1 hour"), "late-test")
    assert sorted(r["event_id"] for r in kept.collect()) == ["a", "b", "c", "e"]
    assert [S.dropped_late(p) for p in seen] == [0, 0, 2]


def test_update_mode_forgets_closed_windows(spark):
    from lossgrid.streaming import runs as S
    from lossgrid.streaming import telemetry as T

    stream = T.as_telemetry(S.event_stream(spark, SF)).withWatermark("event_time", "10 minutes")
    progress = []
    rows = S.run_available(T.success_rate(stream, ["agent"]), "state", "update", keys=["window", "agent"], progress=progress)
    whole = T.success_rate(T.as_telemetry(spark.read.parquet(f"{SF}/events.parquet")), ["agent"])
    assert rows.count() == whole.count() > 100
    held = sum(int(op["numRowsTotal"]) for op in progress[-1]["stateOperators"])
    newest = whole.agg(F.max("window.end")).first()[0]
    still_open = whole.where(F.col("window.end") > F.lit(newest) - F.expr("interval 20 minutes")).count()
    assert held <= still_open


def test_upsert_keeps_the_last_version(spark, tmp_path):
    from lossgrid.streaming import runs as S
    from lossgrid.streaming import telemetry as T

    for k, at in enumerate(("10:00:30", "10:02:00", "10:04:59", "10:07:00")):
        _events(spark, [(f"e{k}", f"2024-01-01 {at}")]).coalesce(1).write.mode("append").parquet(str(tmp_path))
    stream = spark.readStream.schema("event_id string, event_time timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path))
    counts = T.windowed(stream.withWatermark("event_time", "1 hour"), "5 minutes", None, [], F.count("*").alias("n"))
    progress = []
    got = S.run_available(counts, "upsert", "update", keys=["window"], progress=progress)
    assert len(progress) >= 4
    assert sorted(r["n"] for r in got.collect()) == [1, 3]


def test_alerts_wait_until_their_condition_has_held(spark):
    """Ten minutes of errors fire in the third window; a good window or a gap starts the wait again."""
    rows = []
    for minute, failures in ((0, 40), (5, 40), (10, 40), (15, 40), (20, 0), (25, 40), (30, 40), (40, 40), (45, 40), (50, 40)):
        rows += [(f"2020-01-01 00:{minute:02d}:30", "failed", "x", 1.0, 9_000_000)] * failures
        rows += [(f"2020-01-01 00:{minute:02d}:40", "success", "x", 1.0, 9_000_000)] * 60
    events = spark.createDataFrame(rows, "t string, status string, task_id string, duration_seconds double, records_processed long")
    events = events.withColumn("event_time", F.to_timestamp("t"))
    fired = T.held_alerts(events).where("alert = 'error_rate_high'")
    got = {(r["window_start"].minute, r["pending_since"].minute) for r in fired.collect()}
    assert got == {(10, 0), (15, 0), (50, 40)}


def test_alerts_on_quality_duration_and_audit_trail(spark):
    sound, gap, slow = ("x", 1.0, 99_999_999), ("x", 1.0, None), ("x", 9_001.0, 99_999_999)
    rows = [("2020-01-01 00:01:00", "success", *sound)] * 30 + [("2020-01-01 00:06:00", "success", *gap)] * 2
    rows += [("2020-01-01 00:06:00", "success", *sound)] * 30 + [("2020-01-01 00:11:00", "success", *slow)] * 9
    events = spark.createDataFrame(rows, "t string, status string, task_id string, duration_seconds double, records_processed long")
    events = events.withColumn("event_time", F.to_timestamp("t"))
    got = {(r["window_start"].minute, r["alert"], r["severity"]) for r in T.held_alerts(events).collect()}
    # two of 32 leave 93.75 % whole; the duration has not held for five minutes yet
    assert got == {
        (5, "audit_trail_incomplete", "critical"), (5, "data_quality_low", "critical"),
        (10, "processing_window_breach", "critical"),
    }


def test_daily_alerts_count_falls_and_rises(spark):
    changes = spark.sql(
        "SELECT * FROM VALUES (date'2001-01-02', -10.5D, 20.0D, 4.0D), (date'2001-01-03', 9.0D, -20.5D, -5.5D),"
        " (date'2001-01-04', null, null, null) AS v(day, ecl_change_pct, volume_change_pct, stage2_change_pts)"
    )
    hits = spark.sql("SELECT * FROM VALUES (date'2001-01-02', 85.0D), (date'2001-01-05', 84.9D) AS v(day, accuracy)")
    got = {(str(r["day"]), r["alert"], r["observed"]) for r in T.daily_alerts(changes, hits).collect()}
    assert got == {
        ("2001-01-02", "ecl_variation_high", 10.5), ("2001-01-03", "volume_anomaly", 20.5),
        ("2001-01-03", "staging_anomaly", 5.5), ("2001-01-05", "model_accuracy_low", 84.9),
    }
