"""Running streams to completion: sources, idempotent sinks, stateful operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import LongType, StructField, StructType

from lossgrid.functions.expr import pct
from lossgrid.sources.schemas import TELEMETRY_SOURCE_DDL
from lossgrid.sources.scratch import fresh_path


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared-schema file stream over the events table, one file or a folder of part files.

    As a pattern, since a stream takes a plain path for a folder.
    """
    return spark.readStream.schema(TELEMETRY_SOURCE_DDL).parquet(f"{sf_dir.rstrip('/')}/events.parque[t]")


def _sink(path: str, keep_all: bool) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        # a batch that is retried after a failure replaces its own output
        folder = f"{path}/batch_id={batch_id}" if keep_all else f"{path}/current"
        batch.write.mode("overwrite").parquet(folder)

    return write


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the moment a query starts (it keeps its own copy)."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _drain(
    stream: DataFrame, path: str, mode: str, settings: dict[str, str] | None, progress: list | None
) -> None:
    """Runs everything available into ``path``; what an earlier call left there is the query's state."""
    with _settings(stream.sparkSession, settings or {}):
        query = (
            stream.writeStream.outputMode(mode)
            .option("checkpointLocation", f"{path}/_progress")
            .foreachBatch(_sink(f"{path}/out", keep_all=mode != "complete"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    if progress is not None:
        progress.extend(query.recentProgress)


def run_available(
    stream: DataFrame,
    name: str,
    mode: str = "append",
    settings: dict[str, str] | None = None,
    keys: Sequence[str] = (),
    progress: list | None = None,
) -> DataFrame:
    """Process everything available, then return what was written.

    ``append`` output accumulates per batch; ``complete`` output is replaced by
    every batch; of ``update`` output the last version of every row of ``keys``
    counts, so the sink is an upsert and the state may forget closed windows.
    Nothing passes through the driver; ``progress`` receives the metrics of the batches.
    """
    spark = stream.sparkSession
    path = fresh_path(spark, name)
    _drain(stream, path, mode, settings, progress)
    schema = stream.schema
    written = spark.read.schema(schema)
    if mode == "append":
        return written.option("recursiveFileLookup", True).parquet(f"{path}/out")
    if mode == "update":
        versions = spark.read.schema(StructType([*schema, StructField("batch_id", LongType())])).parquet(f"{path}/out")
        rest = [c for c in stream.columns if c not in keys]
        last = F.max_by(F.struct(*rest), "batch_id").alias("_last")
        return versions.groupBy(*keys).agg(last).select(*keys, "_last.*")
    return written.parquet(f"{path}/out/current")


def run_arrivals(
    arrivals: Sequence[DataFrame],
    build: Callable[[DataFrame], DataFrame],
    name: str,
    settings: dict[str, str] | None = None,
) -> tuple[DataFrame, list[list[dict]]]:
    """Lets tables arrive one after the other at a stream that keeps its state and watermark in between.

    ``build`` makes the query of the stream; its output is in append mode.  Each arrival is a folder of any number of
    files, read by one micro-batch.  The second result is the progress of the batches, a list for each arrival.
    """
    spark = arrivals[0].sparkSession
    path, landing = fresh_path(spark, name), fresh_path(spark, f"{name}-landing")
    seen: list[list[dict]] = []
    for k, rows in enumerate(arrivals):
        rows.write.parquet(f"{landing}/arrival={k}")
        stream = build(spark.readStream.schema(arrivals[0].schema).parquet(f"{landing}/arrival=[0-9]*"))
        seen.append([])
        _drain(stream, path, "append", settings, seen[-1])
    return spark.read.schema(stream.schema).option("recursiveFileLookup", True).parquet(f"{path}/out"), seen


def dropped_late(progress: Sequence[dict]) -> int:
    """Rows that the batches left out because the watermark had passed them."""
    return sum(int(op["numRowsDroppedByWatermark"]) for batch in progress for op in batch["stateOperators"])


#: sessions are merged before the shuffle, so a busy user sends sessions and not events
LOCAL_SESSION_MERGE = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}


def deduplicated(stream: DataFrame, key: str, delay: str, salts: int = 16) -> DataFrame:
    """First arrival per key; state for a key is dropped once the watermark has passed it.

    Copies of one key are first thinned out per (key, input task slot), which
    spreads a heavily repeated key over several tasks, and then per key.
    """
    return (
        stream.withWatermark("event_time", delay)
        .withColumn("_slot", F.spark_partition_id() % salts)
        .dropDuplicatesWithinWatermark([key, "_slot"])
        .dropDuplicatesWithinWatermark([key])
        .drop("_slot")
    )


# -- sustained error rate as a stateful operator ------------------------------

ALERT_SCHEMA = "agent string, fired_at timestamp, windows long"
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}


class ErrorStreak(StatefulProcessor):
    """Length of the current run of bad windows per agent; fires when it reaches ``runs``."""

    def __init__(self, window_seconds: int, min_errors: int, runs: int):
        self.window_seconds, self.min_errors, self.runs = window_seconds, min_errors, runs

    def init(self, handle) -> None:
        self.state = handle.getValueState("streak", "last long, length long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # one row per closed window; windows close in watermark order across batches
        closed = pd.concat(list(rows)).sort_values("start")
        last, length = self.state.get() if self.state.exists() else (None, 0)
        fired = []
        for start, errors in zip(closed["start"], closed["errors"]):
            follows = last is not None and int(start) == last + self.window_seconds
            length = 0 if errors < self.min_errors else (length + 1 if follows and length else 1)
            last = int(start)
            if length == self.runs:
                fired.append(pd.Timestamp(last, unit="s"))
        self.state.update((last, int(length)))
        yield pd.DataFrame({"agent": [key[0]] * len(fired), "fired_at": fired, "windows": [self.runs] * len(fired)}).astype(
            {"agent": "object", "fired_at": "datetime64[ns]", "windows": "int64"}
        )

    def close(self) -> None:
        pass


def sustained_error_alerts(
    stream: DataFrame, window_seconds: int, min_errors: int, runs: int, delay: str
) -> DataFrame:
    """Alerts after ``runs`` consecutive windows of an agent with at least ``min_errors`` failures.

    Events are summed per agent and window by a streaming aggregate first, so a
    noisy agent reaches the state function as one row per closed window.  Start it
    with :data:`ROCKSDB` among the settings.
    """
    closed = (
        stream.where(F.col("status") == "failed")
        .withWatermark("event_time", delay)
        .groupBy(F.window("event_time", f"{window_seconds} seconds"), "agent")
        .agg(F.count("*").alias("errors"))
        .select("agent", F.unix_timestamp("window.start").alias("start"), "errors")
    )
    return closed.groupBy("agent").transformWithStateInPandas(
        statefulProcessor=ErrorStreak(window_seconds, min_errors, runs),
        outputStructType=ALERT_SCHEMA,
        outputMode="append",
        timeMode="none",
    )


def running_shares(
    landing: str, spark: SparkSession, ddl: str, process: Callable[[DataFrame], DataFrame], key: str
) -> DataFrame:
    """Share of every value of ``key`` among all rows that arrived; the state is a count per value."""
    stream = process(spark.readStream.schema(ddl).option("maxFilesPerTrigger", 4).parquet(landing))
    counts = run_available(stream.groupBy(key).agg(F.count("*").alias("n")), "shares", "update", keys=[key])
    whole = counts.agg(F.sum("n").alias("n")).scalar()
    return counts.select(key, "n", pct(F.col("n"), whole).alias("percent"))


def ingest_portfolio(landing: str, spark: SparkSession, ddl: str, process: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Arriving loan files through the provisioning chain, one output folder per micro-batch."""
    stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 4).parquet(landing)
    return run_available(process(stream), "portfolio")
