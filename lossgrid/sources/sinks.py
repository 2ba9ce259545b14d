"""Writers.  Every sink is a plain ``DataFrameWriter`` call that can be retried."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_results(df: DataFrame, root: str, run: str) -> str:
    """Snappy parquet in a directory named by the run."""
    path = f"{root}/results_{run}/calculations"
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def write_single_file(df: DataFrame, path: str) -> str:
    """One file, written by one task: for aggregated results."""
    df.coalesce(1).write.mode("overwrite").parquet(path)
    return path


def write_split_files(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> str:
    """Files of bounded length, written where the rows are: for results of any size."""
    df.write.option("maxRecordsPerFile", rows_per_file).mode("overwrite").parquet(path)
    return path


def write_json_rows(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode(mode).text(path)
    return path


def audit_frame(spark: SparkSession, events: Sequence[tuple[dt.datetime, str, Mapping]]) -> DataFrame:
    rows = [(ts.isoformat(), kind, json.dumps(dict(meta), sort_keys=True, default=str)) for ts, kind, meta in events]
    return spark.createDataFrame(rows, "timestamp string, event_type string, metadata string")


def write_audit(events: DataFrame, path: str) -> str:
    events.write.mode("append").json(path)
    return path


WRITE_MODES = {"WRITE_TRUNCATE": "overwrite", "WRITE_APPEND": "append", "WRITE_EMPTY": "errorifexists"}


def load_table(df: DataFrame, path: str, disposition: str = "WRITE_TRUNCATE") -> str:
    """Load with a named disposition."""
    df.write.mode(WRITE_MODES[disposition]).parquet(path)
    return path


def load_once(df: DataFrame, path: str, job_id: str) -> str:
    """The same job id twice is one load: its partition is replaced, others stay."""
    (
        df.withColumn("job_id", F.lit(job_id))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("job_id").parquet(path)
    )
    return path


def write_versioned(df: DataFrame, root: str, table: str, run_ts: str) -> str:
    path = f"{root}/data/{table}/{run_ts}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_formats(df: DataFrame, root: str, formats: Sequence[str] = ("parquet", "csv", "json")) -> list[str]:
    """Same dataset in each of the formats, whatever its size."""
    for f in formats:
        writer = df.write.mode("overwrite").format(f)
        (writer.option("header", True) if f == "csv" else writer).save(f"{root}/{f}")
    return list(formats)


def write_with_manifest(df: DataFrame, root: str, stage: str, amount: str) -> DataFrame:
    """Data plus a one-row manifest; the row count is observed while writing, not counted again."""
    seen = Observation("rows")
    df.observe(seen, F.count("*").alias("n")).write.mode("overwrite").parquet(f"{root}/portfolio")
    spark = df.sparkSession
    summary = (
        spark.read.schema(df.schema).parquet(f"{root}/portfolio")
        .groupBy(stage).agg(F.count("*").alias("loan_count"), F.sum(amount).alias("total_exposure"))
    )
    manifest = summary.agg(
        F.lit(seen.get["n"]).cast("long").alias("record_count"),
        F.array_sort(F.collect_list(F.struct(stage, "loan_count", "total_exposure"))).alias("stage_summary"),  # one per stage
    )
    manifest.write.mode("overwrite").json(f"{root}/manifest")
    return spark.read.schema(manifest.schema).json(f"{root}/manifest")


def create_table_if_absent(spark: SparkSession, name: str, ddl: str, path: str) -> DataFrame:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet LOCATION '{path}'")
    return spark.table(name)


def write_clustered(df: DataFrame, path: str, day: str, keys: Sequence[str], tie: str, files: int | None = None) -> str:
    """Day partitions with rows clustered by the keys.

    Ranges over (day, keys, tie-break) instead of hashing the keys: a hot key
    spreads over several files, and min/max statistics still skip by key.
    """
    order = [day, *keys, tie]
    placed = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    placed.sortWithinPartitions(*order).write.mode("overwrite").partitionBy(day).parquet(path)
    return path


def refresh_partitions(df: DataFrame, path: str, *partition: str) -> str:
    """Replace only the partitions present in the frame."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)
    return path


def past_retention(column: Column, as_of: Column, days: int) -> Column:
    return F.datediff(as_of, column) > days


def retention_keep(df: DataFrame, column: str, as_of: dt.date, days: int) -> DataFrame:
    return df.where(~past_retention(F.col(column), F.lit(as_of), days))


def retention_violations(frames: Mapping[str, tuple[DataFrame, str, int]], as_of: dt.date) -> DataFrame:
    """Rows past their limit per dataset."""
    parts = [
        df.agg(
            F.count("*").alias("records"), F.count_if(past_retention(F.col(c), F.lit(as_of), days)).alias("violations")
        ).select(F.lit(name).alias("policy"), F.lit(days).alias("days"), "records", "violations")
        for name, (df, c, days) in frames.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
