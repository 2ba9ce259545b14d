"""Typed reads and date handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossgrid import config as C


def scan_csv_typed(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """CSV with a header and a declared schema: no inference pass over the files."""
    return spark.read.schema(ddl).option("header", True).csv(path)


def scan_parquet(spark: SparkSession, path: str, ddl: str | None = None) -> DataFrame:
    reader = spark.read.schema(ddl) if ddl else spark.read
    return reader.parquet(path)


def lookup(df: DataFrame, key: str, value, columns: Sequence[str] | None = None) -> DataFrame:
    """Parametrised point lookup; predicate and projection reach the scan."""
    found = df.where(F.col(key) == F.lit(value))
    return found.select(*columns) if columns else found


def datetime_columns(df: DataFrame) -> list[str]:
    """Columns that hold dates by type or by name."""
    typed = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, typed)
        or (isinstance(f.dataType, T.StringType) and any(k in f.name.lower() for k in C.DATETIME_KEYWORDS))
    ]


def to_naive_utc(df: DataFrame, column: str) -> Column:
    """One timestamp type for every date-like input; unparseable text becomes null."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.try_to_timestamp(F.col(column)).cast("timestamp_ntz")
    return F.col(column).cast("timestamp").cast("timestamp_ntz")


def normalize_datetimes(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.withColumns({c: to_naive_utc(df, c) for c in (columns or datetime_columns(df))})


def datetime_conversion_report(df: DataFrame) -> DataFrame:
    """Values per date-like column that would be lost, counted in one pass."""
    from lossgrid.operators.quality import stack

    columns = datetime_columns(df)
    one = df.agg(
        *[F.count_if(F.col(c).isNotNull() & to_naive_utc(df, c).isNull()).alias(c) for c in columns]
    )
    return stack(
        one,
        [
            {
                "column_name": F.lit(c),
                "data_type": F.lit(df.schema[c].dataType.simpleString()),
                "unconvertible": F.col(c),
                "conversion_safe": F.col(c) == 0,
            }
            for c in columns
        ],
    )
