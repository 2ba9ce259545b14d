"""Declared schemas and column contracts; nothing is inferred."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossgrid.config import DEFAULTS, EclConfig

REQUIRED_LOAN_COLUMNS = ("loan_id", "current_balance", "days_past_due", "credit_score", "loan_type")


LOAN_DDL = (
    "loan_id string, customer_id string, loan_amount double, interest_rate double, term_months int, "
    "loan_type string, origination_date date, maturity_date date, collateral_value double, ltv_ratio double, "
    "monthly_payment double, customer_income double, credit_score int, days_past_due int, dti_ratio double, "
    "current_balance double, region string, sector string, employment_length int, credit_score_change int"
)
TELEMETRY_SOURCE_DDL = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)
STAGED_RESULT_DDL = (
    "loan_id string, calculation_date date, calculated_stage string, calculated_pd double, calculated_lgd double, "
    "calculated_ead double, calculated_ecl double, discount_factor double, watch_list_flag boolean, "
    "ml_enabled boolean, processing_timestamp timestamp"
)


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Fail on the driver, before any job, when a required column is absent."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def with_default_columns(df: DataFrame, cfg: EclConfig = DEFAULTS) -> DataFrame:
    """Optional columns that are absent get their documented defaults; rows are untouched."""
    defaults = {
        "origination_date": F.lit(cfg.as_of_date),
        "maturity_date": F.lit(cfg.as_of_date + dt.timedelta(days=365)),
        "credit_score_change": F.lit(0.0),
        "dti_ratio": F.lit(0.0),
        "ltv_ratio": F.lit(None).cast("double"),
        "collateral_value": F.lit(0.0),
    }
    absent = {name: value for name, value in defaults.items() if name not in df.columns}
    return df.withColumns(absent) if absent else df


def schema_column_diff(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Required columns the frame does not have, as a table."""
    spark = df.sparkSession
    want = spark.createDataFrame([(c,) for c in required], "column_name string")
    have = spark.createDataFrame([(c,) for c in df.columns], "column_name string")
    return want.exceptAll(have)
