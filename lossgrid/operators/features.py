"""Feature tables: learned statistics enter the plan as scalar subqueries, never as driver collects of rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossgrid import config as C
from lossgrid.functions import features as X
from lossgrid.operators.scale import distributed_row_number, quantile_columns

EMPLOYMENT = ("EMPLOYED", "SELF_EMPLOYED", "RETIRED", "UNEMPLOYED")


def learned(df: DataFrame, columns: Sequence[str], strategy: str) -> dict[str, Column]:
    """Fill value per column: mean, median or zero over the whole table."""
    if strategy == "zero":
        return {c: F.lit(0.0) for c in columns}
    if strategy == "mean":
        one = df.agg(*[F.avg(c).alias(c) for c in columns])
    elif strategy == "median":
        one = quantile_columns(df, {c: (c, 0.5) for c in columns})
    else:
        raise ValueError(f"unknown strategy {strategy}")
    row = one.select(F.struct(*columns).alias("s")).scalar()
    return {c: row[c] for c in columns}


def impute(df: DataFrame, columns: Sequence[str], strategy: str) -> DataFrame:
    fill = learned(df, columns, strategy)
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), fill[c]) for c in columns})


def features_basic(loans: DataFrame, customers: DataFrame, strategy: str = "median") -> DataFrame:
    """Base columns, burden ratios and one-hot categories; numeric gaps filled."""
    status = customers.select("customer_id", "employment_status")
    df = loans.join(status, "customer_id", "left").withColumns(
        {"employment_status": F.coalesce("employment_status", F.lit("UNKNOWN"))}
    )
    wide = df.select(
        "loan_id",
        *X.BASE,
        *[c.alias(n) for n, c in (X.burden() | {"loan_age_months": X.age_months()}).items()],
        *[
            c.alias(n)
            for n, c in (
                X.dummies("loan_type", C.LOAN_TYPES, "loan_type") | X.dummies("employment_status", EMPLOYMENT, "employment")
            ).items()
        ],
    )
    gaps = ["customer_income", "ltv_ratio", "debt_to_income", "payment_burden", "utilization_rate"]
    return impute(wide, gaps, strategy)


def features_missing_defaults(loans: DataFrame) -> DataFrame:
    """Estimated income and payment for portfolios without those columns."""
    median = quantile_columns(loans, {"m": ("loan_amount", 0.5)}).scalar()
    estimated = loans.withColumns({"_p": X.default_payment()})
    typical = quantile_columns(estimated, {"m": ("_p", 0.5)}).scalar()
    return estimated.withColumns(
        {
            "customer_income": X.default_income(median),
            "monthly_payment": F.coalesce(F.col("_p"), typical),
        }
    ).drop("_p")


def categorical_levels(df: DataFrame, column: str) -> DataFrame:
    """Known levels in alphabetical order, then the markers for missing and unseen values."""
    seen = (
        df.select(F.coalesce(F.col(column).cast("string"), F.lit("__missing__")).alias("level")).distinct()
        .where(~F.col("level").isin("__missing__", "__other__"))
        .withColumn("_k", F.lit(0))
    )
    marks = df.sparkSession.createDataFrame([("__missing__", 1), ("__other__", 2)], "level string, _k int")
    numbered = distributed_row_number(seen.unionByName(marks), [], ["_k", "level"], "_n")
    return numbered.select("level", (F.col("_n") - 1).cast("int").alias("level_index"))


def apply_levels(df: DataFrame, column: str, levels: DataFrame) -> DataFrame:
    """Column mapped onto the learned levels; unseen values become ``__other__``."""
    known = levels.withColumnRenamed("level", "_level")
    raw = F.coalesce(F.col(column).cast("string"), F.lit("__missing__"))
    mapped = df.withColumn("_raw", raw).join(known, F.col("_raw") == F.col("_level"), "left")
    other = levels.where(F.col("level") == "__other__").select("level_index").scalar()
    return mapped.withColumns(
        {
            f"{column}_level": F.coalesce("_level", F.lit("__other__")),
            f"{column}_index": F.coalesce("level_index", other),
        }
    ).drop("_raw", "_level", "level_index")


def z_scores(df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Population z-scores; the two moments per column come from one aggregate."""
    moments = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    )
    row = moments.select(F.struct("*").alias("s")).scalar()
    return df.select(
        *keep,
        *[F.try_divide(F.col(c) - row[f"m_{c}"], row[f"s_{c}"]).alias(f"{c}_z") for c in columns],
    )


def preprocess(df: DataFrame, numeric: Sequence[str], categorical: Mapping[str, Sequence[str]], key: str) -> DataFrame:
    """z-scores plus one-hot columns without the first level of each category."""
    hot = {
        n: c
        for column, values in categorical.items()
        for n, c in X.dummies(column, list(values)[1:], column).items()
    }
    base = df.select(key, *numeric, *[c.alias(n) for n, c in hot.items()])
    return z_scores(base, numeric, [key, *hot])
