"""Joins between loans, customers, payments, predictions and the macro series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossgrid.functions.expr import month_start


def attach_predictions(loans: DataFrame, predictions: DataFrame) -> DataFrame:
    """Model outputs beside the loans, matched by key (never by position)."""
    said = predictions.select(
        "loan_id",
        F.col("predicted_stage").alias("ml_stage_prediction"),
        F.col("confidence").alias("ml_stage_confidence"),
        F.col("probability_default").alias("ml_pd_prediction"),
    )
    return loans.join(said, "loan_id", "left")


def latest_macro(macro: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The newest macro row: one partial aggregate per task instead of a global sort."""
    row = F.max_by(F.struct("date", *columns), F.col("date"))
    return macro.agg(row.alias("m")).select("m.*")


def with_latest_macro(df: DataFrame, macro: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Latest macro values on every row through a scalar subquery (a plan literal, not a join)."""
    row = macro.agg(F.max_by(F.struct(*columns), F.col("date")).alias("m")).scalar()
    return df.withColumns({"_macro": row}).select(*df.columns, *[F.col("_macro")[c].alias(c) for c in columns])


def macro_asof(loans: DataFrame, macro: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each loan with the last macro row at or before its origination.

    The as-of match is resolved once per origination *date* (a calendar, so small
    and independent of the loan count) and then joined back by equality.
    """
    points = loans.select(F.col("origination_date").alias("_d")).distinct()
    marks = points.select("_d", F.lit(None).cast("date").alias("_m"), F.lit(None).alias("_v")).unionByName(
        macro.select(F.col("date").alias("_d"), F.col("date").alias("_m"), F.struct(*columns).alias("_v")),
        allowMissingColumns=True,
    )
    # macro rows of a day sort before the loans of that day
    upto = Window.orderBy("_d", F.desc_nulls_last("_m")).rowsBetween(Window.unboundedPreceding, 0)
    seen = (
        marks.withColumns(
            {"macro_date": F.last("_m", True).over(upto), "_seen": F.last("_v", True).over(upto)}
        )
        .where(F.col("_m").isNull())
        .select(F.col("_d").alias("origination_date"), "macro_date", *[F.col("_seen")[c].alias(c) for c in columns])
    )
    return loans.join(seen, "origination_date", "left")


def model_performance_snapshot(predictions: DataFrame, features: DataFrame) -> DataFrame:
    """Predictions with the feature values of their own feature-set version."""
    return predictions.join(features, ["loan_id", "feature_set_version"], "left").select(
        "loan_id", "prediction_date", "model_name", "model_version", "probability_default", "predicted_stage",
        "behaviour_score", "utilisation_rate", "delinquency_days",
    )


def exposure_by_stage_income(staged: DataFrame, customers: DataFrame, stage: str = "stage") -> DataFrame:
    """Loans per stage with their borrowers' mean income.

    Loans are summed per (customer, stage) first, so a customer with very many
    loans reaches the join as at most three rows.
    """
    per_customer = staged.groupBy("customer_id", stage).agg(
        F.count("*").alias("_n"), F.sum("current_balance").alias("_exposure")
    )
    joined = per_customer.join(customers.select("customer_id", "annual_income"), "customer_id")
    return (
        joined.groupBy(stage)
        .agg(
            F.sum("_n").alias("loan_count"),
            F.try_divide(
                F.sum(F.col("annual_income") * F.col("_n")),
                F.sum(F.when(F.col("annual_income").isNotNull(), F.col("_n"))),
            ).alias("avg_income"),
            F.sum("_exposure").alias("total_exposure"),
        )
        .orderBy(F.desc_nulls_last("total_exposure"), stage)
    )


def ml_vs_rules(staged: DataFrame, predictions: DataFrame) -> DataFrame:
    return staged.select("loan_id", F.col("stage").alias("rule_stage")).join(
        predictions.select(
            "loan_id", "original_stage", "predicted_stage", "confidence",
        ),
        "loan_id",
    ).withColumn("agrees", F.col("predicted_stage") == F.col("rule_stage"))


def payment_totals(payments: DataFrame) -> DataFrame:
    """One row per loan with payments."""
    return payments.groupBy("loan_id").agg(
        F.count("*").alias("n_payments"),
        F.sum("scheduled_payment").alias("scheduled_total"),
        F.sum("actual_payment").alias("actual_total"),
        F.count_if(F.col("payment_status") == "MISSED").alias("n_missed"),
        F.max("days_late").alias("max_days_late"),
    )


def loan_payments(loans: DataFrame, payments: DataFrame) -> DataFrame:
    """Loans with their payments, one row per payment."""
    return loans.select("loan_id", "loan_type", "monthly_payment").join(payments, "loan_id")


def loans_without_payments(loans: DataFrame, payments: DataFrame) -> DataFrame:
    """Anti join on the de-duplicated payment keys, so hot loans cost one row."""
    return loans.join(payments.select("loan_id").distinct(), "loan_id", "left_anti")


def origination_month() -> Column:
    return month_start(F.col("origination_date"))
