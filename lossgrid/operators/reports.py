"""Portfolio reports.  All are ``groupBy().agg()`` with map-side partial aggregation:
a hot group arrives at its reducer as one partial row per task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossgrid import config as C
from lossgrid.config import DEFAULTS, EclConfig
from lossgrid.functions import portfolio as P
from lossgrid.functions import rules as R
from lossgrid.functions.expr import (
    avg_if,
    bins,
    month_start,
    months_between,
    pct,
    share,
    sum_if,
)
from lossgrid.operators.joins import with_latest_macro

STAGE = F.col
NPL = "npl_dpd_gt_90"


def _stage(n: int) -> Column:
    return F.col("calculated_stage") == f"STAGE_{n}"


def _npl() -> Column:
    return F.col("days_past_due") > 90


def active(results: DataFrame) -> DataFrame:
    return results.where(F.col("current_balance") > 0)


# -- run summaries -----------------------------------------------------------


def summary_report(results: DataFrame) -> DataFrame:
    """Portfolio totals, stage counts and mean risk parameters in one pass."""
    exposure, ecl = F.sum("calculated_ead"), F.sum("calculated_ecl")
    return results.agg(
        F.count("*").alias("total_loans"),
        exposure.alias("total_exposure"),
        ecl.alias("total_ecl"),
        F.coalesce(share(ecl, exposure), F.lit(0.0)).alias("coverage_ratio"),
        *[F.count_if(_stage(n)).alias(f"stage{n}_count") for n in (1, 2, 3)],
        F.avg("calculated_pd").alias("average_pd"),
        F.avg("calculated_lgd").alias("average_lgd"),
        F.avg("calculated_ead").alias("average_ead"),
    )


def stage_metrics(results: DataFrame) -> DataFrame:
    return results.groupBy("calculated_stage").agg(
        F.count("*").alias("loan_count"),
        F.sum("current_balance").alias("exposure"),
        F.sum("calculated_ecl").alias("ecl"),
        F.sum("calculated_ead").alias("ead"),
        F.avg("calculated_pd").alias("avg_pd"),
        F.avg("calculated_lgd").alias("avg_lgd"),
        F.avg("stage_confidence").alias("avg_confidence"),
    )


def rating_metrics(results: DataFrame) -> DataFrame:
    return results.groupBy("risk_rating").agg(
        F.count("*").alias("loan_count"),
        F.avg("calculated_pd").alias("avg_pd"),
        F.sum("calculated_ecl").alias("ecl"),
    )


def ml_usage_metrics(results: DataFrame) -> DataFrame:
    said = F.col("ml_stage_prediction")
    return results.agg(
        F.count(said).alias("ml_predictions_used"),
        F.count_if(F.col("stage_confidence") >= 0.8).alias("high_confidence_predictions"),
        F.count_if(said == F.col("rule_based_stage")).alias("ml_rule_agreement"),
        F.avg("stage_confidence").alias("avg_ml_confidence"),
    )


# -- warehouse views ---------------------------------------------------------


def stage_distribution(results: DataFrame) -> DataFrame:
    balance = F.col("current_balance")
    return (
        active(results)
        .groupBy("calculation_date", "calculated_stage", "region", "loan_type", "sector")
        .agg(
            F.count("*").alias("loan_count"),
            F.sum(balance).alias("total_exposure"),
            F.sum("calculated_ecl").alias("total_ecl"),
            F.avg("calculated_pd").alias("avg_pd_12m"),
            F.avg("calculated_lgd").alias("avg_lgd"),
            F.avg("credit_score").alias("avg_credit_score"),
            share(F.sum("calculated_ecl"), F.sum(balance)).alias("ecl_coverage_ratio"),
            F.count_if(F.col("days_past_due") > 0).alias("delinquent_count"),
            F.count_if(_npl()).alias("npl_count"),
            P.exposure_weight(F.col("calculated_pd"), balance).alias("portfolio_weighted_pd"),
        )
    )


def regional_risk(results: DataFrame, macro: DataFrame) -> DataFrame:
    total = F.count("*")
    grouped = (
        active(results)
        .groupBy("region")
        .agg(
            total.alias("total_loans"),
            F.sum("current_balance").alias("total_exposure"),
            F.avg("loan_amount").alias("avg_loan_amount"),
            F.avg("current_balance").alias("avg_current_balance"),
            F.avg("credit_score").alias("avg_credit_score"),
            F.avg("calculated_pd").alias("avg_pd_12m"),
            F.avg("calculated_lgd").alias("avg_lgd"),
            F.sum("calculated_ecl").alias("total_ecl"),
            share(F.sum("calculated_ecl"), F.sum("current_balance")).alias("ecl_coverage_ratio"),
            *[F.count_if(_stage(n)).alias(f"stage{n}_count") for n in (1, 2, 3)],
            *[pct(F.count_if(_stage(n)), total).alias(f"stage{n}_pct") for n in (1, 2, 3)],
            F.count_if(F.col("days_past_due") > 0).alias("delinquent_loans"),
            F.count_if(_npl()).alias("npl_loans"),
            pct(F.count_if(_npl()), total).alias("npl_ratio"),
            F.max("current_balance").alias("largest_exposure"),
            F.stddev_samp("current_balance").alias("exposure_volatility"),
        )
    )
    # five grouped rows carry the macro literals, not the loan rows
    return with_latest_macro(grouped, macro, ["gdp_growth", "unemployment_rate", "economic_cycle"]).orderBy(
        F.desc_nulls_last("total_exposure"), "region"
    )


def product_performance(results: DataFrame, cfg: EclConfig = DEFAULTS) -> DataFrame:
    total = F.count("*")
    to_maturity = months_between(F.col("maturity_date"), F.lit(cfg.as_of_date))
    return (
        active(results)
        .groupBy("loan_type", "sector")
        .agg(
            total.alias("loan_count"),
            F.sum("loan_amount").alias("total_originated"),
            F.sum("current_balance").alias("current_exposure"),
            F.avg("loan_amount").alias("avg_loan_size"),
            F.avg("interest_rate").alias("avg_interest_rate"),
            F.sum(F.col("loan_amount") - F.col("current_balance")).alias("total_principal_collected"),
            F.avg("credit_score").alias("avg_credit_score"),
            F.avg("calculated_pd").alias("avg_pd_12m"),
            F.avg("calculated_lgd").alias("avg_lgd"),
            F.sum("calculated_ecl").alias("total_ecl"),
            share(F.sum("calculated_ecl"), F.sum("current_balance")).alias("ecl_rate"),
            pct(F.count_if(_stage(3)), total).alias("default_rate"),
            pct(F.count_if(F.col("days_past_due") > 30), total).alias("delinquency_rate"),
            F.avg("days_past_due").alias("avg_days_past_due"),
            pct(F.count_if(F.col("credit_score") >= 700), total).alias("prime_percentage"),
            pct(F.count_if(F.col("credit_score") < 600), total).alias("subprime_percentage"),
            F.avg("term_months").alias("avg_term_months"),
            F.avg(to_maturity).alias("avg_months_to_maturity"),
        )
        .orderBy(F.desc_nulls_last("current_exposure"), "loan_type", "sector")
    )


def executive_summary(results: DataFrame) -> DataFrame:
    balance = F.col("current_balance")
    base = active(results).agg(
        F.count("*").alias("total_loans"),
        F.sum(balance).alias("total_exposure"),
        F.sum("calculated_ecl").alias("total_provisions"),
        F.avg("credit_score").alias("avg_credit_score"),
        *[F.count_if(_stage(n)).alias(f"stage{n}_loans") for n in (1, 2, 3)],
        *[sum_if(balance, _stage(n)).alias(f"stage{n}_exposure") for n in (1, 2, 3)],
        pct(F.count_if(_npl()), F.count("*")).alias("npl_ratio"),
        pct(F.sum("calculated_ecl"), F.sum(balance)).alias("provision_coverage_ratio"),
        pct(F.sum("calculated_ecl"), sum_if(balance, _npl())).alias("npl_coverage_ratio"),
    )
    npl, cover = F.col("npl_ratio"), F.col("provision_coverage_ratio")
    return base.select(
        "*",
        *[pct(F.col(f"stage{n}_loans"), F.col("total_loans")).alias(f"stage{n}_pct") for n in (1, 2, 3)],
        *[pct(F.col(f"stage{n}_exposure"), F.col("total_exposure")).alias(f"stage{n}_exposure_pct") for n in (1, 2, 3)],
        F.when((npl <= 2.0) & (cover >= 1.0), "Low Risk")
        .when((npl <= 5.0) & (cover >= 0.5), "Moderate Risk")
        .otherwise("High Risk")
        .alias("portfolio_risk_assessment"),
    )


def regulatory_report(results: DataFrame, cfg: EclConfig = DEFAULTS) -> DataFrame:
    balance, ecl = F.col("current_balance"), F.col("calculated_ecl")
    per_stage = []
    for n in (1, 2, 3):
        per_stage += [
            F.count_if(_stage(n)).alias(f"stage{n}_count"),
            sum_if(balance, _stage(n)).alias(f"stage{n}_gross_carrying_amount"),
            sum_if(ecl, _stage(n)).alias(f"stage{n}_ecl_provisions"),
            pct(sum_if(ecl, _stage(n)), sum_if(balance, _stage(n))).alias(f"stage{n}_coverage_ratio"),
        ]
    return active(results).agg(
        F.max(F.trunc(F.lit(cfg.as_of_date), "quarter")).alias("reporting_quarter"),
        *per_stage,
        avg_if(F.col("calculated_pd"), _stage(1)).alias("stage1_avg_pd"),
        avg_if(F.col("calculated_pd"), _stage(2)).alias("stage2_avg_pd"),
        F.count("*").alias("total_count"),
        F.sum(balance).alias("total_gross_carrying_amount"),
        F.sum(ecl).alias("total_ecl_provisions"),
        pct(F.sum(ecl), F.sum(balance)).alias("overall_coverage_ratio"),
    )


def credit_quality_monthly(results: DataFrame) -> DataFrame:
    return results.groupBy(month_start(F.col("origination_date")).alias("reporting_month"), "calculated_stage").agg(
        F.count("*").alias("new_loans_count"),
        F.sum("loan_amount").alias("new_loans_volume"),
        F.avg("credit_score").alias("avg_credit_score"),
        F.avg("calculated_pd").alias("avg_pd"),
        F.sum("calculated_ecl").alias("total_ecl"),
    )


def by_stage_and(results: DataFrame, keys: Sequence[str | Column], *measures: Column) -> DataFrame:
    """Stage view: keys + stage number with its display label and a loan count."""
    number = R.stage_number(F.col("calculated_stage"))
    return (
        results.groupBy(*keys, number.alias("provision_stage"))
        .agg(F.count("*").alias("loan_count"), *measures)
        .withColumn("provision_stage_label", P.stage_text(F.col("provision_stage")))
    )


def risk_metrics_global(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count("*").alias("loan_count"),
        F.sum("loan_amount").alias("total_exposure"),
        F.avg("credit_score").alias("avg_credit_score"),
        F.avg("dti_ratio").alias("avg_dti"),
        F.avg("ltv_ratio").alias("avg_ltv"),
        F.avg("days_past_due").alias("avg_days_past_due"),
        pct(F.count_if(_stage(3)), F.count("*")).alias("default_rate_pct"),
        F.sum("calculated_ead").alias("total_ead"),
        F.sum("calculated_ecl").alias("total_ecl"),
    )


# -- analyst tables ----------------------------------------------------------


def pd_pivot(results: DataFrame) -> DataFrame:
    """Mean PD with one column per stage; the stage list is fixed, so no job looks for pivot values."""
    return results.groupBy("loan_type").pivot("calculated_stage", list(C.STAGES)).agg(F.avg("calculated_pd"))


def coverage_by(results: DataFrame, key: str) -> DataFrame:
    return (
        results.groupBy(key)
        .agg(share(F.sum("calculated_ecl"), F.sum("current_balance")).alias("coverage"))
        .orderBy(F.desc_nulls_last("coverage"), key)
    )


def loan_type_risk(results: DataFrame) -> DataFrame:
    return results.groupBy("loan_type").agg(
        F.avg("calculated_pd").alias("avg_pd"),
        F.avg("calculated_lgd").alias("avg_lgd"),
        share(F.sum("calculated_ecl"), F.sum("current_balance")).alias("coverage"),
    )


def payment_stats(payments: DataFrame) -> DataFrame:
    return payments.groupBy("payment_status").agg(
        F.count("loan_id").alias("payment_count"),
        F.sum("actual_payment").alias("actual_total"),
        F.sum("scheduled_payment").alias("scheduled_total"),
    )


def monthly_payment_pivot(payments: DataFrame) -> DataFrame:
    return (
        payments.groupBy(month_start(F.col("payment_date")).alias("month"))
        .pivot("payment_status", ["MISSED", "PAID", "PARTIAL"])
        .count()
        .na.fill(0)
    )


def report_histograms(results: DataFrame, specs: Mapping[str, int]) -> DataFrame:
    """Histograms of several columns, each over its own range from the least to the greatest value.

    All ranges come from one aggregate, all counts from one more scan; no value lies outside the bins.
    """
    edges = [f(F.col(c).cast("double")).alias(f"{name}_{c}") for c in specs for name, f in (("low", F.min), ("high", F.max))]
    ranges = results.agg(F.struct(*edges).alias("ranges")).scalar()
    low, high = ({c: ranges[f"{name}_{c}"] for c in specs} for name in ("low", "high"))
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("measure"), bins(F.col(c).cast("double"), low[c], high[c], n).alias("bin"))
            for c, n in specs.items()
        ]
    )
    start = reduce(
        lambda chain, c: chain.when(F.col("measure") == c, low[c] + (F.col("bin") - 1) * ((high[c] - low[c]) / specs[c])),
        specs,
        F,
    )
    return (
        results.select(*specs)
        .select(F.explode(entries).alias("e"))
        .where(F.col("e.bin").isNotNull())
        .groupBy(F.col("e.measure").alias("measure"), F.col("e.bin").alias("bin"))
        .agg(F.count("*").alias("n"))
        .select("measure", "bin", start.alias("bin_start"), "n")
    )


def with_risk_category(results: DataFrame) -> DataFrame:
    return results.withColumns(
        {
            "risk_category": P.risk_category(F.col("credit_score")),
            "ecl_amount": F.col("current_balance") * F.col("calculated_pd") * F.col("calculated_lgd"),
        }
    )


def stage_risk_summary(results: DataFrame) -> DataFrame:
    return with_risk_category(results).groupBy("calculated_stage", "risk_category").agg(
        F.sum("loan_amount").alias("total_loan_amount"),
        F.sum("current_balance").alias("total_current_balance"),
        F.sum("ecl_amount").alias("total_ecl_amount"),
        F.count("*").alias("loan_count"),
    )


def with_horizon_ecl(results: DataFrame) -> DataFrame:
    """Undiscounted 12-month and whole-term loss; Stage 1 keeps the 12-month one."""
    first = _stage(1)
    horizon = F.when(first, 1.0).otherwise(F.col("term_months") / 12.0)
    year = F.col("current_balance") * F.col("calculated_pd") * F.col("calculated_lgd")
    return results.withColumns({"time_horizon": horizon, "ecl_12m": year}).withColumns(
        {"ecl_life": F.col("ecl_12m") * F.col("time_horizon")}
    ).withColumns({"ecl_final": F.when(first, F.col("ecl_12m")).otherwise(F.col("ecl_life"))})


def ecl_stage_rates(results: DataFrame) -> DataFrame:
    """Per-stage loss summary with each stage's share of exposure.

    The total comes from the (three) stage rows, not from a second scan.
    """
    per_stage = with_horizon_ecl(results).groupBy("calculated_stage").agg(
        F.sum("current_balance").alias("total_exposure"),
        F.sum("ecl_final").alias("total_ecl"),
        F.avg("calculated_pd").alias("avg_pd_rate"),
        F.avg("calculated_lgd").alias("avg_lgd_rate"),
        F.avg("ecl_final").alias("avg_ecl_per_loan"),
    )
    from pyspark.sql import Window

    whole = F.sum("total_exposure").over(Window.partitionBy())
    return per_stage.select(
        "*",
        pct(F.col("total_ecl"), F.col("total_exposure")).alias("ecl_rate"),
        pct(F.col("total_exposure"), whole).alias("exposure_pct"),
    )


def rating_bucket_exposure(results: DataFrame, minimum: float = 1000.0) -> DataFrame:
    return (
        results.where(F.col("current_balance") > minimum)
        .groupBy("risk_rating", P.ltv_risk_bucket(F.col("ltv_ratio")).alias("risk_bucket"))
        .agg(
            F.sum("current_balance").alias("total_exposure"),
            F.avg("current_balance").alias("avg_balance"),
            F.avg("interest_rate").alias("avg_rate"),
            F.count("*").alias("loan_count"),
        )
        .orderBy("risk_rating", F.desc_nulls_last("total_exposure"), "risk_bucket")
    )


def monthly_provisions(results: DataFrame) -> DataFrame:
    """Daily origination cohorts rolled up to months."""
    daily = results.groupBy("origination_date").agg(
        F.sum("current_balance").alias("portfolio_balance"),
        F.sum("calculated_ecl").alias("provision_amount"),
        F.count_if(_stage(3)).alias("new_defaults"),
    )
    return (
        daily.groupBy(month_start(F.col("origination_date")).alias("month"))
        .agg(
            F.avg("portfolio_balance").alias("avg_portfolio_balance"),
            F.sum("provision_amount").alias("total_provisions"),
            F.avg(F.try_divide("provision_amount", "portfolio_balance")).alias("avg_provision_rate"),
            F.sum("new_defaults").alias("total_new_defaults"),
        )
        .orderBy("month")
    )


def category_mean_std(df: DataFrame, key: str, value: str, minimum: float) -> DataFrame:
    return (
        df.where(F.col(value) > minimum)
        .groupBy(key)
        .agg(
            F.avg(value).alias("mean_value"),
            F.stddev_samp(value).alias("std_value"),
            F.count("*").alias("n"),
        )
        .orderBy(F.desc_nulls_last("mean_value"), key)
    )


def ml_vs_rules_confusion(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("original_stage").agg(
        *[F.count_if(F.col("predicted_stage") == s).alias(f"predicted_{s.lower()}") for s in C.STAGES],
        F.avg("confidence").alias("avg_confidence"),
    )


def dataset_profile(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns and nulls of each dataset: one aggregate per dataset."""
    parts = []
    for name, df in frames.items():
        nulls = sum((F.count_if(F.col(c).isNull()) for c in df.columns[1:]), F.count_if(F.col(df.columns[0]).isNull()))
        parts.append(
            df.agg(F.count("*").alias("record_count"), nulls.alias("missing_values")).select(
                F.lit(name).alias("dataset"),
                "record_count",
                F.lit(len(df.columns)).cast("long").alias("column_count"),
                "missing_values",
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def value_distribution(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Value counts of several columns in one pass."""
    entries = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns])
    return (
        df.select(F.explode(entries).alias("e"))
        .groupBy(F.col("e.field").alias("field"), F.col("e.value").alias("value"))
        .agg(F.count("*").alias("n"))
    )


def portfolio_composition(results: DataFrame) -> DataFrame:
    return results.rollup("loan_type", "calculated_stage").agg(
        F.sum("current_balance").alias("exposure"), F.count("*").alias("loan_count")
    )
