"""The provisioning chain: one lazy, shuffle-free projection over the loan table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossgrid.config import DEFAULTS, EclConfig
from lossgrid.functions import rules as R
from lossgrid.sources.schemas import REQUIRED_LOAN_COLUMNS, require_columns, with_default_columns


def stage_portfolio(df: DataFrame, cfg: EclConfig = DEFAULTS, model: bool = False) -> DataFrame:
    """Adds SICR flags, rule stage, final stage and confidence.

    With ``model=True`` the frame must carry ``ml_stage_prediction`` and
    ``ml_stage_confidence``; rows without a prediction fall back to the rules.
    """
    df = df.withColumns({**R.sicr_flags(cfg), "_rule_severity": R.final_severity(cfg)})
    rule = F.col("_rule_severity")
    if model:
        said = R.stage_number(F.col("ml_stage_prediction"))
        sure = F.col("ml_stage_confidence")
        known = said.isNotNull() & sure.isNotNull()
        severity: Column = F.when(known, R.hybrid_severity(said, rule, sure, cfg)).otherwise(rule)
        confidence: Column = F.when(known, R.hybrid_confidence(said, rule, sure, cfg)).otherwise(
            F.lit(cfg.fallback_confidence)
        )
    else:
        severity, confidence = rule, F.lit(cfg.rules_confidence)
    return df.withColumns({"_severity": severity}).select(
        "*",
        R.stage_label(F.col("_rule_severity")).alias("rule_based_stage"),
        R.stage_label(F.col("_severity")).alias("calculated_stage"),
        confidence.alias("stage_confidence"),
    )


def risk_parameters(df: DataFrame, cfg: EclConfig = DEFAULTS, model: bool = False) -> DataFrame:
    severity = F.col("_severity")
    pd_ = R.pd_from_model(severity, F.col("ml_pd_prediction"), cfg) if model else R.pd_from_score(severity, cfg)
    return df.withColumns({"recovery_rate": R.recovery_rate(cfg)}).withColumns(
        {
            "calculated_pd": pd_,
            "calculated_lgd": R.lgd(F.col("recovery_rate")),
            "calculated_ead": R.ead(),
            "remaining_term_years": R.remaining_term_years(cfg),
        }
    )


def expected_loss(df: DataFrame, cfg: EclConfig = DEFAULTS) -> DataFrame:
    severity = F.col("_severity")
    df = df.withColumns(
        {
            "base_ecl_12_month": F.col("calculated_pd") * F.col("calculated_lgd") * F.col("calculated_ead"),
            "discount_factor": R.discount_factor(F.col("remaining_term_years"), cfg),
            "forward_looking_adjustment": R.forward_adjustment(severity, cfg),
        }
    )
    scaled = F.col("discount_factor") * F.col("forward_looking_adjustment")
    df = df.withColumns(
        {
            "ecl_12_month": F.col("base_ecl_12_month") * scaled,
            "ecl_lifetime": F.col("base_ecl_12_month") * F.col("remaining_term_years") * scaled,
            "stage_weight": R.stage_weight(severity, cfg),
        }
    )
    ecl = R.ecl_by_stage(
        severity, F.col("ecl_12_month"), F.col("ecl_lifetime"), F.col("calculated_lgd"), F.col("calculated_ead")
    )
    df = df.withColumns({"_ecl": ecl}).withColumns({"ecl_stage_weighted": F.col("_ecl") * F.col("stage_weight")})
    chosen = F.col("ecl_stage_weighted") if cfg.apply_stage_weight else F.col("_ecl")
    return df.withColumns({"calculated_ecl": chosen})


def monitoring_columns(df: DataFrame) -> DataFrame:
    return df.withColumns({"provision_rate": R.provision_rate(F.col("calculated_ecl"))}).withColumns(
        {
            "risk_rating": R.risk_rating(F.col("calculated_pd")),
            "watch_list_flag": R.watch_list(F.col("_severity"), F.col("provision_rate"), F.col("stage_confidence")),
            "model_reliability": R.reliability(F.col("stage_confidence")),
        }
    )


def audit_columns(
    df: DataFrame, cfg: EclConfig = DEFAULTS, model: bool = False, run_ts: dt.datetime | None = None
) -> DataFrame:
    stamp = run_ts or dt.datetime.combine(cfg.as_of_date, dt.time())
    return df.withColumns(
        {
            "processing_timestamp": F.lit(stamp.isoformat(sep=" ")).cast("timestamp"),
            "config_version": F.lit(cfg.config_version),
            "ml_enabled": F.lit(model),
        }
    )


def process_portfolio(
    loans: DataFrame, cfg: EclConfig = DEFAULTS, model: bool = False, run_ts: dt.datetime | None = None
) -> DataFrame:
    """Full chain from raw loans to provisions; no action, no shuffle."""
    require_columns(loans, REQUIRED_LOAN_COLUMNS)
    df = with_default_columns(loans, cfg)
    df = stage_portfolio(df, cfg, model)
    df = risk_parameters(df, cfg, model)
    df = expected_loss(df, cfg)
    df = monitoring_columns(df)
    df = audit_columns(df, cfg, model, run_ts)
    return df.drop("_rule_severity", "_severity", "_ecl")
