"""Staging, PD, LGD, EAD and ECL as pure ``Column`` expressions.

A stage is computed as a *severity* 1..3: every rule yields its severity when it
fires and null otherwise, and ``greatest`` (which skips nulls) combines them.
Unknown inputs therefore never escalate a loan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lossgrid import config as C
from lossgrid.config import DEFAULTS, EclConfig
from lossgrid.functions.expr import any_of, at_least, clamp, dbl, hit, lookup, under


def stage_label(severity: Column) -> Column:
    return F.concat(F.lit("STAGE_"), severity.cast("string"))


def stage_number(stage: Column) -> Column:
    """Trailing digit of any of the label spellings, null when there is none."""
    return F.regexp_extract(stage.cast("string"), r"([123])$", 1).try_cast("int")


# -- staging ----------------------------------------------------------------


def arrears_severity(cfg: EclConfig = DEFAULTS) -> Column:
    """Severity from arrears, score floor and loan-to-value."""
    dpd = dbl("days_past_due")
    return F.greatest(
        F.lit(1),
        F.when(dpd >= cfg.dpd_stage_3, 3),
        F.when(dpd >= cfg.dpd_stage_2, 2),
        F.when(F.col("credit_score") < cfg.score_floor, 2),
        F.when(F.col("ltv_ratio") > cfg.ltv_limit, 2),
    )


def sicr_flags(cfg: EclConfig = DEFAULTS) -> dict[str, Column]:
    return {
        "sicr_credit_score_decline": hit(F.col("credit_score_change") < -cfg.score_drop),
        "sicr_high_ltv": hit(F.col("ltv_ratio") > cfg.ltv_limit),
        "sicr_high_dti": hit(F.col("dti_ratio") > cfg.dti_limit),
    }


def sicr_severity(cfg: EclConfig = DEFAULTS) -> Column:
    return F.greatest(arrears_severity(cfg), F.when(any_of(sicr_flags(cfg).values()), 2))


def final_severity(cfg: EclConfig = DEFAULTS) -> Column:
    low = F.when(F.col("credit_score") <= cfg.low_credit_threshold, 2)
    return F.greatest(sicr_severity(cfg), low)


def low_score_severity(severity: Column, cfg: EclConfig = DEFAULTS) -> Column:
    return F.greatest(severity, F.when(F.col("credit_score") <= cfg.low_credit_threshold, 2))


def hybrid_severity(model: Column, rules: Column, confidence: Column, cfg: EclConfig = DEFAULTS) -> Column:
    """A confident model decides; otherwise the more conservative of both."""
    return F.when(confidence >= cfg.ml_confidence, model).otherwise(F.greatest(model, rules))


def hybrid_confidence(model: Column, rules: Column, confidence: Column, cfg: EclConfig = DEFAULTS) -> Column:
    agree = hit(model == rules)
    return F.when(agree, F.greatest(confidence, F.lit(cfg.agreement_floor))).otherwise(
        F.least(confidence, F.lit(cfg.disagreement_cap))
    )


# -- risk parameters --------------------------------------------------------


def _pd_bounds(stage: Column, value_1: Column, value_2: Column, cfg: EclConfig) -> Column:
    return (
        F.when(stage == 3, F.lit(cfg.pd_stage_3))
        .when(stage == 2, clamp(value_2, *cfg.pd_stage_2))
        .otherwise(clamp(value_1, *cfg.pd_stage_1))
    )


def pd_from_score(stage: Column, cfg: EclConfig = DEFAULTS) -> Column:
    score = dbl("credit_score")
    return _pd_bounds(stage, (F.lit(850.0) - score) / 1700.0, (F.lit(900.0) - score) / 900.0, cfg)


def pd_from_model(stage: Column, model_pd: Column, cfg: EclConfig = DEFAULTS) -> Column:
    """Model PD within the stage's bounds; the score-based PD when it is missing or invalid."""
    return F.when(model_pd.between(0.0, 1.0), _pd_bounds(stage, model_pd, model_pd, cfg)).otherwise(
        pd_from_score(stage, cfg)
    )


def _risk_parameter(loan_type: Column, position: int) -> Column:
    table = {k: v[position] for k, v in C.RISK_PARAMETERS.items()}
    return lookup(loan_type, table, C.OTHER_RISK_PARAMETERS[position])


def recovery_rate(cfg: EclConfig = DEFAULTS) -> Column:
    cover = F.try_divide(F.col("collateral_value"), F.col("current_balance"))
    return F.when(F.col("collateral_value") > 0, F.least(F.lit(cfg.recovery_cap), cover)).otherwise(0.0)


def lgd(recovery: Column) -> Column:
    kind = F.col("loan_type")
    return F.greatest(_risk_parameter(kind, 0), F.lit(1.0) - recovery * _risk_parameter(kind, 1))


def ead() -> Column:
    return F.col("current_balance") * _risk_parameter(F.col("loan_type"), 2)


# -- expected loss ----------------------------------------------------------


def remaining_term_years(cfg: EclConfig = DEFAULTS) -> Column:
    days = F.datediff(F.col("maturity_date"), F.lit(cfg.as_of_date))
    return clamp(days / 365.25, cfg.min_term_years, cfg.max_term_years)


def discount_factor(term: Column, cfg: EclConfig = DEFAULTS) -> Column:
    return F.pow(F.lit(1.0 + (cfg.risk_free_rate + cfg.cycle_adjustment)), -term)


def forward_adjustment(stage: Column, cfg: EclConfig = DEFAULTS) -> Column:
    secured = F.col("loan_type").isin(*C.SECURED_TYPES)
    return (
        F.lit(1.0)
        + F.when(secured, F.lit(cfg.gdp_impact)).otherwise(F.lit(0.0))
        + F.when(stage >= 2, F.lit(cfg.unemployment_impact)).otherwise(F.lit(0.0))
        + F.lit(cfg.rate_impact)
    )


def ecl_by_stage(stage: Column, twelve_month: Column, lifetime: Column, lgd_: Column, ead_: Column) -> Column:
    return (
        F.when(stage == 1, twelve_month)
        .when(stage == 2, F.least(lifetime, lgd_ * ead_))
        .otherwise(ead_)
    )


def stage_weight(stage: Column, cfg: EclConfig = DEFAULTS) -> Column:
    return lookup(stage, {k: float(v) for k, v in cfg.stage_weights.items()}, 1.0)


# -- monitoring -------------------------------------------------------------


def provision_rate(ecl: Column) -> Column:
    return F.try_divide(ecl, F.col("current_balance"))


def risk_rating(pd_: Column) -> Column:
    return under(pd_, C.PD_RATINGS, C.PD_RATING_ABOVE)


def reliability(confidence: Column) -> Column:
    return at_least(confidence, C.RELIABILITY, C.RELIABILITY_BELOW)


def watch_list(stage: Column, rate: Column, confidence: Column) -> Column:
    return any_of(
        [
            stage == 2,
            dbl("days_past_due") > 15,
            F.col("credit_score") < 550,
            rate > 0.1,
            confidence < 0.5,
        ]
    )
