"""Loan arithmetic and classification beyond the provisioning rules (pure ``Column``s)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lossgrid import config as C
from lossgrid.config import DEFAULTS, EclConfig
from lossgrid.functions.expr import above, at_least, clamp, count_of, dbl, hit, lookup, months_between


# -- loan metrics -----------------------------------------------------------


def annuity_payment(amount: Column, annual_rate_pct: Column, months: Column) -> Column:
    """Level payment; an interest-free loan is repaid in equal parts."""
    r = annual_rate_pct / 100.0 / 12.0
    growth = F.pow(F.lit(1.0) + r, months.cast("double"))
    level = F.try_divide(amount * (r * growth), growth - 1.0)
    return F.when(r > 0, level).otherwise(F.try_divide(amount, months.cast("double")))


def maturity_from_term(origination: Column, months: Column) -> Column:
    return F.date_add(origination, (months * 30).cast("int"))


def loan_to_value(amount: Column, collateral: Column) -> Column:
    return F.when(collateral > 0, F.try_divide(amount, collateral))


def debt_to_income(monthly_payment: Column, income: Column) -> Column:
    return F.try_divide(monthly_payment * 12.0, income)


def sicr_trigger_count(history: Column | None = None) -> Column:
    conditions = [
        F.col("credit_score") < 600,
        F.col("dti_ratio") > 0.45,
        F.col("employment_length") < 12,
    ]
    if history is not None:
        conditions.append(history.isin(*C.BAD_HISTORY))
    return count_of(conditions)


def stage_numeric(dpd: Column, triggers: Column) -> Column:
    """Significant increase outranks long arrears in this numeric scheme."""
    increased = triggers >= 2
    return F.when((dpd == 0) & ~increased, 1).when((dpd <= 90) | increased, 2).otherwise(3)


def pd_score_adjusted(base: Column, score: Column) -> Column:
    return base * F.when(score >= 800, 0.5).when(score < 500, 2.0).otherwise(1.0)


def pd_lifetime(pd_12m: Column, stage: Column, factor: float) -> Column:
    return F.when(stage == 3, F.lit(1.0)).otherwise(F.least(F.lit(1.0), pd_12m * factor))


def lgd_ltv_adjusted(base: Column, ltv: Column) -> Column:
    tilt = F.when(ltv > 0.9, 1.2).when(ltv < 0.6, 0.8).otherwise(1.0)
    return clamp(base * tilt, 0.05, 0.95)


def ead_revolving(ccf: float = 0.75) -> Column:
    unused = F.col("loan_amount") - F.col("current_balance")
    drawn = F.when(F.col("loan_type").isin(*C.REVOLVING_TYPES), unused * ccf).otherwise(0.0)
    return F.col("current_balance") + drawn


def ecl_simple(stage: Column, ead: Column, lgd: Column, pd_12m: Column, pd_life: Column) -> Column:
    return ead * F.when(stage == 1, pd_12m).otherwise(pd_life) * lgd


def rating_scale(stage: Column, pd_12m: Column, score: Column) -> Column:
    by_score = at_least(score, C.LETTER_BY_SCORE, C.LETTER_BELOW)
    return F.when(stage == 3, F.lit(C.LETTER_DEFAULT)).otherwise(above(pd_12m, C.LETTER_BY_PD, by_score))


def rate_for_score(base: Column, score: Column) -> Column:
    return F.greatest(F.lit(0.1), base + at_least(score, C.RATE_ADJUSTMENTS, C.RATE_ADJUSTMENT_BELOW))


def transition_direction(from_stage: Column, to_stage: Column) -> Column:
    return lookup(F.signum(to_stage - from_stage).cast("int"), {1: "deteriorated", -1: "improved", 0: "unchanged"})


# -- report bands -----------------------------------------------------------


def stage_description(stage: Column) -> Column:
    return lookup(stage, C.STAGE_DESCRIPTIONS, "Unknown")


def stage_text(stage: Column) -> Column:
    return F.when(stage.isin(1, 2, 3), F.concat(F.lit("Stage "), stage.cast("string"))).otherwise(
        stage.cast("string")
    )


def dpd_bucket(dpd: Column) -> Column:
    named = F.when(dpd > 90, "90+ DPD").when(dpd > 30, "31-90 DPD").when(dpd >= 1, "1-30 DPD")
    return named.when(dpd == 0, "Current").otherwise("Unknown")


def score_band_5(score: Column) -> Column:
    return at_least(score, C.SCORE_BANDS_5, C.SCORE_BAND_BELOW)


def score_band_6(score: Column) -> Column:
    return at_least(score, C.SCORE_BANDS_6, C.SCORE_BAND_BELOW)


def npl_risk_level(npl_pct: Column) -> Column:
    return F.when(npl_pct <= 2.0, "Low Risk").when(npl_pct <= 5.0, "Moderate Risk").otherwise("High Risk")


def coverage_status(coverage_pct: Column) -> Column:
    return at_least(coverage_pct, ((2.0, "Well Covered"), (1.0, "Adequately Covered")), "Under Covered")


def quality_score(score: Column) -> Column:
    return at_least(score, ((800, 5), (700, 4), (600, 3), (500, 2)), 1)


def paydown() -> dict[str, Column]:
    paid = F.col("loan_amount") - F.col("current_balance")
    return {"principal_paid": paid, "paydown_ratio": F.try_divide(paid, F.col("loan_amount"))}


def seasoning(cfg: EclConfig = DEFAULTS) -> dict[str, Column]:
    today = F.lit(cfg.as_of_date)
    return {
        "months_on_books": months_between(today, F.col("origination_date")),
        "months_to_maturity": months_between(F.col("maturity_date"), today),
    }


def ltv_risk_bucket(ltv: Column) -> Column:
    return F.when(ltv > 0.8, "High Risk").when(ltv > 0.6, "Medium Risk").otherwise("Low Risk")


def risk_category(score: Column) -> Column:
    return at_least(score, ((750, "LOW"), (650, "MEDIUM")), "HIGH")


# -- closed-form PD and indicator staging -----------------------------------


def pd_closed_form(score: Column, dpd: Column, dti: Column) -> Column:
    by_score = at_least(score, C.PD_SCORE_FACTORS, C.PD_SCORE_FACTOR_BELOW)
    by_dpd = F.lit(1.0) + (dpd.cast("double") / 30.0) * 0.5
    by_dti = F.lit(1.0) + F.greatest(F.lit(0.0), (dti - 0.4) * 2.0)
    return F.least(F.lit(1.0), F.lit(0.02) * by_score * by_dpd * by_dti)


def risk_indicators(pd_: Column, original_score: Column, original_dti: Column) -> Column:
    named = {
        "high_pd": pd_ > 0.05,
        "credit_score_deterioration": (original_score - F.col("credit_score")) >= 100,
        "dti_increase": (F.col("dti_ratio") - original_dti) >= 0.2,
        "short_employment": F.col("employment_length") < 6,
    }
    return F.array_compact(F.array(*[F.when(hit(c), F.lit(n)) for n, c in named.items()]))


def stage_from_indicators(dpd: Column, indicators: Column) -> Column:
    worsened = (F.size(indicators) >= 2) | (dpd > 30)
    return F.greatest(F.lit(1), F.when(worsened, 2), F.when(dpd >= 90, 3))


# -- vocabularies -----------------------------------------------------------


def normalize_loan_type(raw: Column) -> Column:
    """Any known spelling to the canonical upper-case type; unknown values pass through upper-cased."""
    return lookup(raw, C.LOAN_TYPE_SYNONYMS, F.upper(F.translate(F.trim(raw), " -", "__")))


def normalize_stage_label(raw: Column) -> Column:
    digit = F.regexp_extract(raw.cast("string"), r"([123])\s*$", 1)
    return F.when(digit != "", F.concat(F.lit("STAGE_"), digit))


def one_hot(value: Column, vocabulary, prefix: str) -> dict[str, Column]:
    """Fixed-vocabulary indicators with slugged names."""
    return {
        f"{prefix}_{word.lower().replace(' ', '_')}": F.when(value == word, 1.0).otherwise(0.0)
        for word in vocabulary
    }


def exposure_weight(value: Column, weight: Column) -> Column:
    """Weighted mean aggregate."""
    return F.try_divide(F.sum(value * weight), F.sum(weight))


def score_as_double() -> Column:
    return dbl("credit_score")
