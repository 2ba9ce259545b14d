"""Model features as ``Column`` expressions; a feature set is a dict name -> Column."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lossgrid.config import DEFAULTS, EclConfig
from lossgrid.functions.expr import clamp, flag

TINY = 1e-8

INTERACTIONS = (
    ("credit_score", "dti_ratio"),
    ("credit_score", "days_past_due"),
    ("loan_amount", "credit_score"),
    ("interest_rate", "credit_score"),
    ("employment_length", "dti_ratio"),
    ("current_balance", "days_past_due"),
)
POLYNOMIALS = ("credit_score", "dti_ratio", "loan_amount")
BASE = (
    "loan_amount", "interest_rate", "term_months", "current_balance", "credit_score", "days_past_due",
    "customer_income", "ltv_ratio",
)


def age_months(cfg: EclConfig = DEFAULTS) -> Column:
    return F.datediff(F.lit(cfg.as_of_date), F.col("origination_date")) / 30.44


def burden() -> dict[str, Column]:
    income = F.col("customer_income")
    return {
        "debt_to_income": F.try_divide("loan_amount", income),
        "payment_burden": F.try_divide("monthly_payment", income) * 12.0,
        "utilization_rate": F.try_divide("current_balance", "loan_amount"),
    }


def dummies(column: str, values: Iterable[str], prefix: str) -> dict[str, Column]:
    return {f"{prefix}_{v.lower()}": flag(F.col(column) == v) for v in values}


def default_income(median_amount: Column) -> Column:
    """Income estimate for portfolios that do not carry one."""
    return F.greatest(F.lit(30000.0), F.coalesce(F.abs("loan_amount"), median_amount) * 1.5)


def default_payment() -> Column:
    """Payment estimate before the median fallback; missing terms count as 36 months, rates as 0.05."""
    term = F.coalesce(F.when(F.col("term_months") != 0, F.col("term_months")), F.lit(36))
    rate = F.coalesce("interest_rate", F.lit(0.05))
    return F.try_divide(F.coalesce("loan_amount", F.lit(0.0)), term.cast("double")) * (F.lit(1.0) + rate / 12.0)


def flags() -> dict[str, Column]:
    return {
        "is_90_dpd": flag(F.col("days_past_due") > 90),
        "high_ltv": flag(F.col("ltv_ratio") > 0.8),
        "subprime": flag(F.col("credit_score") < 600),
        "annual_interest_cost": F.col("interest_rate") * F.col("loan_amount"),
        "months_past_due": F.col("days_past_due") / 30.0,
        "score_ltv_interaction": F.col("credit_score") * F.col("ltv_ratio"),
        "income_loan_ratio": F.try_divide("customer_income", "loan_amount"),
    }


def _present(needs: dict[str, tuple[tuple[str, ...], Column]], columns: Iterable[str] | None) -> dict[str, Column]:
    have = None if columns is None else set(columns)
    return {n: c for n, (used, c) in needs.items() if have is None or have.issuperset(used)}


def ratios(columns: Iterable[str] | None = None) -> dict[str, Column]:
    """Financial ratios, as far as the given columns allow."""
    def over(a: Column, b: str) -> Column:
        return a / (F.col(b) + TINY)

    return _present(
        {
            "debt_service_coverage": (("customer_income", "monthly_payment"), over(F.col("customer_income") / 12.0, "monthly_payment")),
            "loan_utilization": (("current_balance", "loan_amount"), over(F.col("current_balance"), "loan_amount")),
            "payment_to_income": (("monthly_payment", "customer_income"), over(F.col("monthly_payment") * 12.0, "customer_income")),
            "credit_score_per_amount": (("credit_score", "loan_amount"), F.try_divide(F.col("credit_score"), F.log1p("loan_amount"))),
            "interest_rate_spread": (("interest_rate",), F.col("interest_rate") - 0.02),
            "employment_stability": (("employment_length",), clamp(F.col("employment_length") / 60.0, 0.0, 1.0)),
        },
        columns,
    )


def interactions(columns: Iterable[str] | None = None) -> dict[str, Column]:
    needs = {}
    for a, b in INTERACTIONS:
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        needs[f"{a}_x_{b}"] = ((a, b), x * y)
        needs[f"{a}_div_{b}"] = ((a, b), x / (y + TINY))
    return _present(needs, columns)


def temporal(cfg: EclConfig = DEFAULTS) -> dict[str, Column]:
    d = F.col("origination_date")
    return {
        "origination_year": F.year(d),
        "origination_month": F.month(d),
        "origination_quarter": F.quarter(d),
        "origination_day_of_year": F.dayofyear(d),
        "loan_age_months": age_months(cfg),
        "is_q4_origination": flag(F.quarter(d) == 4),
    }


def polynomials(degree: int) -> dict[str, Column]:
    """Powers 2..degree as repeated products (exact, and cheaper than ``pow``)."""
    out = {}
    for c in POLYNOMIALS:
        x = F.col(c).cast("double")
        power = x
        for k in range(2, degree + 1):
            power = power * x
            out[f"{c}_poly_{k}"] = power
    return out
