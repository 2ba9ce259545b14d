"""Feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossgrid import config as C
from lossgrid.functions import features as X
from lossgrid.functions.portfolio import one_hot
from lossgrid.operators import features as FE
from lossgrid.plans.registry import query

TYPE_FLAGS = ", ".join(f"CAST(loan_type='{k}' AS INT) AS loan_type_{k.lower()}" for k in C.LOAN_TYPES)
JOB_FLAGS = ", ".join(f"CAST(employment_status='{k}' AS INT) AS employment_{k.lower()}" for k in FE.EMPLOYMENT)


@query(
    "features_basic",
    f"""SELECT loan_id, loan_amount, interest_rate, term_months, current_balance, credit_score, days_past_due, customer_income,
         coalesce(ltv_ratio, (SELECT quantile_cont(ltv_ratio, 0.5) FROM {{loans}})) AS ltv_ratio, loan_amount/customer_income AS debt_to_income,
         monthly_payment/customer_income*12 AS payment_burden, current_balance/loan_amount AS utilization_rate,
         datediff('day', origination_date, DATE '2001-12-31')/30.44E0 AS loan_age_months, {TYPE_FLAGS}, {JOB_FLAGS}
       FROM {{loans}} JOIN (SELECT customer_id, employment_status FROM {{customers}}) c USING (customer_id)""",
    ratio="ltv_ratio debt_to_income payment_burden utilization_rate loan_age_months",
)
def _(t):
    return FE.features_basic(t.loans, t.customers)


@query(
    "features_missing_defaults",
    """SELECT loan_id, greatest(30000.0E0, abs(loan_amount)*1.5E0) AS customer_income,
         loan_amount/term_months*(1+interest_rate/12.0E0) AS monthly_payment FROM {loans}""",
)
def _(t):
    bare = t.loans.drop("customer_income", "monthly_payment")
    return FE.features_missing_defaults(bare).select("loan_id", "customer_income", "monthly_payment")


@query(
    "features_flags",
    """SELECT loan_id, CAST(days_past_due>90 AS INT) AS is_90_dpd, CAST(coalesce(ltv_ratio>0.8E0, false) AS INT) AS high_ltv,
         CAST(credit_score<600 AS INT) AS subprime, interest_rate*loan_amount AS annual_interest_cost, days_past_due/30.0E0 AS months_past_due,
         credit_score*ltv_ratio AS score_ltv_interaction, customer_income/loan_amount AS income_loan_ratio FROM {loans}""",
)
def _(t):
    return t.loans.select("loan_id", *[c.alias(n) for n, c in X.flags().items()])


@query(
    "features_ratios",
    """SELECT loan_id, (customer_income/12.0E0)/(monthly_payment+1e-8) AS debt_service_coverage, current_balance/(loan_amount+1e-8) AS loan_utilization,
         (monthly_payment*12)/(customer_income+1e-8) AS payment_to_income, credit_score/ln(1+loan_amount) AS credit_score_per_amount,
         interest_rate-0.02E0 AS interest_rate_spread, least(1.0E0, greatest(0.0E0, employment_length/60.0E0)) AS employment_stability FROM {loans}""",
    ratio="debt_service_coverage loan_utilization payment_to_income credit_score_per_amount",
)
def _(t):
    return t.loans.select("loan_id", *[c.alias(n) for n, c in X.ratios(t.loans.columns).items()])


@query(
    "features_interactions",
    "SELECT loan_id, "
    + ", ".join(
        f"CAST({a} AS DOUBLE)*CAST({b} AS DOUBLE) AS {a}_x_{b}, CAST({a} AS DOUBLE)/({b}+1e-8::DOUBLE) AS {a}_div_{b}" for a, b in X.INTERACTIONS
    )
    + " FROM {loans}",
)
def _(t):
    return t.loans.select("loan_id", *[c.alias(n) for n, c in X.interactions(t.loans.columns).items()])


@query(
    "features_temporal",
    """SELECT loan_id, CAST(year(origination_date) AS INT) AS origination_year, CAST(month(origination_date) AS INT) AS origination_month,
         CAST(quarter(origination_date) AS INT) AS origination_quarter, CAST(dayofyear(origination_date) AS INT) AS origination_day_of_year,
         datediff('day', origination_date, DATE '2001-12-31')/30.44E0 AS loan_age_months, CAST(quarter(origination_date)=4 AS INT) AS is_q4_origination FROM {loans}""",
    ratio="loan_age_months",
)
def _(t):
    return t.loans.select("loan_id", *[c.alias(n) for n, c in X.temporal().items()])


@query(
    "features_polynomial",
    """SELECT loan_id, CAST(credit_score AS DOUBLE)*credit_score AS credit_score_poly_2, CAST(credit_score AS DOUBLE)*credit_score*credit_score AS credit_score_poly_3,
         dti_ratio*dti_ratio AS dti_ratio_poly_2, dti_ratio*dti_ratio*dti_ratio AS dti_ratio_poly_3,
         loan_amount*loan_amount AS loan_amount_poly_2, loan_amount*loan_amount*loan_amount AS loan_amount_poly_3 FROM {loans}""",
)
def _(t):
    return t.loans.select("loan_id", *[c.alias(n) for n, c in X.polynomials(3).items()])


@query(
    "impute",
    """SELECT loan_id, coalesce(ltv_ratio, (SELECT avg(ltv_ratio) FROM {loans})) AS ltv_mean, coalesce(ltv_ratio, (SELECT quantile_cont(ltv_ratio, 0.5) FROM {loans})) AS ltv_median,
         coalesce(ltv_ratio, 0.0E0) AS ltv_zero FROM {loans}""",
    ratio="ltv_mean ltv_median ltv_zero",
)
def _(t):
    base = t.loans.select("loan_id", *[F.col("ltv_ratio").alias(f"ltv_{s}") for s in ("mean", "median", "zero")])
    for s in ("mean", "median", "zero"):
        base = FE.impute(base, [f"ltv_{s}"], s)
    return base


@query(
    "categorical_levels",
    """SELECT level, count(*) AS n, any_value(level_index) AS level_index FROM (
         SELECT CASE WHEN loan_type IN (SELECT DISTINCT loan_type FROM {loans}) THEN loan_type ELSE '__other__' END AS level,
           CAST(CASE WHEN loan_type IN (SELECT DISTINCT loan_type FROM {loans})
             THEN (SELECT count(DISTINCT loan_type) FROM {loans} l WHERE l.loan_type < d.loan_type)
             ELSE 1+(SELECT count(DISTINCT loan_type) FROM {loans}) END AS INT) AS level_index
         FROM {loans_dirty} d) q GROUP BY level""",
)
def _(t):
    levels = FE.categorical_levels(t.loans, "loan_type")
    mapped = FE.apply_levels(t.loans_dirty, "loan_type", levels)
    return mapped.groupBy(F.col("loan_type_level").alias("level"), F.col("loan_type_index").alias("level_index")).agg(
        F.count("*").alias("n")
    )


Z = ("loan_amount", "interest_rate", "credit_score", "dti_ratio")


@query(
    "preprocess_scale_onehot",
    "SELECT loan_id, "
    + ", ".join(f"CAST(loan_type='{k}' AS INT) AS loan_type_{k.lower()}" for k in C.LOAN_TYPES[1:])
    + ", "
    + ", ".join(f"({c}-avg({c}) OVER ())/stddev_pop({c}) OVER () AS {c}_z" for c in Z)
    + " FROM {loans}",
    ratio=" ".join(f"{c}_z" for c in Z),
)
def _(t):
    return FE.preprocess(t.loans, Z, {"loan_type": C.LOAN_TYPES}, "loan_id")


PRODUCT_OF = {
    "MORTGAGE": "Hipoteca Residencial", "AUTO": "Préstamo Vehículo", "PERSONAL": "Préstamo Personal",
    "CREDIT_CARD": "Tarjeta de Crédito", "BUSINESS": "Préstamo Empresarial", "LINE_OF_CREDIT": "Línea de Crédito",
}
REGION_OF = {"EUROPE": "Madrid", "ASIA": "Cataluña", "AMERICA": "País Vasco", "AFRICA": "Castilla y León", "MIDDLE EAST": "Aragón"}


def _encode_sql() -> str:
    product = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PRODUCT_OF.items())
    region = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in REGION_OF.items())
    cols = [
        f"CASE WHEN {c}='{w}' THEN 1.0E0 ELSE 0.0E0 END AS \"{p}_{w.lower().replace(' ', '_')}\""
        for c, p, words in (("producto", "product", C.PRODUCTS_ENCODED), ("zona", "region", C.REGIONS_ENCODED))
        for w in words
    ]
    return f"SELECT loan_id, {', '.join(cols)} FROM (SELECT loan_id, CASE loan_type {product} END AS producto, CASE region {region} END AS zona FROM {{loans}}) q"


@query("encode_product_region", _encode_sql())
def _(t):
    from lossgrid.functions.expr import lookup

    named = t.loans.select(
        "loan_id", lookup(F.col("loan_type"), PRODUCT_OF).alias("producto"), lookup(F.col("region"), REGION_OF).alias("zona")
    )
    hot = one_hot(F.col("producto"), C.PRODUCTS_ENCODED, "product") | one_hot(F.col("zona"), C.REGIONS_ENCODED, "region")
    return named.select("loan_id", *[c.alias(n) for n, c in hot.items()])
