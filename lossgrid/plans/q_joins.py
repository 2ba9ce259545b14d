"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossgrid.operators import joins as J
from lossgrid.operators.scale import attach_group_stats
from lossgrid.plans.provisioning import process_portfolio
from lossgrid.plans.registry import query


@query(
    "join_latest_macro",
    """SELECT l.loan_id, m.gdp_growth, m.unemployment_rate, m.economic_cycle FROM {loans} l
       LEFT JOIN (SELECT *, row_number() OVER (ORDER BY date DESC) AS rn FROM {macro}) m ON m.rn=1""",
)
def _(t):
    return J.with_latest_macro(t.loans.select("loan_id"), t.macro, ["gdp_growth", "unemployment_rate", "economic_cycle"])


@query(
    "model_performance_snapshot",
    """SELECT loan_id, p.prediction_date, p.model_name, p.model_version, p.probability_default, p.predicted_stage,
         f.behaviour_score, f.utilisation_rate, f.delinquency_days
       FROM {predictions} p LEFT JOIN {features} f USING (loan_id, feature_set_version)""",
)
def _(t):
    return J.model_performance_snapshot(t.predictions, t.features)


@query(
    "exposure_by_stage_income",
    """SELECT stage, count(*) AS loan_count, avg(c.annual_income) AS avg_income, sum(current_balance) AS total_exposure
       FROM {staged} s JOIN {customers} c USING (customer_id) GROUP BY stage""",
    money="avg_income total_exposure",
)
def _(t):
    return J.exposure_by_stage_income(t.staged, t.customers)


@query(
    "join_group_means",
    """SELECT loan_id, loan_type, avg(current_balance) OVER (PARTITION BY loan_type) AS mean_balance, count(*) OVER (PARTITION BY loan_type) AS group_size
       FROM {loans}""",
    money="mean_balance",
)
def _(t):
    base = t.loans.select("loan_id", "loan_type", "current_balance")
    return attach_group_stats(
        base, ["loan_type"], F.avg("current_balance").alias("mean_balance"), F.count("*").alias("group_size")
    ).select("loan_id", "loan_type", "mean_balance", "group_size")


@query(
    "attach_predictions",
    """SELECT loan_id, predicted_stage AS ml_stage_prediction, confidence AS ml_stage_confidence, probability_default AS ml_pd_prediction
       FROM {predictions}""",
)
def _(t):
    return J.attach_predictions(t.loans, t.predictions).select(
        "loan_id", "ml_stage_prediction", "ml_stage_confidence", "ml_pd_prediction"
    )


@query(
    "ml_vs_rules",
    """SELECT s.loan_id, s.stage AS rule_stage, p.original_stage, p.predicted_stage, p.confidence, p.predicted_stage=s.stage AS agrees
       FROM {staged} s JOIN {predictions} p USING (loan_id)""",
)
def _(t):
    return J.ml_vs_rules(t.staged, t.predictions)


@query(
    "concat_horizontal",
    """SELECT loan_id, loan_amount, credit_score, loan_amount/customer_income AS debt_to_income,
         CAST(loan_type='MORTGAGE' AS INT) AS loan_type_mortgage, CAST(loan_type='AUTO' AS INT) AS loan_type_auto FROM {loans}""",
)
def _(t):
    base = ["loan_id", "loan_amount", "credit_score"]
    ratios = {"debt_to_income": F.try_divide("loan_amount", "customer_income")}
    dummies = {f"loan_type_{k.lower()}": (F.col("loan_type") == k).cast("int") for k in ("MORTGAGE", "AUTO")}
    return t.loans.select(*base, *[c.alias(n) for n, c in {**ratios, **dummies}.items()])


@query(
    "loan_payments",
    """SELECT loan_id, loan_type, line_no, l_partkey, l_suppkey, payment_date, actual_payment, payment_status, monthly_payment
       FROM {loans} JOIN {payments} USING (loan_id)""",
)
def _(t):
    return J.loan_payments(t.loans, t.payments).select(
        "loan_id", "loan_type", "line_no", "l_partkey", "l_suppkey", "payment_date", "actual_payment", "payment_status",
        "monthly_payment",
    )


@query(
    "payments_per_loan",
    """SELECT loan_id, count(*) AS n_payments, sum(scheduled_payment) AS scheduled_total, sum(actual_payment) AS actual_total,
         count(*) FILTER (payment_status='MISSED') AS n_missed, max(days_late) AS max_days_late FROM {payments} GROUP BY loan_id""",
    cents="scheduled_total actual_total",
)
def _(t):
    return J.payment_totals(t.payments)


@query(
    "loans_without_payments",
    "SELECT loan_id, loan_type FROM {loans} l WHERE NOT EXISTS (SELECT 1 FROM {payments} p WHERE p.loan_id=l.loan_id)",
)
def _(t):
    return J.loans_without_payments(t.loans.select("loan_id", "loan_type"), t.payments)


@query(
    "macro_asof",
    """SELECT l.loan_id, l.origination_date, m.date AS macro_date, m.gdp_growth, m.unemployment_rate
       FROM {loans} l ASOF LEFT JOIN {macro} m ON l.origination_date >= m.date""",
)
def _(t):
    return J.macro_asof(t.loans.select("loan_id", "origination_date"), t.macro, ["gdp_growth", "unemployment_rate"]).select(
        "loan_id", "origination_date", "macro_date", "gdp_growth", "unemployment_rate"
    )


@query(
    "hybrid_portfolio",
    "SELECT calculated_stage, count(*) AS loan_count, avg(stage_confidence) AS avg_confidence FROM {hybrid} GROUP BY calculated_stage",
    ratio="avg_confidence",
)
def _(t):
    df = process_portfolio(J.attach_predictions(t.loans, t.predictions), model=True)
    return df.groupBy("calculated_stage").agg(
        F.count("*").alias("loan_count"), F.avg("stage_confidence").alias("avg_confidence")
    )
