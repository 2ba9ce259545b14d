"""Scenario and stress queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossgrid import config as C
from lossgrid.operators import stress as X
from lossgrid.plans.registry import query

SCENARIOS = ", ".join(f"('{n}', {m}E0)" for n, (_, _, m) in C.SCENARIOS.items())


@query(
    "stress_pd",
    f"""SELECT scenario, calculated_stage, count(*) AS loan_count, avg(least(1.0E0, calculated_pd*m)) AS avg_stressed_pd,
         sum(calculated_ead*calculated_lgd*least(1.0E0, calculated_pd*m)) AS stressed_ecl
       FROM {{results}} CROSS JOIN (VALUES {SCENARIOS}) v(scenario, m) GROUP BY scenario, calculated_stage""",
    money="stressed_ecl",
    ratio="avg_stressed_pd",
)
def _(t):
    return X.stress_pd(t.results)


@query(
    "stress_pd_per_loan",
    f"""SELECT loan_id, scenario, least(1.0E0, calculated_pd*m) AS stressed_pd, calculated_ead*calculated_lgd*least(1.0E0, calculated_pd*m) AS stressed_ecl
       FROM {{results}} CROSS JOIN (VALUES {SCENARIOS}) v(scenario, m)""",
)
def _(t):
    multipliers = {n: m for n, (_, _, m) in C.SCENARIOS.items()}
    return X.per_scenario(t.results, multipliers).select("loan_id", "scenario", "stressed_pd", "stressed_ecl")


def _weighted_sql() -> str:
    parts = {n: C.SCENARIOS[C.WEIGHTED_SCENARIOS[n]][2] for n in C.SCENARIO_WEIGHTS}
    sums = {n: f"sum(calculated_ead*calculated_lgd*least(1.0E0, calculated_pd*{m}E0))" for n, m in parts.items()}
    total = "+".join(f"{C.SCENARIO_WEIGHTS[n]}E0*{s}" for n, s in sums.items())
    return f"SELECT calculated_stage, {', '.join(f'{s} AS ecl_{n}' for n, s in sums.items())}, {total} AS weighted_ecl FROM {{results}} GROUP BY calculated_stage"


@query("scenario_weighted_ecl", _weighted_sql(), money="ecl_base ecl_adverse ecl_severe_adverse weighted_ecl")
def _(t):
    return X.scenario_weighted_ecl(t.results)


@query(
    "stress_ltv",
    """SELECT loan_id, ltv_ratio,
         CASE loan_type WHEN 'MORTGAGE' THEN greatest(0.2E0, 1-rec) WHEN 'AUTO' THEN greatest(0.25E0, 1-rec*0.9E0) WHEN 'PERSONAL' THEN greatest(0.45E0, 1-rec*0.5E0)
           WHEN 'CREDIT_CARD' THEN greatest(0.7E0, 1-rec*0.3E0) ELSE greatest(0.6E0, 1-rec*0.4E0) END AS stressed_lgd,
         CASE WHEN days_past_due>=90 THEN 'STAGE_3' WHEN days_past_due>=30 OR credit_score<=650 OR ltv_ratio>0.95E0 OR credit_score_change < -100 OR dti_ratio>0.45E0
           THEN 'STAGE_2' ELSE 'STAGE_1' END AS stressed_stage
       FROM (SELECT loan_id, loan_type, days_past_due, credit_score, credit_score_change, dti_ratio, CASE WHEN cv>0 THEN loan_amount/cv END AS ltv_ratio,
               CASE WHEN cv>0 THEN least(0.95E0, cv/current_balance) ELSE 0.0E0 END AS rec
             FROM (SELECT l.*, collateral_value*0.85E0 AS cv FROM {loans} l) a) b""",
    ratio="ltv_ratio stressed_lgd",
)
def _(t):
    return X.stress_ltv(t.loans).select("loan_id", "ltv_ratio", "stressed_lgd", "stressed_stage")


@query(
    "fx_convert",
    """SELECT loan_id, currency, loan_amount*rate AS loan_amount_base, current_balance*rate AS current_balance_base
       FROM (SELECT loan_id, loan_amount, current_balance, CASE CAST(substr(loan_id,2) AS BIGINT)%5 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' WHEN 2 THEN 'GBP' WHEN 3 THEN 'CAD' ELSE 'AUD' END AS currency FROM {loans}) l
       JOIN (VALUES ('EUR', 1.0E0), ('USD', 0.9E0), ('GBP', 1.15E0), ('CAD', 0.68E0), ('AUD', 0.6E0)) r(cur, rate) ON cur=currency""",
)
def _(t):
    return X.fx_convert(with_currency(t.loans), ["loan_amount", "current_balance"]).select(
        "loan_id", "currency", "loan_amount_base", "current_balance_base"
    )


def with_currency(loans):
    code = F.element_at(F.array(*[F.lit(c) for c in C.CURRENCIES]), (F.expr("substring(loan_id, 2)").cast("long") % 5 + 1).cast("int"))
    return loans.withColumn("currency", code)


@query(
    "boundary_cases",
    """SELECT loan_id, edges, stage FROM (SELECT loan_id, stage, concat_ws(',', CASE WHEN days_past_due IN (29,30,89,90) THEN 'dpd_' || days_past_due END,
         CASE WHEN credit_score IN (499,500,501,650,651) THEN 'score_' || credit_score END, CASE WHEN ltv_ratio BETWEEN 0.94E0 AND 0.96E0 THEN 'ltv_edge' END) AS edges
       FROM {staged}) q WHERE edges<>''""",
)
def _(t):
    return X.boundary_cases(t.loans)


@query(
    "segment_and_stage_mix",
    """SELECT 'stage' AS dimension, stage AS value, count(*) AS n, count(*)/sum(count(*)) OVER () AS observed,
         CASE stage WHEN 'STAGE_1' THEN 0.85E0 WHEN 'STAGE_2' THEN 0.12E0 ELSE 0.03E0 END AS target,
         count(*)/sum(count(*)) OVER () - CASE stage WHEN 'STAGE_1' THEN 0.85E0 WHEN 'STAGE_2' THEN 0.12E0 ELSE 0.03E0 END AS gap FROM {staged} GROUP BY stage
       UNION ALL SELECT 'sector', sector, count(*), count(*)/sum(count(*)) OVER (), 0.2E0, count(*)/sum(count(*)) OVER ()-0.2E0 FROM {staged} GROUP BY sector""",
    ratio="observed gap",
)
def _(t):
    sectors = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    stages = X.mix_against_target(t.staged, "stage", {"STAGE_1": 0.85, "STAGE_2": 0.12, "STAGE_3": 0.03})
    return stages.unionByName(X.mix_against_target(t.staged, "sector", {s: 0.2 for s in sectors}))


@query(
    "seasonal_payment_miss",
    """SELECT CAST(month(payment_date) AS INT) AS month, stage, count(*) AS payments, count(*) FILTER (payment_status='MISSED') AS missed,
         count(*) FILTER (payment_status='MISSED')/count(*) AS miss_rate, CAST(month(payment_date) AS INT) IN (12,1,2) AS is_winter
       FROM {payments} JOIN (SELECT loan_id, stage FROM {staged}) s USING (loan_id) GROUP BY 1, 2, 6""",
    ratio="miss_rate",
)
def _(t):
    return X.seasonal_payment_miss(t.payments, t.staged)
