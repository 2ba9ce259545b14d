"""Row-level rule queries: every plan is one projection over the loan table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossgrid import config as C
from lossgrid.functions import portfolio as P
from lossgrid.functions import rules as R
from lossgrid.operators.joins import attach_predictions
from lossgrid.plans.provisioning import audit_columns, process_portfolio
from lossgrid.plans.registry import SQL_ONLY, query
from lossgrid.sources.schemas import (
    REQUIRED_LOAN_COLUMNS,
    require_columns,
    with_default_columns,
)

AS_OF = "DATE '2001-12-31'"

# Independent statement of the whole chain, used by the SQL side only.
SQL_ONLY["results"] = """
SELECT p.*,
  CASE WHEN s=1 THEN ecl_12_month WHEN s=2 THEN least(ecl_lifetime, calculated_lgd*calculated_ead) ELSE calculated_ead END AS calculated_ecl,
  CASE WHEN s=1 THEN ecl_12_month WHEN s=2 THEN least(ecl_lifetime, calculated_lgd*calculated_ead) ELSE calculated_ead END
    * CASE s WHEN 3 THEN 2.0E0 WHEN 2 THEN 1.3E0 ELSE 1.0E0 END AS ecl_stage_weighted
FROM (SELECT o.*,
    calculated_pd*calculated_lgd*calculated_ead*(discount_factor*forward_looking_adjustment) AS ecl_12_month,
    calculated_pd*calculated_lgd*calculated_ead*remaining_term_years*(discount_factor*forward_looking_adjustment) AS ecl_lifetime
  FROM (SELECT n.*, power(1.03E0, -remaining_term_years) AS discount_factor,
      1.0E0 + CASE WHEN loan_type IN ('MORTGAGE','AUTO') THEN 0.1E0 ELSE 0.0E0 END
        + CASE WHEN s>=2 THEN 0.15E0 ELSE 0.0E0 END + 0.05E0 AS forward_looking_adjustment
    FROM (SELECT m.*,
        CASE s WHEN 3 THEN 1.0E0
               WHEN 2 THEN least(0.99E0, greatest(0.05E0, (900-credit_score)/900.0E0))
               ELSE least(0.04E0, greatest(0.0005E0, (850-credit_score)/1700.0E0)) END AS calculated_pd,
        CASE loan_type WHEN 'MORTGAGE' THEN greatest(0.2E0, 1-recovery_rate*1.0E0)
                       WHEN 'AUTO' THEN greatest(0.25E0, 1-recovery_rate*0.9E0)
                       WHEN 'PERSONAL' THEN greatest(0.45E0, 1-recovery_rate*0.5E0)
                       WHEN 'CREDIT_CARD' THEN greatest(0.7E0, 1-recovery_rate*0.3E0)
                       ELSE greatest(0.6E0, 1-recovery_rate*0.4E0) END AS calculated_lgd,
        current_balance * CASE loan_type WHEN 'CREDIT_CARD' THEN 1.1E0 WHEN 'LINE_OF_CREDIT' THEN 0.75E0 ELSE 1.0E0 END AS calculated_ead,
        greatest(1.0E0/12, least(30.0E0, datediff('day', DATE '2001-12-31', maturity_date)/365.25E0)) AS remaining_term_years,
        CAST(0.8 AS DOUBLE) AS stage_confidence
      FROM (SELECT q.*, stage AS calculated_stage, CAST(substr(stage,7,1) AS INT) AS s,
          CASE WHEN collateral_value>0 THEN least(0.95E0, collateral_value/current_balance) ELSE 0.0E0 END AS recovery_rate
        FROM {staged} q) m) n) o) p
"""

STAGE_OF = "CAST(substr(stage,7,1) AS INT)"


# -- contracts and defaults --------------------------------------------------


@query("require_columns", f"SELECT {', '.join(REQUIRED_LOAN_COLUMNS)} FROM {{loans}}")
def _(t):
    return require_columns(t.loans, REQUIRED_LOAN_COLUMNS).select(*REQUIRED_LOAN_COLUMNS)


@query(
    "with_default_columns",
    """SELECT loan_id, DATE '2001-12-31' AS origination_date, DATE '2002-12-31' AS maturity_date,
         0.0E0 AS credit_score_change, 0.0E0 AS dti_ratio FROM {loans}""",
)
def _(t):
    bare = t.loans.select(*REQUIRED_LOAN_COLUMNS)
    return with_default_columns(bare).select(
        "loan_id", "origination_date", "maturity_date", "credit_score_change", "dti_ratio"
    )


# -- staging -----------------------------------------------------------------


@query(
    "stage_rule_based",
    """SELECT loan_id, CASE WHEN days_past_due>=90 THEN 'STAGE_3' WHEN days_past_due>=30 THEN 'STAGE_2'
         WHEN credit_score<500 OR ltv_ratio>0.95E0 THEN 'STAGE_2' ELSE 'STAGE_1' END AS rule_based_stage FROM {loans}""",
)
def _(t):
    return t.loans.select("loan_id", R.stage_label(R.arrears_severity()).alias("rule_based_stage"))


@query(
    "sicr_flags",
    """SELECT loan_id, coalesce(credit_score_change < -100, false) AS sicr_credit_score_decline,
         coalesce(ltv_ratio > 0.95E0, false) AS sicr_high_ltv, coalesce(dti_ratio > 0.45E0, false) AS sicr_high_dti FROM {loans}""",
)
def _(t):
    return t.loans.select("loan_id", *[c.alias(n) for n, c in R.sicr_flags().items()])


@query(
    "sicr_upgrade",
    """SELECT loan_id, CASE WHEN days_past_due>=90 THEN 'STAGE_3' WHEN days_past_due>=30 THEN 'STAGE_2'
         WHEN credit_score<500 OR ltv_ratio>0.95E0 THEN 'STAGE_2'
         WHEN credit_score_change < -100 OR dti_ratio>0.45E0 THEN 'STAGE_2' ELSE 'STAGE_1' END AS stage FROM {loans}""",
)
def _(t):
    return t.loans.select("loan_id", R.stage_label(R.sicr_severity()).alias("stage"))


@query(
    "stage_low_score_escalation",
    """SELECT loan_id, CASE WHEN days_past_due>=90 THEN 'STAGE_3' WHEN days_past_due>=30 THEN 'STAGE_2'
         WHEN credit_score<500 OR ltv_ratio>0.95E0 THEN 'STAGE_2'
         WHEN credit_score<=650 THEN 'STAGE_2' ELSE 'STAGE_1' END AS stage FROM {loans}""",
)
def _(t):
    return t.loans.select("loan_id", R.stage_label(R.low_score_severity(R.arrears_severity())).alias("stage"))


@query("stage_final", "SELECT loan_id, stage FROM {staged}")
def _(t):
    return t.loans.select("loan_id", R.stage_label(R.final_severity()).alias("stage"))


_HYBRID = """
SELECT l.loan_id, l.stage AS rule_based_stage, p.predicted_stage AS ml_stage_prediction, p.confidence,
  CASE WHEN p.confidence>=0.8E0 THEN p.predicted_stage
       WHEN p.predicted_stage=l.stage THEN l.stage
       WHEN p.predicted_stage='STAGE_3' OR l.stage='STAGE_3' THEN 'STAGE_3'
       WHEN p.predicted_stage='STAGE_2' OR l.stage='STAGE_2' THEN 'STAGE_2' ELSE 'STAGE_1' END AS calculated_stage,
  CASE WHEN p.predicted_stage=l.stage THEN greatest(p.confidence, 0.8E0) ELSE least(p.confidence, 0.6E0) END AS stage_confidence,
  p.probability_default, l.credit_score
FROM {staged} l JOIN {predictions} p USING (loan_id)
"""
SQL_ONLY["hybrid"] = _HYBRID


@query(
    "stage_hybrid",
    "SELECT loan_id, rule_based_stage, ml_stage_prediction, calculated_stage FROM {hybrid}",
)
def _(t):
    df = process_portfolio(attach_predictions(t.loans, t.predictions), model=True)
    return df.select("loan_id", "rule_based_stage", "ml_stage_prediction", "calculated_stage")


@query(
    "stage_confidence",
    """SELECT loan_id, stage_confidence, CAST(0.8 AS DOUBLE) AS rules_only_confidence,
         CAST(0.7 AS DOUBLE) AS fallback_confidence FROM {hybrid}""",
)
def _(t):
    df = process_portfolio(attach_predictions(t.loans, t.predictions), model=True)
    return df.select(
        "loan_id",
        "stage_confidence",
        F.lit(C.DEFAULTS.rules_confidence).alias("rules_only_confidence"),
        F.lit(C.DEFAULTS.fallback_confidence).alias("fallback_confidence"),
    )


# -- risk parameters ---------------------------------------------------------


@query("pd_rule_based", "SELECT loan_id, calculated_stage, calculated_pd FROM {results}")
def _(t):
    return t.results.select("loan_id", "calculated_stage", "calculated_pd")


@query(
    "pd_ml_bounded",
    """SELECT loan_id, CASE calculated_stage WHEN 'STAGE_3' THEN 1.0E0
         WHEN 'STAGE_2' THEN least(0.99E0, greatest(0.05E0, probability_default))
         ELSE least(0.04E0, greatest(0.0005E0, probability_default)) END AS calculated_pd FROM {hybrid}""",
)
def _(t):
    return process_portfolio(attach_predictions(t.loans, t.predictions), model=True).select(
        "loan_id", "calculated_pd"
    )


@query("recovery_rate", "SELECT loan_id, recovery_rate FROM {results}")
def _(t):
    return t.loans.select("loan_id", R.recovery_rate().alias("recovery_rate"))


@query("lgd_by_type", "SELECT loan_id, loan_type, calculated_lgd FROM {results}")
def _(t):
    return t.loans.select("loan_id", "loan_type", R.lgd(R.recovery_rate()).alias("calculated_lgd"))


@query("ead_ccf", "SELECT loan_id, loan_type, calculated_ead FROM {results}")
def _(t):
    return t.loans.select("loan_id", "loan_type", R.ead().alias("calculated_ead"))


@query(
    "base_ecl",
    "SELECT loan_id, calculated_pd*calculated_lgd*calculated_ead AS base_ecl_12_month FROM {results}",
)
def _(t):
    return t.results.select("loan_id", "base_ecl_12_month")


@query("remaining_term_years", "SELECT loan_id, remaining_term_years FROM {results}", ratio="remaining_term_years")
def _(t):
    return t.loans.select("loan_id", R.remaining_term_years().alias("remaining_term_years"))


@query("discount_factor", "SELECT loan_id, discount_factor FROM {results}", ratio="discount_factor")
def _(t):
    return t.loans.select("loan_id", R.discount_factor(R.remaining_term_years()).alias("discount_factor"))


@query(
    "forward_looking_adjustment",
    "SELECT loan_id, forward_looking_adjustment FROM {results}",
    ratio="forward_looking_adjustment",
)
def _(t):
    return t.results.select("loan_id", "forward_looking_adjustment")


@query(
    "ecl_12m_lifetime",
    "SELECT loan_id, ecl_12_month, ecl_lifetime FROM {results}",
    ratio="ecl_12_month ecl_lifetime",
)
def _(t):
    return t.results.select("loan_id", "ecl_12_month", "ecl_lifetime")


@query(
    "ecl_by_stage",
    "SELECT loan_id, calculated_stage, calculated_ecl FROM {results}",
    ratio="calculated_ecl",
)
def _(t):
    return t.results.select("loan_id", "calculated_stage", "calculated_ecl")


@query(
    "ecl_stage_weighted",
    "SELECT loan_id, calculated_stage, ecl_stage_weighted FROM {results}",
    ratio="ecl_stage_weighted",
)
def _(t):
    return t.results.select("loan_id", "calculated_stage", "ecl_stage_weighted")


@query(
    "provision_rate",
    "SELECT loan_id, calculated_ecl/nullif(current_balance,0) AS provision_rate FROM {results}",
    ratio="provision_rate",
)
def _(t):
    return t.results.select("loan_id", "provision_rate")


@query(
    "risk_rating_pd",
    """SELECT loan_id, CASE WHEN calculated_pd<0.005E0 THEN 'EXCELLENT' WHEN calculated_pd<0.01E0 THEN 'GOOD'
         WHEN calculated_pd<0.05E0 THEN 'FAIR' WHEN calculated_pd<0.2E0 THEN 'POOR' ELSE 'DEFAULT' END AS risk_rating FROM {results}""",
)
def _(t):
    return t.results.select("loan_id", "risk_rating")


@query(
    "watch_list",
    """SELECT loan_id, calculated_stage='STAGE_2' OR days_past_due>15 OR credit_score<550
         OR calculated_ecl/current_balance>0.1E0 OR stage_confidence<0.5E0 AS watch_list_flag FROM {results}""",
)
def _(t):
    return t.results.select("loan_id", "watch_list_flag")


@query(
    "model_reliability",
    """SELECT loan_id, CASE WHEN stage_confidence>=0.8E0 THEN 'HIGH' WHEN stage_confidence>=0.6E0 THEN 'MEDIUM' ELSE 'LOW' END
         AS model_reliability FROM {hybrid}""",
)
def _(t):
    return process_portfolio(attach_predictions(t.loans, t.predictions), model=True).select(
        "loan_id", "model_reliability"
    )


@query(
    "audit_columns",
    "SELECT loan_id, TIMESTAMP '2001-12-31 00:00:00' AS processing_timestamp, '1.0' AS config_version, false AS ml_enabled FROM {loans}",
)
def _(t):
    stamp = F.col("processing_timestamp").cast("timestamp_ntz").alias("processing_timestamp")
    return audit_columns(t.loans).select("loan_id", stamp, "config_version", "ml_enabled")


SQL_ONLY["rated"] = """
SELECT r.*, CASE WHEN calculated_pd<0.005E0 THEN 'EXCELLENT' WHEN calculated_pd<0.01E0 THEN 'GOOD'
         WHEN calculated_pd<0.05E0 THEN 'FAIR' WHEN calculated_pd<0.2E0 THEN 'POOR' ELSE 'DEFAULT' END AS risk_rating
FROM {results} r
"""


@query(
    "process_portfolio",
    """SELECT loan_id, calculated_stage, calculated_pd, calculated_lgd, calculated_ead, discount_factor,
         forward_looking_adjustment, calculated_ecl, calculated_ecl/current_balance AS provision_rate, risk_rating,
         calculated_stage='STAGE_2' OR days_past_due>15 OR credit_score<550
           OR calculated_ecl/current_balance>0.1E0 OR stage_confidence<0.5E0 AS watch_list_flag,
         'HIGH' AS model_reliability, '1.0' AS config_version, false AS ml_enabled FROM {rated}""",
    ratio="calculated_pd calculated_lgd calculated_ead discount_factor forward_looking_adjustment calculated_ecl provision_rate",
)
def _(t):
    return t.results.select(
        "loan_id", "calculated_stage", "calculated_pd", "calculated_lgd", "calculated_ead", "discount_factor",
        "forward_looking_adjustment", "calculated_ecl", "provision_rate", "risk_rating", "watch_list_flag",
        "model_reliability", "config_version", "ml_enabled",
    )


# -- loan metrics ------------------------------------------------------------


@query(
    "annuity_payment",
    """SELECT loan_id, CASE WHEN interest_rate>0 THEN loan_amount*((interest_rate/100.0E0/12.0E0)*power(1+interest_rate/100.0E0/12.0E0, term_months))
         /(power(1+interest_rate/100.0E0/12.0E0, term_months)-1) ELSE loan_amount/term_months END AS annuity FROM {loans}""",
    ratio="annuity",
)
def _(t):
    value = P.annuity_payment(F.col("loan_amount"), F.col("interest_rate"), F.col("term_months"))
    return t.loans.select("loan_id", value.alias("annuity"))


@query(
    "maturity_from_term",
    "SELECT loan_id, origination_date + CAST(30*term_months AS INT) AS maturity FROM {loans}",
)
def _(t):
    return t.loans.select(
        "loan_id", P.maturity_from_term(F.col("origination_date"), F.col("term_months")).alias("maturity")
    )


@query(
    "ltv_dti",
    """SELECT loan_id, CASE WHEN collateral_value>0 THEN loan_amount/collateral_value END AS ltv,
         12*monthly_payment/nullif(customer_income,0) AS dti FROM {loans}""",
    ratio="ltv dti",
)
def _(t):
    return t.loans.select(
        "loan_id",
        P.loan_to_value(F.col("loan_amount"), F.col("collateral_value")).alias("ltv"),
        P.debt_to_income(F.col("monthly_payment"), F.col("customer_income")).alias("dti"),
    )


SQL_ONLY["numeric_stage"] = """
SELECT q.*, CASE WHEN days_past_due=0 AND triggers<2 THEN 1 WHEN days_past_due<=90 OR triggers>=2 THEN 2 ELSE 3 END AS stage_num
FROM (SELECT l.*, CASE WHEN credit_score<600 THEN 1 ELSE 0 END + CASE WHEN dti_ratio>0.45E0 THEN 1 ELSE 0 END
        + CASE WHEN employment_length<12 THEN 1 ELSE 0 END AS triggers FROM {loans} l) q
"""


@query("sicr_trigger_count", "SELECT loan_id, CAST(triggers AS INT) AS triggers, triggers>=2 AS sicr FROM {numeric_stage}")
def _(t):
    n = P.sicr_trigger_count()
    return t.loans.select("loan_id", n.alias("triggers"), (n >= 2).alias("sicr"))


@query("stage_numeric", "SELECT loan_id, CAST(stage_num AS INT) AS stage_num FROM {numeric_stage}")
def _(t):
    return t.loans.select(
        "loan_id", P.stage_numeric(F.col("days_past_due"), P.sicr_trigger_count()).alias("stage_num")
    )


@query(
    "pd_lifetime_adjust",
    """SELECT loan_id, pd_12m, CASE WHEN calculated_stage='STAGE_3' THEN 1.0E0 ELSE least(1.0E0, pd_12m*3.0E0) END AS pd_lifetime
       FROM (SELECT loan_id, calculated_stage, calculated_pd * CASE WHEN credit_score>=800 THEN 0.5E0 WHEN credit_score<500 THEN 2.0E0 ELSE 1.0E0 END AS pd_12m
             FROM {results}) q""",
    ratio="pd_12m pd_lifetime",
)
def _(t):
    adjusted = P.pd_score_adjusted(F.col("calculated_pd"), F.col("credit_score"))
    stage = R.stage_number(F.col("calculated_stage"))
    return t.results.select(
        "loan_id", adjusted.alias("pd_12m"), P.pd_lifetime(adjusted, stage, 3.0).alias("pd_lifetime")
    )


@query(
    "lgd_ltv_adjust",
    """SELECT loan_id, least(0.95E0, greatest(0.05E0, calculated_lgd * CASE WHEN ltv_ratio>0.9E0 THEN 1.2E0 WHEN ltv_ratio<0.6E0 THEN 0.8E0 ELSE 1.0E0 END)) AS lgd_adjusted
       FROM {results}""",
    ratio="lgd_adjusted",
)
def _(t):
    return t.results.select(
        "loan_id", P.lgd_ltv_adjusted(F.col("calculated_lgd"), F.col("ltv_ratio")).alias("lgd_adjusted")
    )


@query(
    "ead_revolving",
    """SELECT loan_id, current_balance + CASE WHEN loan_type IN ('CREDIT_CARD','LINE_OF_CREDIT') THEN 0.75E0*(loan_amount-current_balance) ELSE 0.0E0 END AS ead
       FROM {loans}""",
    ratio="ead",
)
def _(t):
    return t.loans.select("loan_id", P.ead_revolving().alias("ead"))


@query(
    "ecl_simple",
    """SELECT loan_id, calculated_ead*CASE WHEN calculated_stage='STAGE_1' THEN calculated_pd
         WHEN calculated_stage='STAGE_3' THEN 1.0E0 ELSE least(1.0E0, 3*calculated_pd) END*calculated_lgd AS ecl FROM {results}""",
)
def _(t):
    stage = R.stage_number(F.col("calculated_stage"))
    pd_ = F.col("calculated_pd")
    return t.results.select(
        "loan_id",
        P.ecl_simple(stage, F.col("calculated_ead"), F.col("calculated_lgd"), pd_, P.pd_lifetime(pd_, stage, 3.0)).alias("ecl"),
    )


@query(
    "rating_scale",
    """SELECT loan_id, CASE WHEN calculated_stage='STAGE_3' THEN 'D' WHEN calculated_pd>0.2E0 THEN 'CCC' WHEN calculated_pd>0.1E0 THEN 'CC'
         WHEN calculated_pd>0.05E0 THEN 'C' WHEN credit_score>=800 THEN 'AAA' WHEN credit_score>=750 THEN 'AA' WHEN credit_score>=700 THEN 'A'
         WHEN credit_score>=650 THEN 'BBB' WHEN credit_score>=600 THEN 'BB' ELSE 'B' END AS rating FROM {results}""",
)
def _(t):
    stage = R.stage_number(F.col("calculated_stage"))
    return t.results.select(
        "loan_id", P.rating_scale(stage, F.col("calculated_pd"), F.col("credit_score")).alias("rating")
    )


@query(
    "rate_score_adjustment",
    """SELECT loan_id, greatest(0.1E0, interest_rate + CASE WHEN credit_score>=800 THEN -0.5E0 WHEN credit_score>=700 THEN 0.0E0
         WHEN credit_score>=600 THEN 1.0E0 ELSE 2.5E0 END) AS adjusted_rate FROM {loans}""",
    ratio="adjusted_rate",
)
def _(t):
    return t.loans.select("loan_id", P.rate_for_score(F.col("interest_rate"), F.col("credit_score")).alias("adjusted_rate"))


@query(
    "transition_direction",
    """SELECT loan_id, transition_date, from_stage, to_stage,
         CASE WHEN from_stage<to_stage THEN 'deteriorated' WHEN from_stage>to_stage THEN 'improved' ELSE 'unchanged' END AS direction
       FROM {transitions}""",
)
def _(t):
    return t.transitions.select(
        "loan_id", "transition_date", "from_stage", "to_stage",
        P.transition_direction(F.col("from_stage"), F.col("to_stage")).alias("direction"),
    )


# -- report projections ------------------------------------------------------


@query(
    "portfolio_overview",
    """SELECT loan_id, CASE calculated_stage WHEN 'STAGE_1' THEN 'Stage 1 - Normal' WHEN 'STAGE_2' THEN 'Stage 2 - Significant Increase'
           WHEN 'STAGE_3' THEN 'Stage 3 - Credit Impaired' ELSE 'Unknown' END AS stage_description,
         CASE WHEN days_past_due=0 THEN 'Current' WHEN days_past_due BETWEEN 1 AND 30 THEN '1-30 DPD'
           WHEN days_past_due BETWEEN 31 AND 90 THEN '31-90 DPD' WHEN days_past_due>90 THEN '90+ DPD' ELSE 'Unknown' END AS dpd_bucket,
         CASE WHEN credit_score>=800 THEN 'Excellent (800+)' WHEN credit_score>=700 THEN 'Good (700-799)' WHEN credit_score>=600 THEN 'Fair (600-699)'
           WHEN credit_score>=500 THEN 'Poor (500-599)' ELSE 'Very Poor (<500)' END AS credit_score_band,
         loan_amount-current_balance AS principal_paid, (loan_amount-current_balance)/loan_amount AS paydown_ratio,
         calculated_ecl/current_balance AS ecl_rate,
         datediff('month', origination_date, DATE '2001-12-31') AS months_on_books,
         datediff('month', DATE '2001-12-31', maturity_date) AS months_to_maturity
       FROM {results} WHERE current_balance>0""",
    ratio="principal_paid paydown_ratio ecl_rate",
)
def _(t):
    ages = {n: c.cast("long") for n, c in P.seasoning().items()}
    return (
        t.results.where(F.col("current_balance") > 0)
        .select(
            "loan_id",
            P.stage_description(R.stage_number(F.col("calculated_stage"))).alias("stage_description"),
            P.dpd_bucket(F.col("days_past_due")).alias("dpd_bucket"),
            P.score_band_5(F.col("credit_score")).alias("credit_score_band"),
            *[c.alias(n) for n, c in P.paydown().items()],
            R.provision_rate(F.col("calculated_ecl")).alias("ecl_rate"),
            *[c.alias(n) for n, c in ages.items()],
        )
    )


@query(
    "credit_band_6",
    """SELECT loan_id, CASE WHEN credit_score>=900 THEN 'Excellent (900+)' WHEN credit_score>=800 THEN 'Very Good (800-899)'
         WHEN credit_score>=700 THEN 'Good (700-799)' WHEN credit_score>=600 THEN 'Fair (600-699)'
         WHEN credit_score>=500 THEN 'Poor (500-599)' ELSE 'Very Poor (<500)' END AS credit_band FROM {loans}""",
)
def _(t):
    return t.loans.select("loan_id", P.score_band_6(F.col("credit_score")).alias("credit_band"))


@query(
    "stage_label",
    f"SELECT loan_id, CASE {STAGE_OF} WHEN 1 THEN 'Stage 1' WHEN 2 THEN 'Stage 2' WHEN 3 THEN 'Stage 3' END AS stage_label FROM {{staged}}",
)
def _(t):
    return t.loans.select("loan_id", P.stage_text(R.final_severity()).alias("stage_label"))


@query(
    "dashboard_flags",
    """SELECT region, npl_ratio, ecl_coverage_ratio, avg_score,
         CASE WHEN npl_ratio<=2 THEN 'Low Risk' WHEN npl_ratio<=5 THEN 'Moderate Risk' ELSE 'High Risk' END AS risk_level,
         CASE WHEN ecl_coverage_ratio>=2 THEN 'Well Covered' WHEN ecl_coverage_ratio>=1 THEN 'Adequately Covered' ELSE 'Under Covered' END AS coverage_status,
         CAST(CASE WHEN avg_score>=800 THEN 5 WHEN avg_score>=700 THEN 4 WHEN avg_score>=600 THEN 3 WHEN avg_score>=500 THEN 2 ELSE 1 END AS INT) AS quality_score
       FROM (SELECT region, 100.0E0*sum(CASE WHEN days_past_due>90 THEN 1 ELSE 0 END)/count(*) AS npl_ratio,
               100.0E0*sum(calculated_ecl)/sum(current_balance) AS ecl_coverage_ratio, avg(credit_score) AS avg_score
             FROM {results} GROUP BY region) q""",
    ratio="npl_ratio ecl_coverage_ratio avg_score",
)
def _(t):
    from lossgrid.functions.expr import pct

    base = t.results.groupBy("region").agg(
        pct(F.count_if(F.col("days_past_due") > 90), F.count("*")).alias("npl_ratio"),
        pct(F.sum("calculated_ecl"), F.sum("current_balance")).alias("ecl_coverage_ratio"),
        F.avg("credit_score").alias("avg_score"),
    )
    return base.select(
        "*",
        P.npl_risk_level(F.col("npl_ratio")).alias("risk_level"),
        P.coverage_status(F.col("ecl_coverage_ratio")).alias("coverage_status"),
        P.quality_score(F.col("avg_score")).alias("quality_score"),
    )


# -- closed-form PD and indicators -------------------------------------------

SQL_ONLY["fallback"] = """
SELECT l.*, least(1.0E0, 0.02E0 * CASE WHEN credit_score>=800 THEN 0.5E0 WHEN credit_score>=700 THEN 1.0E0 WHEN credit_score>=600 THEN 1.5E0 ELSE 3.0E0 END
   * (1.0E0 + (days_past_due/30.0E0)*0.5E0) * (1.0E0 + greatest(0.0E0, (dti_ratio-0.4E0)*2.0E0))) AS pd_value
FROM {loans} l
"""

SQL_ONLY["indicated"] = """
SELECT q.*, CASE WHEN days_past_due>=90 THEN 3 WHEN i1+i2+i3+i4>=2 OR days_past_due>30 THEN 2 ELSE 1 END AS ind_stage
FROM (SELECT f.*, CASE WHEN pd_value>0.05E0 THEN 1 ELSE 0 END AS i1,
        CASE WHEN -credit_score_change>=100 THEN 1 ELSE 0 END AS i2,
        CASE WHEN dti_ratio-0.3E0>=0.2E0 THEN 1 ELSE 0 END AS i3,
        CASE WHEN employment_length<6 THEN 1 ELSE 0 END AS i4 FROM {fallback} f) q
"""


@query("pd_fallback", "SELECT loan_id, pd_value FROM {fallback}", ratio="pd_value")
def _(t):
    value = P.pd_closed_form(F.col("credit_score"), F.col("days_past_due"), F.col("dti_ratio"))
    return t.loans.select("loan_id", value.alias("pd_value"))


@query(
    "stage_by_indicators",
    """SELECT loan_id, CAST(ind_stage AS INT) AS stage_num, CAST(i1+i2+i3+i4 AS INT) AS n_indicators,
         concat_ws(',', CASE WHEN i1=1 THEN 'high_pd' END, CASE WHEN i2=1 THEN 'credit_score_deterioration' END,
           CASE WHEN i3=1 THEN 'dti_increase' END, CASE WHEN i4=1 THEN 'short_employment' END) AS indicators
       FROM {indicated}""",
)
def _(t):
    from lossgrid.operators.explain import with_indicator_stage

    return with_indicator_stage(t.loans).select(
        "loan_id", "stage_num", F.size("indicators").alias("n_indicators"), F.concat_ws(",", "indicators").alias("indicators")
    )


@query(
    "ltv_risk_bucket",
    """SELECT loan_id, CASE WHEN ltv_ratio>0.8E0 THEN 'High Risk' WHEN ltv_ratio>0.6E0 THEN 'Medium Risk' ELSE 'Low Risk' END AS risk_bucket,
         datediff('day', origination_date, maturity_date)/30.0E0 AS remaining_term_months, current_balance*(interest_rate/100.0E0)/12.0E0 AS monthly_payment_approx
       FROM {loans}""",
)
def _(t):
    return t.loans.select(
        "loan_id",
        P.ltv_risk_bucket(F.col("ltv_ratio")).alias("risk_bucket"),
        (F.datediff("maturity_date", "origination_date") / 30.0).alias("remaining_term_months"),
        (F.col("current_balance") * (F.col("interest_rate") / 100.0) / 12.0).alias("monthly_payment_approx"),
    )


@query(
    "risk_category_util",
    """SELECT loan_id, CASE WHEN credit_score>=750 THEN 'LOW' WHEN credit_score>=650 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_category,
         current_balance/loan_amount AS utilization_ratio, current_balance*calculated_pd*calculated_lgd AS ecl_amount FROM {results}""",
)
def _(t):
    return t.results.select(
        "loan_id",
        P.risk_category(F.col("credit_score")).alias("risk_category"),
        F.try_divide("current_balance", "loan_amount").alias("utilization_ratio"),
        (F.col("current_balance") * F.col("calculated_pd") * F.col("calculated_lgd")).alias("ecl_amount"),
    )


SQL_ONLY["horizon"] = """
SELECT r.*, CASE WHEN calculated_stage='STAGE_1' THEN 1.0E0 ELSE term_months/12.0E0 END AS time_horizon,
  current_balance*calculated_pd*calculated_lgd AS ecl_12m,
  current_balance*calculated_pd*calculated_lgd*CASE WHEN calculated_stage='STAGE_1' THEN 1.0E0 ELSE term_months/12.0E0 END AS ecl_life
FROM {results} r
"""


@query(
    "ecl_time_horizon",
    """SELECT loan_id, time_horizon, ecl_12m, ecl_life, CASE WHEN calculated_stage='STAGE_1' THEN ecl_12m ELSE ecl_life END AS ecl_final
       FROM {horizon}""",
)
def _(t):
    from lossgrid.operators.reports import with_horizon_ecl

    return with_horizon_ecl(t.results).select("loan_id", "time_horizon", "ecl_12m", "ecl_life", "ecl_final")


@query(
    "normalize_loan_type",
    """SELECT loan_id, CASE WHEN loan_type='LINE_OF_CREDIT' THEN 'line of credit' WHEN loan_type='MORTGAGE' THEN 'Hipoteca Residencial' ELSE lower(loan_type) END AS raw_type,
         loan_type FROM {loans}""",
)
def _(t):
    raw = (
        F.when(F.col("loan_type") == "LINE_OF_CREDIT", "line of credit")
        .when(F.col("loan_type") == "MORTGAGE", "Hipoteca Residencial")
        .otherwise(F.lower("loan_type"))
    )
    return t.loans.select("loan_id", raw.alias("raw_type")).select(
        "loan_id", "raw_type", P.normalize_loan_type(F.col("raw_type")).alias("loan_type")
    )


@query(
    "normalize_stage_label",
    """SELECT loan_id, CASE WHEN id%4=0 THEN 'Stage ' || substr(stage,7,1) WHEN id%4=1 THEN 'Stage' || substr(stage,7,1)
         WHEN id%4=2 THEN substr(stage,7,1) ELSE stage END AS raw_label, stage AS stage
       FROM (SELECT loan_id, stage, CAST(substr(loan_id,2) AS BIGINT) AS id FROM {staged}) q""",
)
def _(t):
    number = F.substring("stage", 7, 1)
    form = F.expr("substring(loan_id, 2)").cast("long") % 4
    raw = (
        F.when(form == 0, F.concat(F.lit("Stage "), number))
        .when(form == 1, F.concat(F.lit("Stage"), number))
        .when(form == 2, number)
        .otherwise(F.col("stage"))
    )
    return t.staged.select("loan_id", raw.alias("raw_label")).select(
        "loan_id", "raw_label", P.normalize_stage_label(F.col("raw_label")).alias("stage")
    )


@query("active_loans", "SELECT loan_id, current_balance FROM {loans} WHERE current_balance>0")
def _(t):
    return t.loans.where(F.col("current_balance") > 0).select("loan_id", "current_balance")


@query(
    "recent_loans",
    "SELECT loan_id, origination_date FROM {loans} WHERE origination_date >= DATE '2000-12-31'",
)
def _(t):
    since = F.add_months(F.lit(C.DEFAULTS.as_of_date), -12)
    return t.loans.where(F.col("origination_date") >= since).select("loan_id", "origination_date")


@query(
    "scalar_showcase",
    """SELECT loan_id, coalesce(ltv_ratio, 0.0E0) AS ltv_or_zero, ln(1+loan_amount) AS log_amount, abs(credit_score_change) AS abs_change,
         CAST(year(origination_date) AS INT) AS y, CAST(quarter(origination_date) AS INT) AS q, CAST(dayofyear(origination_date) AS INT) AS doy,
         regexp_matches(loan_id, '^L[0-9]{{6}}$') AS id_ok, replace(lower(loan_type), '_', ' ') AS pretty_type,
         contains(sector, 'BUILD') AS is_building, concat_ws('|', region, sector) AS segment,
         TRY_CAST(substr(loan_id, 2) AS BIGINT) AS id_num, TRY_CAST(region AS DOUBLE) AS not_a_number
       FROM {loans}""",
    ratio="log_amount",
)
def _(t):
    return t.loans.select(
        "loan_id",
        F.coalesce("ltv_ratio", F.lit(0.0)).alias("ltv_or_zero"),
        F.log1p("loan_amount").alias("log_amount"),
        F.abs("credit_score_change").alias("abs_change"),
        F.year("origination_date").alias("y"),
        F.quarter("origination_date").alias("q"),
        F.dayofyear("origination_date").alias("doy"),
        F.col("loan_id").rlike("^L[0-9]{6}$").alias("id_ok"),
        F.translate(F.lower("loan_type"), "_", " ").alias("pretty_type"),
        F.col("sector").contains("BUILD").alias("is_building"),
        F.concat_ws("|", "region", "sector").alias("segment"),
        F.expr("try_cast(substring(loan_id, 2) as bigint)").alias("id_num"),
        F.expr("try_cast(region as double)").alias("not_a_number"),
    )
