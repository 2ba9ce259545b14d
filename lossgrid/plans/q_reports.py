"""Portfolio report queries (aggregations)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossgrid import config as C
from lossgrid.functions import portfolio as P
from lossgrid.operators import reports as A
from lossgrid.operators.joins import attach_predictions
from lossgrid.plans.provisioning import process_portfolio
from lossgrid.plans.registry import query

N = "CAST(substr(calculated_stage,7,1) AS INT) AS provision_stage, 'Stage ' || substr(calculated_stage,7,1) AS provision_stage_label"
G = "GROUP BY calculated_stage"


@query(
    "summary_report",
    """SELECT count(*) AS total_loans, sum(calculated_ead) AS total_exposure, sum(calculated_ecl) AS total_ecl,
         sum(calculated_ecl)/sum(calculated_ead) AS coverage_ratio,
         count(*) FILTER (calculated_stage='STAGE_1') AS stage1_count, count(*) FILTER (calculated_stage='STAGE_2') AS stage2_count,
         count(*) FILTER (calculated_stage='STAGE_3') AS stage3_count,
         avg(calculated_pd) AS average_pd, avg(calculated_lgd) AS average_lgd, avg(calculated_ead) AS average_ead FROM {results}""",
    money="total_exposure total_ecl average_ead",
    ratio="coverage_ratio average_pd average_lgd",
)
def _(t):
    return A.summary_report(t.results)


@query(
    "stage_metrics",
    f"""SELECT calculated_stage, count(*) AS loan_count, sum(current_balance) AS exposure, sum(calculated_ecl) AS ecl, sum(calculated_ead) AS ead,
         avg(calculated_pd) AS avg_pd, avg(calculated_lgd) AS avg_lgd, avg(stage_confidence) AS avg_confidence FROM {{results}} {G}""",
    money="exposure ecl ead",
    ratio="avg_pd avg_lgd avg_confidence",
)
def _(t):
    return A.stage_metrics(t.results)


@query(
    "rating_metrics",
    "SELECT risk_rating, count(*) AS loan_count, avg(calculated_pd) AS avg_pd, sum(calculated_ecl) AS ecl FROM {rated} GROUP BY risk_rating",
    money="ecl",
    ratio="avg_pd",
)
def _(t):
    return A.rating_metrics(t.results)


@query(
    "ml_usage_metrics",
    """SELECT count(ml_stage_prediction) AS ml_predictions_used, count(*) FILTER (stage_confidence>=0.8E0) AS high_confidence_predictions,
         count(*) FILTER (ml_stage_prediction=rule_based_stage) AS ml_rule_agreement, avg(stage_confidence) AS avg_ml_confidence FROM {hybrid}""",
    ratio="avg_ml_confidence",
)
def _(t):
    return A.ml_usage_metrics(process_portfolio(attach_predictions(t.loans, t.predictions), model=True))


def dated(t):
    return t.results.withColumn("calculation_date", F.lit(C.DEFAULTS.as_of_date))


@query(
    "stage_distribution_view",
    """SELECT calculation_date, calculated_stage, region, loan_type, sector, count(*) AS loan_count, sum(current_balance) AS total_exposure,
         sum(calculated_ecl) AS total_ecl, avg(calculated_pd) AS avg_pd_12m, avg(calculated_lgd) AS avg_lgd, avg(credit_score) AS avg_credit_score,
         sum(calculated_ecl)/nullif(sum(current_balance),0) AS ecl_coverage_ratio,
         count(*) FILTER (days_past_due>0) AS delinquent_count, count(*) FILTER (days_past_due>90) AS npl_count,
         sum(current_balance*calculated_pd)/nullif(sum(current_balance),0) AS portfolio_weighted_pd
       FROM {results} WHERE current_balance>0 GROUP BY calculation_date, calculated_stage, region, loan_type, sector""",
    money="total_ecl",
    cents="total_exposure",
    ratio="avg_pd_12m avg_lgd avg_credit_score ecl_coverage_ratio portfolio_weighted_pd",
)
def _(t):
    return A.stage_distribution(dated(t))


@query(
    "regional_risk",
    """SELECT region, count(*) AS total_loans, sum(current_balance) AS total_exposure, avg(loan_amount) AS avg_loan_amount,
         avg(current_balance) AS avg_current_balance, avg(credit_score) AS avg_credit_score, avg(calculated_pd) AS avg_pd_12m,
         avg(calculated_lgd) AS avg_lgd, sum(calculated_ecl) AS total_ecl, sum(calculated_ecl)/nullif(sum(current_balance),0) AS ecl_coverage_ratio,
         count(*) FILTER (calculated_stage='STAGE_1') AS stage1_count, count(*) FILTER (calculated_stage='STAGE_2') AS stage2_count,
         count(*) FILTER (calculated_stage='STAGE_3') AS stage3_count,
         100.0E0*count(*) FILTER (calculated_stage='STAGE_1')/count(*) AS stage1_pct, 100.0E0*count(*) FILTER (calculated_stage='STAGE_2')/count(*) AS stage2_pct,
         100.0E0*count(*) FILTER (calculated_stage='STAGE_3')/count(*) AS stage3_pct,
         count(*) FILTER (days_past_due>0) AS delinquent_loans, count(*) FILTER (days_past_due>90) AS npl_loans,
         100.0E0*count(*) FILTER (days_past_due>90)/count(*) AS npl_ratio, max(current_balance) AS largest_exposure,
         stddev_samp(current_balance) AS exposure_volatility, any_value(m.gdp_growth) AS gdp_growth,
         any_value(m.unemployment_rate) AS unemployment_rate, any_value(m.economic_cycle) AS economic_cycle
       FROM {results} r LEFT JOIN (SELECT *, row_number() OVER (ORDER BY date DESC) AS rn FROM {macro}) m ON m.rn=1
       WHERE current_balance>0 GROUP BY region""",
    money="total_exposure avg_loan_amount avg_current_balance total_ecl largest_exposure exposure_volatility",
    ratio="avg_credit_score avg_pd_12m avg_lgd ecl_coverage_ratio stage1_pct stage2_pct stage3_pct npl_ratio",
)
def _(t):
    return A.regional_risk(t.results, t.macro)


@query(
    "product_performance",
    """SELECT loan_type, sector, count(*) AS loan_count, sum(loan_amount) AS total_originated, sum(current_balance) AS current_exposure,
         avg(loan_amount) AS avg_loan_size, avg(interest_rate) AS avg_interest_rate, sum(loan_amount-current_balance) AS total_principal_collected,
         avg(credit_score) AS avg_credit_score, avg(calculated_pd) AS avg_pd_12m, avg(calculated_lgd) AS avg_lgd, sum(calculated_ecl) AS total_ecl,
         sum(calculated_ecl)/nullif(sum(current_balance),0) AS ecl_rate,
         100.0E0*count(*) FILTER (calculated_stage='STAGE_3')/count(*) AS default_rate, 100.0E0*count(*) FILTER (days_past_due>30)/count(*) AS delinquency_rate,
         avg(days_past_due) AS avg_days_past_due, 100.0E0*count(*) FILTER (credit_score>=700)/count(*) AS prime_percentage,
         100.0E0*count(*) FILTER (credit_score<600)/count(*) AS subprime_percentage, avg(term_months) AS avg_term_months,
         avg(datediff('month', DATE '2001-12-31', maturity_date)) AS avg_months_to_maturity
       FROM {results} WHERE current_balance>0 GROUP BY loan_type, sector""",
    money="total_originated current_exposure avg_loan_size total_principal_collected total_ecl",
    ratio="avg_interest_rate avg_credit_score avg_pd_12m avg_lgd ecl_rate default_rate delinquency_rate avg_days_past_due "
    "prime_percentage subprime_percentage avg_term_months avg_months_to_maturity",
)
def _(t):
    return A.product_performance(t.results)


@query(
    "executive_summary",
    """SELECT *, CASE WHEN npl_ratio<=2 AND provision_coverage_ratio>=1 THEN 'Low Risk'
           WHEN npl_ratio<=5 AND provision_coverage_ratio>=0.5E0 THEN 'Moderate Risk' ELSE 'High Risk' END AS portfolio_risk_assessment,
         100.0E0*stage1_loans/total_loans AS stage1_pct, 100.0E0*stage2_loans/total_loans AS stage2_pct, 100.0E0*stage3_loans/total_loans AS stage3_pct,
         100.0E0*stage1_exposure/total_exposure AS stage1_exposure_pct, 100.0E0*stage2_exposure/total_exposure AS stage2_exposure_pct,
         100.0E0*stage3_exposure/total_exposure AS stage3_exposure_pct
       FROM (SELECT count(*) AS total_loans, sum(current_balance) AS total_exposure, sum(calculated_ecl) AS total_provisions,
           avg(credit_score) AS avg_credit_score, count(*) FILTER (calculated_stage='STAGE_1') AS stage1_loans,
           count(*) FILTER (calculated_stage='STAGE_2') AS stage2_loans, count(*) FILTER (calculated_stage='STAGE_3') AS stage3_loans,
           sum(current_balance) FILTER (calculated_stage='STAGE_1') AS stage1_exposure, sum(current_balance) FILTER (calculated_stage='STAGE_2') AS stage2_exposure,
           sum(current_balance) FILTER (calculated_stage='STAGE_3') AS stage3_exposure,
           100.0E0*count(*) FILTER (days_past_due>90)/count(*) AS npl_ratio, 100.0E0*sum(calculated_ecl)/sum(current_balance) AS provision_coverage_ratio,
           100.0E0*sum(calculated_ecl)/sum(current_balance) FILTER (days_past_due>90) AS npl_coverage_ratio
         FROM {results} WHERE current_balance>0) q""",
    money="total_exposure total_provisions stage1_exposure stage2_exposure stage3_exposure",
    ratio="avg_credit_score npl_ratio provision_coverage_ratio npl_coverage_ratio stage1_pct stage2_pct stage3_pct "
    "stage1_exposure_pct stage2_exposure_pct stage3_exposure_pct",
)
def _(t):
    return A.executive_summary(t.results)


def _reg_sql() -> str:
    parts = []
    for n in (1, 2, 3):
        s = f"calculated_stage='STAGE_{n}'"
        parts.append(
            f"count(*) FILTER ({s}) AS stage{n}_count, sum(current_balance) FILTER ({s}) AS stage{n}_gross_carrying_amount, "
            f"sum(calculated_ecl) FILTER ({s}) AS stage{n}_ecl_provisions, "
            f"100.0E0*sum(calculated_ecl) FILTER ({s})/sum(current_balance) FILTER ({s}) AS stage{n}_coverage_ratio"
        )
    return (
        "SELECT DATE '2001-10-01' AS reporting_quarter, " + ", ".join(parts) + ", "
        "avg(calculated_pd) FILTER (calculated_stage='STAGE_1') AS stage1_avg_pd, avg(calculated_pd) FILTER (calculated_stage='STAGE_2') AS stage2_avg_pd, "
        "count(*) AS total_count, sum(current_balance) AS total_gross_carrying_amount, sum(calculated_ecl) AS total_ecl_provisions, "
        "100.0E0*sum(calculated_ecl)/sum(current_balance) AS overall_coverage_ratio FROM {results} WHERE current_balance>0"
    )


@query(
    "regulatory_report",
    _reg_sql(),
    money="stage1_gross_carrying_amount stage2_gross_carrying_amount stage3_gross_carrying_amount stage1_ecl_provisions "
    "stage2_ecl_provisions stage3_ecl_provisions total_gross_carrying_amount total_ecl_provisions",
    ratio="stage1_coverage_ratio stage2_coverage_ratio stage3_coverage_ratio stage1_avg_pd stage2_avg_pd overall_coverage_ratio",
)
def _(t):
    return A.regulatory_report(t.results)


@query(
    "credit_quality_monthly",
    """SELECT CAST(date_trunc('month', origination_date) AS DATE) AS reporting_month, calculated_stage, count(*) AS new_loans_count,
         sum(loan_amount) AS new_loans_volume, avg(credit_score) AS avg_credit_score, avg(calculated_pd) AS avg_pd, sum(calculated_ecl) AS total_ecl
       FROM {results} GROUP BY 1, 2""",
    money="new_loans_volume total_ecl",
    ratio="avg_credit_score avg_pd",
)
def _(t):
    return A.credit_quality_monthly(t.results)


@query(
    "ecl_by_stage_view",
    f"""SELECT {N}, count(*) AS loan_count, sum(loan_amount) AS total_exposure, avg(loan_amount) AS avg_loan_amount, avg(credit_score) AS avg_credit_score,
         avg(days_past_due) AS avg_days_past_due, sum(calculated_ead) AS total_ead, sum(calculated_ecl) AS total_ecl FROM {{results}} {G}""",
    money="total_exposure avg_loan_amount total_ead total_ecl",
    ratio="avg_credit_score avg_days_past_due",
)
def _(t):
    return A.by_stage_and(
        t.results, [],
        F.sum("loan_amount").alias("total_exposure"), F.avg("loan_amount").alias("avg_loan_amount"),
        F.avg("credit_score").alias("avg_credit_score"), F.avg("days_past_due").alias("avg_days_past_due"),
        F.sum("calculated_ead").alias("total_ead"), F.sum("calculated_ecl").alias("total_ecl"),
    )


@query(
    "geographic_distribution",
    f"""SELECT region, {N}, count(*) AS loan_count, sum(loan_amount) AS total_exposure, avg(credit_score) AS avg_credit_score
       FROM {{results}} {G}, region""",
    money="total_exposure",
    ratio="avg_credit_score",
)
def _(t):
    return A.by_stage_and(
        t.results, ["region"], F.sum("loan_amount").alias("total_exposure"), F.avg("credit_score").alias("avg_credit_score")
    )


@query(
    "product_analysis",
    f"""SELECT loan_type, {N}, count(*) AS loan_count, sum(loan_amount) AS total_exposure, avg(interest_rate) AS avg_interest_rate,
         avg(term_months) AS avg_term_months FROM {{results}} {G}, loan_type""",
    money="total_exposure",
    ratio="avg_interest_rate avg_term_months",
)
def _(t):
    return A.by_stage_and(
        t.results, ["loan_type"], F.sum("loan_amount").alias("total_exposure"),
        F.avg("interest_rate").alias("avg_interest_rate"), F.avg("term_months").alias("avg_term_months"),
    )


@query(
    "risk_metrics_global",
    """SELECT count(*) AS loan_count, sum(loan_amount) AS total_exposure, avg(credit_score) AS avg_credit_score, avg(dti_ratio) AS avg_dti,
         avg(ltv_ratio) AS avg_ltv, avg(days_past_due) AS avg_days_past_due, 100.0E0*count(*) FILTER (calculated_stage='STAGE_3')/count(*) AS default_rate_pct,
         sum(calculated_ead) AS total_ead, sum(calculated_ecl) AS total_ecl FROM {results}""",
    money="total_exposure total_ead total_ecl",
    ratio="avg_credit_score avg_dti avg_ltv avg_days_past_due default_rate_pct",
)
def _(t):
    return A.risk_metrics_global(t.results)


@query(
    "credit_score_bands",
    f"""SELECT CASE WHEN credit_score>=900 THEN 'Excellent (900+)' WHEN credit_score>=800 THEN 'Very Good (800-899)' WHEN credit_score>=700 THEN 'Good (700-799)'
         WHEN credit_score>=600 THEN 'Fair (600-699)' WHEN credit_score>=500 THEN 'Poor (500-599)' ELSE 'Very Poor (<500)' END AS credit_band,
         {N}, count(*) AS loan_count, sum(loan_amount) AS total_exposure, sum(calculated_ecl) AS total_ecl FROM {{results}} {G}, credit_band""",
    money="total_exposure total_ecl",
)
def _(t):
    return A.by_stage_and(
        t.results, [P.score_band_6(F.col("credit_score")).alias("credit_band")],
        F.sum("loan_amount").alias("total_exposure"), F.sum("calculated_ecl").alias("total_ecl"),
    )


@query(
    "loan_stage_summary",
    f"""SELECT calculated_stage, count(*) AS loan_count, sum(calculated_ecl) AS total_ecl, sum(calculated_ead) AS total_ead FROM {{results}} {G}""",
    money="total_ecl total_ead",
)
def _(t):
    return t.results.groupBy("calculated_stage").agg(
        F.count("*").alias("loan_count"), F.sum("calculated_ecl").alias("total_ecl"), F.sum("calculated_ead").alias("total_ead")
    )


@query(
    "portfolio_region_summary",
    f"""SELECT region, calculated_stage, count(*) AS loan_count, sum(loan_amount) AS total_exposure, avg(credit_score) AS average_credit_score
       FROM {{results}} {G}, region""",
    money="total_exposure",
    ratio="average_credit_score",
)
def _(t):
    return t.results.groupBy("region", "calculated_stage").agg(
        F.count("*").alias("loan_count"), F.sum("loan_amount").alias("total_exposure"), F.avg("credit_score").alias("average_credit_score")
    )


@query(
    "ecl_type_stage",
    f"""SELECT loan_type, calculated_stage, sum(calculated_ecl) AS ecl_sum, avg(calculated_ecl) AS ecl_mean, count(*) AS ecl_count,
         sum(current_balance) AS balance_sum, avg(calculated_pd) AS pd_mean, avg(calculated_lgd) AS lgd_mean FROM {{results}} {G}, loan_type""",
    money="ecl_sum ecl_mean balance_sum",
    ratio="pd_mean lgd_mean",
)
def _(t):
    return t.results.groupBy("loan_type", "calculated_stage").agg(
        F.sum("calculated_ecl").alias("ecl_sum"), F.avg("calculated_ecl").alias("ecl_mean"), F.count("*").alias("ecl_count"),
        F.sum("current_balance").alias("balance_sum"), F.avg("calculated_pd").alias("pd_mean"), F.avg("calculated_lgd").alias("lgd_mean"),
    )


@query(
    "pd_pivot",
    """SELECT loan_type, avg(calculated_pd) FILTER (calculated_stage='STAGE_1') AS STAGE_1, avg(calculated_pd) FILTER (calculated_stage='STAGE_2') AS STAGE_2,
         avg(calculated_pd) FILTER (calculated_stage='STAGE_3') AS STAGE_3 FROM {results} GROUP BY loan_type""",
    ratio="STAGE_1 STAGE_2 STAGE_3",
)
def _(t):
    return A.pd_pivot(t.results)


@query(
    "coverage_by_type",
    "SELECT loan_type, sum(calculated_ecl)/sum(current_balance) AS coverage FROM {results} GROUP BY loan_type",
    ratio="coverage",
)
def _(t):
    return A.coverage_by(t.results, "loan_type")


@query(
    "payment_stats",
    """SELECT payment_status, count(loan_id) AS payment_count, sum(actual_payment) AS actual_total, sum(scheduled_payment) AS scheduled_total
       FROM {payments} GROUP BY payment_status""",
    money="actual_total scheduled_total",
)
def _(t):
    return A.payment_stats(t.payments)


@query(
    "monthly_payment_pivot",
    """SELECT CAST(date_trunc('month', payment_date) AS DATE) AS month, count(*) FILTER (payment_status='MISSED') AS MISSED,
         count(*) FILTER (payment_status='PAID') AS PAID, count(*) FILTER (payment_status='PARTIAL') AS PARTIAL FROM {payments} GROUP BY 1""",
)
def _(t):
    return A.monthly_payment_pivot(t.payments)


@query(
    "loan_type_risk",
    "SELECT loan_type, avg(calculated_pd) AS avg_pd, avg(calculated_lgd) AS avg_lgd, sum(calculated_ecl)/sum(current_balance) AS coverage FROM {results} GROUP BY loan_type",
    ratio="avg_pd avg_lgd coverage",
)
def _(t):
    return A.loan_type_risk(t.results)


@query(
    "stage_exposure_totals",
    f"SELECT calculated_stage, count(*) AS loan_count, sum(loan_amount) AS total_exposure, sum(calculated_ecl) AS total_ecl FROM {{results}} {G}",
    money="total_exposure total_ecl",
)
def _(t):
    return t.results.groupBy("calculated_stage").agg(
        F.count("*").alias("loan_count"), F.sum("loan_amount").alias("total_exposure"), F.sum("calculated_ecl").alias("total_ecl")
    )


HISTOGRAMS = {"calculated_pd": 50, "credit_score": 30, "calculated_ecl": 50}


def _hist_sql() -> str:
    parts = [
        f"""SELECT '{c}' AS measure, CAST(least({n}, greatest(1, coalesce(floor(({c} - lo)/nullif((hi - lo)/{n}, 0)) + 1, 1))) AS INT) AS bin, lo, (hi - lo)/{n} AS width
        FROM {{results}}, (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM {{results}}) r WHERE {c} IS NOT NULL"""
        for c, n in HISTOGRAMS.items()
    ]
    return "SELECT measure, bin, min(lo + (bin - 1) * width) AS bin_start, count(*) AS n FROM (" + " UNION ALL ".join(parts) + ") q GROUP BY measure, bin"


@query("report_histograms", _hist_sql(), ratio="bin_start")
def _(t):
    return A.report_histograms(t.results, HISTOGRAMS)


@query(
    "stage_risk_summary",
    """SELECT calculated_stage, CASE WHEN credit_score>=750 THEN 'LOW' WHEN credit_score>=650 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_category,
         sum(loan_amount) AS total_loan_amount, sum(current_balance) AS total_current_balance,
         sum(current_balance*calculated_pd*calculated_lgd) AS total_ecl_amount, count(*) AS loan_count FROM {results} GROUP BY 1, 2""",
    money="total_loan_amount total_current_balance total_ecl_amount",
)
def _(t):
    return A.stage_risk_summary(t.results)


@query(
    "ecl_stage_rates",
    """SELECT *, 100.0E0*total_ecl/total_exposure AS ecl_rate, 100.0E0*total_exposure/sum(total_exposure) OVER () AS exposure_pct
       FROM (SELECT calculated_stage, sum(current_balance) AS total_exposure, sum(e) AS total_ecl, avg(calculated_pd) AS avg_pd_rate,
               avg(calculated_lgd) AS avg_lgd_rate, avg(e) AS avg_ecl_per_loan
             FROM (SELECT h.*, CASE WHEN calculated_stage='STAGE_1' THEN ecl_12m ELSE ecl_life END AS e FROM {horizon} h) z GROUP BY calculated_stage) q""",
    money="total_exposure total_ecl avg_ecl_per_loan",
    ratio="avg_pd_rate avg_lgd_rate ecl_rate exposure_pct",
)
def _(t):
    return A.ecl_stage_rates(t.results)


@query(
    "rating_bucket_exposure",
    """SELECT risk_rating, CASE WHEN ltv_ratio>0.8E0 THEN 'High Risk' WHEN ltv_ratio>0.6E0 THEN 'Medium Risk' ELSE 'Low Risk' END AS risk_bucket,
         sum(current_balance) AS total_exposure, avg(current_balance) AS avg_balance, avg(interest_rate) AS avg_rate, count(*) AS loan_count
       FROM {rated} WHERE current_balance>1000 GROUP BY 1, 2""",
    money="total_exposure avg_balance",
    ratio="avg_rate",
)
def _(t):
    return A.rating_bucket_exposure(t.results)


@query(
    "monthly_provisions",
    """SELECT CAST(date_trunc('month', origination_date) AS DATE) AS month, avg(pb) AS avg_portfolio_balance, sum(pa) AS total_provisions,
         avg(pa/pb) AS avg_provision_rate, CAST(sum(nd) AS BIGINT) AS total_new_defaults
       FROM (SELECT origination_date, sum(current_balance) AS pb, sum(calculated_ecl) AS pa, count(*) FILTER (calculated_stage='STAGE_3') AS nd
             FROM {results} GROUP BY origination_date) d GROUP BY 1""",
    money="avg_portfolio_balance total_provisions",
    ratio="avg_provision_rate",
)
def _(t):
    return A.monthly_provisions(t.results)


@query(
    "category_mean_std",
    "SELECT sector, avg(loan_amount) AS mean_value, stddev_samp(loan_amount) AS std_value, count(*) AS n FROM {loans} WHERE loan_amount>100000 GROUP BY sector",
    money="mean_value std_value",
)
def _(t):
    return A.category_mean_std(t.loans, "sector", "loan_amount", 100000.0)


@query(
    "simple_totals",
    """SELECT count(*) AS total_loans, sum(current_balance) AS total_balance, avg(interest_rate) AS avg_rate
       FROM {loans} WHERE origination_date >= DATE '2000-12-31'""",
    money="total_balance",
    ratio="avg_rate",
)
def _(t):
    since = F.add_months(F.lit(C.DEFAULTS.as_of_date), -12)
    return t.loans.where(F.col("origination_date") >= since).agg(
        F.count("*").alias("total_loans"), F.sum("current_balance").alias("total_balance"), F.avg("interest_rate").alias("avg_rate")
    )


@query(
    "ml_vs_rules_confusion",
    """SELECT original_stage, count(*) FILTER (predicted_stage='STAGE_1') AS predicted_stage_1, count(*) FILTER (predicted_stage='STAGE_2') AS predicted_stage_2,
         count(*) FILTER (predicted_stage='STAGE_3') AS predicted_stage_3, avg(confidence) AS avg_confidence FROM {predictions} GROUP BY original_stage""",
    ratio="avg_confidence",
)
def _(t):
    return A.ml_vs_rules_confusion(t.predictions)


@query(
    "ml_confidence_by_predicted",
    "SELECT predicted_stage, avg(confidence) AS avg_probability, count(*) AS n FROM {predictions} GROUP BY predicted_stage",
    ratio="avg_probability",
)
def _(t):
    return t.predictions.groupBy("predicted_stage").agg(
        F.avg("confidence").alias("avg_probability"), F.count("*").alias("n")
    )


@query(
    "dataset_profile",
    """SELECT 'loans' AS dataset, count(*) AS record_count, CAST(20 AS BIGINT) AS column_count, count(*) FILTER (ltv_ratio IS NULL) AS missing_values FROM {loans}
       UNION ALL SELECT 'payments', count(*), 9, 0 FROM {payments}
       UNION ALL SELECT 'macro', count(*), 6, 0 FROM {macro}
       UNION ALL SELECT 'loans_dirty', count(*), 10, count(*) FILTER (credit_score IS NULL) FROM {loans_dirty}""",
)
def _(t):
    return A.dataset_profile({"loans": t.loans, "payments": t.payments, "macro": t.macro, "loans_dirty": t.loans_dirty})


@query(
    "dataset_distributions",
    """SELECT field, value, count(*) AS n FROM (SELECT 'stage' AS field, stage AS value FROM {staged}
         UNION ALL SELECT 'region', region FROM {staged} UNION ALL SELECT 'loan_type', loan_type FROM {staged}) q GROUP BY field, value""",
)
def _(t):
    return A.value_distribution(t.staged, ["stage", "region", "loan_type"])


@query(
    "portfolio_composition",
    """SELECT loan_type, calculated_stage, sum(current_balance) AS exposure, count(*) AS loan_count FROM {results}
       GROUP BY ROLLUP (loan_type, calculated_stage)""",
    money="exposure",
)
def _(t):
    return A.portfolio_composition(t.results)
