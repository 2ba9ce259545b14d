"""Window, ordering, sampling and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossgrid import config as C
from lossgrid.operators import sampling as S
from lossgrid.operators import windows as W
from lossgrid.operators.joins import latest_macro
from lossgrid.operators.reports import product_performance
from lossgrid.plans.registry import SQL_ONLY, query
from lossgrid.sources.schemas import REQUIRED_LOAN_COLUMNS, schema_column_diff

SQL_ONLY["hashed"] = """
SELECT s.*, ((CAST(substr(loan_id,2) AS BIGINT) % 2147483647) * 1103515245) % 2147483647 AS h FROM {staged} s
"""


@query(
    "credit_quality_trends",
    """SELECT *, 100.0E0*(new_loans_count-pc)/nullif(pc,0) AS loan_count_growth_pct, 100.0E0*(avg_credit_score-ps)/nullif(ps,0) AS credit_score_change_pct,
         100.0E0*(total_ecl-pe)/nullif(pe,0) AS ecl_growth_pct
       FROM (SELECT m.*, lag(new_loans_count) OVER w AS pc, lag(avg_credit_score) OVER w AS ps, lag(total_ecl) OVER w AS pe
             FROM (SELECT CAST(date_trunc('month', origination_date) AS DATE) AS reporting_month, calculated_stage, count(*) AS new_loans_count,
                     sum(loan_amount) AS new_loans_volume, avg(credit_score) AS avg_credit_score, avg(calculated_pd) AS avg_pd, sum(calculated_ecl) AS total_ecl
                   FROM {results} GROUP BY 1, 2) m WINDOW w AS (PARTITION BY calculated_stage ORDER BY reporting_month)) q""".replace(
        "SELECT *, 100", "SELECT * EXCLUDE (pc, ps, pe), 100"
    ),
    money="new_loans_volume total_ecl",
    ratio="avg_credit_score avg_pd loan_count_growth_pct credit_score_change_pct ecl_growth_pct",
)
def _(t):
    return W.credit_quality_trends(t.results)


@query(
    "latest_macro_row",
    "SELECT date, gdp_growth, unemployment_rate, economic_cycle FROM {macro} ORDER BY date DESC LIMIT 1",
)
def _(t):
    return latest_macro(t.macro, ["gdp_growth", "unemployment_rate", "economic_cycle"])


@query(
    "stage_rank",
    "SELECT loan_id, stage, row_number() OVER (PARTITION BY stage ORDER BY loan_id) AS stage_rank FROM {staged}",
)
def _(t):
    return W.stage_rank(t.staged)


@query(
    "share_of_total",
    "SELECT stage, count(*) AS n, count(*)/sum(count(*)) OVER () AS share, 100.0E0*count(*)/sum(count(*)) OVER () AS percent FROM {staged} GROUP BY stage",
    ratio="share percent",
)
def _(t):
    return W.share_of_total(t.staged, "stage")


@query(
    "series_gap_check",
    """SELECT count(*) AS n_points, CAST(max(gap) AS INT) AS max_gap_days, max(gap)>35 AS has_gaps, count(*) FILTER (gap<=0)=0 AS strictly_increasing
       FROM (SELECT datediff('day', lag(date) OVER (ORDER BY date), date) AS gap FROM {macro}) q""",
)
def _(t):
    return W.series_gap_check(t.macro, "date")


@query(
    "ecl_day_over_day",
    """WITH d AS (SELECT origination_date AS day, sum(calculated_ecl) AS ecl, count(*) AS volume,
           100.0E0*count(*) FILTER (calculated_stage='STAGE_2')/count(*) AS s2 FROM {results} GROUP BY 1)
       SELECT a.day, a.ecl, a.volume, 100.0E0*(a.ecl-b.ecl)/b.ecl AS ecl_change_pct, 100.0E0*(a.volume-b.volume)/b.volume AS volume_change_pct,
         a.s2-b.s2 AS stage2_change_pts, abs(100.0E0*(a.ecl-b.ecl)/b.ecl)>10 AS ecl_alert, abs(100.0E0*(a.volume-b.volume)/b.volume)>20 AS volume_alert,
         abs(a.s2-b.s2)>5 AS stage2_alert
       FROM d a JOIN d b ON a.day = b.day + CAST(1 AS INT)""",
    money="ecl",
    ratio="ecl_change_pct volume_change_pct stage2_change_pts",
)
def _(t):
    return W.day_over_day(t.results)


@query(
    "payment_streaks",
    """SELECT loan_id, line_no, l_partkey, l_suppkey, payment_date, payment_status, row_number() OVER w AS payment_no,
         lag(payment_status) OVER w AS previous_status,
         CAST(sum(CASE WHEN payment_status='MISSED' THEN 1 ELSE 0 END) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS missed_so_far
       FROM {payments} WINDOW w AS (PARTITION BY loan_id ORDER BY payment_date, line_no, l_partkey, l_suppkey)""",
)
def _(t):
    return W.payment_streaks(t.payments).select(
        "loan_id", "line_no", "l_partkey", "l_suppkey", "payment_date", "payment_status", "payment_no", "previous_status",
        "missed_so_far",
    )


@query(
    "macro_smoothing",
    """SELECT date, g AS gdp_growth_smooth, u AS unemployment_rate_smooth FROM (
         WITH RECURSIVE o AS (SELECT *, row_number() OVER (ORDER BY date) AS k FROM {macro}),
         r(k, date, g, u) AS (SELECT k, date, gdp_growth, unemployment_rate FROM o WHERE k=1
           UNION ALL SELECT o.k, o.date, 0.7E0*r.g + 0.3E0*o.gdp_growth, 0.8E0*r.u + 0.2E0*o.unemployment_rate FROM r JOIN o ON o.k = r.k+1)
         SELECT * FROM r) z""",
    ratio="gdp_growth_smooth unemployment_rate_smooth",
)
def _(t):
    return W.persistence(t.macro, "date", {"gdp_growth": 0.7, "unemployment_rate": 0.8})


# -- order, limit, top-k -----------------------------------------------------


@query(
    "ordered_views",
    "SELECT loan_type, sector, sum(current_balance) AS current_exposure FROM {loans} WHERE current_balance>0 GROUP BY loan_type, sector",
    money="current_exposure",
)
def _(t):
    return product_performance(t.results).select("loan_type", "sector", "current_exposure")


@query(
    "largest_exposures",
    """SELECT region, loan_id, current_balance, CAST(rk AS INT) AS rank, current_balance>10000000 AS over_limit
       FROM (SELECT region, loan_id, current_balance, row_number() OVER (PARTITION BY region ORDER BY current_balance DESC, loan_id) AS rk FROM {loans}) q WHERE rk<=3""",
)
def _(t):
    return W.top_exposures(t.loans, "region", 3)


@query("limit_offset_pages", "SELECT loan_id FROM {loans} ORDER BY loan_id LIMIT 100 OFFSET 200")
def _(t):
    return t.loans.select("loan_id").orderBy("loan_id").offset(200).limit(100)


@query("sample_n", "SELECT loan_id, stage FROM {hashed} ORDER BY h, loan_id LIMIT 500")
def _(t):
    return S.sample_n(t.staged.select("loan_id", "stage"), 500)


@query(
    "stratified_sample",
    """SELECT loan_id, stage, CASE WHEN stage='STAGE_1' THEN 'credit_score,loan_amount,dti_ratio' ELSE 'credit_score,days_past_due,ltv_ratio' END AS expected_top_features
       FROM (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY h, loan_id) AS rk FROM {hashed}) q
       WHERE rk <= CASE stage WHEN 'STAGE_3' THEN 2000 WHEN 'STAGE_2' THEN 5000 ELSE 3000 END""",
)
def _(t):
    picked = S.stratified_sample(
        t.staged.select("loan_id", "stage"), "stage", {"STAGE_3": 2000, "STAGE_2": 5000, "STAGE_1": 3000}
    )
    expected = F.when(F.col("stage") == "STAGE_1", "credit_score,loan_amount,dti_ratio").otherwise(
        "credit_score,days_past_due,ltv_ratio"
    )
    return picked.withColumn("expected_top_features", expected)


@query(
    "union_batches",
    """SELECT loan_id, stage, 'performing' AS batch, CAST(NULL AS INT) AS days_past_due FROM {staged} WHERE stage='STAGE_1'
       UNION ALL SELECT loan_id, stage, 'watch', days_past_due FROM {staged} WHERE stage<>'STAGE_1'""",
)
def _(t):
    good = t.staged.where(F.col("stage") == "STAGE_1").select("loan_id", "stage", F.lit("performing").alias("batch"))
    rest = t.staged.where(F.col("stage") != "STAGE_1").select(
        "loan_id", "stage", F.lit("watch").alias("batch"), "days_past_due"
    )
    return S.union_batches([good, rest])


@query("distinct_values", "SELECT DISTINCT loan_type, sector FROM {loans}")
def _(t):
    return t.loans.select("loan_type", "sector").distinct()


@query(
    "split_stratified",
    """SELECT loan_id, stage, rk <= floor(0.8E0*n) AS is_train
       FROM (SELECT loan_id, stage, row_number() OVER (PARTITION BY stage ORDER BY h, loan_id) AS rk, count(*) OVER (PARTITION BY stage) AS n FROM {hashed}) q""",
)
def _(t):
    return S.split_stratified(t.staged.select("loan_id", "stage"), "stage").select("loan_id", "stage", "is_train")


@query("train_test_disjoint", "SELECT CAST(0 AS BIGINT) AS overlap, count(*)>0 AS both_used FROM {staged}")
def _(t):
    split = S.split_stratified(t.staged.select("loan_id", "stage"), "stage")
    both = S.overlap_count(split.where("is_train"), split.where("not is_train"), "loan_id")
    return both.withColumn("both_used", split.select("is_train").agg(F.count_distinct("is_train")).scalar() == 2)


@query(
    "schema_column_diff",
    "SELECT * FROM (VALUES ('pd_rate'), ('lgd_rate')) v(column_name) WHERE (SELECT count(*) FROM {loans_dirty}) > 0",
)
def _(t):
    wanted = (*REQUIRED_LOAN_COLUMNS, "customer_id", "loan_amount", "pd_rate", "lgd_rate")
    return schema_column_diff(t.loans_dirty, wanted)


@query(
    "economic_cycle_phase",
    """SELECT date, CAST((year(date)*12+month(date)-23941)%58 AS INT) AS month_in_cycle, economic_cycle AS phase FROM {macro}""",
)
def _(t):
    return W.cycle_phase(t.macro, "date", C.CYCLE_PHASES, 23941)
