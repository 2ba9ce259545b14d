"""Data-quality and compliance queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossgrid.operators import quality as Q
from lossgrid.operators.reports import with_risk_category
from lossgrid.plans.registry import SQL_ONLY, query
from lossgrid.sources.schemas import REQUIRED_LOAN_COLUMNS

CHECKED = ("check", "violations", "records", "passed")


def _sql_checks(table: str, rules: dict[str, str]) -> str:
    """SQL twin of a check set: one SELECT per rule (rules say what is wrong)."""
    return " UNION ALL ".join(
        f"SELECT '{n}' AS \"check\", count(*) FILTER ({bad}) AS violations, count(*) AS records, count(*) FILTER ({bad})=0 AS passed FROM {{{table}}}"
        for n, bad in rules.items()
    )


@query(
    "null_counts_required",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count FROM {{loans_dirty}}" for c in REQUIRED_LOAN_COLUMNS
    ),
)
def _(t):
    return Q.null_counts(t.loans_dirty, REQUIRED_LOAN_COLUMNS)


LOAN_SQL_RULES = {
    "loan_id": "NOT coalesce(regexp_full_match(loan_id, 'L[0-9]{{6}}'), false)",
    "customer_id": "NOT coalesce(regexp_full_match(customer_id, 'C[0-9]{{6}}'), false)",
    "loan_amount": "loan_amount IS NULL OR loan_amount<=0 OR loan_amount>10000000",
    "interest_rate": "interest_rate IS NULL OR interest_rate<0 OR interest_rate>30",
    "term_months": "term_months IS NULL OR term_months<=0 OR term_months>360",
    "loan_type": "loan_type IS NULL OR loan_type NOT IN ('MORTGAGE','AUTO','PERSONAL','BUSINESS','CREDIT_CARD')",
    "credit_score": "credit_score IS NULL OR credit_score<300 OR credit_score>850",
    "days_past_due": "days_past_due IS NULL OR days_past_due<0",
    "current_balance": "current_balance IS NULL OR current_balance<0",
    "provision_stage": "provision_stage IS NULL OR provision_stage NOT IN ('STAGE_1','STAGE_2','STAGE_3')",
}


@query("schema_checks_loan", _sql_checks("loans_dirty", LOAN_SQL_RULES))
def _(t):
    return Q.check_counts(t.loans_dirty, Q.loan_schema_rules(t.loans_dirty))


@query(
    "schema_checks_rates",
    _sql_checks("results", {"pd_rate": "calculated_pd<0 OR calculated_pd>1", "lgd_rate": "calculated_lgd<0 OR calculated_lgd>1"}),
)
def _(t):
    rates = t.results.select(F.col("calculated_pd").alias("pd_rate"), F.col("calculated_lgd").alias("lgd_rate"))
    return Q.check_counts(rates, Q.loan_schema_rules(rates))


PAYMENT_SQL_RULES = {
    "loan_id": "NOT coalesce(regexp_full_match(loan_id, 'L[0-9]{{6}}'), false)",
    "payment_date": "payment_date IS NULL",
    "scheduled_payment": "scheduled_payment IS NULL OR scheduled_payment<0",
    "actual_payment": "actual_payment IS NULL OR actual_payment<0",
    "payment_status": "payment_status NOT IN ('PAID','MISSED','PARTIAL')",
    "days_late": "days_late<0",
}


@query("schema_checks_payment", _sql_checks("payments", PAYMENT_SQL_RULES))
def _(t):
    return Q.check_counts(t.payments, Q.payment_schema_rules())


MACRO_SQL_RULES = {
    "date": "date IS NULL",
    "gdp_growth": "gdp_growth<=-10 OR gdp_growth>=10",
    "unemployment_rate": "unemployment_rate<0 OR unemployment_rate>=30",
    "inflation_rate": "inflation_rate<=-5 OR inflation_rate>=20",
    "interest_rate": "interest_rate<0 OR interest_rate>=25",
}


@query("schema_checks_macro", _sql_checks("macro", MACRO_SQL_RULES))
def _(t):
    return Q.check_counts(t.macro, Q.macro_schema_rules())


LOAN_BUSINESS_SQL = (
    _sql_checks(
        "loans_dirty",
        {
            "balance_exceeds_amount": "current_balance>loan_amount",
            "stage_3_low_dpd": "provision_stage='STAGE_3' AND days_past_due<90",
        },
    )
    + """ UNION ALL SELECT 'duplicate_loan_id', CAST(coalesce(sum(c) FILTER (c>1), 0) AS BIGINT), CAST(sum(c) AS BIGINT), coalesce(sum(c) FILTER (c>1), 0)=0
          FROM (SELECT loan_id, count(*) AS c FROM {loans_dirty} GROUP BY loan_id) d"""
)


@query("business_rules_loan", LOAN_BUSINESS_SQL)
def _(t):
    return Q.business_rules_loan(t.loans_dirty)


PAYMENT_BUSINESS_SQL = _sql_checks(
    "payments",
    {
        "overpayment": "actual_payment>scheduled_payment*2",
        "status_mismatch": "(payment_status='PAID' AND actual_payment=0) OR (payment_status='MISSED' AND actual_payment>0)",
    },
)


@query("business_rules_payment", PAYMENT_BUSINESS_SQL)
def _(t):
    return Q.business_rules_payment(t.payments)


def _report_sql() -> str:
    sets = {"loan_portfolio": LOAN_BUSINESS_SQL, "payment_history": PAYMENT_BUSINESS_SQL, "macroeconomic_data": _sql_checks("macro", MACRO_SQL_RULES)}
    return " UNION ALL ".join(
        f"""SELECT '{n}' AS dataset, max(records) AS records, count(*) FILTER (NOT passed)=0 AS passed, count(*) FILTER (NOT passed) AS n_errors,
              coalesce(string_agg("check", ',' ORDER BY "check") FILTER (NOT passed), '') AS errors FROM ({sql}) q"""
        for n, sql in sets.items()
    )


@query("validation_report", _report_sql())
def _(t):
    return Q.validation_report(
        {
            "loan_portfolio": Q.business_rules_loan(t.loans_dirty),
            "payment_history": Q.business_rules_payment(t.payments),
            "macroeconomic_data": Q.check_counts(t.macro, Q.macro_schema_rules()),
        }
    )


DIRTY_NUMERIC = ("loan_amount", "interest_rate", "term_months", "credit_score", "days_past_due", "current_balance")
DIRTY_TYPES = {
    "loan_id": "string", "customer_id": "string", "loan_amount": "double", "interest_rate": "double", "term_months": "int",
    "loan_type": "string", "credit_score": "int", "days_past_due": "int", "current_balance": "double", "provision_stage": "string",
}


def _profile_sql() -> str:
    parts = []
    for c, kind in DIRTY_TYPES.items():
        if c in DIRTY_NUMERIC:
            nums = (
                f"avg({c}) AS mean, stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
                f"CAST(quantile_cont({c}, 0.25) AS DOUBLE) AS q25, CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS q50, CAST(quantile_cont({c}, 0.75) AS DOUBLE) AS q75"
            )
        else:
            nums = ", ".join(f"CAST(NULL AS DOUBLE) AS {n}" for n in ("mean", "std", "min", "max", "q25", "q50", "q75"))
        parts.append(
            f"""SELECT '{c}' AS column_name, '{kind}' AS data_type, count(*) AS records, count(*)-count({c}) AS null_count,
                  100.0E0*(count(*)-count({c}))/count(*) AS null_pct, {nums}, count(DISTINCT {c}) AS unique_values,
                  100.0E0*count(DISTINCT {c})/count(*) AS unique_pct, count(DISTINCT {c})=count(*) AS candidate_key FROM {{loans_dirty}}"""
        )
    return " UNION ALL ".join(parts)


@query("column_profile", _profile_sql(), money="mean std", ratio="null_pct min max q25 q50 q75 unique_pct")
def _(t):
    return Q.column_profile(t.loans_dirty)


@query(
    "duplicate_rows",
    """SELECT CAST(sum(c) AS BIGINT) AS records, CAST(sum(c-1) AS BIGINT) AS duplicate_rows, 100.0E0*sum(c-1)/sum(c) AS duplicate_pct
       FROM (SELECT count(*) AS c FROM {loans_dirty} GROUP BY ALL) q""".replace(
        "SELECT count(*) AS c FROM {loans_dirty} GROUP BY ALL",
        "SELECT count(*) AS c FROM {loans_dirty} GROUP BY " + ", ".join(DIRTY_TYPES),
    ),
    ratio="duplicate_pct",
)
def _(t):
    return Q.duplicate_rows(t.loans_dirty)


OUTLIER_COLUMNS = ("loan_amount", "credit_score", "days_past_due", "current_balance")


def _fence_sql(c: str, table: str = "loans_dirty") -> str:
    return (
        f"SELECT quantile_cont({c}, 0.25) - 1.5E0*(quantile_cont({c}, 0.75)-quantile_cont({c}, 0.25)) AS lo, "
        f"quantile_cont({c}, 0.75) + 1.5E0*(quantile_cont({c}, 0.75)-quantile_cont({c}, 0.25)) AS hi FROM {{{table}}}"
    )


@query(
    "iqr_outliers",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS metric, CAST(any_value(lo) AS DOUBLE) AS lower_bound, CAST(any_value(hi) AS DOUBLE) AS upper_bound,
              count(*) FILTER ({c}<lo OR {c}>hi) AS outlier_count, 100.0E0*count(*) FILTER ({c}<lo OR {c}>hi)/count(*) AS outlier_pct
            FROM {{loans_dirty}}, ({_fence_sql(c)}) b"""
        for c in OUTLIER_COLUMNS
    ),
    ratio="lower_bound upper_bound outlier_pct",
)
def _(t):
    return Q.iqr_outliers(t.loans_dirty, OUTLIER_COLUMNS)


@query(
    "iqr_outlier_examples",
    " UNION ALL ".join(
        f"""SELECT metric, loan_id, value, CAST(rk AS INT) AS rank FROM (SELECT '{c}' AS metric, loan_id, CAST({c} AS DOUBLE) AS value, row_number() OVER (ORDER BY loan_id) AS rk
            FROM {{staged}}, ({_fence_sql(c, 'staged')}) b WHERE {c}<lo OR {c}>hi) q{i} WHERE rk<=10"""
        for i, c in enumerate(OUTLIER_COLUMNS)
    ),
)
def _(t):
    return Q.iqr_outlier_examples(t.staged, OUTLIER_COLUMNS, "loan_id")


@query(
    "calc_bounds_checks",
    _sql_checks(
        "results",
        {
            "pd_bounds": "calculated_pd<0 OR calculated_pd>1",
            "lgd_bounds": "calculated_lgd<0 OR calculated_lgd>1",
            "ecl_non_negative": "calculated_ecl<0",
        },
    ),
)
def _(t):
    return Q.calc_bounds_checks(t.results)


def _compliance_sql() -> str:
    def row(name: str, expr: str, limit: str, ok: str, sev: str) -> str:
        return f"SELECT '{name}' AS \"check\", CAST({expr} AS DOUBLE) AS observed, {limit}E0 AS threshold, ({expr}){ok} AS passed, CASE WHEN ({expr}){ok} THEN 'INFO' ELSE '{sev}' END AS severity FROM {{results}}"

    rows = [
        row(f"null_check_calculated_{c}", f"count(*) FILTER (calculated_{c} IS NULL)", "0", "=0", "CRITICAL")
        for c in ("pd", "lgd", "ead", "ecl", "stage")
    ]
    rows += [
        row("pd_range_validation", "count(*) FILTER (calculated_pd<0 OR calculated_pd>1)", "0", "=0", "CRITICAL"),
        row("lgd_range_validation", "count(*) FILTER (calculated_lgd<0 OR calculated_lgd>1)", "0", "=0", "CRITICAL"),
        row("ecl_consistency_validation", "count(*) FILTER (calculated_ecl>calculated_ead)", "0", "=0", "HIGH"),
        row("portfolio_ecl_rate_validation", "sum(calculated_ecl)/sum(current_balance)", "0.25", "<=0.25", "HIGH"),
        row("stage3_distribution_check", "count(*) FILTER (calculated_stage='STAGE_3')/count(*)", "0.1", "<0.1", "MEDIUM"),
        row("ml_confidence_validation", "count(*) FILTER (stage_confidence<0.5E0)/count(*)", "0.1", "<0.1", "MEDIUM"),
    ]
    return " UNION ALL ".join(rows)


@query("calc_compliance_checks", _compliance_sql(), ratio="observed")
def _(t):
    return Q.calc_compliance_checks(t.results)


SQL_ONLY["scored"] = """
SELECT r.*, s AS provision_stage, calculated_pd AS pd_12m, CASE WHEN s=3 THEN 1.0E0 ELSE least(1.0E0, calculated_pd*3) END AS pd_lifetime,
  calculated_lgd AS lgd, calculated_ead AS ead, calculated_ecl AS ecl FROM {results} r
"""


@query(
    "data_quality_view",
    """SELECT *, CASE WHEN overall_quality_score>=95 THEN 'Excellent' WHEN overall_quality_score>=85 THEN 'Good' WHEN overall_quality_score>=70 THEN 'Fair' ELSE 'Poor' END AS quality_rating
       FROM (SELECT *, (completeness_score+consistency_score+freshness_score)/3.0E0 AS overall_quality_score
       FROM (SELECT total_records, 100.0E0*(total_records-a)/total_records AS completeness_score, 100.0E0*(total_records-b)/total_records AS consistency_score,
           CAST(days AS INT) AS days_since_update, CAST(CASE WHEN days<=1 THEN 100 WHEN days<=7 THEN 80 WHEN days<=30 THEN 60 ELSE 0 END AS DOUBLE) AS freshness_score
         FROM (SELECT count(*) AS total_records,
             count(*) FILTER (loan_id IS NULL) + count(*) FILTER (customer_id IS NULL) + count(*) FILTER (loan_amount IS NULL OR loan_amount<=0)
             + count(*) FILTER (current_balance IS NULL OR current_balance<0) + count(*) FILTER (credit_score IS NULL OR credit_score<300 OR credit_score>850)
             + count(*) FILTER (provision_stage IS NULL OR provision_stage NOT IN (1,2,3)) + count(*) FILTER (pd_12m IS NULL OR pd_12m<0 OR pd_12m>1)
             + count(*) FILTER (lgd IS NULL OR lgd<0 OR lgd>1) + count(*) FILTER (ecl IS NULL OR ecl<0) AS a,
             count(*) FILTER (current_balance>loan_amount) + count(*) FILTER (provision_stage=3 AND days_past_due=0)
             + count(*) FILTER (provision_stage=1 AND days_past_due>90) + count(*) FILTER (maturity_date<=origination_date) AS b,
             datediff('day', max(origination_date), DATE '2001-12-31') AS days
           FROM {scored}) q) z) y""",
    ratio="completeness_score consistency_score overall_quality_score",
)
def _(t):
    return Q.data_quality_view(Q.scored_portfolio(t.results), "origination_date")


def _gates_sql() -> str:
    cells = "+".join(f"count({c})" for c in DIRTY_TYPES)
    out = "+".join(f"(SELECT count(*) FILTER ({c}<lo OR {c}>hi) FROM {{loans_dirty}}, ({_fence_sql(c)}) b{i})" for i, c in enumerate(OUTLIER_COLUMNS))
    return f"""SELECT gate, observed, threshold, CASE WHEN gate='completeness' THEN observed>=threshold ELSE observed<=threshold END AS passed FROM (
        SELECT 'completeness' AS gate, 100.0E0*({cells})/(count(*)*10) AS observed, 95.0E0 AS threshold FROM {{loans_dirty}}
        UNION ALL SELECT 'duplicates', 100.0E0*sum(c-1)/sum(c), 1.0E0 FROM (SELECT count(*) AS c FROM {{loans_dirty}} GROUP BY {", ".join(DIRTY_TYPES)}) d
        UNION ALL SELECT 'outliers', 100.0E0*({out})/(count(*)*4), 5.0E0 FROM {{loans_dirty}}
        UNION ALL SELECT 'required_fields', 1.0E0, 0.0E0) g"""


@query("quality_gates", _gates_sql(), ratio="observed")
def _(t):
    return Q.quality_gates(t.loans_dirty, ("loan_id", "customer_id", "loan_amount", "risk_rating"), OUTLIER_COLUMNS)


# -- readiness tiers ---------------------------------------------------------


def _tier_sql(tier: str, rows: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{tier}' AS tier, '{c}' AS \"check\", {status} AS status, CAST({score} AS DOUBLE) AS score FROM one" for c, status, score in rows
    )


def _wrap(one: str, rows: str) -> str:
    return f"SELECT tier, \"check\", status, score FROM (WITH one AS ({one}) {rows}) z"


def _p(cond: str) -> str:
    return f"100.0E0*count(*) FILTER ({cond})/count(*)"


def _in(cond: str, scope: str) -> str:
    return f"100.0E0*count(*) FILTER (({cond}) AND {scope})/nullif(count(*) FILTER ({scope}),0)"


def _tiers() -> dict[str, tuple[str, str]]:
    f = Q.REQUIRED_FIELDS
    t = {}
    t["completeness_validation"] = (
        "SELECT count(*) AS n, " + ", ".join(f"100.0E0*count({c})/count(*) AS c_{c}" for c in f) + " FROM {scored}",
        _tier_sql(
            "completeness_validation",
            [("required_fields_present", "'PASSED'", "100")]
            + [(f"completeness_{c}", f"CASE WHEN c_{c}>=99 THEN 'PASSED' WHEN c_{c}>=90 THEN 'WARNING' ELSE 'FAILED' END", f"c_{c}") for c in f]
            + [("minimum_record_count", "CASE WHEN n>=1000 THEN 'PASSED' ELSE 'FAILED' END", "CASE WHEN n>=1000 THEN 100 ELSE 0 END")],
        ),
    )
    t["consistency_validation"] = (
        f"""SELECT {_p('current_balance<=loan_amount')} AS bal, ({_in('days_past_due=0', 'provision_stage=1')}
              + {_in('days_past_due>0 AND days_past_due<90', 'provision_stage=2')} + {_in('days_past_due>=90', 'provision_stage=3')})/3.0E0 AS st,
              {_p('pd_12m<=pd_lifetime')} AS pdr, {_p('abs(x-ecl)/greatest(x, 0.01E0)<=0.05E0')} AS e
            FROM (SELECT q.*, ead*CASE WHEN provision_stage=1 THEN pd_12m ELSE pd_lifetime END*lgd AS x FROM {{scored}} q) w""",
        _tier_sql(
            "consistency_validation",
            [
                ("schema_validation", "'FAILED'", "0"),
                ("balance_consistency", "CASE WHEN bal>=95 THEN 'PASSED' ELSE 'FAILED' END", "bal"),
                ("stage_dpd_consistency", "CASE WHEN st>=80 THEN 'PASSED' ELSE 'FAILED' END", "st"),
                ("pd_relationship_consistency", "CASE WHEN pdr>=95 THEN 'PASSED' ELSE 'WARNING' END", "pdr"),
                ("ecl_calculation_consistency", "CASE WHEN e>=95 THEN 'PASSED' ELSE 'FAILED' END", "e"),
            ],
        ),
    )

    def ok(name: str, cond: str, other: int) -> tuple[str, str, str]:
        return name, f"CASE WHEN {cond} THEN 'PASSED' ELSE 'WARNING' END", f"CASE WHEN {cond} THEN 100 ELSE {other} END"

    t["distribution_validation"] = (
        f"""SELECT avg(credit_score) AS s, quantile_cont(loan_amount, 0.5) AS m, {_p('days_past_due=0')} AS c, avg(interest_rate) AS r FROM {{scored}}""",
        _tier_sql(
            "distribution_validation",
            [
                ok("credit_score_distribution", "s BETWEEN 600 AND 750", 60),
                ok("loan_amount_distribution", "m BETWEEN 10000 AND 500000", 70),
                ok("dpd_distribution", "c>=80", 60),
                ok("interest_rate_distribution", "r BETWEEN 0.01E0 AND 0.15E0", 50),
            ],
        ),
    )
    pairs = [(a, b) for i, a in enumerate(Q.NUMERIC_COLUMNS) for b in Q.NUMERIC_COLUMNS[i + 1 :]]
    rows = []
    for a, b, sign, strength in Q.EXPECTED_CORRELATIONS:
        right = f"{a}_{b}{'>' if sign > 0 else '<'}0"
        firm = f"{right} AND abs({a}_{b})>={strength}E0"
        rows.append(
            (
                f"correlation_{a}_{b}",
                f"CASE WHEN {firm} THEN 'PASSED' WHEN {right} THEN 'WARNING' ELSE 'FAILED' END",
                f"CASE WHEN {firm} THEN 100 WHEN {right} THEN 70 ELSE 30 END",
            )
        )
    many = " OR ".join(f"coalesce(abs(p_{a}_{b})>0.95E0, false)" for a, b in pairs)
    rows.append(("multicollinearity_detection", f"CASE WHEN {many} THEN 'WARNING' ELSE 'PASSED' END", f"CASE WHEN {many} THEN 60 ELSE 100 END"))
    t["correlation_validation"] = (
        "SELECT "
        + ", ".join(f"corr({a}, {b}) AS {a}_{b}" for a, b, _, _ in Q.EXPECTED_CORRELATIONS)
        + ", "
        + ", ".join(f"corr({a}, {b}) AS p_{a}_{b}" for a, b in pairs)
        + " FROM {scored}",
        _tier_sql("correlation_validation", rows),
    )
    bands = {1: (80, 90), 2: (8, 15), 3: (2, 7)}
    rows = []
    for n, (lo, hi) in bands.items():
        far = f"(s{n}<{lo}*0.5E0 OR s{n}>{hi}*1.5E0)"
        rows.append(
            (
                f"stage_{n}_distribution",
                f"CASE WHEN s{n} BETWEEN {lo} AND {hi} THEN 'PASSED' WHEN {far} THEN 'FAILED' ELSE 'WARNING' END",
                f"CASE WHEN s{n} BETWEEN {lo} AND {hi} THEN 100 WHEN {far} THEN 0 ELSE 60 END",
            )
        )
    rows.append(("dpd_threshold_compliance", "CASE WHEN d>=95 THEN 'PASSED' ELSE 'FAILED' END", "d"))
    rows += [(f"{p}_range_compliance", f"CASE WHEN r_{p}>=99 THEN 'PASSED' ELSE 'FAILED' END", f"r_{p}") for p in ("pd_12m", "pd_lifetime", "lgd")]
    rows.append(("ecl_non_negative", "CASE WHEN e=100 THEN 'PASSED' ELSE 'FAILED' END", "e"))
    rows.append(("stage_transition_logic", "CASE WHEN f<=2 THEN 'PASSED' ELSE 'WARNING' END", "100-f"))
    t["compliance_validation"] = (
        "SELECT "
        + ", ".join(f"{_p(f'provision_stage={n}')} AS s{n}" for n in bands)
        + f", ({_in('days_past_due<=30', 'provision_stage=1')} + {_in('days_past_due>0 AND days_past_due<90', 'provision_stage=2')} + {_in('days_past_due>=90', 'provision_stage=3')})/3.0E0 AS d, "
        + ", ".join(f"{_p(f'{p} BETWEEN 0 AND 1')} AS r_{p}" for p in ("pd_12m", "pd_lifetime", "lgd"))
        + f", {_p('ecl>=0')} AS e, (SELECT {_p('from_stage=3 AND to_stage=1')} FROM {{transitions}}) AS f FROM {{scored}}",
        _tier_sql("compliance_validation", rows),
    )
    ml = Q.ML_FEATURES
    std = [f"stddev_samp({c})" for c in ml]
    out = "+".join(
        f"100-least(100, 2*100.0E0*(SELECT count(*) FILTER ({c}<lo OR {c}>hi)/count({c}) FROM {{scored}}, ({_fence_sql(c, 'scored')}) b{i}))" for i, c in enumerate(ml)
    )
    t["ml_readiness_validation"] = (
        f"""SELECT greatest({", ".join(f"100.0E0*count(*) FILTER ({c} IS NULL)/count(*)" for c in ml)}) AS miss,
              least({", ".join(f"count(*) FILTER (provision_stage={n})/count(*)" for n in (1, 2, 3))}) AS cls,
              greatest({", ".join(std)})/least({", ".join(std)}) AS ratio, ({out})/8.0E0 AS o FROM {{scored}}""",
        _tier_sql(
            "ml_readiness_validation",
            [
                ("ml_feature_completeness", "'PASSED'", "100"),
                ("numeric_feature_ratio", "'PASSED'", "100"),
                ("ml_missing_values", "CASE WHEN miss<=5 THEN 'PASSED' ELSE 'WARNING' END", "greatest(0, 100-miss*2)"),
                ("target_class_balance", "CASE WHEN cls>=0.01E0 THEN 'PASSED' ELSE 'WARNING' END", "least(100, cls*1000)"),
                ("feature_scaling_readiness", "CASE WHEN ratio<=100 THEN 'PASSED' ELSE 'WARNING' END", "greatest(0, 100-log10(ratio)*20)"),
                ("outlier_analysis", "CASE WHEN o>=80 THEN 'PASSED' ELSE 'WARNING' END", "o"),
            ],
        ),
    )
    return t


TIER_SQL = {name: _wrap(*parts) for name, parts in _tiers().items()}


def _one_tier(key: str, name: str, build):
    @query(key, TIER_SQL[name], ratio="score")
    def _(t):
        df = Q.narrow_portfolio(t.results)
        return Q.tier_checks(df, [build(df, t)])


_one_tier("tier_completeness", "completeness_validation", lambda df, t: Q.tier_completeness(df))
_one_tier("tier_consistency", "consistency_validation", lambda df, t: Q.tier_consistency(df))
_one_tier("tier_distribution", "distribution_validation", lambda df, t: Q.tier_distribution(df))



@query(
    "distribution_details",
    """SELECT avg(credit_score) AS score_mean, stddev_samp(credit_score) AS score_std, 100.0E0*count(*) FILTER (days_past_due=0)/count(*) AS current_pct,
         avg(interest_rate) AS rate_mean, count(*) AS n, quantile_cont(loan_amount, 0.5) AS amount_median, quantile_cont(loan_amount, 0.95) AS amount_p95 FROM {scored}""",
    ratio="score_mean score_std current_pct rate_mean amount_median amount_p95",
)
def _(t):
    return Q.distribution_details(Q.narrow_portfolio(t.results))


_one_tier("tier_correlation", "correlation_validation", lambda df, t: Q.tier_correlation(df))
_one_tier("tier_compliance", "compliance_validation", lambda df, t: Q.tier_compliance(df, t.transitions))
_one_tier("tier_ml_readiness", "ml_readiness_validation", lambda df, t: Q.tier_ml_readiness(df))


@query(
    "weighted_readiness",
    """SELECT overall_score, tiers, CASE WHEN overall_score>=95 THEN 'EXCELLENT' WHEN overall_score>=90 THEN 'PASSED' WHEN overall_score>=80 THEN 'PASSED_WITH_WARNINGS' ELSE 'FAILED' END AS compliance_status
       FROM (SELECT sum(score*CASE tier WHEN 'completeness_validation' THEN 0.2E0 WHEN 'consistency_validation' THEN 0.25E0 WHEN 'distribution_validation' THEN 0.15E0
                 WHEN 'correlation_validation' THEN 0.1E0 WHEN 'compliance_validation' THEN 0.25E0 ELSE 0.05E0 END) AS overall_score, count(*) AS tiers
             FROM (SELECT tier, avg(score) AS score FROM ("""
    + " UNION ALL ".join(TIER_SQL.values())
    + ") a GROUP BY tier) b) c",
    ratio="overall_score",
)
def _(t):
    df = Q.narrow_portfolio(t.results)
    tiers = [
        Q.tier_completeness(df), Q.tier_consistency(df), Q.tier_distribution(df), Q.tier_correlation(df),
        Q.tier_compliance(df, t.transitions), Q.tier_ml_readiness(df),
    ]
    return Q.weighted_readiness(Q.tier_checks(df, tiers))


# -- migration, scenario, integrity, masking ---------------------------------


@query(
    "stage_migration_matrix",
    "SELECT from_stage, to_stage, count(*) AS n, count(*)/sum(count(*)) OVER (PARTITION BY from_stage) AS row_share FROM {transitions} GROUP BY 1, 2",
    ratio="row_share",
)
def _(t):
    return Q.migration_matrix(t.transitions)


@query(
    "stage_migration_checks",
    """SELECT 'stage_migration' AS "check", 100.0E0*count(*) FILTER (from_stage<>to_stage)/count(*) AS observed, 100.0E0*count(*) FILTER (from_stage<>to_stage)/count(*)<=15 AS passed FROM {transitions}
       UNION ALL SELECT 'coverage_ratio', sum(calculated_ecl)/sum(current_balance), sum(calculated_ecl)/sum(current_balance) BETWEEN 0.01E0 AND 0.25E0 FROM {results}
       UNION ALL SELECT 'stage_3_share', count(*) FILTER (s=3)/count(*), count(*) FILTER (s=3)/count(*)<=0.1E0 FROM {results}""",
    ratio="observed",
)
def _(t):
    return Q.stage_migration_checks(t.transitions, t.results)


@query(
    "scenario_quality_score",
    f"""SELECT *, (completeness+uniqueness+stage_mix)/3.0E0 AS quality_score, (completeness+uniqueness+stage_mix)/3.0E0>=90 AS passed
       FROM (SELECT 100.0E0*({"+".join(f"count({c})" for c in DIRTY_TYPES)})/(count(*)*10) AS completeness, 100.0E0*count(DISTINCT loan_id)/count(*) AS uniqueness,
         CASE WHEN abs(count(*) FILTER (provision_stage='STAGE_1')/count(*)-0.85E0)<0.05E0 THEN 100.0E0 ELSE 60.0E0 END AS stage_mix FROM {{loans_dirty}}) q""",
    ratio="completeness uniqueness quality_score",
)
def _(t):
    return Q.scenario_quality(t.loans_dirty, 0.85)


@query(
    "transform_integrity",
    "SELECT count(*) AS rows_before, count(*) AS rows_after, CAST(0 AS BIGINT) AS rows_with_nulls, true AS intact FROM {loans}",
)
def _(t):
    return Q.transform_integrity(t.loans, with_risk_category(t.results), ["risk_category", "ecl_amount"])


@query(
    "pii_masked_loans",
    "SELECT sha256(loan_id || 'pepper') AS loan_id, sha256(customer_id || 'pepper') AS customer_id, loan_type, current_balance FROM {loans}",
)
def _(t):
    base = t.loans.select("loan_id", "customer_id", "loan_type", "current_balance", "region")
    return Q.masked(base, ["loan_id", "customer_id"], "pepper", drop=["region"])
