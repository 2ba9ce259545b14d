"""Data-quality and compliance checks.

A set of checks is one aggregate: every rule becomes a conditional count, so a
table is scanned once however many rules there are, and the result is stacked
into one row per check.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossgrid import config as C
from lossgrid.config import DEFAULTS, EclConfig
from lossgrid.functions import rules as R
from lossgrid.functions.expr import hit, pct, share
from lossgrid.operators.moments import correlations
from lossgrid.operators.scale import exact_quantiles, quantile_columns
from lossgrid.sources.scratch import materialised


def stack(one_row: DataFrame, rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Several output rows from one aggregate row."""
    entries = F.array(*[F.struct(*[c.alias(n) for n, c in row.items()]) for row in rows])
    return one_row.select(F.explode(entries).alias("r")).select("r.*")


def check_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(check, violations, records, passed) per rule; an unknown rule value is not a violation."""
    one = df.agg(
        F.count("*").alias("records"), *[F.count_if(hit(bad)).alias(f"v{i}") for i, bad in enumerate(rules.values())]
    )
    return stack(
        one,
        [
            {
                "check": F.lit(name),
                "violations": F.col(f"v{i}"),
                "records": F.col("records"),
                "passed": F.col(f"v{i}") == 0,
            }
            for i, name in enumerate(rules)
        ],
    )


def must(condition: Column) -> Column:
    """Violation of a non-nullable column rule: false or unknown."""
    return ~hit(condition)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return stack(one, [{"column_name": F.lit(c), "null_count": F.col(c)} for c in columns])


# -- schema rules ------------------------------------------------------------


def loan_schema_rules(df: DataFrame) -> dict[str, Column]:
    """Violations of the loan schema, for the columns the frame has."""
    rules = {
        "loan_id": must(F.col("loan_id").rlike(r"^L\d{6}$")),
        "customer_id": must(F.col("customer_id").rlike(r"^C\d{6}$")),
        "loan_amount": must((F.col("loan_amount") > 0) & (F.col("loan_amount") <= 10_000_000)),
        "interest_rate": must(F.col("interest_rate").between(0, 30)),
        "term_months": must((F.col("term_months") > 0) & (F.col("term_months") <= 360)),
        "loan_type": must(F.col("loan_type").isin("MORTGAGE", "AUTO", "PERSONAL", "BUSINESS", "CREDIT_CARD")),
        "credit_score": must(F.col("credit_score").between(300, 850)),
        "days_past_due": must(F.col("days_past_due") >= 0),
        "current_balance": must(F.col("current_balance") >= 0),
        "provision_stage": must(F.col("provision_stage").isin(*C.STAGES)),
        # nullable: only present values can violate
        "pd_rate": hit(~F.col("pd_rate").between(0, 1)),
        "lgd_rate": hit(~F.col("lgd_rate").between(0, 1)),
    }
    return {c: bad for c, bad in rules.items() if c in df.columns}


PAYMENT_STATUSES = ("PAID", "MISSED", "PARTIAL")


def payment_schema_rules() -> dict[str, Column]:
    return {
        "loan_id": must(F.col("loan_id").rlike(r"^L\d{6}$")),
        "payment_date": F.col("payment_date").isNull(),
        "scheduled_payment": must(F.col("scheduled_payment") >= 0),
        "actual_payment": must(F.col("actual_payment") >= 0),
        "payment_status": must(F.col("payment_status").isin(*PAYMENT_STATUSES)),
        "days_late": must(F.col("days_late") >= 0),
    }


def macro_schema_rules() -> dict[str, Column]:
    return {
        "date": F.col("date").isNull(),
        "gdp_growth": must((F.col("gdp_growth") > -10) & (F.col("gdp_growth") < 10)),
        "unemployment_rate": must((F.col("unemployment_rate") >= 0) & (F.col("unemployment_rate") < 30)),
        "inflation_rate": must((F.col("inflation_rate") > -5) & (F.col("inflation_rate") < 20)),
        "interest_rate": must((F.col("interest_rate") >= 0) & (F.col("interest_rate") < 25)),
    }


# -- business rules ----------------------------------------------------------


def duplicate_id_rows(df: DataFrame, key: str) -> Column:
    """Scalar subquery: rows whose key occurs more than once, all copies counted."""
    per_key = df.groupBy(key).agg(F.count("*").alias("c"))
    return per_key.agg(F.coalesce(F.sum(F.when(F.col("c") > 1, F.col("c"))), F.lit(0)).alias("d")).scalar()


def business_rules_loan(df: DataFrame) -> DataFrame:
    low = (F.col("provision_stage") == "STAGE_3") & (F.col("days_past_due") < 90)
    simple = check_counts(
        df,
        {
            "balance_exceeds_amount": F.col("current_balance") > F.col("loan_amount"),
            "stage_3_low_dpd": low,
            **({"negative_ecl": F.col("ecl_amount") < 0} if "ecl_amount" in df.columns else {}),
        },
    )
    dup = df.select("loan_id").agg(F.count("*").alias("records")).select(
        F.lit("duplicate_loan_id").alias("check"),
        duplicate_id_rows(df, "loan_id").alias("violations"),
        "records",
    )
    return simple.unionByName(dup.withColumn("passed", F.col("violations") == 0))


def business_rules_payment(df: DataFrame) -> DataFrame:
    paid, status = F.col("actual_payment"), F.col("payment_status")
    return check_counts(
        df,
        {
            "overpayment": paid > F.col("scheduled_payment") * 2,
            "status_mismatch": ((status == "PAID") & (paid == 0)) | ((status == "MISSED") & (paid > 0)),
        },
    )


def validation_report(results: Mapping[str, DataFrame]) -> DataFrame:
    """One row per dataset from its check rows."""
    parts = [
        checks.agg(
            F.max("records").alias("records"),
            F.count_if(~F.col("passed")).alias("n_errors"),
            F.concat_ws(",", F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("check"))))).alias("errors"),
        ).select(F.lit(name).alias("dataset"), "records", (F.col("n_errors") == 0).alias("passed"), "n_errors", "errors")
        for name, checks in results.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -- profiles ----------------------------------------------------------------


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def column_profile(df: DataFrame) -> DataFrame:
    """Type, nulls, distinct values, moments and quartiles of every column.

    Distinct counts come from (column, value) groups, which spread over the
    cluster by value; quartiles use the bracketed exact method.
    """
    columns, numeric = df.columns, _numeric(df)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    aggs = [F.count("*").alias("n")]
    for i, c in enumerate(columns):
        aggs.append(F.count(c).alias(f"c{i}"))
        if c in numeric:
            aggs += [
                F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}"),
                F.min(c).cast("double").alias(f"lo{i}"), F.max(c).cast("double").alias(f"hi{i}"),
            ]
    none = F.lit(None).cast("double")
    basic = stack(
        df.agg(*aggs),
        [
            {
                "column_name": F.lit(c),
                "data_type": F.lit(types[c]),
                "records": F.col("n"),
                "null_count": F.col("n") - F.col(f"c{i}"),
                "null_pct": pct(F.col("n") - F.col(f"c{i}"), F.col("n")),
                "mean": F.col(f"m{i}") if c in numeric else none,
                "std": F.col(f"s{i}") if c in numeric else none,
                "min": F.col(f"lo{i}") if c in numeric else none,
                "max": F.col(f"hi{i}") if c in numeric else none,
            }
            for i, c in enumerate(columns)
        ],
    )
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns])
    )
    distinct = (
        df.select(cells.alias("e")).select("e.*").where(F.col("v").isNotNull()).groupBy("column_name", "v").agg(F.lit(1).alias("_one"))
        .groupBy("column_name").agg(F.count("*").alias("unique_values"))
    )
    quart = exact_quantiles(df, numeric, (0.25, 0.5, 0.75)).groupBy(F.col("metric").alias("column_name")).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"q{int(p * 100)}") for p in (0.25, 0.5, 0.75)]
    )
    # both right sides have one row per column of the table
    return (
        basic.join(F.broadcast(distinct), "column_name", "left")
        .join(F.broadcast(quart), "column_name", "left")
        .withColumn("unique_values", F.coalesce("unique_values", F.lit(0)))
        .withColumn("unique_pct", pct(F.col("unique_values"), F.col("records")))
        .withColumn("candidate_key", F.col("unique_values") == F.col("records"))
    )


def completeness(df: DataFrame) -> Column:
    """Aggregate: percent of non-null cells."""
    filled = sum((F.count(c) for c in df.columns[1:]), F.count(df.columns[0]))
    return pct(filled, F.count("*") * len(df.columns))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of identical rows."""
    per_row = df.groupBy(*df.columns).agg(F.count("*").alias("_c"))
    return per_row.agg(
        F.sum("_c").alias("records"), F.sum(F.col("_c") - 1).alias("duplicate_rows")
    ).withColumn("duplicate_pct", pct(F.col("duplicate_rows"), F.col("records")))


def _fences(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    q = exact_quantiles(df, columns, (0.25, 0.75))
    wide = q.groupBy("metric").agg(
        F.max("n").alias("present"),
        F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("q3"),
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    return wide.select(
        "metric", "present", (F.col("q1") - reach).alias("lower_bound"), (F.col("q3") + reach).alias("upper_bound")
    )


def _outlying(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns])
    )
    long = df.select(*keep, cells.alias("e")).select(*keep, "e.*")
    # one fence row per column
    return long.join(F.broadcast(_fences(df, columns)), "metric").withColumn(
        "is_outlier", hit((F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound")))
    )


def iqr_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _outlying(df, columns).groupBy("metric", "lower_bound", "upper_bound").agg(
        F.count_if("is_outlier").alias("outlier_count"),
        pct(F.count_if("is_outlier"), F.count("*")).alias("outlier_pct"),
    )


def iqr_outlier_examples(df: DataFrame, columns: Sequence[str], key: str, k: int = 10) -> DataFrame:
    """First k outliers per column in key order (k rows per task and column reach the last step)."""
    from pyspark.sql import Window

    w = Window.partitionBy("metric").orderBy(key)
    return (
        _outlying(df, columns, [key]).where("is_outlier")
        .select("metric", key, "value", F.row_number().over(w).alias("rank"))
        .where(F.col("rank") <= k)
    )


# -- calculation checks ------------------------------------------------------


def calc_bounds_checks(results: DataFrame) -> DataFrame:
    return check_counts(
        results,
        {
            "pd_bounds": ~F.col("calculated_pd").between(0, 1),
            "lgd_bounds": ~F.col("calculated_lgd").between(0, 1),
            "ecl_non_negative": F.col("calculated_ecl") < 0,
        },
    )


def calc_compliance_checks(results: DataFrame, cfg: EclConfig = DEFAULTS) -> DataFrame:
    """Null, range, consistency and portfolio-level checks with severities, in one pass."""
    critical = ("calculated_pd", "calculated_lgd", "calculated_ead", "calculated_ecl", "calculated_stage")
    counted = {f"null_check_{c}": (F.col(c).isNull(), "CRITICAL") for c in critical}
    counted |= {
        "pd_range_validation": (~F.col("calculated_pd").between(0, 1), "CRITICAL"),
        "lgd_range_validation": (~F.col("calculated_lgd").between(0, 1), "CRITICAL"),
        "ecl_consistency_validation": (F.col("calculated_ecl") > F.col("calculated_ead"), "HIGH"),
    }
    one = results.agg(
        *[F.count_if(hit(bad)).alias(name) for name, (bad, _) in counted.items()],
        F.coalesce(share(F.sum("calculated_ecl"), F.sum("current_balance")), F.lit(0.0)).alias("ecl_rate"),
        share(F.count_if(F.col("calculated_stage") == "STAGE_3"), F.count("*")).alias("stage3_rate"),
        share(F.count_if(F.col("stage_confidence") < 0.5), F.count("*")).alias("low_confidence"),
    )

    def row(name: str, observed: Column, limit: float, ok: Column, severity: str) -> dict[str, Column]:
        return {
            "check": F.lit(name),
            "observed": observed.cast("double"),
            "threshold": F.lit(float(limit)),
            "passed": ok,
            "severity": F.when(ok, "INFO").otherwise(severity),
        }

    rows = [row(n, F.col(n), 0, F.col(n) == 0, sev) for n, (_, sev) in counted.items()]
    rate, s3, low = F.col("ecl_rate"), F.col("stage3_rate"), F.col("low_confidence")
    rows += [
        row("portfolio_ecl_rate_validation", rate, cfg.max_portfolio_rate, rate <= cfg.max_portfolio_rate, "HIGH"),
        row("stage3_distribution_check", s3, cfg.max_stage_3_share, s3 < cfg.max_stage_3_share, "MEDIUM"),
        row("ml_confidence_validation", low, cfg.max_low_confidence_share, low < cfg.max_low_confidence_share, "MEDIUM"),
    ]
    return stack(one, rows)


def data_quality_view(scored: DataFrame, updated: str, cfg: EclConfig = DEFAULTS) -> DataFrame:
    """Thirteen violation counters to completeness, consistency, freshness and an overall rating."""
    def bad(c: str, cond: Column) -> Column:
        return F.col(c).isNull() | hit(cond)

    incomplete = {
        "loan_id": F.col("loan_id").isNull(),
        "customer_id": F.col("customer_id").isNull(),
        "amount": bad("loan_amount", F.col("loan_amount") <= 0),
        "balance": bad("current_balance", F.col("current_balance") < 0),
        "score": bad("credit_score", ~F.col("credit_score").between(300, 850)),
        "stage": bad("provision_stage", ~F.col("provision_stage").isin(1, 2, 3)),
        "pd": bad("pd_12m", ~F.col("pd_12m").between(0, 1)),
        "lgd": bad("lgd", ~F.col("lgd").between(0, 1)),
        "ecl": bad("ecl", F.col("ecl") < 0),
    }
    inconsistent = {
        "balance_exceeds_original": F.col("current_balance") > F.col("loan_amount"),
        "stage3_no_dpd": (F.col("provision_stage") == 3) & (F.col("days_past_due") == 0),
        "stage1_high_dpd": (F.col("provision_stage") == 1) & (F.col("days_past_due") > 90),
        "invalid_dates": F.col("maturity_date") <= F.col("origination_date"),
    }

    def total(rules: Mapping[str, Column]) -> Column:
        return F.sum(sum((hit(c).cast("long") for c in rules.values()), F.lit(0)))

    n = F.count("*")
    age = F.datediff(F.lit(cfg.as_of_date), F.max(updated))
    base = scored.agg(
        n.alias("total_records"),
        pct(n - total(incomplete), n).alias("completeness_score"),
        pct(n - total(inconsistent), n).alias("consistency_score"),
        age.alias("days_since_update"),
    )
    days = F.col("days_since_update")
    fresh = F.when(days <= 1, 100.0).when(days <= 7, 80.0).when(days <= 30, 60.0).otherwise(0.0)
    overall = (F.col("completeness_score") + F.col("consistency_score") + F.col("freshness_score")) / 3.0
    rating = (
        F.when(F.col("overall_quality_score") >= 95, "Excellent").when(F.col("overall_quality_score") >= 85, "Good")
        .when(F.col("overall_quality_score") >= 70, "Fair").otherwise("Poor")
    )
    return (
        base.withColumn("freshness_score", fresh)
        .withColumn("overall_quality_score", overall)
        .withColumn("quality_rating", rating)
    )


def quality_gates(df: DataFrame, required: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """Completeness, duplicates, outliers and required fields against their limits."""
    full = df.agg(
        completeness(df).alias("completeness"),
        F.lit(float(len(set(required) - set(df.columns)))).alias("missing_fields"),
    )
    dup = duplicate_rows(df).select("duplicate_pct").scalar()
    outlying = _outlying(df, numeric).agg(pct(F.count_if("is_outlier"), F.count("*")).alias("o")).scalar()
    one = full.withColumns({"dup": dup, "outlier": outlying})
    return stack(
        one,
        [
            {"gate": F.lit("completeness"), "observed": F.col("completeness"), "threshold": F.lit(95.0), "passed": F.col("completeness") >= 95},
            {"gate": F.lit("duplicates"), "observed": F.col("dup"), "threshold": F.lit(1.0), "passed": F.col("dup") <= 1},
            {"gate": F.lit("outliers"), "observed": F.col("outlier"), "threshold": F.lit(5.0), "passed": F.col("outlier") <= 5},
            {"gate": F.lit("required_fields"), "observed": F.col("missing_fields"), "threshold": F.lit(0.0), "passed": F.col("missing_fields") == 0},
        ],
    )


# -- readiness tiers ---------------------------------------------------------

REQUIRED_FIELDS = (
    "loan_id", "customer_id", "loan_amount", "interest_rate", "origination_date", "provision_stage",
    "credit_score", "pd_12m", "lgd", "ead", "ecl",
)
ML_FEATURES = (
    "credit_score", "loan_amount", "interest_rate", "term_months", "current_balance", "days_past_due",
    "ltv_ratio", "dti_ratio",
)
EXPECTED_CORRELATIONS = (
    ("credit_score", "pd_12m", -1, 0.3),
    ("days_past_due", "provision_stage", 1, 0.5),
    ("ltv_ratio", "lgd", 1, 0.2),
    ("loan_amount", "ead", 1, 0.7),
)
NUMERIC_COLUMNS = (
    "loan_amount", "interest_rate", "term_months", "credit_score", "days_past_due", "dti_ratio", "ltv_ratio",
    "current_balance", "provision_stage", "pd_12m", "lgd", "ead", "ecl",
)


def narrow_portfolio(results: DataFrame) -> DataFrame:
    """The columns of all tiers, written once: their aggregates, quantiles and moments are passes of their own."""
    df = scored_portfolio(results)
    wanted = dict.fromkeys([*REQUIRED_FIELDS, *ML_FEATURES, *NUMERIC_COLUMNS, "pd_lifetime"])
    return materialised(df.select(*[c for c in wanted if c in df.columns]), "portfolio")


def scored_portfolio(results: DataFrame) -> DataFrame:
    """Results under the column names the readiness tiers use."""
    stage = R.stage_number(F.col("calculated_stage"))
    return results.select(
        *[c for c in results.columns if c in (
            "loan_id", "customer_id", "loan_amount", "interest_rate", "term_months", "loan_type", "origination_date", "maturity_date",
            "current_balance", "days_past_due", "credit_score", "ltv_ratio", "dti_ratio", "region",
        )],
        stage.alias("provision_stage"),
        F.col("calculated_pd").alias("pd_12m"),
        F.when(stage == 3, 1.0).otherwise(F.least(F.lit(1.0), F.col("calculated_pd") * 3.0)).alias("pd_lifetime"),
        F.col("calculated_lgd").alias("lgd"),
        F.col("calculated_ead").alias("ead"),
        F.col("calculated_ecl").alias("ecl"),
    )


def _mean_pct(condition: Column) -> Column:
    """Aggregate: percent of rows where the condition holds (unknown counts as not)."""
    return F.avg(hit(condition).cast("double")) * 100.0


def _mean_pct_in(condition: Column, scope: Column) -> Column:
    """Same within a scope; an empty scope counts as fully compliant."""
    return F.coalesce(F.avg(F.when(scope, hit(condition).cast("double"))), F.lit(1.0)) * 100.0


def _grade(score: Column, limit: float, below: str) -> Column:
    return F.when(score >= limit, "PASSED").otherwise(below)


class Tier:
    """Aggregates and check rows of one readiness tier; tiers share a single scan."""

    def __init__(
        self,
        name: str,
        passing: float,
        aggs: dict[str, Column],
        rows: list[tuple[str, Column, Column]],
        before: dict[str, Column] | None = None,
        after: dict[str, Column] | None = None,
    ):
        self.name, self.passing, self.aggs, self.rows = name, passing, aggs, rows
        #: scalar subqueries needed on the rows, and on the single aggregate row
        self.before, self.after = before or {}, after or {}


def tier_completeness(df: DataFrame, minimum: int = 1000) -> Tier:
    present = [f for f in REQUIRED_FIELDS if f in df.columns]
    aggs = {f"t1_{f}": pct(F.count(f), F.count("*")) for f in present} | {"t1_n": F.count("*")}
    all_there = len(present) == len(REQUIRED_FIELDS)
    rows = [("required_fields_present", F.lit("PASSED" if all_there else "FAILED"), F.lit(100.0 if all_there else 0.0))]
    for f in present:
        s = F.col(f"t1_{f}")
        rows.append((f"completeness_{f}", F.when(s >= 99.0, "PASSED").when(s >= 90.0, "WARNING").otherwise("FAILED"), s))
    enough = F.col("t1_n") >= minimum
    rows.append(("minimum_record_count", F.when(enough, "PASSED").otherwise("FAILED"), F.when(enough, 100.0).otherwise(0.0)))
    return Tier("completeness_validation", 99.0, aggs, rows)


def tier_consistency(df: DataFrame) -> Tier:
    stage, dpd = F.col("provision_stage"), F.col("days_past_due")
    schema_bad = ~(
        (F.col("loan_amount") > 0) & F.col("interest_rate").between(0, 1) & (F.col("term_months") > 0)
        & (F.col("current_balance") >= 0) & (dpd >= 0) & stage.isin(1, 2, 3) & F.col("credit_score").between(300, 999)
        & F.col("pd_12m").between(0, 1) & F.col("pd_lifetime").between(0, 1) & F.col("lgd").between(0, 1)
        & (F.col("ead") >= 0) & (F.col("ecl") >= 0)
    )
    expected = F.col("ead") * F.when(stage == 1, F.col("pd_12m")).otherwise(F.col("pd_lifetime")) * F.col("lgd")
    close = F.abs(expected - F.col("ecl")) / F.greatest(expected, F.lit(0.01)) <= 0.05
    aggs = {
        "t2_schema": F.count_if(F.coalesce(schema_bad, F.lit(True))),
        "t2_balance": _mean_pct(F.col("current_balance") <= F.col("loan_amount")),
        "t2_s1": _mean_pct_in(dpd == 0, stage == 1),
        "t2_s2": _mean_pct_in((dpd > 0) & (dpd < 90), stage == 2),
        "t2_s3": _mean_pct_in(dpd >= 90, stage == 3),
        "t2_pd": _mean_pct(F.col("pd_12m") <= F.col("pd_lifetime")),
        "t2_ecl": _mean_pct(close),
    }
    staged = (F.col("t2_s1") + F.col("t2_s2") + F.col("t2_s3")) / 3.0
    clean = F.col("t2_schema") == 0
    rows = [
        ("schema_validation", F.when(clean, "PASSED").otherwise("FAILED"), F.when(clean, 100.0).otherwise(0.0)),
        ("balance_consistency", _grade(F.col("t2_balance"), 95, "FAILED"), F.col("t2_balance")),
        ("stage_dpd_consistency", _grade(staged, 80, "FAILED"), staged),
        ("pd_relationship_consistency", _grade(F.col("t2_pd"), 95, "WARNING"), F.col("t2_pd")),
        ("ecl_calculation_consistency", _grade(F.col("t2_ecl"), 95, "FAILED"), F.col("t2_ecl")),
    ]
    return Tier("consistency_validation", 95.0, aggs, rows)


def tier_distribution(df: DataFrame) -> Tier:
    median = quantile_columns(df, {"median": ("loan_amount", 0.5)}).scalar()
    aggs = {
        "t3_score": F.avg("credit_score"),
        "t3_current": _mean_pct(F.col("days_past_due") == 0),
        "t3_rate": F.avg("interest_rate"),
    }
    def row(name: str, ok: Column, otherwise: float) -> tuple[str, Column, Column]:
        return name, F.when(ok, "PASSED").otherwise("WARNING"), F.when(ok, 100.0).otherwise(otherwise)

    rows = [
        row("credit_score_distribution", F.col("t3_score").between(600, 750), 60.0),
        row("loan_amount_distribution", F.col("t3_median").between(10000, 500000), 70.0),
        row("dpd_distribution", F.col("t3_current") >= 80, 60.0),
        row("interest_rate_distribution", F.col("t3_rate").between(0.01, 0.15), 50.0),
    ]
    return Tier("distribution_validation", 80.0, aggs, rows, after={"t3_median": median})


def distribution_details(df: DataFrame) -> DataFrame:
    """The figures behind the distribution tier: score, amount, arrears and rate."""
    picked = quantile_columns(df, {"amount_median": ("loan_amount", 0.5), "amount_p95": ("loan_amount", 0.95)})
    both = picked.select(F.struct("amount_median", "amount_p95").alias("q")).scalar()
    return df.agg(
        F.avg("credit_score").alias("score_mean"),
        F.stddev("credit_score").alias("score_std"),
        _mean_pct(F.col("days_past_due") == 0).alias("current_pct"),
        F.avg("interest_rate").alias("rate_mean"),
        F.count("*").alias("n"),
    ).select("*", both["amount_median"].alias("amount_median"), both["amount_p95"].alias("amount_p95"))


def tier_correlation(df: DataFrame) -> Tier:
    cols = [c for c in NUMERIC_COLUMNS if c in df.columns]
    wanted = list(dict.fromkeys([*cols, *(c for a, b, _, _ in EXPECTED_CORRELATIONS for c in (a, b))]))
    pair = F.concat_ws(":", "a", "b")
    found = correlations(df, wanted).agg(F.map_from_entries(F.collect_list(F.struct(pair.alias("pair"), "r"))).alias("m"))
    rows = []
    for a, b, sign, strength in EXPECTED_CORRELATIONS:
        r = F.try_element_at("t4_r", F.lit(":".join(sorted((a, b), key=wanted.index))))
        right = (r * sign) > 0
        firm = right & (F.abs(r) >= strength)
        rows.append(
            (
                f"correlation_{a}_{b}",
                F.when(firm, "PASSED").when(right, "WARNING").otherwise("FAILED"),
                F.when(firm, 100.0).when(right, 70.0).otherwise(30.0),
            )
        )
    listed = [f"{a}:{b}" for i, a in enumerate(cols) for b in cols[i + 1 :]]
    close = F.map_filter("t4_r", lambda k, v: k.isin(listed) & (F.abs(v) > 0.95))
    many = F.size(close) > 0
    rows.append(("multicollinearity_detection", F.when(many, "WARNING").otherwise("PASSED"), F.when(many, 60.0).otherwise(100.0)))
    # a scalar of its own: one entry per pair of columns
    return Tier("correlation_validation", 80.0, {"t4_n": F.count("*")}, rows, after={"t4_r": found.scalar()})


def tier_compliance(df: DataFrame, transitions: DataFrame | None = None) -> Tier:
    stage, dpd = F.col("provision_stage"), F.col("days_past_due")
    aggs, rows = {}, []
    for n, (low, high) in C.STAGE_SHARE_BANDS.items():
        aggs[f"t5_share{n}"] = _mean_pct(stage == n)
        s = F.col(f"t5_share{n}")
        far = (s < low * 0.5) | (s > high * 1.5)
        rows.append(
            (
                f"stage_{n}_distribution",
                F.when(s.between(low, high), "PASSED").when(far, "FAILED").otherwise("WARNING"),
                F.when(s.between(low, high), 100.0).when(far, 0.0).otherwise(60.0),
            )
        )
    aggs |= {
        "t5_d1": _mean_pct_in(dpd <= 30, stage == 1),
        "t5_d2": _mean_pct_in((dpd > 0) & (dpd < 90), stage == 2),
        "t5_d3": _mean_pct_in(dpd >= 90, stage == 3),
        "t5_ecl": _mean_pct(F.col("ecl") >= 0),
    }
    met = (F.col("t5_d1") + F.col("t5_d2") + F.col("t5_d3")) / 3.0
    rows.append(("dpd_threshold_compliance", _grade(met, 95, "FAILED"), met))
    for p in ("pd_12m", "pd_lifetime", "lgd"):
        aggs[f"t5_{p}"] = _mean_pct_in(F.col(p).between(0, 1), F.col(p).isNotNull())
        rows.append((f"{p}_range_compliance", _grade(F.col(f"t5_{p}"), 99, "FAILED"), F.col(f"t5_{p}")))
    rows.append(("ecl_non_negative", F.when(F.col("t5_ecl") == 100.0, "PASSED").otherwise("FAILED"), F.col("t5_ecl")))
    after = {}
    if transitions is not None:
        jump = (F.col("from_stage") == 3) & (F.col("to_stage") == 1)
        after["t5_jumps"] = transitions.agg(_mean_pct(jump).alias("f")).scalar()
        jumps = F.col("t5_jumps")
        rows.append(("stage_transition_logic", F.when(jumps <= 2.0, "PASSED").otherwise("WARNING"), F.lit(100.0) - jumps))
    return Tier("compliance_validation", 100.0, aggs, rows, after=after)


def tier_ml_readiness(df: DataFrame) -> Tier:
    have = [f for f in ML_FEATURES if f in df.columns]
    numeric = [f for f in have if isinstance(df.schema[f].dataType, T.NumericType)]
    found = 100.0 * len(have) / len(ML_FEATURES)
    as_number = 100.0 * len(numeric) / len(have) if have else 0.0
    fences = _fences(df, numeric).agg(
        F.map_from_entries(F.collect_list(F.struct("metric", F.struct("lower_bound", "upper_bound")))).alias("m")
    ).scalar()  # one entry per feature
    aggs = {f"t6_null_{f}": F.avg(F.col(f).isNull().cast("double")) * 100.0 for f in have}
    aggs |= {f"t6_std_{f}": F.stddev_samp(f) for f in numeric}
    aggs |= {f"t6_class{n}": F.avg(hit(F.col("provision_stage") == n).cast("double")) for n in (1, 2, 3)}
    for f in numeric:
        fence = F.element_at(F.col("_fences"), f)
        outside = (F.col(f) < fence["lower_bound"]) | (F.col(f) > fence["upper_bound"])
        aggs[f"t6_out_{f}"] = pct(F.count_if(hit(outside)), F.count(f))
    missing = F.greatest(*[F.col(f"t6_null_{f}") for f in have])
    classes = F.least(*[F.when(F.col(f"t6_class{n}") > 0, F.col(f"t6_class{n}")) for n in (1, 2, 3)])
    stds = [F.col(f"t6_std_{f}") for f in numeric]
    ratio = F.try_divide(F.greatest(*stds), F.least(*stds))
    outliers = sum((100.0 - F.least(F.col(f"t6_out_{f}") * 2, F.lit(100.0)) for f in numeric), F.lit(0.0)) / float(len(numeric))
    rows = [
        ("ml_feature_completeness", F.lit("PASSED" if found >= 80 else "FAILED"), F.lit(found)),
        ("numeric_feature_ratio", F.lit("PASSED" if as_number >= 70 else "WARNING"), F.lit(as_number)),
        ("ml_missing_values", F.when(missing <= 5, "PASSED").otherwise("WARNING"), F.greatest(F.lit(0.0), 100.0 - missing * 2)),
        ("target_class_balance", F.when(classes >= 0.01, "PASSED").otherwise("WARNING"), F.least(F.lit(100.0), classes * 1000)),
        ("feature_scaling_readiness", F.when(ratio <= 100, "PASSED").otherwise("WARNING"), F.greatest(F.lit(0.0), 100.0 - F.log10(ratio) * 20)),
        ("outlier_analysis", _grade(outliers, 80, "WARNING"), outliers),
    ]
    return Tier("ml_readiness_validation", 90.0, aggs, rows, before={"_fences": fences})


def tier_checks(df: DataFrame, tiers: Sequence[Tier]) -> DataFrame:
    """(tier, check, status, score) of all tiers from one aggregate over the portfolio."""
    before = {n: c for t in tiers for n, c in t.before.items()}
    after = {n: c for t in tiers for n, c in t.after.items()}
    aggs = {n: c for t in tiers for n, c in t.aggs.items()}
    base = df.withColumns(before) if before else df
    one = base.agg(*[a.alias(n) for n, a in aggs.items()])
    one = one.withColumns(after) if after else one
    return stack(
        one,
        [
            {"tier": F.lit(t.name), "check": F.lit(name), "status": status, "score": score.cast("double")}
            for t in tiers
            for name, status, score in t.rows
        ],
    )


def weighted_readiness(checks: DataFrame, weights: Mapping[str, float] = C.TIER_WEIGHTS) -> DataFrame:
    tiers = checks.groupBy("tier").agg(F.avg("score").alias("score"))
    from lossgrid.functions.expr import lookup

    overall = F.sum(F.col("score") * lookup(F.col("tier"), dict(weights), 1.0 / len(weights)))
    graded = tiers.agg(overall.alias("overall_score"), F.count("*").alias("tiers"))
    s = F.col("overall_score")
    return graded.withColumn(
        "compliance_status",
        F.when(s >= 95, "EXCELLENT").when(s >= 90, "PASSED").when(s >= 80, "PASSED_WITH_WARNINGS").otherwise("FAILED"),
    )


# -- migration, scenario quality, integrity ----------------------------------


def migration_matrix(transitions: DataFrame) -> DataFrame:
    counts = transitions.groupBy("from_stage", "to_stage").agg(F.count("*").alias("n"))
    from pyspark.sql import Window

    return counts.withColumn("row_share", share(F.col("n"), F.sum("n").over(Window.partitionBy("from_stage"))))


def stage_migration_checks(transitions: DataFrame, results: DataFrame, cfg: EclConfig = DEFAULTS) -> DataFrame:
    moved = transitions.agg(_mean_pct(F.col("from_stage") != F.col("to_stage")).alias("m")).scalar()
    one = results.agg(
        share(F.sum("calculated_ecl"), F.sum("current_balance")).alias("coverage"),
        share(F.count_if(F.col("calculated_stage") == "STAGE_3"), F.count("*")).alias("s3"),
    ).withColumn("moved", moved)
    low, high = cfg.coverage_band
    return stack(
        one,
        [
            {"check": F.lit("stage_migration"), "observed": F.col("moved"), "passed": F.col("moved") <= cfg.max_stage_migration_pct},
            {"check": F.lit("coverage_ratio"), "observed": F.col("coverage"), "passed": F.col("coverage").between(low, high)},
            {"check": F.lit("stage_3_share"), "observed": F.col("s3"), "passed": F.col("s3") <= cfg.max_stage_3_share},
        ],
    )


def scenario_quality(df: DataFrame, target_stage_1: float) -> DataFrame:
    """Mean of completeness, id uniqueness and closeness of the Stage 1 share to its target."""
    one = df.agg(
        completeness(df).alias("completeness"),
        share(F.count_if(F.col("provision_stage").cast("string").endswith("1")), F.count("*")).alias("s1"),
        F.count("*").alias("n"),
    )
    ids = df.select("loan_id").distinct().agg(F.count("*").alias("d")).scalar()
    near = F.abs(F.col("s1") - target_stage_1) < 0.05
    return (
        one.withColumns({"uniqueness": pct(ids, F.col("n")), "mix": F.when(near, 100.0).otherwise(60.0)})
        .select(
            "completeness", "uniqueness", F.col("mix").alias("stage_mix"),
            ((F.col("completeness") + F.col("uniqueness") + F.col("mix")) / 3.0).alias("quality_score"),
        )
        .withColumn("passed", F.col("quality_score") >= 90)
    )


def transform_integrity(before: DataFrame, after: DataFrame, produced: Sequence[str]) -> DataFrame:
    """Row count preserved and no nulls introduced in the produced columns."""
    nulls = F.count_if(sum((F.col(c).isNull().cast("int") for c in produced[1:]), F.col(produced[0]).isNull().cast("int")) > 0)
    return after.agg(F.count("*").alias("rows_after"), nulls.alias("rows_with_nulls")).select(
        before.agg(F.count("*").alias("n")).scalar().alias("rows_before"), "rows_after", "rows_with_nulls"
    ).withColumn("intact", (F.col("rows_before") == F.col("rows_after")) & (F.col("rows_with_nulls") == 0))


def masked(df: DataFrame, ids: Sequence[str], salt: str, drop: Sequence[str] = ()) -> DataFrame:
    """Identifiers replaced by salted hashes, direct identifiers dropped."""
    return df.drop(*drop).withColumns({c: F.sha2(F.concat(F.col(c), F.lit(salt)), 256) for c in ids})


