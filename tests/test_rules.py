"""Hand-checked loans, boundaries and invariants of the provisioning chain."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lossgrid.config import EclConfig
from lossgrid.operators import quality as Q
from lossgrid.plans.provisioning import process_portfolio
from lossgrid.sources.schemas import require_columns

CFG = EclConfig(as_of_date=dt.date(2024, 1, 1))
COLUMNS = (
    "loan_id string, loan_amount double, current_balance double, days_past_due int, credit_score int, loan_type string, "
    "collateral_value double, ltv_ratio double, term_months int, maturity_date date"
)


def _loan(i, amount, balance, dpd, score, kind, collateral, ltv, term):
    return (f"L{i:06d}", amount, balance, dpd, score, kind, collateral, ltv, term, dt.date(2024, 1, 1) + dt.timedelta(days=term * 30))


SAMPLE = [
    _loan(1, 100e3, 80e3, 0, 750, "MORTGAGE", 120e3, 0.83, 360),
    _loan(2, 50e3, 45e3, 35, 650, "AUTO", 55e3, 0.91, 60),
    _loan(3, 25e3, 24e3, 95, 500, "PERSONAL", 0.0, None, 36),
    _loan(4, 150e3, 140e3, 15, 700, "MORTGAGE", 180e3, 0.83, 360),
    _loan(5, 75e3, 70e3, 45, 600, "AUTO", 85e3, 0.88, 72),
    _loan(6, 300e3, 280e3, 120, 480, "MORTGAGE", 350e3, 0.86, 360),
    _loan(7, 15e3, 14e3, 5, 800, "PERSONAL", 0.0, None, 24),
    _loan(8, 200e3, 180e3, 60, 550, "MORTGAGE", 220e3, 0.91, 360),
    _loan(9, 80e3, 78e3, 0, 720, "AUTO", 90e3, 0.89, 60),
    _loan(10, 120e3, 110e3, 30, 680, "PERSONAL", 0.0, None, 48),
]


@pytest.fixture(scope="module")
def processed(spark):
    return process_portfolio(spark.createDataFrame(SAMPLE, COLUMNS), CFG).persist()


def test_sample_stages(processed):
    stages = {r.loan_id: r.calculated_stage[-1] for r in processed.collect()}
    assert "".join(stages[f"L{i:06d}"] for i in range(1, 11)) == "1231231212"


def test_boundaries(spark):
    rows = [
        _loan(1, 100e3, 80e3, 30, 499, "MORTGAGE", 120e3, 0.94, 12),
        _loan(2, 50e3, 45e3, 89, 500, "AUTO", 55e3, 0.95, 12),
        _loan(3, 25e3, 24e3, 90, 501, "PERSONAL", 0.0, 0.96, 12),
        _loan(4, 150e3, 140e3, 0, 750, "MORTGAGE", 180e3, 0.83, 12),
        _loan(5, 75e3, 70e3, 91, 400, "AUTO", 85e3, None, 12),
        _loan(6, 75e3, 70e3, 29, 651, "AUTO", 85e3, 0.95, 12),
        _loan(7, 75e3, 70e3, 0, 650, "AUTO", 85e3, 0.5, 12),
        _loan(8, 75e3, 70e3, 0, 700, "AUTO", 85e3, 0.9501, 12),
        _loan(9, 75e3, 70e3, None, None, "AUTO", 85e3, None, 12),
    ]
    got = {r.loan_id: r.calculated_stage for r in process_portfolio(spark.createDataFrame(rows, COLUMNS), CFG).collect()}
    assert [got[f"L{i:06d}"][-1] for i in range(1, 10)] == list("223131221")


def test_values_by_hand(processed):
    r = processed.where("loan_id = 'L000003'").first()
    assert (r.calculated_pd, r.calculated_lgd, r.calculated_ead, r.calculated_ecl) == (1.0, 1.0, 24e3, 24e3)
    r = processed.where("loan_id = 'L000001'").first()
    assert r.calculated_pd == pytest.approx(0.04)  # (850-750)/1700 is above the Stage 1 ceiling
    assert r.calculated_lgd == pytest.approx(0.20)  # recovery capped at .95, floor .20
    years = 10800 / 365.25
    assert r.calculated_ecl == pytest.approx(0.04 * 0.2 * 80e3 * 1.03**-years * 1.15)
    r = processed.where("loan_id = 'L000002'").first()
    assert r.calculated_pd == pytest.approx(250 / 900)
    assert r.calculated_ecl <= r.calculated_lgd * r.calculated_ead


def test_invariants(processed):
    bad = processed.where(
        "calculated_pd not between 0 and 1 or calculated_lgd not between 0 and 1 or calculated_ecl < 0 or calculated_ecl > calculated_ead"
    )
    assert bad.count() == 0
    mean = {r[0]: r[1] for r in processed.groupBy("calculated_stage").agg(F.avg("calculated_ecl")).collect()}
    assert mean["STAGE_3"] > mean["STAGE_1"]
    assert all(c.passed for c in Q.calc_compliance_checks(processed).where("check not like 'stage3%' and check not like 'portfolio%'").collect())


def test_stage_weight_is_optional(spark, processed):
    weighted = process_portfolio(spark.createDataFrame(SAMPLE, COLUMNS), EclConfig(as_of_date=CFG.as_of_date, apply_stage_weight=True))
    r = weighted.where("loan_id = 'L000003'").first()
    assert r.calculated_ecl == 48e3
    assert processed.where("loan_id = 'L000003'").first().ecl_stage_weighted == 48e3


def test_many_stage_3_loans_keep_their_exposure(spark):
    rows = [_loan(i, 10e3, 9e3, 120, 600, "AUTO", 0.0, None, 12) for i in range(1, 31)]
    got = process_portfolio(spark.createDataFrame(rows, COLUMNS), CFG).agg(F.min("calculated_ecl"), F.max("calculated_ecl")).first()
    assert tuple(got) == (9e3, 9e3)


def test_missing_columns_fail_without_a_job(spark):
    with pytest.raises(ValueError, match="current_balance"):
        require_columns(spark.createDataFrame([("L1",)], "loan_id string"), ["loan_id", "current_balance"])


def test_invalid_rows_are_caught(spark):
    ddl = (
        "loan_id string, customer_id string, loan_amount double, interest_rate double, term_months int, loan_type string, credit_score int, "
        "days_past_due int, current_balance double, provision_stage string, pd_rate double, lgd_rate double"
    )
    rows = [("INVALID", "X1", -25000.0, 45.0, 0, "OTHER", 1000, -5, -1.0, "STAGE_9", 1.5, -0.1)]
    df = spark.createDataFrame(rows, ddl)
    assert {r.check: r.violations for r in Q.check_counts(df, Q.loan_schema_rules(df)).collect()} == {c: 1 for c in df.columns}
