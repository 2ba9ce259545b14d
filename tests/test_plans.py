"""Plan shape: what reaches the scan, and what must not appear."""

from lossgrid.plans.registry import load_all

Q = load_all()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_provisioning_has_no_shuffle(spark, tables):
    plan = _plan(tables.results)
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan and "Window" not in plan


def test_scan_is_pruned(tables):
    plan = _plan(tables.loans.select("loan_id", "days_past_due"))
    orders = next(line for line in plan.splitlines() if "orders.parquet" in line)
    assert "o_totalprice" not in orders and "o_orderdate" not in orders


def test_no_cross_joins(spark, tables):
    for key in ("stress_pd", "stress_pd_per_loan", "join_latest_macro", "regional_risk", "impute", "feature_contributions", "transition_direction"):
        plan = _plan(Q[key].build(tables))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, key


def test_top_k_keeps_k_rows_per_task(tables):
    assert "WindowGroupLimit" in _plan(Q["largest_exposures"].build(tables))
    assert "WindowGroupLimit" in _plan(Q["iqr_outlier_examples"].build(tables))
    assert "TakeOrderedAndProject" in _plan(Q["sample_n"].build(tables))


def test_checks_are_one_aggregate(tables):
    plan = _plan(Q["schema_checks_payment"].build(tables))
    assert plan.count("FileScan parquet") == 1
