"""Distributed building blocks against brute force, with one key holding a third of the rows."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lossgrid.operators import scale as S
from lossgrid.operators import windows as W
from lossgrid.operators.evaluation import auc_one_vs_rest
from lossgrid.operators.sampling import loan_hash, split_stratified


@pytest.fixture(scope="module")
def skewed():
    rng = np.random.default_rng(7)
    n = 6000
    key = np.where(np.arange(n) % 3 == 0, "hot", rng.integers(0, 40, n).astype(str))
    return pd.DataFrame({"k": key, "t": rng.permutation(n), "v": rng.normal(size=n).round(2), "w": rng.integers(0, 5, n)})


@pytest.fixture(scope="module")
def frame(spark, skewed):
    return spark.createDataFrame(skewed).repartition(7)


def test_row_number(frame, skewed):
    got = S.distributed_row_number(frame, ["k"], ["t"]).toPandas().set_index("t").row_number.sort_index()
    want = skewed.sort_values("t").groupby("k").cumcount() + 1
    assert (got.values == want.values).all()


def test_lag(frame, skewed):
    got = S.distributed_lag(frame, ["k"], ["t"], {"prev": "v"}).toPandas().sort_values("t").prev
    want = skewed.sort_values("t").groupby("k").v.shift()
    assert np.allclose(got.astype(float).values, want.values, equal_nan=True)


def test_running_sums(frame, skewed):
    got = S.distributed_running_sums(frame, ["k"], ["t"], {"s": F.col("w")}).toPandas().sort_values("t").s_before
    ordered = skewed.sort_values("t")
    want = ordered.groupby("k").w.cumsum() - ordered.w
    assert (got.values == want.values).all()


@pytest.mark.parametrize("accuracy", [50, 400, 20000])
def test_quantiles_by_group(frame, skewed, accuracy):
    probs = [0.0, 0.05, 0.25, 0.5, 0.95, 1.0]
    got = S.exact_quantiles(frame, ["v", "w"], probs, by=["k"], accuracy=accuracy).toPandas()
    for (k, metric), part in got.groupby(["k", "metric"]):
        want = skewed[skewed.k == k][metric].quantile(probs)
        assert np.allclose(part.set_index("prob").value.loc[probs], want.loc[probs]), (k, metric)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-3, 3), st.floats(-1e6, 1e6)), min_size=1, max_size=300), st.floats(0, 1))
def test_quantiles_any_values(spark, values, p):
    floats = [None if v is None else float(v) for v in values]
    df = spark.createDataFrame([(v,) for v in floats], "x double")
    got = [r.value for r in S.exact_quantiles(df, ["x"], [p], accuracy=20).collect()]
    present = [v for v in floats if v is not None]
    assert len(got) == (1 if present else 0)
    if present:
        assert got[0] == pytest.approx(np.quantile(present, p), rel=1e-9, abs=1e-9)


def test_split_is_exact(spark):
    ids = spark.range(5000).select(
        F.concat(F.lit("L"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("loan_id"),
        F.when(F.col("id") % 3 == 0, "STAGE_1").when(F.col("id") % 7 == 0, "STAGE_3").otherwise("STAGE_2").alias("stage"),
    )
    for r in split_stratified(ids, "stage").groupBy("stage").agg(F.count("*").alias("n"), F.count_if("is_train").alias("t")).collect():
        assert r.t == int(0.8 * r.n)


def test_auc_against_pairs(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"y": rng.choice(["a", "b"], 400), "s": rng.integers(0, 20, 400) / 20})
    got = auc_one_vs_rest(spark.createDataFrame(pdf), "y", {"a": F.col("s")}).first().auc
    pos, neg = pdf[pdf.y == "a"].s.values[:, None], pdf[pdf.y == "b"].s.values[None, :]
    assert got == pytest.approx(((pos > neg) + 0.5 * (pos == neg)).mean())


def test_streaks_equal_whole_loan_windows(tables):
    columns = ["loan_id", "line_no", "l_partkey", "l_suppkey", "payment_no", "previous_status", "missed_so_far"]
    third = F.when(F.col("l_partkey") % 3 == 0, "L000000").otherwise(F.col("loan_id"))
    pays = tables.payments.withColumn("loan_id", third).dropDuplicates(["loan_id", *W.PAYMENT_ORDER])
    order = Window.partitionBy("loan_id").orderBy(*W.PAYMENT_ORDER)
    missed = (F.col("payment_status") == "MISSED").cast("long")
    plain = pays.withColumns(
        {
            "payment_no": F.row_number().over(order).cast("long"),
            "previous_status": F.lag("payment_status").over(order),
            "missed_so_far": F.sum(missed).over(order.rowsBetween(Window.unboundedPreceding, 0)),
        }
    ).select(*columns, "payment_date")
    split = W.payment_streaks(pays).select(*columns, "payment_date")
    assert plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0


def test_group_stats_start_no_job(spark, frame):
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("group-stats", "")
    small = S.attach_group_stats(frame, ["k"], F.count("*").alias("n"))
    assert not status.getJobIdsForGroup("group-stats")
    assert small.where("k = 'hot'").select("n").first().n >= 2000


@pytest.mark.parametrize("n", [1_500, 15_000, 2_000_000])
def test_hash_is_no_order(spark, n):
    number = F.col("id") * (1 if n < 1_000_000 else 4_001)
    rows = spark.range(0, n, max(1, n // 1_500)).select(F.concat(F.lit("L"), number.cast("string")).alias("loan_id"), number.alias("v"))
    assert abs(rows.select(F.corr(loan_hash(), F.col("v"))).first()[0]) < 0.08


def test_ids_keep_all_digits(spark):
    from lossgrid.sources.tables import DERIVED

    keys = [5, 99_999, 999_999, 1_000_000, 1_000_001, 9_999_999_999]
    text = DERIVED["payments"].split(" AS loan_id")[0].split("SELECT ")[1]
    got = spark.createDataFrame([(k,) for k in keys], "l_orderkey long").selectExpr(f"{text} AS loan_id").collect()
    assert [r.loan_id for r in got] == ["L000005", "L099999", "L999999", "L1000000", "L1000001", "L9999999999"]


def test_affine_scan_of_a_long_series(spark):
    """A million steps over many slices, with gaps and nothing at the start."""
    import numpy as np

    from lossgrid.operators.windows import persistence

    n = 1_000_000
    k = F.col("id")
    u = F.when((k < 3) | (k % 1000 == 17), None).otherwise(F.pmod(F.hash(k), F.lit(1000)) / 10.0)
    series = spark.range(n).select(k.alias("day"), u.alias("u"), F.when(k == 0, 1.0).otherwise(u).alias("v")).repartition(9)
    got = persistence(series, "day", {"u": 0.7, "v": 0.99}).toPandas().sort_values("day")
    values = series.orderBy("day").toPandas()
    for c, w in (("u", 0.7), ("v", 0.99)):
        x, want = None, np.full(n, np.nan)
        for i, v in enumerate(values[c].to_numpy()):
            if not np.isnan(v):
                x = v if x is None else w * x + (1 - w) * v
            if x is not None:
                want[i] = x
        np.testing.assert_allclose(got[f"{c}_smooth"].to_numpy(dtype=float), want, rtol=1e-9)


def test_affine_scan_of_nothing(spark):
    from lossgrid.operators.windows import persistence

    empty = spark.createDataFrame([], "day long, u double")
    assert persistence(empty, "day", {"u": 0.5}).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, None)], "day long, u double")
    assert [r["u_smooth"] for r in persistence(nulls, "day", {"u": 0.5}).collect()] == [None, None]


def test_streaks_of_one_loan_and_month_in_many_slices(spark, monkeypatch):
    """Half of all payments belong to one loan and day; a null loan is a loan, a null status is no missed payment."""
    n = F.col("id")
    status = F.when(n % 11 == 0, None).when(n % 3 == 0, "MISSED").otherwise("PAID")
    pays = spark.range(6_000).select(
        F.when(n % 2 == 0, "L000000").when(n % 5 == 0, None).otherwise(F.concat(F.lit("L"), n % 40)).alias("loan_id"),
        n.alias("line_no"), (n * 7).alias("l_partkey"), (n % 13).alias("l_suppkey"),
        F.to_date(F.lit("2001-05-07")).alias("payment_date"), status.alias("payment_status"),
    )
    order = Window.partitionBy("loan_id").orderBy(*W.PAYMENT_ORDER)
    missed = (F.col("payment_status") == "MISSED").cast("long")
    plain = pays.withColumns(
        {
            "payment_no": F.row_number().over(order).cast("long"),
            "previous_status": F.lag("payment_status").over(order),
            "missed_so_far": F.sum(missed).over(order.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    sizes = []
    slices = S.ordered_slices
    monkeypatch.setattr(W, "ordered_slices", lambda *a: sizes.append(slices(*a)) or sizes[-1])
    # so few rows would be sorted into one slice
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        split = W.payment_streaks(pays).select(*plain.columns)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert plain.exceptAll(split).count() == 0 and split.count() == 6_000
    assert sizes[0].where("loan_id = 'L000000'").select("_pid").distinct().count() > 1


def test_histograms_hold_every_value(spark):
    """Ranges are those of the values; a column with one value has one bin, a null is in none."""
    from lossgrid.operators.reports import report_histograms

    rows = [(float(x), 5.0, None) for x in (0, 1, 2, 7, 10)] + [(None, 5.0, None)]
    got = report_histograms(spark.createDataFrame(rows, "x double, same double, none double"), {"x": 5, "same": 4, "none": 3})
    found = {(r["measure"], r["bin"], r["bin_start"], r["n"]) for r in got.collect()}
    assert found == {("x", 1, 0.0, 2), ("x", 2, 2.0, 1), ("x", 4, 6.0, 1), ("x", 5, 8.0, 1), ("same", 1, 5.0, 6)}
