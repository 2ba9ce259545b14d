"""Ordered computations.  Windows only run over groups whose size is bounded
(calendar buckets, aggregated rows); anything larger is split first."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import accumulate
from math import isnan

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossgrid.config import DEFAULTS
from lossgrid.functions.expr import pct, share
from lossgrid.operators.reports import credit_quality_monthly
from lossgrid.operators.scale import distributed_row_number, ordered_slices, with_slice_summary

PAYMENT_ORDER = ("payment_date", "line_no", "l_partkey", "l_suppkey")


def growth(current: Column, previous: Column) -> Column:
    return F.try_divide(current - previous, previous) * 100.0


def credit_quality_trends(results: DataFrame) -> DataFrame:
    """Month-over-month change per stage; the window sees one row per month and stage."""
    monthly = credit_quality_monthly(results)
    w = Window.partitionBy("calculated_stage").orderBy("reporting_month")
    changes = {
        "loan_count_growth_pct": "new_loans_count",
        "credit_score_change_pct": "avg_credit_score",
        "ecl_growth_pct": "total_ecl",
    }
    return monthly.select(
        "*", *[growth(F.col(c), F.lag(c).over(w)).alias(name) for name, c in changes.items()]
    ).orderBy(F.desc("reporting_month"), "calculated_stage")


def share_of_total(df: DataFrame, key: str) -> DataFrame:
    counted = df.groupBy(key).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counted.select(key, "n", share(F.col("n"), total).alias("share"), pct(F.col("n"), total).alias("percent"))


def stage_rank(staged: DataFrame, stage: str = "stage") -> DataFrame:
    return distributed_row_number(staged.select("loan_id", stage), [stage], ["loan_id"], "stage_rank")


def series_gap_check(series: DataFrame, date: str, max_gap: int = 35) -> DataFrame:
    """Largest gap and order of a calendar series (one row per period)."""
    prev = F.lag(date).over(Window.orderBy(date))
    gaps = series.select(date).select(date, F.datediff(F.col(date), prev).alias("gap"))
    return gaps.agg(
        F.count("*").alias("n_points"),
        F.max("gap").alias("max_gap_days"),
        F.coalesce(F.max("gap") > max_gap, F.lit(False)).alias("has_gaps"),
        (F.count_if(F.col("gap") <= 0) == 0).alias("strictly_increasing"),
    )


def day_over_day(results: DataFrame, day: str = "origination_date") -> DataFrame:
    """Daily totals beside the same totals exactly one day earlier (self-join on the date, not the previous row)."""
    daily = results.groupBy(F.col(day).alias("day")).agg(
        F.sum("calculated_ecl").alias("ecl"),
        F.count("*").alias("volume"),
        pct(F.count_if(F.col("calculated_stage") == "STAGE_2"), F.count("*")).alias("stage2_pct"),
    )
    before = daily.select(
        F.date_add("day", 1).alias("day"),
        F.col("ecl").alias("p_ecl"),
        F.col("volume").alias("p_volume"),
        F.col("stage2_pct").alias("p_stage2"),
    )
    change = growth(F.col("ecl"), F.col("p_ecl"))
    moved = growth(F.col("volume"), F.col("p_volume"))
    drift = F.col("stage2_pct") - F.col("p_stage2")
    return daily.join(before, "day").select(
        "day",
        "ecl",
        "volume",
        change.alias("ecl_change_pct"),
        moved.alias("volume_change_pct"),
        drift.alias("stage2_change_pts"),
        (F.abs(change) > 10).alias("ecl_alert"),
        (F.abs(moved) > 20).alias("volume_alert"),
        (F.abs(drift) > 5).alias("stage2_alert"),
    )


# -- payment streaks ---------------------------------------------------------


def _missed() -> Column:
    return (F.col("payment_status") == "MISSED").cast("long")


def payment_streaks(payments: DataFrame) -> DataFrame:
    """Payment number, previous status and missed payments so far, per loan.

    The rows are range-sorted by loan and place, so that a loan with any number of payments, in one month too, lies in
    many slices; each row needs its slice's rows of the loan and a summary of the slices before.
    """
    rows = ordered_slices(payments, ["loan_id"], PAYMENT_ORDER)
    slices = rows.groupBy("loan_id", "_pid").agg(
        F.count("*").alias("_c"),
        F.sum(_missed()).alias("_x"),
        F.min("_pos").alias("_first"),
        F.max_by("payment_status", "_pos").alias("_last"),
    )
    by_slice = Window.partitionBy("loan_id").orderBy("_pid")
    earlier = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(
        "loan_id",
        "_pid",
        "_first",
        F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_c0"),
        F.sum("_x").over(earlier).alias("_x0"),
        F.lag("_last").over(by_slice).alias("_last0"),
    )
    w = Window.partitionBy("loan_id", "_pid").orderBy("_pos")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({"_before": F.lag("payment_status").over(w), "_here": F.sum(_missed()).over(upto)})
    missed = F.coalesce("_here", F.lit(0)) + F.coalesce("_x0", F.lit(0))
    return (
        with_slice_summary(local, slices, ["loan_id"])
        .withColumns(
            {
                "payment_no": (F.col("_pos") - F.col("_first") + F.col("_c0") + 1).cast("long"),
                "previous_status": F.when(F.col("_pos") == F.col("_first"), F.col("_last0")).otherwise(F.col("_before")),
                "missed_so_far": F.when(F.col("_here").isNotNull() | F.col("_x0").isNotNull(), missed),
            }
        )
        .drop("_at", "_pid", "_pos", "_first", "_c0", "_x0", "_last0", "_before", "_here")
    )


# -- macro series ------------------------------------------------------------


def persistence(series: DataFrame, date: str, weights: dict[str, float]) -> DataFrame:
    """x_t = w*x_{t-1} + (1-w)*u_t, exactly, in the order of ``date``; the first x is the first u.

    A step is an affine map of the value before it, and maps compose.  The series is range-sorted once; every slice
    works out its maps on its own, the slices' last maps (one row each) are followed on the driver, and each row's
    map is then applied to what enters its slice.  A null value passes on what was before it; while there was none,
    the smooth value is null.
    """
    columns = list(weights)
    placed = ordered_slices(series.select(date, *[F.col(c).cast("double").alias(c) for c in columns]), [], [date])
    maps = [f"{x}{k}" for k in range(len(columns)) for x in ("_a", "_b")]

    def compose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # x = a * (what enters the slice) + b
        state = [(1.0, 0.0)] * len(columns)
        for batch in batches:
            out = {date: batch[date], "_pid": batch["_pid"], "_pos": batch["_pos"]}
            for k, c in enumerate(columns):
                w = weights[c]
                steps = accumulate(
                    batch[c], lambda m, u, w=w: m if isnan(u) else (w * m[0], w * m[1] + (1.0 - w) * u), initial=state[k]
                )
                *_, state[k] = found = list(steps)
                out[f"_a{k}"], out[f"_b{k}"] = np.array(found[1:]).reshape(-1, 2).T
            yield pd.DataFrame(out)

    kind = series.schema[date].dataType.simpleString()
    schema = f"{date} {kind}, _pid long, _pos long, " + ", ".join(f"{m} double" for m in maps)
    mapped = placed.select(date, "_pid", "_pos", *columns).mapInPandas(compose, schema)
    ends = mapped.groupBy("_pid").agg(*[F.max_by(m, "_pos").alias(m) for m in maps]).orderBy("_pid").collect()
    at = F.struct("_pid", "_pos")
    starts = placed.agg(
        *[F.min(F.when(F.col(c).isNotNull(), F.struct("_pid", "_pos", F.col(c).alias("value")))).alias(c) for c in columns]
    ).first()
    # the value before the first one is taken to be the first one
    now = [starts[c] and starts[c]["value"] for c in columns]
    entering = []
    for end in ends:
        entering.append((end["_pid"], *now))
        now = [None if x is None else end[f"_a{k}"] * x + end[f"_b{k}"] for k, x in enumerate(now)]
    enters = series.sparkSession.createDataFrame(entering, "_pid long" + "".join(f", _x{k} double" for k in range(len(columns))))
    smooth = []
    for k, c in enumerate(columns):
        value = F.col(f"_a{k}") * F.col(f"_x{k}") + F.col(f"_b{k}")
        if starts[c]:
            begun = at >= F.struct(*[F.lit(starts[c][x]).alias(x) for x in ("_pid", "_pos")])
            value = F.when(begun, value)
        smooth.append(value.alias(f"{c}_smooth"))
    return mapped.join(F.broadcast(enters), "_pid").select(date, *smooth)  # one row per slice


def cycle_phase(series: DataFrame, date: str, phases: Sequence[tuple[str, int]], start_index: int) -> DataFrame:
    """Phase of the cycle by month index modulo the cycle length."""
    total = sum(n for _, n in phases)
    offset = F.pmod(F.year(date) * 12 + F.month(date) - start_index, F.lit(total))
    chain, upper = None, 0
    for name, length in phases:
        upper += length
        chain = F.when(offset < upper, name) if chain is None else chain.when(offset < upper, name)
    return series.select(date, offset.alias("month_in_cycle"), chain.alias("phase"))


def top_exposures(df: DataFrame, key: str, k: int) -> DataFrame:
    """k largest balances per group; Spark keeps k rows per group and task before the shuffle."""
    w = Window.partitionBy(key).orderBy(F.desc_nulls_last("current_balance"), "loan_id")
    return (
        df.select(key, "loan_id", "current_balance", F.row_number().over(w).alias("rank"))
        .where(F.col("rank") <= k)
        .withColumn("over_limit", F.col("current_balance") > 10_000_000)
    )


def as_of() -> Column:
    return F.lit(DEFAULTS.as_of_date)


__all__ = [
    "credit_quality_trends", "cycle_phase", "day_over_day", "payment_streaks", "persistence", "series_gap_check",
    "share_of_total", "stage_rank", "top_exposures",
]
