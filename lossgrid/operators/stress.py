"""Scenario and stress operators: scenarios are literals exploded per row, so nothing is joined."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossgrid import config as C
from lossgrid.config import DEFAULTS, EclConfig
from lossgrid.functions import rules as R
from lossgrid.functions.expr import lookup, share


def _multiplied(factor: float) -> Column:
    """Loss with the PD scaled and capped at 1."""
    return F.col("calculated_ead") * F.col("calculated_lgd") * F.least(F.lit(1.0), F.col("calculated_pd") * factor)


def per_scenario(results: DataFrame, scenarios: Mapping[str, float]) -> DataFrame:
    """One row per loan and scenario."""
    cases = F.array(
        *[
            F.struct(
                F.lit(name).alias("scenario"),
                F.least(F.lit(1.0), F.col("calculated_pd") * m).alias("stressed_pd"),
                _multiplied(m).alias("stressed_ecl"),
            )
            for name, m in scenarios.items()
        ]
    )
    return results.select("*", F.explode(cases).alias("_s")).select(*results.columns, "_s.*")


def stress_pd(results: DataFrame, scenarios: Mapping[str, tuple] = C.SCENARIOS) -> DataFrame:
    """Scenario losses per stage.

    The scenarios become aggregate columns of one pass (rows are not multiplied)
    and are stacked after the three stage rows exist.
    """
    factors = {name: m for name, (_, _, m) in scenarios.items()}
    wide = results.groupBy("calculated_stage").agg(
        F.count("*").alias("loan_count"),
        *[F.sum(_multiplied(m)).alias(f"e_{n}") for n, m in factors.items()],
        *[F.avg(F.least(F.lit(1.0), F.col("calculated_pd") * m)).alias(f"p_{n}") for n, m in factors.items()],
    )
    cases = F.array(
        *[
            F.struct(
                F.lit(n).alias("scenario"), F.col(f"p_{n}").alias("avg_stressed_pd"), F.col(f"e_{n}").alias("stressed_ecl")
            )
            for n in factors
        ]
    )
    return wide.select("calculated_stage", "loan_count", F.explode(cases).alias("s")).select(
        "s.scenario", "calculated_stage", "loan_count", "s.avg_stressed_pd", "s.stressed_ecl"
    )


def scenario_weighted_ecl(
    results: DataFrame,
    weights: Mapping[str, float] = C.SCENARIO_WEIGHTS,
    scenario_of: Mapping[str, str] = C.WEIGHTED_SCENARIOS,
) -> DataFrame:
    """Probability-weighted loss over the weighted scenarios."""
    parts = {n: F.sum(_multiplied(C.SCENARIOS[scenario_of[n]][2])) for n in weights}
    one = results.groupBy("calculated_stage").agg(*[c.alias(f"ecl_{n}") for n, c in parts.items()])
    weighted = sum((F.col(f"ecl_{n}") * w for n, w in weights.items()), F.lit(0.0))
    return one.withColumn("weighted_ecl", weighted)


def stress_ltv(loans: DataFrame, haircut: float = 0.15, cfg: EclConfig = DEFAULTS) -> DataFrame:
    """Collateral haircut and what it does to LTV, recovery, LGD and stage."""
    kept = F.col("collateral_value") * (1.0 - haircut)
    stressed = loans.withColumns(
        {
            "collateral_value": kept,
            "ltv_ratio": F.when(kept > 0, F.try_divide(F.col("loan_amount"), kept)),
        }
    )
    return stressed.withColumns(
        {
            "stressed_lgd": R.lgd(R.recovery_rate(cfg)),
            "stressed_stage": R.stage_label(R.final_severity(cfg)),
        }
    )


def fx_convert(df: DataFrame, amounts: Sequence[str], rates: Mapping[str, float] = C.FX_RATES) -> DataFrame:
    """Amounts in base currency; the rate table is a literal."""
    rate = lookup(F.col("currency"), dict(rates))
    return df.withColumns({f"{a}_base": F.col(a) * rate for a in amounts})


def boundary_cases(loans: DataFrame, cfg: EclConfig = DEFAULTS) -> DataFrame:
    """Loans sitting on a rule edge, with the stage the rules give them."""
    dpd, score, ltv = F.col("days_past_due"), F.col("credit_score"), F.col("ltv_ratio")
    near = F.array_compact(
        F.array(
            F.when(dpd.isin(29, 30, 89, 90), F.concat(F.lit("dpd_"), dpd.cast("string"))),
            F.when(score.isin(499, 500, 501, 650, 651), F.concat(F.lit("score_"), score.cast("string"))),
            F.when(ltv.between(0.94, 0.96), F.lit("ltv_edge")),
        )
    )
    return (
        loans.withColumns({"_near": near})
        .where(F.size("_near") > 0)
        .select("loan_id", F.concat_ws(",", "_near").alias("edges"), R.stage_label(R.final_severity(cfg)).alias("stage"))
    )


def mix_against_target(df: DataFrame, key: str, targets: Mapping[str, float]) -> DataFrame:
    """Observed share per value beside its target."""
    from pyspark.sql import Window

    counted = df.groupBy(key).agg(F.count("*").alias("n"))
    observed = share(F.col("n"), F.sum("n").over(Window.partitionBy()))
    target = lookup(F.col(key), {k: float(v) for k, v in targets.items()}, 0.0)
    return counted.select(
        F.lit(key).alias("dimension"),
        F.col(key).alias("value"),
        "n",
        observed.alias("observed"),
        target.alias("target"),
        (observed - target).alias("gap"),
    )


def seasonal_payment_miss(payments: DataFrame, staged: DataFrame) -> DataFrame:
    """Miss rate by calendar month and stage; payments are summed per loan and month before the join."""
    per_loan = payments.groupBy("loan_id", F.month("payment_date").alias("month")).agg(
        F.count("*").alias("_n"), F.count_if(F.col("payment_status") == "MISSED").alias("_missed")
    )
    return (
        per_loan.join(staged.select("loan_id", "stage"), "loan_id")
        .groupBy("month", "stage")
        .agg(F.sum("_n").alias("payments"), F.sum("_missed").alias("missed"))
        .withColumns({"miss_rate": share(F.col("missed"), F.col("payments")), "is_winter": F.col("month").isin(12, 1, 2)})
    )
