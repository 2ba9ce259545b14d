"""Explanations for every loan in one table pass, outlier scores and exact contributions."""

from __future__ import annotations

import re
from itertools import combinations
from math import factorial

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossgrid import config as C
from lossgrid.functions import portfolio as P
from lossgrid.functions import rules as R
from lossgrid.functions.expr import at_least, hit, lookup
from lossgrid.operators.moments import covariance
from lossgrid.operators.quality import stack
from lossgrid.operators.scale import computed_once, quantile_columns
from lossgrid.sources.scratch import materialised

_SLOT = re.compile(r"\{(\w+)\}")


def fill(template: str, **slots: Column) -> Column:
    """Template text with columns in its named slots."""
    parts = [slots[p] if i % 2 else F.lit(p) for i, p in enumerate(_SLOT.split(template)) if i % 2 or p]
    return F.concat(*parts)


def decimals(value: Column, n: int) -> Column:
    return F.format_string(f"%.{n}f", F.round(value, n))


# -- stage explanations ------------------------------------------------------


def with_indicator_stage(loans: DataFrame) -> DataFrame:
    """Closed-form PD, indicator list and the stage they imply."""
    pd_ = P.pd_closed_form(F.col("credit_score"), F.col("days_past_due"), F.col("dti_ratio"))
    before = F.col("credit_score") - F.col("credit_score_change")
    return (
        loans.withColumns({"pd_value": pd_})
        .withColumns({"indicators": P.risk_indicators(F.col("pd_value"), before, F.lit(0.3))})
        .withColumns({"stage_num": P.stage_from_indicators(F.col("days_past_due"), F.col("indicators"))})
    )


def explain_stage_rule(staged: DataFrame, stage: str = "stage") -> DataFrame:
    """Reason list and sentence per loan."""
    found = F.array_compact(
        F.array(
            F.when(F.col("days_past_due") > 30, F.lit(C.REASON_HIGH_DPD)),
            F.when(F.col("credit_score") < 600, F.lit(C.REASON_SCORE_DECLINE)),
        )
    )
    none = F.when(F.col(stage) == "STAGE_1", C.REASON_NONE_STAGE_1).otherwise(C.REASON_NONE_OTHER)
    return (
        staged.withColumns({"_found": found})
        .withColumns({"risk_factors": F.when(F.size("_found") > 0, F.col("_found")).otherwise(F.array(none))})
        .select(
            "loan_id",
            stage,
            F.concat(lookup(F.col(stage), C.STAGE_TEMPLATES), F.concat_ws(", ", "risk_factors")).alias("explanation"),
            "risk_factors",
            F.lit(0.75).alias("confidence"),
        )
    )


def explain_stage_text(loans: DataFrame) -> DataFrame:
    """Stage sentence with its context, from the closed-form PD and the indicators."""
    staged = with_indicator_stage(loans)
    loan, stage, found = F.col("loan_id"), F.col("stage_num"), F.col("indicators")
    head = (
        F.when(stage == 3, fill(C.TEXT_STAGE_3, loan=loan, dpd=F.col("days_past_due").cast("string")))
        .when(stage == 2, fill(C.TEXT_STAGE_2, loan=loan))
        .otherwise(fill(C.TEXT_STAGE_1, loan=loan))
    )
    second = stage == 2
    high = F.when(
        second & F.array_contains(found, "high_pd"), fill(C.TEXT_HIGH_PD, pd=decimals(F.col("pd_value") * 100.0, 2))
    )
    drop = F.when(second & F.array_contains(found, "credit_score_deterioration"), F.lit(C.TEXT_SCORE_DROP))
    score = F.when(F.col("credit_score") > 0, at_least(F.col("credit_score"), C.TEXT_SCORE, C.TEXT_SCORE_BELOW))
    return staged.select(
        "loan_id", "stage_num", "pd_value", F.concat_ws(" ", head, high, drop, score).alias("explanation")
    )


# -- unusual values ----------------------------------------------------------


def unusual_factors(results: DataFrame) -> DataFrame:
    """Extreme values per loan as an array of structs and as JSON."""
    base = results.withColumns({"ecl_rate": R.provision_rate(F.col("calculated_ecl"))})
    entries = []
    for name, op, bound, text, severity in C.UNUSUAL_FACTORS:
        value = F.col(name).cast("double")
        fires = value > bound if op == ">" else value < bound
        entry = F.struct(
            F.lit(name).alias("factor"), value.alias("value"), F.lit(text).alias("description"), F.lit(severity).alias("severity")
        )
        entries.append(F.when(hit(fires), entry))
    return base.withColumns({"factors": F.array_compact(F.array(*entries))}).withColumns(
        {"factors_json": F.to_json("factors")}
    )


def explain_outlier_text(flagged: DataFrame, score: str = "anomaly_score") -> DataFrame:
    """Sentence by severity group; expects ``factors`` from :func:`unusual_factors`."""

    def listed(severity: str) -> Column:
        chosen = F.filter("factors", lambda f: f["severity"] == severity)
        return F.transform(chosen, lambda f: F.concat(F.lit("- "), f["description"]))

    def group(title: str, severity: str) -> Column:
        items = listed(severity)
        return F.when(F.size(items) > 0, F.concat_ws(" ", F.lit(title), items))

    body = F.when(
        F.size("factors") > 0,
        F.concat_ws(" ", group(C.TEXT_OUTLIER_HIGH, "high"), group(C.TEXT_OUTLIER_MEDIUM, "medium")),
    ).otherwise(C.TEXT_OUTLIER_NONE)
    body = F.when(body != "", body)
    head = fill(C.TEXT_OUTLIER, loan=F.col("loan_id"), score=decimals(F.col(score), 3))
    return flagged.withColumns(
        {"outlier_explanation": F.concat_ws(" ", head, body, F.lit(C.TEXT_OUTLIER_ACTION))}
    )


OUTLIER_FEATURES = (
    "loan_amount", "current_balance", "interest_rate", "credit_score", "dti_ratio", "days_past_due",
    "calculated_pd", "calculated_lgd", "calculated_ecl",
)


def with_distance_score(results: DataFrame, columns=OUTLIER_FEATURES) -> DataFrame:
    """Root mean square of the population z-scores; gaps count as zero."""
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns}
    active = results.where(F.col("current_balance") > 0)
    moments = active.agg(
        *[F.avg(v).alias(f"m_{c}") for c, v in filled.items()], *[F.stddev_pop(v).alias(f"s_{c}") for c, v in filled.items()]
    )
    row = moments.select(F.struct("*").alias("s")).scalar()
    zs = F.array(*[F.try_divide(v - F.col("_row")[f"m_{c}"], F.col("_row")[f"s_{c}"]) for c, v in filled.items()])
    # a fold binds each z once; writing z * z would inline its whole expression twice
    total = F.aggregate("_zs", F.lit(0.0), lambda acc, z: acc + F.coalesce(z * z, F.lit(0.0)))
    scaled = active.withColumns({"_row": row}).withColumns({"_zs": zs})
    return computed_once(scaled, "anomaly_score", F.sqrt(total / float(len(filled)))).drop("_row", "_zs")


def detect_outliers(results: DataFrame, contamination: float = 0.05) -> DataFrame:
    """The most distant share of the portfolio, cut at an exact quantile of the score."""
    scored = with_distance_score(results)
    cut = quantile_columns(scored, {"q": ("anomaly_score", 1.0 - contamination)}).scalar()
    return scored.where(F.col("anomaly_score") > cut)


def with_mahalanobis(results: DataFrame, columns=OUTLIER_FEATURES) -> DataFrame:
    """Mahalanobis distance from the portfolio's centre; gaps count as zero.

    The covariance comes from one pass of pairwise moments; its Cholesky factor is inverted on the driver (as many
    numbers as pairs of columns) and the distance is column arithmetic.  Columns that the ones before them determine
    add nothing.
    """
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns}
    active = results.where(F.col("current_balance") > 0)
    means, matrix = covariance(active.select(*[v.alias(c) for c, v in filled.items()]), columns)
    spread = np.sqrt(np.diag(matrix))
    kept: list[int] = []
    for k in range(len(means)):  # on the scale of correlations, where a remainder near zero means dependence
        trial = [*kept, k]
        if spread[k] > 0 and np.linalg.eigvalsh(matrix[np.ix_(trial, trial)] / np.outer(spread[trial], spread[trial]))[0] > 1e-10:
            kept.append(k)
    names = [columns[k] for k in kept]
    factor = np.linalg.inv(np.linalg.cholesky(matrix[np.ix_(kept, kept)])) if kept else np.zeros((0, 0))
    apart = [filled[c] - float(means[k]) for c, k in zip(names, kept)]
    parts = [
        sum((apart[j] * float(factor[i, j]) for j in range(1, i + 1)), apart[0] * float(factor[i, 0])) for i in range(len(names))
    ]
    if not parts:
        return active.withColumn("distance", F.lit(0.0))
    total = F.aggregate(F.array(*parts), F.lit(0.0), lambda acc, z: acc + z * z)
    return computed_once(active, "distance", F.sqrt(total))


def distant(results: DataFrame, columns=OUTLIER_FEATURES, contamination: float = 0.05) -> DataFrame:
    """The share of the portfolio with the largest Mahalanobis distance, cut at an exact quantile."""
    scored = materialised(with_mahalanobis(results, columns), "distances")
    cut = quantile_columns(scored, {"q": ("distance", 1.0 - contamination)}).scalar()
    return scored.where(F.col("distance") > cut)


# -- contributions -----------------------------------------------------------

INPUTS = ("credit_score", "days_past_due", "dti_ratio")


def _shapley_weight(size: int, n: int) -> float:
    return factorial(size) * factorial(n - size - 1) / factorial(n)


def feature_contributions(loans: DataFrame) -> DataFrame:
    """Exact Shapley values of the closed-form PD for its three inputs against the portfolio mean.

    With three inputs the eight coalitions are plain column arithmetic; the
    background enters as one scalar subquery.
    """
    means = loans.agg(*[F.avg(c).alias(c) for c in INPUTS]).select(F.struct(*INPUTS).alias("s")).scalar()
    base = loans.withColumns({f"_b_{c}": means[c] for c in INPUTS})

    def value(coalition: frozenset) -> Column:
        args = [F.col(c).cast("double") if c in coalition else F.col(f"_b_{c}") for c in INPUTS]
        return P.pd_closed_form(*args)

    subsets = [frozenset(s) for k in range(4) for s in combinations(INPUTS, k)]
    names = {s: "_v_" + "".join("1" if c in s else "0" for c in INPUTS) for s in subsets}
    valued = base.withColumns({names[s]: value(s) for s in subsets})
    phi = {}
    for c in INPUTS:
        terms = [
            (F.col(names[s | {c}]) - F.col(names[s])) * _shapley_weight(len(s), 3) for s in subsets if c not in s
        ]
        phi[f"phi_{c}"] = sum(terms[1:], terms[0])
    return (
        valued.withColumns(phi)
        .withColumns({"base_value": F.col(names[frozenset()]), "prediction": F.col(names[frozenset(INPUTS)])})
        .drop(*names.values(), *[f"_b_{c}" for c in INPUTS])
    )


def contribution_text(contributions: DataFrame) -> DataFrame:
    """Ranked factors and the sentence about them."""
    ranked = F.array_sort(
        F.array(
            *[
                F.struct(
                    (-F.round(F.abs(F.col(f"phi_{c}")), 9)).alias("k"),
                    F.lit(c).alias("name"),
                    F.concat(
                        F.lit(f"{C.SHAP_NAMES[c]} ("),
                        F.col(c).cast("string"),
                        F.when(F.col(f"phi_{c}") > 0, ") aumenta").otherwise(") reduce"),
                        F.lit(" el riesgo de impago significativamente."),
                    ).alias("text"),
                )
                for c in INPUTS
            ]
        )
    )
    total = sum((F.col(f"phi_{c}") for c in INPUTS[1:]), F.col(f"phi_{INPUTS[0]}"))
    lines = F.transform(F.col("_r"), lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x["text"]))
    return (
        contributions.withColumns({"_r": ranked})
        .withColumns(
            {
                "top_features": F.concat_ws(",", F.transform("_r", lambda x: x["name"])),
                "text_explanation": F.concat_ws(
                    " ",
                    fill(C.TEXT_SHAP_HEAD, loan=F.col("loan_id")),
                    lines,
                    F.when(total > 0, C.TEXT_SHAP_UP).otherwise(C.TEXT_SHAP_DOWN),
                ),
            }
        )
        .drop("_r")
    )


def global_importance(loans: DataFrame) -> DataFrame:
    """Mean absolute contribution per input."""
    one = feature_contributions(loans).agg(*[F.avg(F.abs(F.col(f"phi_{c}"))).alias(c) for c in INPUTS])
    return stack(one, [{"feature": F.lit(c), "importance": F.col(c)} for c in INPUTS]).orderBy(
        F.desc_nulls_last("importance"), "feature"
    )
