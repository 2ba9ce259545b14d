"""Model evaluation as aggregates over a predictions table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossgrid import config as C
from lossgrid.functions.expr import share
from lossgrid.operators.quality import stack
from lossgrid.operators.scale import distributed_running_sums, exact_quantiles


def confusion(predictions: DataFrame, actual: str, predicted: str) -> DataFrame:
    return predictions.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n")
    )


def class_report(predictions: DataFrame, actual: str, predicted: str, classes: Sequence[str] = C.STAGES) -> DataFrame:
    """Precision, recall, F1 and support per class plus overall accuracy, from one aggregate."""
    a, p = F.col(actual), F.col(predicted)
    aggs = [F.count("*").alias("n"), F.count_if(a == p).alias("right")]
    for i, c in enumerate(classes):
        aggs += [
            F.count_if((a == c) & (p == c)).alias(f"tp{i}"), F.count_if(p == c).alias(f"pp{i}"), F.count_if(a == c).alias(f"ap{i}"),
        ]
    one = predictions.agg(*aggs)

    def zero(x: Column) -> Column:
        return F.coalesce(x, F.lit(0.0))

    rows = []
    for i, c in enumerate(classes):
        precision = zero(share(F.col(f"tp{i}"), F.col(f"pp{i}")))
        recall = zero(share(F.col(f"tp{i}"), F.col(f"ap{i}")))
        f1 = zero(share(F.col(f"tp{i}") * 2, F.col(f"pp{i}") + F.col(f"ap{i}")))
        rows.append(
            {
                "class": F.lit(c), "precision": precision, "recall": recall, "f1": f1, "support": F.col(f"ap{i}"),
                "accuracy": share(F.col("right"), F.col("n")),
            }
        )
    return stack(one, rows)


def auc_one_vs_rest(scored: DataFrame, actual: str, scores: Mapping[str, Column]) -> DataFrame:
    """Exact one-vs-rest AUC per class, ties counted half, with its prevalence weight.

    Rows collapse to (class, score) counts first; the rank sum then needs a running
    count of negatives in score order, computed without a global sort task.
    """
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("class"), s.cast("double").alias("score"), (F.col(actual) == c).cast("long").alias("pos"))
            for c, s in scores.items()
        ]
    )
    counts = (
        scored.select(F.explode(entries).alias("e")).select("e.*").groupBy("class", "score")
        .agg(F.sum("pos").alias("pos"), F.sum(1 - F.col("pos")).alias("neg"))
    )
    ranked = distributed_running_sums(counts, ["class"], ["score"], {"below": F.col("neg")})
    won = F.sum(F.col("pos") * (F.col("below_before") + F.col("neg") / 2.0))
    per_class = ranked.groupBy("class").agg(
        share(won, F.sum("pos") * F.sum("neg")).alias("auc"), F.sum("pos").alias("positives"), F.sum(F.col("pos") + F.col("neg")).alias("n")
    )
    return per_class.select("class", "auc", share(F.col("positives"), F.col("n")).alias("weight"))


def weighted_auc(per_class: DataFrame) -> DataFrame:
    return per_class.agg(share(F.sum(F.col("auc") * F.col("weight")), F.sum("weight")).alias("roc_auc"))


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    e = F.col(actual) - F.col(predicted)
    mse = F.avg(e * e)
    return df.agg(
        F.avg(F.abs(e)).alias("mae"),
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        (F.lit(1.0) - F.try_divide(mse, F.var_pop(actual))).alias("r2"),
    )


def model_thresholds(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Two metric snapshots (accuracy, pd_mae, importances map) against the model limits."""
    old = previous.select(F.struct("*").alias("s")).scalar()
    both = current.withColumns({"_old": old})
    drift = F.array_max(
        F.map_values(F.map_zip_with("importances", F.col("_old")["importances"], lambda k, a, b: F.abs(a - b)))
    )
    stability = F.lit(1.0) - F.abs(F.col("accuracy") - F.col("_old")["accuracy"])
    wide = both.withColumns({"stability": stability, "importance_drift": drift})
    limits = (("accuracy", 0.85, True), ("pd_mae", 0.05, False), ("stability", 0.90, True), ("importance_drift", 0.15, False))
    return stack(
        wide,
        [
            {
                "metric": F.lit(m), "observed": F.col(m).cast("double"), "limit": F.lit(limit),
                "passed": (F.col(m) >= limit) if at_least else (F.col(m) <= limit),
            }
            for m, limit, at_least in limits
        ],
    )


def _bin(value: Column, edges: Column) -> Column:
    """Number of edges below the value, plus one."""
    return F.size(F.filter(edges, lambda e: e < value)) + 1


def decile_edges(df: DataFrame, score: str) -> Column:
    q = exact_quantiles(df, [score], [i / 10 for i in range(1, 10)])
    return q.agg(F.array_sort(F.collect_list("value")).alias("e")).scalar()  # nine values


def calibration(df: DataFrame, score: str, default: Column) -> DataFrame:
    """Mean predicted PD beside the observed default rate per score decile."""
    return (
        df.withColumns({"_edges": decile_edges(df, score)})
        .groupBy(_bin(F.col(score), F.col("_edges")).alias("decile"))
        .agg(F.count("*").alias("n"), F.avg(score).alias("mean_predicted"), F.avg(default.cast("double")).alias("default_rate"))
    )


def stability_index(base: DataFrame, recent: DataFrame, score: str) -> DataFrame:
    """Population stability index over the base population's deciles."""
    edges = decile_edges(base, score)
    both = base.select(score, F.lit(1).alias("_b")).unionByName(recent.select(score, F.lit(0).alias("_b")))
    counted = (
        both.withColumns({"_edges": edges})
        .groupBy(_bin(F.col(score), F.col("_edges")).alias("decile"))
        .agg(F.sum("_b").alias("b"), F.sum(1 - F.col("_b")).alias("r"))
    )
    totals = counted.agg(F.sum("b").alias("b"), F.sum("r").alias("r")).select(F.struct("*").alias("s")).scalar()
    p = F.greatest(share(F.col("b"), F.col("_t")["b"]), F.lit(1e-6))
    q = F.greatest(share(F.col("r"), F.col("_t")["r"]), F.lit(1e-6))
    return counted.withColumns({"_t": totals}).agg(F.sum((q - p) * F.log(q / p)).alias("psi"), F.count("*").alias("bins"))


__all__ = [
    "auc_one_vs_rest", "calibration", "class_report", "confusion", "decile_edges", "model_thresholds", "regression_metrics",
    "stability_index", "weighted_auc",
]
