"""Training and scoring with Spark ML; metrics come back as small tables."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from statistics import fmean, pstdev

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lossgrid.config import DEFAULTS, EclConfig
from lossgrid.functions.rules import stage_label, stage_number
from lossgrid.operators import boost
from lossgrid.operators.evaluation import auc_one_vs_rest, class_report, regression_metrics, weighted_auc
from lossgrid.operators.forest import ForestClassifier
from lossgrid.operators.sampling import split_stratified
from lossgrid.operators.tuning import LABELLED_ROWS, Sample, Whole, labelled_sample, search
from lossgrid.operators.walk import with_class_scores
from lossgrid.sources.scratch import materialised, spread

FEATURES = (
    "loan_amount", "interest_rate", "term_months", "credit_score", "days_past_due", "dti_ratio", "ltv_ratio",
    "employment_length",
)


def training_table(staged: DataFrame, features: Sequence[str] = FEATURES, target: Column | None = None) -> DataFrame:
    """Key, zero-filled features, label and the deterministic train/test flag.

    Written once, dealt over all cores: training reads it many times, and the loans' own files may be one task's work.
    """
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]
    label = (stage_number(F.col("stage")) - 1).cast("double") if target is None else target
    narrow = spread(staged.select("loan_id", "stage", *filled, label.alias("label")), "loan_id", "training")
    return materialised(split_stratified(narrow, "stage"), "training")


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features")


def stage_classifier(features: Sequence[str] = FEATURES, trees: int = 100, depth: int = 10, leaf: int = 10) -> Pipeline:
    return Pipeline(stages=[_assembler(features), ForestClassifier(features, trees, depth, leaf)])


def pd_regressor(rounds: int = 100, depth: int = 5, leaf: int = 10) -> GBTRegressor:
    return GBTRegressor(maxIter=rounds, maxDepth=depth, stepSize=0.1, minInstancesPerNode=leaf, seed=42)


@dataclass(frozen=True)
class Fit:
    model: PipelineModel
    metrics: dict[str, float]
    importance: dict[str, float]


def _importance(model: PipelineModel, features: Sequence[str]) -> dict[str, float]:
    weights = model.stages[-1].featureImportances
    return {f: float(weights[i]) for i, f in enumerate(features)}


#: Folds of the stage model that are fitted at a time, beside the model itself.
FOLDS_AT_A_TIME = 5


def _fold_accuracy(train: DataFrame, fold: int, pipeline: Pipeline) -> float:
    """Accuracy on one fold of the model fitted on the others."""
    model = pipeline.fit(train.where(F.col("fold") != fold))
    scored = stage_scores(train.where(F.col("fold") == fold), model)
    return scored.agg(F.avg((F.col("predicted_stage") == stage_label((F.col("label") + 1).cast("int"))).cast("double"))).first()[0]


def _fit_and_measure(table: DataFrame, pipeline: Pipeline) -> tuple[PipelineModel, dict[str, float]]:
    """The model of the train part, and what it says about the rest."""
    model = pipeline.fit(table.where("is_train"))
    names = {f"STAGE_{i}": f"prob_stage_{i}" for i in (1, 2, 3)}
    scored = stage_scores(table.where("not is_train"), model).select("stage", "predicted_stage", *names.values())
    scored = materialised(scored, "scored")
    return model, {
        "accuracy": scored.agg(F.avg((F.col("predicted_stage") == F.col("stage")).cast("double"))).first()[0],
        "roc_auc": weighted_auc(auc_one_vs_rest(scored, "stage", {s: F.col(p) for s, p in names.items()})).first()[0],
    }


def train_stage(
    table: DataFrame, features: Sequence[str] = FEATURES, trees: int = 100, depth: int = 10, folds: int = 5
) -> Fit:
    """Forest on the train part; accuracy, cross-validated accuracy and weighted one-vs-rest AUC on the rest.

    Every training row lies in one fold, by a hash of its loan.
    """
    train = table.where("is_train")
    pipeline = stage_classifier(features, trees, depth)
    with ThreadPoolExecutor(FOLDS_AT_A_TIME + 1) as pool:
        fitted = pool.submit(_fit_and_measure, table, pipeline)
        found = []
        if folds > 1:
            dealt = train.withColumn("fold", F.pmod(F.xxhash64("loan_id"), F.lit(folds)))
            found = list(pool.map(lambda k: _fold_accuracy(dealt, k, pipeline), range(folds)))
        model, metrics = fitted.result()
    if found:
        metrics |= {"cv_mean": fmean(found), "cv_std": pstdev(found)}
    return Fit(model, metrics, _importance(model, features))


def train_pd(
    table: DataFrame,
    features: Sequence[str] = FEATURES,
    rounds: int = 100,
    depth: int = 5,
    folds: int = 5,
) -> Fit:
    """Boosted PD model; predictions are limited to [0, 1] before scoring.

    Every training row lies in one fold, by a hash of its loan.  The model learns from all of them and each of ``folds`` others
    from all outside its fold, side by side; the cross-validated absolute error is of the rows in the folds.
    """
    folds = folds if folds > 1 else 0
    fold = F.pmod(F.xxhash64("loan_id"), F.lit(max(folds, 1))).cast("int")
    rows = table.select(*features, "label", F.when(F.col("is_train"), fold).otherwise(boost.TEST).alias("part"))
    how = pd_regressor(rounds, depth)
    grown = boost.fit(rows, features, [boost.Target(held=k) for k in (boost.TEST, *range(folds))], how)
    scored = with_pd(grown.scored.withColumnRenamed("s0", "prediction"))
    found = regression_metrics(scored.where(F.col("part") == boost.TEST), "label", "ml_pd_prediction")
    metrics = found.first().asDict()
    if folds:
        of_fold = scored.where(F.col("part") != boost.TEST).groupBy("part").agg(F.avg(F.abs(F.col("label") - F.col("ml_pd_prediction"))).alias("mae"))
        errors = [r["mae"] for r in of_fold.collect()]
        metrics |= {"cv_mae_mean": fmean(errors), "cv_mae_std": pstdev(errors)}
    model = PipelineModel([_assembler(features), boost.regression_model(table.sparkSession, grown.trees[0], grown.edges, how)])
    return Fit(model, metrics, _importance(model, features))


def train_boosted(table: DataFrame, features: Sequence[str] = FEATURES, rounds: int = 100, depth: int = 5, leaf: int = 10) -> dict[str, float]:
    """Boosted trees, one model per stage against the others; accuracy and weighted one-vs-rest AUC on the rest."""
    how = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.1, minInstancesPerNode=leaf, seed=42)
    rows = table.select(*features, "label", F.when(F.col("is_train"), 0).otherwise(boost.TEST).alias("part"))
    found = boost.fit(rows, features, [boost.Target(of=float(k)) for k in range(3)], how).scored
    scored = found.select(
        stage_label((F.col("label") + 1).cast("int")).alias("stage"),
        *[(1.0 / (1.0 + F.exp(-2.0 * F.col(f"s{k}")))).alias(f"prob_stage_{k + 1}") for k in range(3)],
    )
    probs = {f"STAGE_{i}": F.col(f"prob_stage_{i}") for i in (1, 2, 3)}
    predicted = stage_label(F.array_position(F.array(*probs.values()), F.greatest(*probs.values())).cast("int"))
    return {
        "accuracy": scored.agg(F.avg((predicted == F.col("stage")).cast("double"))).first()[0],
        "roc_auc": weighted_auc(auc_one_vs_rest(scored, "stage", probs)).first()[0],
    }


def with_stage_scores(transformed: DataFrame) -> DataFrame:
    p = vector_to_array("probability")
    return transformed.withColumns(
        {
            "predicted_stage": stage_label((F.col("prediction") + 1).cast("int")),
            **{f"prob_stage_{i + 1}": p[i] for i in range(3)},
        }
    )


def stage_scores(df: DataFrame, model: PipelineModel) -> DataFrame:
    """``df`` with what ``with_stage_scores`` adds; forests on assembled columns are walked for many rows at a time."""
    first, last = model.stages[0], model.stages[-1]
    walked = len(model.stages) == 2 and isinstance(first, VectorAssembler) and isinstance(last, RandomForestClassificationModel)
    if not walked or last.numClasses != 3 or last.isDefined("thresholds"):
        return with_stage_scores(model.transform(df)).select(*df.columns, "predicted_stage", *[f"prob_stage_{i}" for i in (1, 2, 3)])
    found = with_class_scores(df, first.getInputCols(), last, "_prediction", [f"prob_stage_{i}" for i in (1, 2, 3)])
    return found.withColumn("predicted_stage", stage_label((F.col("_prediction") + 1).cast("int"))).drop("_prediction")


def with_pd(transformed: DataFrame) -> DataFrame:
    return transformed.withColumn("ml_pd_prediction", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("prediction"))))


def score_portfolio(table: DataFrame, stage_model: PipelineModel, cfg: EclConfig = DEFAULTS) -> DataFrame:
    """Predicted stage, class probabilities and confidence for every loan; partitions are the batches."""
    scored = stage_scores(table, stage_model)
    return scored.select(
        "loan_id",
        F.col("stage").alias("original_stage"),
        "predicted_stage",
        *[f"prob_stage_{i}" for i in (1, 2, 3)],
        F.greatest(*[F.col(f"prob_stage_{i}") for i in (1, 2, 3)]).alias("confidence"),
        F.lit(cfg.as_of_date).alias("prediction_date"),
    )


def tune(
    table: DataFrame,
    features: Sequence[str] = FEATURES,
    draws: int = 50,
    folds: int = 5,
    seed: int = 42,
    max_trees: int = 300,
    labelled_rows: int = LABELLED_ROWS,
) -> DataFrame:
    """Forest parameters by mean one-vs-rest AUC over stratified folds; one row per trial.

    ``labelled_rows`` bounds the training rows of the search; the result has how many there were.  ``folds`` in it tells after how many of them a
    trial was stopped or complete; the best trial is a complete one.
    """
    space = {"trees": Whole(5, max_trees, 5), "depth": Whole(3, 8), "leaf": Whole(1, 20)}
    narrow = materialised(table.select("loan_id", "stage", "is_train", "label", *features), "tuning")
    sample = Sample.of(labelled_sample(narrow, labelled_rows, folds), features)
    trials = search(table.sparkSession, sample, space, draws, folds, seed)
    top = max(t.mean for t in trials if not t.stopped)
    rows = [
        (k, *(t.params[x] for x in space), len(t.scores), len(sample.y), t.stopped, t.mean, not t.stopped and t.mean == top)
        for k, t in enumerate(trials)
    ]
    names = "trial int, trees int, depth int, leaf int, folds int, labelled_rows long, stopped boolean, auc double, best boolean"
    return table.sparkSession.createDataFrame(rows, names)


def select_model(metrics: DataFrame, strategy: str = "auto") -> DataFrame:
    """Chosen family from one row per candidate (name, success, accuracy, auc).

    Automatic choice takes the advanced model only with an AUC above 0.8 that also
    beats the simple model's accuracy; a failed candidate leaves the other.
    """
    one = metrics.agg(
        F.max(F.when((F.col("name") == "simple") & F.col("success"), F.col("accuracy"))).alias("simple"),
        F.max(F.when((F.col("name") == "advanced") & F.col("success"), F.col("auc"))).alias("advanced"),
    )
    s, a = F.col("simple"), F.col("advanced")
    if strategy == "simple_only":
        chosen, reason = F.when(s.isNotNull(), "simple"), F.lit("simple_only strategy")
    elif strategy == "advanced_only":
        chosen = F.when(a.isNotNull(), "advanced").when(s.isNotNull(), "simple")
        reason = F.when(a.isNotNull(), "advanced_only strategy").otherwise("advanced failed, fallback to simple")
    else:
        better = (a > 0.8) & (a > s)
        chosen = F.when(better, "advanced").when(s.isNotNull(), "simple").when(a.isNotNull(), "advanced")
        reason = (
            F.when(better, "better performance")
            .when(s.isNotNull() & a.isNotNull(), "comparable performance")
            .when(a.isNotNull(), "simple failed")
            .otherwise("advanced failed")
        )
    return one.select(F.lit(strategy).alias("strategy"), chosen.alias("selected"), reason.alias("reason"), "simple", "advanced")


def metric_table(spark: SparkSession, values: Mapping[str, float]) -> DataFrame:
    return spark.createDataFrame([(k, float(v)) for k, v in values.items()], "metric string, value double")


# -- store -------------------------------------------------------------------


def save_model(spark: SparkSession, fit: Fit, root: str, run_id: str) -> str:
    """Model and its metadata under ``root``; runs sort by id."""
    path = f"{root}/models/run_id={run_id}"
    fit.model.write().overwrite().save(path)
    meta = [(run_id, path, json.dumps(fit.metrics, sort_keys=True), json.dumps(fit.importance, sort_keys=True))]
    spark.createDataFrame(meta, "run_id string, path string, metrics string, importance string").coalesce(1).write.mode(
        "append"
    ).json(f"{root}/metadata")
    return path


def latest_run(spark: SparkSession, root: str) -> DataFrame:
    runs = spark.read.schema("run_id string, path string, metrics string, importance string").json(f"{root}/metadata")
    return runs.agg(F.max_by(F.struct("*"), F.col("run_id")).alias("m")).select("m.*")


def load_latest(spark: SparkSession, root: str) -> PipelineModel:
    return PipelineModel.load(latest_run(spark, root).first()["path"])


def report(scored: DataFrame) -> DataFrame:
    return class_report(scored, "original_stage", "predicted_stage")
