"""Training, scoring and evaluation queries.

Models have the operators' full sizes and learn from all training rows (the parameter search from a bounded sample of them).
What a model says about a loan has no SQL form, so its queries return what must hold for whatever it says: row counts, sums of
probabilities, bounds of its errors.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lossgrid.operators import attributions as A
from lossgrid.operators import evaluation as V
from lossgrid.operators import models as M
from lossgrid.operators.tuning import LABELLED_ROWS, STARTUP
from lossgrid.plans.registry import SQL_ONLY, query
from lossgrid.sources.scratch import fresh_path, materialised, version_of

_FITS: dict[tuple, M.Fit] = {}

#: What a model must reach on the rows it has not seen.
LEAST_ACCURACY, LEAST_AUC, MOST_ERROR = 0.85, 0.8, 0.05


def _table(t):
    return M.training_table(t.staged)


def _fit(t, table, folds: int = 5) -> M.Fit:
    """One forest per session and state of the tables, shared by the queries below; folds add metrics and leave the
    model as it is."""
    key = (t.spark.sparkContext.applicationId, version_of(t.spark, t.sf_dir), folds)
    if key not in _FITS:
        _FITS[key] = M.train_stage(table, folds=folds)
    return _FITS[key]


def _forest(t, table) -> M.Fit:
    """The same forest for queries that show none of the folds' metrics."""
    return _FITS.get((t.spark.sparkContext.applicationId, version_of(t.spark, t.sf_dir), 5)) or _fit(t, table, folds=0)


SQL_ONLY["stage_sizes"] = "SELECT stage, count(*) AS n, CAST(floor(0.8E0*count(*)) AS BIGINT) AS train FROM {staged} GROUP BY stage"

_SPLIT_SQL = "SELECT sum(train) AS train_rows, sum(n-train) AS test_rows FROM {stage_sizes}"


def _split_counts(table):
    return table.agg(F.count_if("is_train").alias("train_rows"), F.count_if(~F.col("is_train")).alias("test_rows"))


def _reached(metrics: dict) -> dict:
    """A stage model's metrics against what they must reach."""
    whole = [metrics[k] for k in ("accuracy", "roc_auc", "cv_mean")]
    return {
        "accurate": F.lit(metrics["accuracy"] >= LEAST_ACCURACY),
        "ranks": F.lit(metrics["roc_auc"] >= LEAST_AUC),
        "folds_agree": F.lit(abs(metrics["cv_mean"] - metrics["accuracy"]) <= 0.05 and metrics["cv_std"] <= 0.05),
        "in_range": F.lit(all(0.0 <= x <= 1.0 for x in whole)),
    }


_REACHED_SQL = f"""SELECT CAST(train_rows AS BIGINT) AS train_rows, CAST(test_rows AS BIGINT) AS test_rows,
  true AS accurate, true AS ranks, true AS folds_agree, true AS in_range FROM ({_SPLIT_SQL}) s"""


@query("train_stage_classifier", _REACHED_SQL)
def _(t):
    table = _table(t)
    return _split_counts(table).withColumns(_reached(_fit(t, table).metrics))


@query(
    "train_stage_8feat",
    _REACHED_SQL.replace("true AS in_range", "true AS in_range, CAST(8 AS INT) AS features, CAST(1 AS DOUBLE) AS importance"),
    ratio="importance",
)
def _(t):
    table = _table(t)
    fit = M.train_stage(table, trees=200, depth=12)
    shown = {"features": F.lit(len(fit.importance)), "importance": F.lit(sum(fit.importance.values()))}
    return _split_counts(table).withColumns(_reached(fit.metrics) | shown)


@query(
    "train_pd_regressor",
    f"""SELECT CAST(sum(train) AS BIGINT) AS train_rows, CAST(sum(n-train) AS BIGINT) AS test_rows, true AS exact, true AS consistent, true AS folds_agree
        FROM (SELECT calculated_stage, count(*) AS n, CAST(floor(0.8E0*count(*)) AS BIGINT) AS train FROM {{results}} GROUP BY 1) s""",
)
def _(t):
    table = M.training_table(
        t.results.withColumn("stage", F.col("calculated_stage")), target=F.col("calculated_pd")
    )
    m = M.train_pd(table).metrics
    return _split_counts(table).withColumns(
        {
            "exact": F.lit(m["mae"] <= MOST_ERROR),
            "consistent": F.lit(abs(m["rmse"] ** 2 - m["mse"]) < 1e-9 and m["mae"] <= m["rmse"] and m["r2"] <= 1.0),
            "folds_agree": F.lit(m["cv_mae_mean"] <= MOST_ERROR and m["cv_mae_std"] <= MOST_ERROR),
        }
    )


@query(
    "score_portfolio",
    """SELECT loan_id, stage AS original_stage, true AS whole, true AS confident, true AS most_likely, DATE '2001-12-31' AS prediction_date FROM {staged}""",
)
def _(t):
    table = _table(t)
    probs = [F.col(f"prob_stage_{i}") for i in (1, 2, 3)]
    predicted = F.element_at(F.create_map(*[x for i, p in enumerate(probs) for x in (F.lit(f"STAGE_{i + 1}"), p)]), F.col("predicted_stage"))
    return M.score_portfolio(table, _forest(t, table).model).select(
        "loan_id", "original_stage", (F.abs(probs[0] + probs[1] + probs[2] - 1.0) < 1e-9).alias("whole"),
        (F.col("confidence") == F.greatest(*probs)).alias("confident"), (predicted == F.col("confidence")).alias("most_likely"), "prediction_date",
    )


@query(
    "scan_batched_score",
    "SELECT stage AS original_stage, count(*) AS n, CAST(count(*) AS DOUBLE) AS probability, true AS confident FROM {staged} GROUP BY stage",
    ratio="probability",
)
def _(t):
    table = _table(t)
    scored = M.score_portfolio(table, _forest(t, table).model)
    return scored.groupBy("original_stage").agg(
        F.count("*").alias("n"),
        F.sum(sum((F.col(f"prob_stage_{i}") for i in (2, 3)), F.col("prob_stage_1"))).alias("probability"),
        F.min(F.col("confidence").between(1 / 3 - 1e-9, 1.0)).alias("confident"),
    )


@query(
    "tune_model",
    f"""SELECT CAST(50 AS BIGINT) AS trials, true AS in_space, true AS better_than_blind, true AS one_best, true AS ranks,
          CAST(CASE WHEN sum(train) > {LABELLED_ROWS} THEN sum({LABELLED_ROWS}*train//w) ELSE sum(train) END AS BIGINT) AS labelled_rows
        FROM (SELECT train, sum(train) OVER () AS w FROM {{stage_sizes}}) s""",
)
def _(t):
    trials = M.tune(_table(t))
    top = F.max(F.when(F.col("best"), F.col("auc")))
    return trials.agg(
        F.count("*").alias("trials"),
        F.min(
            F.col("trees").between(5, 300) & (F.col("trees") % 5 == 0) & F.col("depth").between(3, 8) & F.col("leaf").between(1, 20)
            & F.col("auc").between(0, 1) & (F.when(F.col("stopped"), F.col("folds").between(1, 4)).otherwise(F.col("folds") == 5))
        ).alias("in_space"),
        (top >= F.max(F.when(F.col("trial") < STARTUP, F.col("auc")))).alias("better_than_blind"),
        (F.count_if("best") >= 1).alias("one_best"),
        (top >= LEAST_AUC).alias("ranks"),
        F.max("labelled_rows").alias("labelled_rows"),
    )


@query("select_model")
def _(t):
    table = _table(t)
    simple, advanced = _forest(t, table).metrics, M.train_boosted(table)
    rows = [("simple", True, simple["accuracy"], None), ("advanced", True, None, advanced["roc_auc"])]
    return _picks(t.spark.createDataFrame(rows, "name string, success boolean, accuracy double, auc double"))


def _picks(candidates):
    picks = [M.select_model(candidates, s) for s in ("auto", "simple_only", "advanced_only")]
    return picks[0].unionByName(picks[1]).unionByName(picks[2])


@query("model_store", "SELECT count(*) AS scored, count(*) AS identical, '20011231' AS run_id FROM {staged}")
def _(t):
    root = fresh_path(t.spark, "model-store")
    table = _table(t)
    fit = _fit(t, table)
    for run in ("20011130", "20011231"):
        M.save_model(t.spark, fit, root, run)
    reloaded = M.load_latest(t.spark, root)
    same = M.score_portfolio(table, fit.model).select("loan_id", F.col("predicted_stage").alias("before")).join(
        M.score_portfolio(table, reloaded).select("loan_id", "predicted_stage"), "loan_id"
    )
    latest = M.latest_run(t.spark, root).select("run_id").scalar()
    return same.agg(
        F.count("*").alias("scored"), F.count_if(F.col("before") == F.col("predicted_stage")).alias("identical")
    ).withColumn("run_id", latest)


# -- evaluation --------------------------------------------------------------


@query(
    "eval_confusion",
    "SELECT original_stage AS actual, predicted_stage AS predicted, count(*) AS n FROM {predictions} GROUP BY 1, 2",
)
def _(t):
    return V.confusion(t.predictions, "original_stage", "predicted_stage")


def _report_sql() -> str:
    parts = []
    for i in (1, 2, 3):
        tp = f"count(*) FILTER (original_stage='STAGE_{i}' AND predicted_stage='STAGE_{i}')"
        pp, ap = f"count(*) FILTER (predicted_stage='STAGE_{i}')", f"count(*) FILTER (original_stage='STAGE_{i}')"
        parts.append(
            f"""SELECT 'STAGE_{i}' AS class, {tp}/{pp} AS precision, {tp}/{ap} AS recall, 2*({tp}/{pp})*({tp}/{ap})/({tp}/{pp}+{tp}/{ap}) AS f1,
                  {ap} AS support, count(*) FILTER (original_stage=predicted_stage)/count(*) AS accuracy FROM {{predictions}}"""
        )
    return " UNION ALL ".join(parts)


@query("eval_report", _report_sql(), ratio="precision recall f1 accuracy")
def _(t):
    return V.class_report(t.predictions, "original_stage", "predicted_stage")


SQL_ONLY["class_scores"] = " UNION ALL ".join(
    f"""SELECT 'STAGE_{i}' AS class, CASE WHEN predicted_stage='STAGE_{i}' THEN confidence ELSE (1-confidence)/2.0E0 END AS score,
          CASE WHEN original_stage='STAGE_{i}' THEN 1 ELSE 0 END AS pos FROM {{predictions}}"""
    for i in (1, 2, 3)
)
_AUC_SQL = """SELECT class, (sum(pos*rk) - sum(pos)*(sum(pos)+1)/2.0E0)/(sum(pos)*(count(*)-sum(pos))) AS auc, sum(pos)/count(*) AS weight
  FROM (SELECT class, pos, rank() OVER (PARTITION BY class ORDER BY score) + (count(*) OVER (PARTITION BY class, score)-1)/2.0E0 AS rk FROM {class_scores}) q GROUP BY class"""


def _class_scores():
    p, c = F.col("predicted_stage"), F.col("confidence")
    return {f"STAGE_{i}": F.when(p == f"STAGE_{i}", c).otherwise((F.lit(1) - c) / 2.0) for i in (1, 2, 3)}


@query("eval_auc_ovr", _AUC_SQL, ratio="auc weight")
def _(t):
    return V.auc_one_vs_rest(t.predictions, "original_stage", _class_scores())


@query("eval_auc_weighted", f"SELECT sum(auc*weight)/sum(weight) AS roc_auc FROM ({_AUC_SQL}) z", ratio="roc_auc")
def _(t):
    return V.weighted_auc(V.auc_one_vs_rest(t.predictions, "original_stage", _class_scores()))


_CHOICE = "advanced>0.8E0 AND advanced>simple"


@query(
    "select_by_predictions",
    f"""WITH c AS (SELECT (SELECT avg(CAST(predicted_stage=original_stage AS INT)) FROM {{predictions}}) AS simple,
           (SELECT sum(auc*weight)/sum(weight) FROM ({_AUC_SQL}) z) AS advanced)
        SELECT 'auto' AS strategy, CASE WHEN {_CHOICE} THEN 'advanced' ELSE 'simple' END AS selected,
          CASE WHEN {_CHOICE} THEN 'better performance' ELSE 'comparable performance' END AS reason, simple, advanced FROM c
        UNION ALL SELECT 'simple_only', 'simple', 'simple_only strategy', simple, advanced FROM c
        UNION ALL SELECT 'advanced_only', 'advanced', 'advanced_only strategy', simple, advanced FROM c""",
    ratio="simple advanced",
)
def _(t):
    """The same choice between two families whose predictions are on record."""
    right = t.predictions.agg(F.avg((F.col("predicted_stage") == F.col("original_stage")).cast("double")).alias("accuracy"))
    ranks = V.weighted_auc(V.auc_one_vs_rest(t.predictions, "original_stage", _class_scores()))
    none, done = F.lit(None).cast("double"), F.lit(True).alias("success")
    simple = right.select(F.lit("simple").alias("name"), done, "accuracy", none.alias("auc"))
    return _picks(simple.union(ranks.select(F.lit("advanced").alias("name"), done, none.alias("accuracy"), "roc_auc")))


@query(
    "forest_importance",
    """SELECT feature, count(*) AS loans, true AS additive FROM {staged},
         (SELECT unnest(['loan_amount', 'interest_rate', 'term_months', 'credit_score', 'days_past_due', 'dti_ratio', 'ltv_ratio', 'employment_length']) AS feature) f
       GROUP BY feature""",
)
def _(t):
    """Shapley values of a fitted forest for all loans: every feature, and whether they add up to what the forest says."""
    table = _table(t)
    model = M.stage_classifier(trees=20, depth=6).fit(table.where("is_train"))
    forest = A.forest_of(t.spark, model.stages[-1])
    found = materialised(A.attributions(table, "loan_id", M.FEATURES, forest), "attributions")
    said = M.with_stage_scores(model.transform(table)).select("loan_id", *[f"prob_stage_{i}" for i in (1, 2, 3)])
    apart = F.greatest(*[F.abs(F.col("expected")[i] - F.col(f"prob_stage_{i + 1}")) for i in range(3)])
    checked = found.join(said, "loan_id").agg(F.count("*").alias("loans"), (F.max(apart) <= 1e-6).alias("additive"))
    loans, additive = (checked.select(c).scalar() for c in ("loans", "additive"))
    return A.importance(found, M.FEATURES).select("feature", loans.alias("loans"), additive.alias("additive"))


@query(
    "eval_regression",
    """SELECT avg(abs(a-p)) AS mae, avg((a-p)*(a-p)) AS mse, sqrt(avg((a-p)*(a-p))) AS rmse, 1-avg((a-p)*(a-p))/var_pop(a) AS r2
       FROM (SELECT r.calculated_pd AS a, p.probability_default AS p FROM {results} r JOIN {predictions} p USING (loan_id)) q""",
    ratio="mae mse rmse r2",
)
def _(t):
    both = t.results.select("loan_id", "calculated_pd").join(t.predictions.select("loan_id", "probability_default"), "loan_id")
    return V.regression_metrics(both, "calculated_pd", "probability_default")


def _snapshot(t, version: str):
    """Metric snapshot of one feature-set version: accuracy, PD error, and score importances by correlation."""
    p = t.predictions.where(F.col("feature_set_version") == version).join(
        t.results.select("loan_id", "calculated_pd", "credit_score", "days_past_due"), "loan_id"
    )
    weight = {c: F.abs(F.corr(F.col(c).cast("double"), F.col("calculated_pd"))) for c in ("credit_score", "days_past_due")}
    return p.agg(
        F.avg((F.col("predicted_stage") == F.col("original_stage")).cast("double")).alias("accuracy"),
        F.avg(F.abs(F.col("probability_default") - F.col("calculated_pd"))).alias("pd_mae"),
        F.create_map(*[x for c, w in weight.items() for x in (F.lit(c), w)]).alias("importances"),
    )


@query(
    "model_thresholds",
    """WITH s AS (SELECT feature_set_version AS v, avg(CAST(predicted_stage=original_stage AS INT)) AS acc, avg(abs(probability_default-calculated_pd)) AS mae,
           abs(corr(credit_score, calculated_pd)) AS w1, abs(corr(days_past_due, calculated_pd)) AS w2
         FROM {predictions} JOIN (SELECT loan_id, calculated_pd, credit_score, days_past_due FROM {results}) r USING (loan_id) GROUP BY 1),
       m AS (SELECT a.acc, a.mae, 1-abs(a.acc-b.acc) AS stab, greatest(abs(a.w1-b.w1), abs(a.w2-b.w2)) AS drift FROM s a, s b WHERE a.v='fs1' AND b.v='fs0')
       SELECT 'accuracy' AS metric, acc AS observed, 0.85E0 AS "limit", acc>=0.85E0 AS passed FROM m UNION ALL SELECT 'pd_mae', mae, 0.05E0, mae<=0.05E0 FROM m
       UNION ALL SELECT 'stability', stab, 0.9E0, stab>=0.9E0 FROM m UNION ALL SELECT 'importance_drift', drift, 0.15E0, drift<=0.15E0 FROM m""",
    ratio="observed",
)
def _(t):
    return V.model_thresholds(_snapshot(t, "fs1"), _snapshot(t, "fs0"))


_EDGES = ", ".join(f"quantile_cont(probability_default, {i / 10})" for i in range(1, 10))


@query(
    "calibration_psi",
    f"""SELECT CAST(1+len(list_filter(e, lambda x: x < probability_default)) AS INT) AS decile, count(*) AS n, avg(probability_default) AS mean_predicted,
         avg(CAST(original_stage='STAGE_3' AS INT)) AS default_rate
       FROM {{predictions}}, (SELECT [{_EDGES}] AS e FROM {{predictions}}) z GROUP BY 1""",
    ratio="mean_predicted default_rate",
)
def _(t):
    return V.calibration(t.predictions, "probability_default", F.col("original_stage") == "STAGE_3")


@query(
    "stability_index",
    f"""SELECT sum((q-p)*ln(q/p)) AS psi, count(*) AS bins FROM (
         SELECT greatest(count(*) FILTER (feature_set_version='fs1')/(SELECT count(*) FROM {{predictions}} WHERE feature_set_version='fs1'), 1e-6) AS p,
           greatest(count(*) FILTER (feature_set_version='fs0')/(SELECT count(*) FROM {{predictions}} WHERE feature_set_version='fs0'), 1e-6) AS q
         FROM {{predictions}}, (SELECT [{_EDGES}] AS e FROM {{predictions}} WHERE feature_set_version='fs1') z
         GROUP BY len(list_filter(e, lambda x: x < probability_default))) y""",
    ratio="psi",
)
def _(t):
    of = lambda v: t.predictions.where(F.col("feature_set_version") == v)
    return V.stability_index(of("fs1"), of("fs0"), "probability_default")
