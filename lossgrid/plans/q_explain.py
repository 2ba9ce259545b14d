"""Explanation and outlier queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossgrid import config as C
from lossgrid.operators import explain as E
from lossgrid.operators.isolation import isolation_outliers, isolation_scores, strangest
from lossgrid.plans.registry import SQL_ONLY, query


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_fill(template: str, **slots: str) -> str:
    out = []
    for i, part in enumerate(E._SLOT.split(template)):
        if i % 2:
            out.append(slots[part])
        elif part:
            out.append(_q(part))
    return "(" + " || ".join(out) + ")"


SQL_ONLY["reasoned"] = f"""
SELECT s.*, CASE WHEN days_past_due>30 AND credit_score<600 THEN {_q(C.REASON_HIGH_DPD + ", " + C.REASON_SCORE_DECLINE)}
    WHEN days_past_due>30 THEN {_q(C.REASON_HIGH_DPD)} WHEN credit_score<600 THEN {_q(C.REASON_SCORE_DECLINE)}
    WHEN stage='STAGE_1' THEN {_q(C.REASON_NONE_STAGE_1)} ELSE {_q(C.REASON_NONE_OTHER)} END AS reasons FROM {{staged}} s
"""


@query(
    "explain_stage_rule",
    "SELECT loan_id, stage, CASE stage "
    + " ".join(f"WHEN '{k}' THEN {_q(v)}" for k, v in C.STAGE_TEMPLATES.items())
    + " END || reasons AS explanation, reasons AS risk_factors, CAST(0.75 AS DOUBLE) AS confidence FROM {reasoned}",
)
def _(t):
    return E.explain_stage_rule(t.staged).withColumn("risk_factors", F.concat_ws(", ", "risk_factors"))


SQL_ONLY["explained"] = f"""
SELECT loan_id, CAST(ind_stage AS INT) AS stage_num, pd_value, concat_ws(' ',
    CASE ind_stage WHEN 3 THEN {_sql_fill(C.TEXT_STAGE_3, loan="loan_id", dpd="CAST(days_past_due AS STRING)")}
      WHEN 2 THEN {_sql_fill(C.TEXT_STAGE_2, loan="loan_id")} ELSE {_sql_fill(C.TEXT_STAGE_1, loan="loan_id")} END,
    CASE WHEN ind_stage=2 AND i1=1 THEN {_sql_fill(C.TEXT_HIGH_PD, pd="printf('%.2f', round(pd_value*100.0E0, 2))")} END,
    CASE WHEN ind_stage=2 AND i2=1 THEN {_q(C.TEXT_SCORE_DROP)} END,
    CASE WHEN credit_score>=700 THEN {_q(C.TEXT_SCORE[0][1])} WHEN credit_score>=600 THEN {_q(C.TEXT_SCORE[1][1])}
      WHEN credit_score>0 THEN {_q(C.TEXT_SCORE_BELOW)} END) AS explanation
FROM {{indicated}}
"""


@query("explain_stage_text", "SELECT loan_id, stage_num, pd_value, explanation FROM {explained}", ratio="pd_value")
def _(t):
    return E.explain_stage_text(t.loans)


@query(
    "explanations_by_stage",
    "SELECT stage_num, count(*) AS n, avg(length(explanation)) AS mean_length, avg(pd_value) AS mean_pd FROM {explained} GROUP BY stage_num",
    ratio="mean_length mean_pd",
)
def _(t):
    return E.explain_stage_text(t.loans).groupBy("stage_num").agg(
        F.count("*").alias("n"), F.avg(F.length("explanation")).alias("mean_length"), F.avg("pd_value").alias("mean_pd")
    )


def _fires(i: int) -> str:
    name, op, bound, _, _ = C.UNUSUAL_FACTORS[i]
    value = "calculated_ecl/current_balance" if name == "ecl_rate" else name
    return f"{value}{op}{bound}E0"


SQL_ONLY["unusual"] = (
    "SELECT r.*, concat_ws(',', "
    + ", ".join(f"CASE WHEN {_fires(i)} THEN '{f[0]}:{f[4]}' END" for i, f in enumerate(C.UNUSUAL_FACTORS))
    + ") AS factors, concat_ws(' ', "
    + ", ".join(f"CASE WHEN {_fires(i)} THEN {_q('- ' + f[3])} END" for i, f in enumerate(C.UNUSUAL_FACTORS) if f[4] == "high")
    + ") AS high_items, concat_ws(' ', "
    + ", ".join(f"CASE WHEN {_fires(i)} THEN {_q('- ' + f[3])} END" for i, f in enumerate(C.UNUSUAL_FACTORS) if f[4] == "medium")
    + ") AS medium_items FROM {results} r"
)


@query("unusual_factors", "SELECT loan_id, factors FROM {unusual}")
def _(t):
    named = F.transform("factors", lambda f: F.concat_ws(":", f["factor"], f["severity"]))
    return E.unusual_factors(t.results).select("loan_id", F.concat_ws(",", named).alias("factors"))


@query(
    "unusual_factors_json",
    "SELECT severity, count(*) AS n FROM (SELECT unnest(string_split(factors, ',')) AS f, split_part(f, ':', 2) AS severity FROM {unusual} WHERE factors<>'') q GROUP BY severity",
)
def _(t):
    kind = "array<struct<factor:string,value:double,description:string,severity:string>>"
    read = E.unusual_factors(t.results).select(F.explode(F.from_json("factors_json", kind)).alias("f"))
    return read.groupBy(F.col("f.severity").alias("severity")).agg(F.count("*").alias("n"))


def _distance_sql() -> str:
    cols = E.OUTLIER_FEATURES
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in cols)
    square = "+".join(f"(({c}-m_{c})/s_{c})*(({c}-m_{c})/s_{c})" for c in cols)
    return f"SELECT r.*, sqrt(({square})/{len(cols)}.0E0) AS anomaly_score FROM {{results}} r, (SELECT {stats} FROM {{results}} WHERE current_balance>0) m WHERE current_balance>0"


SQL_ONLY["distanced"] = _distance_sql()


@query(
    "detect_outliers",
    "SELECT loan_id, anomaly_score FROM {distanced} WHERE anomaly_score > (SELECT quantile_cont(anomaly_score, 0.95) FROM {distanced})",
    ratio="anomaly_score",
)
def _(t):
    return E.detect_outliers(t.results).select("loan_id", "anomaly_score")


@query(
    "explain_outlier_text",
    f"""SELECT loan_id, round(anomaly_score, 6) AS anomaly_score,
         concat_ws(' ', {_sql_fill(C.TEXT_OUTLIER, loan="loan_id", score="printf('%.3f', round(anomaly_score, 3))")},
         CASE WHEN factors='' THEN {_q(C.TEXT_OUTLIER_NONE)} END,
         CASE WHEN high_items<>'' THEN {_q(C.TEXT_OUTLIER_HIGH)} || ' ' || high_items END,
         CASE WHEN medium_items<>'' THEN {_q(C.TEXT_OUTLIER_MEDIUM)} || ' ' || medium_items END, {_q(C.TEXT_OUTLIER_ACTION)}) AS outlier_explanation
       FROM {{unusual}} JOIN (SELECT loan_id, anomaly_score FROM {{distanced}}
         WHERE anomaly_score > (SELECT quantile_cont(anomaly_score, 0.95) FROM {{distanced}})) o USING (loan_id)""",
    ratio="anomaly_score",
)
def _(t):
    flagged = E.unusual_factors(E.detect_outliers(t.results))
    return E.explain_outlier_text(flagged).select("loan_id", "anomaly_score", "outlier_explanation")


_FAR = ("loan_amount", "credit_score", "dti_ratio")


def _mahalanobis_sql() -> str:
    """Three columns, with the covariance inverted by its cofactors."""
    x, y, z = _FAR
    moments = ", ".join(
        [f"avg({c}) AS m{k}" for k, c in enumerate(_FAR)]
        + [f"covar_pop({_FAR[i]}, {_FAR[j]}) AS c{i}{j}" for i, j in ((0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2))]
    )
    u, v, w = f"({x}-m0)", f"({y}-m1)", f"({z}-m2)"
    det = "(c00*(c11*c22-c12*c12) - c01*(c01*c22-c12*c02) + c02*(c01*c12-c11*c02))"
    form = (
        f"({u}*{u}*(c11*c22-c12*c12) + {v}*{v}*(c00*c22-c02*c02) + {w}*{w}*(c00*c11-c01*c01)"
        f" + 2*{u}*{v}*(c02*c12-c01*c22) + 2*{u}*{w}*(c01*c12-c02*c11) + 2*{v}*{w}*(c01*c02-c00*c12))"
    )
    active = "{results} r, (SELECT " + moments + " FROM {results} WHERE current_balance>0) m WHERE current_balance>0"
    return f"SELECT loan_id, sqrt({form}/{det}) AS distance FROM {active}"


SQL_ONLY["far"] = _mahalanobis_sql()


@query(
    "mahalanobis_outliers",
    "SELECT loan_id, distance FROM {far} WHERE distance > (SELECT quantile_cont(distance, 0.95) FROM {far})",
    ratio="distance",
)
def _(t):
    return E.distant(t.results, _FAR).select("loan_id", "distance")


@query(
    "isolation_summary",
    """SELECT count(*) AS scored, true AS in_range, true AS a_twentieth, true AS apart FROM {results} WHERE current_balance>0""",
)
def _(t):
    """What must hold for any isolation forest: a score for every active loan, and the strangest twentieth set apart."""
    scored = isolation_scores(t.results)
    flagged = strangest(scored)
    few = flagged.agg(F.count("*").alias("n"), F.max("anomaly_score").alias("most"))
    n, most = (few.select(c).scalar() for c in ("n", "most"))
    rest = scored.join(flagged.select("loan_id"), "loan_id", "left_anti").agg(F.min("anomaly_score").alias("least")).scalar()
    one = scored.agg(F.count("*").alias("scored"), F.min(F.col("anomaly_score").between(-1, 0)).alias("in_range"))
    return one.select(
        "scored", "in_range", ((n > 0) & (n <= F.ceil(F.col("scored") * 0.05))).alias("a_twentieth"), (most < rest).alias("apart")
    )


@query("isolation_outliers")
def _(t):
    return isolation_outliers(t.results).select("loan_id", "anomaly_score")


def _pd(score: str, dpd: str, dti: str) -> str:
    return (
        f"least(1.0E0, 0.02E0*CASE WHEN {score}>=800 THEN 0.5E0 WHEN {score}>=700 THEN 1.0E0 WHEN {score}>=600 THEN 1.5E0 ELSE 3.0E0 END"
        f"*(1+({dpd}/30.0E0)*0.5E0)*(1+greatest(0.0E0, ({dti}-0.4E0)*2)))"
    )


def _shapley_sql() -> str:
    own, mean = ("credit_score", "days_past_due", "dti_ratio"), ("bs", "bd", "bt")

    def v(bits: str) -> str:
        return _pd(*[own[i] if b == "1" else mean[i] for i, b in enumerate(bits)])

    values = ", ".join(f"{v(b)} AS v{b}" for b in ("000", "001", "010", "011", "100", "101", "110", "111"))
    return f"""SELECT *, (v100-v000)/3.0E0+(v110-v010)/6.0E0+(v101-v001)/6.0E0+(v111-v011)/3.0E0 AS phi_credit_score,
         (v010-v000)/3.0E0+(v110-v100)/6.0E0+(v011-v001)/6.0E0+(v111-v101)/3.0E0 AS phi_days_past_due,
         (v001-v000)/3.0E0+(v101-v100)/6.0E0+(v011-v010)/6.0E0+(v111-v110)/3.0E0 AS phi_dti_ratio, v000 AS base_value, v111 AS prediction
       FROM (SELECT l.*, {values} FROM {{loans}} l, (SELECT avg(credit_score) AS bs, avg(days_past_due) AS bd, avg(dti_ratio) AS bt FROM {{loans}}) m) q"""


SQL_ONLY["shapley"] = _shapley_sql()
PHI = "phi_credit_score phi_days_past_due phi_dti_ratio base_value prediction"


@query("feature_contributions", f"SELECT loan_id, {', '.join(PHI.split())} FROM {{shapley}}", ratio=PHI)
def _(t):
    return E.feature_contributions(t.loans).select("loan_id", *PHI.split())


@query(
    "contribution_text",
    f"""SELECT loan_id, string_agg(name, ',' ORDER BY k DESC, name) AS top_features,
         {_sql_fill(C.TEXT_SHAP_HEAD, loan="loan_id")} || ' ' || string_agg(rk || '. ' || txt, ' ' ORDER BY rk) || ' ' ||
           CASE WHEN any_value(total)>0 THEN {_q(C.TEXT_SHAP_UP)} ELSE {_q(C.TEXT_SHAP_DOWN)} END AS text_explanation
       FROM (SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY k DESC, name) AS rk FROM (
         """
    + " UNION ALL ".join(
        f"""SELECT loan_id, '{c}' AS name, round(abs(phi_{c}), 9) AS k, phi_credit_score+phi_days_past_due+phi_dti_ratio AS total,
              {_q(C.SHAP_NAMES[c] + " (")} || CAST({c} AS STRING) || CASE WHEN phi_{c}>0 THEN ') aumenta' ELSE ') reduce' END || ' el riesgo de impago significativamente.' AS txt FROM {{{{shapley}}}}""".replace("{{", "{").replace("}}", "}")
        for c in E.INPUTS
    )
    + ") a) b GROUP BY loan_id",
)
def _(t):
    return E.contribution_text(E.feature_contributions(t.loans)).select("loan_id", "top_features", "text_explanation")


_IMPORTANCE = " UNION ALL ".join(f"SELECT '{c}' AS feature, avg(abs(phi_{c})) AS importance FROM {{shapley}}" for c in E.INPUTS)


@query("global_importance", _IMPORTANCE, ratio="importance")
def _(t):
    return E.global_importance(t.loans)


@query(
    "topk_features",
    f"SELECT feature, importance FROM ({_IMPORTANCE}) q ORDER BY importance DESC LIMIT 2",
    ratio="importance",
)
def _(t):
    return E.global_importance(t.loans).orderBy(F.desc_nulls_last("importance"), "feature").limit(2)
