"""Source, sink and user-function queries: write, read back, compare."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lossgrid.config import DEFAULTS, RETENTION_DAYS
from lossgrid.functions import portfolio as P
from lossgrid.functions.udfs import PaymentSchedule, payment_schedule, udaf_coverage, udf_score
from lossgrid.operators.reports import summary_report
from lossgrid.plans.registry import query
from lossgrid.sources import readers as I
from lossgrid.sources import sinks as O
from lossgrid.sources.schemas import LOAN_DDL, STAGED_RESULT_DDL
from lossgrid.sources.scratch import fresh_path

LOAN_COLUMNS = "loan_id, customer_id, loan_amount, term_months, loan_type, origination_date, ltv_ratio, current_balance, region"
CORE = [c.strip() for c in LOAN_COLUMNS.split(",")]


@query("scan_csv_typed", f"SELECT {LOAN_COLUMNS} FROM {{loans}}")
def _(t):
    path = fresh_path(t.spark, "csv")
    t.loans.write.option("header", True).csv(path)
    return I.scan_csv_typed(t.spark, path, LOAN_DDL).select(*CORE)


@query("scan_parquet", f"SELECT {LOAN_COLUMNS} FROM {{loans}}")
def _(t):
    path = fresh_path(t.spark, "parquet")
    t.loans.write.parquet(path)
    return I.scan_parquet(t.spark, path, LOAN_DDL).select(*CORE)


@query("lookup_loan", f"SELECT {LOAN_COLUMNS} FROM {{loans}} WHERE loan_id='L000042'")
def _(t):
    return I.lookup(t.loans, "loan_id", "L000042", CORE)


@query(
    "normalize_datetimes",
    """SELECT loan_id, CAST(origination_date AS TIMESTAMP) AS origination_date,
         CASE WHEN CAST(substr(loan_id,2) AS BIGINT)%97=5 THEN NULL ELSE CAST(maturity_date AS TIMESTAMP) END AS maturity_text,
         CAST(origination_date AS TIMESTAMP) - INTERVAL '2 hours' AS created_at FROM {loans}""",
)
def _(t):
    return I.normalize_datetimes(_texts(t))


def _texts(t):
    """Dates as a date column, as text with faults, and as text with a zone."""
    bad = F.expr("substring(loan_id, 2)").cast("long") % 97 == 5
    return t.loans.select(
        "loan_id",
        "origination_date",
        F.when(bad, "not-a-date").otherwise(F.col("maturity_date").cast("string")).alias("maturity_text"),
        F.concat(F.col("origination_date").cast("string"), F.lit("T00:00:00+02:00")).alias("created_at"),
    )


@query(
    "datetime_conversion_report",
    """SELECT 'origination_date' AS column_name, 'date' AS data_type, CAST(0 AS BIGINT) AS unconvertible, true AS conversion_safe FROM {loans} HAVING count(*)>0
       UNION ALL SELECT 'maturity_text', 'string', count(*) FILTER (CAST(substr(loan_id,2) AS BIGINT)%97=5), count(*) FILTER (CAST(substr(loan_id,2) AS BIGINT)%97=5)=0 FROM {loans}
       UNION ALL SELECT 'created_at', 'string', CAST(0 AS BIGINT), true FROM {loans} HAVING count(*)>0""",
)
def _(t):
    return I.datetime_conversion_report(_texts(t))


# -- sinks -------------------------------------------------------------------

RESULT = "loan_id, calculated_stage, calculated_ead, calculated_ecl"
RESULT_COLUMNS = [c.strip() for c in RESULT.split(",")]


def _core(t):
    return t.results.select(*RESULT_COLUMNS)


@query("sink_parquet", f"SELECT {RESULT} FROM {{results}}", ratio="calculated_ecl")
def _(t):
    path = O.write_results(_core(t), fresh_path(t.spark, "results"), "20011231")
    return t.spark.read.parquet(path)


def _by_stage(t):
    return t.results.groupBy("calculated_stage").agg(
        F.count("*").alias("loan_count"), F.sum("calculated_ecl").alias("total_ecl"), F.sum("calculated_ead").alias("total_ead")
    )


BY_STAGE = "SELECT calculated_stage, count(*) AS loan_count, sum(calculated_ecl) AS total_ecl, sum(calculated_ead) AS total_ead FROM {results} GROUP BY calculated_stage"


@query("sink_single_file", BY_STAGE, money="total_ecl total_ead")
def _(t):
    return t.spark.read.parquet(O.write_single_file(_by_stage(t), fresh_path(t.spark, "single")))


@query(
    "sink_summary_json",
    """SELECT count(*) AS total_loans, sum(calculated_ecl) AS total_ecl, count(*) FILTER (calculated_stage='STAGE_3') AS stage3_count FROM {results}""",
    money="total_ecl",
)
def _(t):
    path = O.write_json_rows(summary_report(t.results), fresh_path(t.spark, "summary"))
    read = t.spark.read.schema("total_loans long, total_ecl double, stage3_count long").json(path)
    return read.select("total_loans", "total_ecl", "stage3_count")


@query("sink_audit_json", "SELECT event_type, count(*) AS n FROM (SELECT unnest(['process_start','process_complete','process_start','process_complete']) AS event_type, (SELECT count(*) FROM {loans}) AS c) q WHERE c>0 GROUP BY event_type")
def _(t):
    path = fresh_path(t.spark, "audit")
    at = dt.datetime.combine(DEFAULTS.as_of_date, dt.time())
    n = t.loans.count()
    for _run in range(2):
        O.write_audit(O.audit_frame(t.spark, [(at, "process_start", {"loan_count": n}), (at, "process_complete", {"loan_count": n})]), path)
    read = t.spark.read.schema("timestamp string, event_type string, metadata string").json(path)
    return read.groupBy("event_type").agg(F.count("*").alias("n"))


@query(
    "sink_write_modes",
    """SELECT 'truncate' AS step, count(*) AS n FROM {loans} UNION ALL SELECT 'append', 2*count(*) FROM {loans}
       UNION ALL SELECT 'empty_refused', 2*count(*) FROM {loans}""",
)
def _(t):
    path, steps = fresh_path(t.spark, "modes"), []

    def rows():
        return t.spark.read.schema(base.schema).parquet(path).count()

    base = t.loans.select("loan_id", "loan_type")
    O.load_table(base, path, "WRITE_TRUNCATE")
    O.load_table(base, path, "WRITE_TRUNCATE")
    steps.append(("truncate", rows()))
    O.load_table(base, path, "WRITE_APPEND")
    steps.append(("append", rows()))
    try:
        O.load_table(base, path, "WRITE_EMPTY")
    except Exception:  # the path holds data, so the load must be refused
        steps.append(("empty_refused", rows()))
    return t.spark.createDataFrame(steps, "step string, n long")


@query("sink_idempotent", "SELECT job_id, loan_id, loan_type FROM {loans}, (VALUES ('job-1'), ('job-2')) j(job_id)")
def _(t):
    path = fresh_path(t.spark, "once")
    base = t.loans.select("loan_id", "loan_type")
    for job in ("job-1", "job-2", "job-1"):
        O.load_once(base, path, job)
    return t.spark.read.schema("loan_id string, loan_type string, job_id string").parquet(path)


@query("sink_versioned_path", "SELECT loan_id, loan_type, CAST(k AS INT) AS version FROM {loans}, (VALUES (1), (2)) v(k)")
def _(t):
    root = fresh_path(t.spark, "versions")
    base = t.loans.select("loan_id", "loan_type")
    parts = [
        t.spark.read.schema(base.schema).parquet(O.write_versioned(base, root, "loans", f"2001123{k}_000000")).withColumn("version", F.lit(k))
        for k in (1, 2)
    ]
    return parts[0].unionByName(parts[1])


@query(
    "sink_multi_format",
    "SELECT f AS format, count(*) AS n, sum(current_balance) AS total FROM {loans}, (VALUES ('csv'), ('json'), ('parquet')) v(f) GROUP BY f",
    money="total",
)
def _(t):
    root = fresh_path(t.spark, "formats")
    base = t.loans.select("loan_id", "current_balance")
    out = None
    for f in O.write_formats(base, root):
        reader = t.spark.read.schema(base.schema).format(f)
        read = (reader.option("header", True) if f == "csv" else reader).load(f"{root}/{f}")
        part = read.agg(F.count("*").alias("n"), F.sum("current_balance").alias("total")).select(F.lit(f).alias("format"), "n", "total")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "sink_manifest",
    """SELECT (SELECT count(*) FROM {results}) AS record_count, calculated_stage, count(*) AS loan_count, sum(calculated_ead) AS total_exposure
       FROM {results} GROUP BY calculated_stage""",
    money="total_exposure",
)
def _(t):
    manifest = O.write_with_manifest(_core(t), fresh_path(t.spark, "manifest"), "calculated_stage", "calculated_ead")
    return manifest.select("record_count", F.explode("stage_summary").alias("s")).select("record_count", "s.*")


@query("create_table_if_absent", "SELECT count(*) AS n_rows, CAST(11 AS INT) AS n_columns FROM {results}")
def _(t):
    path = fresh_path(t.spark, "table")
    name = "staged_results_" + path[-12:]
    for _run in range(2):
        table = O.create_table_if_absent(t.spark, name, STAGED_RESULT_DDL, path)
    rows = t.results.withColumn("calculation_date", F.lit(DEFAULTS.as_of_date)).select(*table.columns)
    rows.write.insertInto(name)
    return t.spark.table(name).agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(table.columns)))


@query(
    "sink_partitioned_clustered",
    "SELECT loan_id, region, loan_type, stage, calculation_date FROM {staged}",
)
def _(t):
    path = fresh_path(t.spark, "clustered")
    rows = t.staged.select("loan_id", "region", "loan_type", "stage", "calculation_date")
    O.write_clustered(rows, path, "calculation_date", ["region", "loan_type", "stage"], "loan_id")
    return t.spark.read.schema(rows.schema).parquet(path).where(F.col("calculation_date") == F.lit(DEFAULTS.as_of_date))


def _dated(t):
    return t.results.withColumn("calculation_date", F.lit(DEFAULTS.as_of_date))


@query(
    "ctas_daily_stage_metrics",
    """SELECT DATE '2001-12-31' AS calculation_date, calculated_stage, count(*) AS loan_count, sum(calculated_ecl) AS total_ecl, sum(calculated_ead) AS total_ead
       FROM {results} GROUP BY calculated_stage""",
    money="total_ecl total_ead",
)
def _(t):
    path = fresh_path(t.spark, "daily")
    daily = _dated(t).groupBy("calculation_date", "calculated_stage").agg(
        F.count("*").alias("loan_count"), F.sum("calculated_ecl").alias("total_ecl"), F.sum("calculated_ead").alias("total_ead")
    )
    return t.spark.read.schema(daily.schema).parquet(O.load_table(daily, path, "WRITE_TRUNCATE"))


@query(
    "mv_daily_portfolio_summary",
    """SELECT DATE '2001-12-31' AS report_date, calculated_stage, region, loan_type, count(*) AS loan_count, sum(current_balance) AS total_exposure,
         sum(calculated_ecl) AS total_ecl, avg(credit_score) AS avg_credit_score, avg(calculated_pd) AS avg_pd
       FROM {results} WHERE current_balance>0 GROUP BY calculated_stage, region, loan_type""",
    money="total_ecl",
    cents="total_exposure",
    ratio="avg_credit_score avg_pd",
)
def _(t):
    path = fresh_path(t.spark, "mv")
    daily = (
        t.results.where(F.col("current_balance") > 0)
        .groupBy("calculated_stage", "region", "loan_type")
        .agg(
            F.count("*").alias("loan_count"), F.sum("current_balance").alias("total_exposure"), F.sum("calculated_ecl").alias("total_ecl"),
            F.avg("credit_score").alias("avg_credit_score"), F.avg("calculated_pd").alias("avg_pd"),
        )
        .withColumn("report_date", F.lit(DEFAULTS.as_of_date))
    )
    O.refresh_partitions(daily, path, "report_date")
    O.refresh_partitions(daily, path, "report_date")
    return t.spark.read.schema(daily.schema).parquet(path)


@query(
    "mv_risk_metrics_snapshot",
    """SELECT DATE '2001-12-31' AS snapshot_date, loan_id, calculated_stage, calculated_pd, calculated_lgd, calculated_ead, calculated_ecl, days_past_due, current_balance
       FROM {results} WHERE current_balance>0""",
    ratio="calculated_ecl",
)
def _(t):
    path = fresh_path(t.spark, "snapshot")
    rows = t.results.where(F.col("current_balance") > 0).select(
        "loan_id", "calculated_stage", "calculated_pd", "calculated_lgd", "calculated_ead", "calculated_ecl", "days_past_due", "current_balance",
        F.lit(DEFAULTS.as_of_date).alias("snapshot_date"),
    )
    O.refresh_partitions(rows, path, "snapshot_date")
    return t.spark.read.schema(rows.schema).parquet(path)


@query(
    "retention_violations",
    """SELECT 'raw' AS policy, CAST(30 AS INT) AS days, count(*) AS records, count(*) FILTER (datediff('day', payment_date, DATE '2001-12-31')>30) AS violations FROM {payments}
       UNION ALL SELECT 'processed', 90, count(*), count(*) FILTER (datediff('day', origination_date, DATE '2001-12-31')>90) FROM {loans}
       UNION ALL SELECT 'audit', 2555, count(*), count(*) FILTER (datediff('day', transition_date, DATE '2001-12-31')>2555) FROM {transitions}""",
)
def _(t):
    d = RETENTION_DAYS
    return O.retention_violations(
        {
            "raw": (t.payments, "payment_date", d["raw"]),
            "processed": (t.loans, "origination_date", d["processed"]),
            "audit": (t.transitions, "transition_date", d["audit"]),
        },
        DEFAULTS.as_of_date,
    )


@query(
    "retention_keep",
    "SELECT loan_id, transition_date, from_stage, to_stage FROM {transitions} WHERE datediff('day', transition_date, DATE '2001-12-31') <= 90",
)
def _(t):
    return O.retention_keep(t.transitions, "transition_date", DEFAULTS.as_of_date, RETENTION_DAYS["processed"])


@query("batch_explanations", "SELECT loan_id, stage_num, pd_value, explanation FROM {explained}", ratio="pd_value")
def _(t):
    from lossgrid.operators.explain import explain_stage_text

    path = fresh_path(t.spark, "explanations")
    rows = explain_stage_text(t.loans)
    O.load_table(rows, path, "WRITE_APPEND")
    return t.spark.read.schema(rows.schema).parquet(path)


# -- user functions ----------------------------------------------------------


@query("udf_score", "SELECT loan_id, pd_value FROM {fallback}", ratio="pd_value")
def _(t):
    def predict(batch):
        import numpy as np

        score, dpd, dti = batch["credit_score"], batch["days_past_due"], batch["dti_ratio"]
        factor = np.select([score >= 800, score >= 700, score >= 600], [0.5, 1.0, 1.5], 3.0)
        raw = 0.02 * factor * (1.0 + dpd / 30.0 * 0.5) * (1.0 + np.maximum(0.0, (dti - 0.4) * 2.0))
        return np.minimum(1.0, raw)

    value = udf_score(predict, ["credit_score", "days_past_due", "dti_ratio"])
    return t.loans.select("loan_id", value.alias("pd_value"))


@query("udaf_coverage", "SELECT loan_type, sum(calculated_ecl)/sum(current_balance) AS coverage FROM {results} GROUP BY loan_type", ratio="coverage")
def _(t):
    return udaf_coverage(t.results, "loan_type", "calculated_ecl", "current_balance", "loan_id")


SCHEDULE = """SELECT loan_id, CAST(k AS INT) AS month, CAST(origination_date + to_months(CAST(k AS INT)) AS DATE) AS payment_date, monthly_payment AS scheduled_payment
  FROM {loans}, (SELECT unnest(range(12)) AS k) s"""


@query("payment_schedule", SCHEDULE)
def _(t):
    return payment_schedule(t.loans)


@query(
    "udtf_payment_schedule",
    f"SELECT month, count(*) AS n, sum(scheduled_payment) AS total, max(payment_date) AS last_date FROM ({SCHEDULE}) q GROUP BY month",
    money="total",
)
def _(t):
    loans = t.loans.select("loan_id", "origination_date", "monthly_payment", F.lit(12).alias("months"))
    rows = PaymentSchedule(loans.asTable())
    return rows.groupBy("month").agg(
        F.count("*").alias("n"), F.sum("scheduled_payment").alias("total"), F.max("payment_date").alias("last_date")
    )


@query("exposure_weighted_pd", "SELECT region, sum(calculated_pd*current_balance)/sum(current_balance) AS weighted_pd FROM {results} GROUP BY region", ratio="weighted_pd")
def _(t):
    return t.results.groupBy("region").agg(
        P.exposure_weight(F.col("calculated_pd"), F.col("current_balance")).alias("weighted_pd")
    )
