"""Loan-domain tables derived from the star-schema parquet files.

The SQL below runs unchanged on Spark and on other SQL engines; ``{name}`` marks
a table reference.  ``Tables`` binds it to a session and a data directory and
builds each frame lazily, so a query only plans what it touches and Catalyst
prunes columns down to the parquet scans.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from lossgrid.session import apply_defaults

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

DERIVED: dict[str, str] = {}

DERIVED["loans"] = """
WITH b AS (SELECT o.*, c.c_acctbal, c.c_mktsegment, r.r_name,
  (o_orderkey*7919 + o_custkey*104729) % 551 AS ua, (o_orderkey*6007 + 13) % 551 AS ub, (o_orderkey*3571 + o_custkey*17) % 551 AS uc,
  (o_orderkey*6151 + o_custkey*31) % 1000 AS d, (o_orderkey*7) % 10 AS t
  FROM {orders} o JOIN {customer} c ON o.o_custkey=c.c_custkey JOIN {nation} n ON c.c_nationkey=n.n_nationkey JOIN {region} r ON n.n_regionkey=r.r_regionkey),
x AS (SELECT b.*, 18000 + (c_acctbal+1000)*10 AS customer_income,
  CASE WHEN t<4 THEN 'MORTGAGE' WHEN t<6 THEN 'AUTO' WHEN t=6 THEN 'PERSONAL' WHEN t=7 THEN 'CREDIT_CARD' WHEN t=8 THEN 'BUSINESS' ELSE 'LINE_OF_CREDIT' END AS loan_type,
  CAST(CASE WHEN t<4 THEN 180+60*(o_orderkey%4) WHEN t<6 THEN 36+12*(o_orderkey%5) WHEN t=6 THEN 12+12*(o_custkey%5) ELSE 24+12*(o_custkey%8) END AS INT) AS term_months,
  (200 + (o_orderkey*37) % 1800)/100.0E0 AS interest_rate,
  CAST(850 - floor(CAST(ua*ub*uc AS DOUBLE)/302500.0E0) AS INT) AS credit_score,
  CAST(CASE WHEN d<800 THEN 0 WHEN d<880 THEN 1+o_orderkey%29 WHEN d<950 THEN 30+o_orderkey%60 ELSE 90+o_orderkey%276 END AS INT) AS days_past_due,
  (5 + (o_orderkey*17 + o_custkey*3) % 45)/100.0E0 AS dti_ratio
  FROM b),
y AS (SELECT x.*, o_totalprice*((30+(o_orderkey*13)%71)/100.0E0) AS current_balance,
  CASE loan_type WHEN 'MORTGAGE' THEN o_totalprice*((105+o_orderkey%40)/100.0E0) WHEN 'AUTO' THEN o_totalprice*((100+o_orderkey%40)/100.0E0) WHEN 'BUSINESS' THEN o_totalprice*((104+o_orderkey%70)/100.0E0) ELSE 0.0E0 END AS collateral_value,
  o_totalprice/term_months + o_totalprice*(interest_rate/1200.0E0) AS monthly_payment FROM x)
SELECT 'L' || CASE WHEN o_orderkey < 1000000 THEN lpad(CAST(o_orderkey AS STRING),6,'0') ELSE CAST(o_orderkey AS STRING) END AS loan_id, 'C' || CASE WHEN o_custkey < 1000000 THEN lpad(CAST(o_custkey AS STRING),6,'0') ELSE CAST(o_custkey AS STRING) END AS customer_id,
  o_totalprice AS loan_amount, interest_rate, term_months, loan_type, CAST(o_orderdate AS DATE) AS origination_date,
  CAST(o_orderdate AS DATE) + CAST(term_months*30 AS INT) AS maturity_date, collateral_value,
  CASE WHEN collateral_value>0 THEN o_totalprice/collateral_value END AS ltv_ratio, monthly_payment, customer_income,
  credit_score, days_past_due, dti_ratio, current_balance, r_name AS region, c_mktsegment AS sector,
  CAST((o_orderkey*11)%301 AS INT) AS employment_length, CAST((o_orderkey*29)%217 - 108 AS INT) AS credit_score_change
FROM y
"""

DERIVED["staged"] = """
SELECT l.*, DATE '2001-12-31' AS calculation_date,
  CASE WHEN days_past_due>=90 THEN 'STAGE_3' WHEN days_past_due>=30 THEN 'STAGE_2'
       WHEN credit_score<500 OR ltv_ratio>0.95E0 THEN 'STAGE_2'
       WHEN credit_score_change < -100 OR ltv_ratio>0.95E0 OR dti_ratio>0.45E0 THEN 'STAGE_2'
       WHEN credit_score<=650 THEN 'STAGE_2' ELSE 'STAGE_1' END AS stage
FROM {loans} l
"""

DERIVED["customers"] = """
SELECT 'C' || CASE WHEN c_custkey < 1000000 THEN lpad(CAST(c_custkey AS STRING),6,'0') ELSE CAST(c_custkey AS STRING) END AS customer_id, c_mktsegment AS segment, r_name AS region,
  18000 + (c_acctbal+1000)*10 AS annual_income,
  CASE c_custkey%4 WHEN 0 THEN 'EMPLOYED' WHEN 1 THEN 'SELF_EMPLOYED' WHEN 2 THEN 'RETIRED' ELSE 'UNEMPLOYED' END AS employment_status
FROM {customer} c JOIN {nation} n ON c.c_nationkey=n.n_nationkey JOIN {region} r ON n.n_regionkey=r.r_regionkey
"""

DERIVED["payments"] = """
SELECT 'L' || CASE WHEN l_orderkey < 1000000 THEN lpad(CAST(l_orderkey AS STRING),6,'0') ELSE CAST(l_orderkey AS STRING) END AS loan_id, l_linenumber AS line_no, l_partkey, l_suppkey,
  CAST(l_shipdate AS DATE) AS payment_date, l_extendedprice AS scheduled_payment,
  CASE WHEN (l_partkey*l_suppkey)%997=3 THEN l_extendedprice*2.5E0 WHEN (l_partkey+l_suppkey)%499=7 THEN 0.0E0
       WHEN (l_partkey*13+l_suppkey)%20=0 THEN 0.0E0 WHEN (l_partkey*13+l_suppkey)%20<3 THEN l_extendedprice*0.5E0
       ELSE l_extendedprice END AS actual_payment,
  CASE WHEN (l_partkey*13+l_suppkey)%20=0 THEN 'MISSED' WHEN (l_partkey*13+l_suppkey)%20<3 THEN 'PARTIAL' ELSE 'PAID' END AS payment_status,
  CAST(CASE WHEN (l_partkey*13+l_suppkey)%20=0 THEN 1+l_partkey%30 WHEN (l_partkey*13+l_suppkey)%20<3 THEN l_partkey%10 ELSE 0 END AS INT) AS days_late
FROM {lineitem}
"""

DERIVED["macro"] = """
WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS date FROM {orders}),
i AS (SELECT date, CAST(year(date)*12 + month(date) - 23941 AS INT) AS idx FROM m)
SELECT date, ((idx*37)%75 - 30)/10.0E0 AS gdp_growth, (40 + (idx*53)%110)/10.0E0 AS unemployment_rate,
  (5 + (idx*29)%45)/10.0E0 AS inflation_rate, ((idx*31)%70)/10.0E0 AS interest_rate,
  CASE WHEN idx%58<25 THEN 'expansion' WHEN idx%58<32 THEN 'peak' WHEN idx%58<51 THEN 'contraction' ELSE 'trough' END AS economic_cycle
FROM i
"""

DERIVED["transitions"] = """
SELECT loan_id, DATE '2001-12-31' - CAST(30*k AS INT) AS transition_date,
  CAST(CASE WHEN stage='STAGE_3' THEN CASE WHEN (id+k*7)%10<1 THEN 1 WHEN (id+k*7)%10<5 THEN 2 ELSE 3 END
            WHEN stage='STAGE_2' THEN CASE WHEN (id+k*7)%10<3 THEN 1 ELSE 2 END
            ELSE CASE WHEN (id+k)%97=1 THEN 3 ELSE 1 END END AS INT) AS from_stage,
  CAST(substr(stage,7,1) AS INT) AS to_stage
FROM (SELECT loan_id, stage, CAST(substr(loan_id,2) AS BIGINT) AS id FROM {staged}) s
CROSS JOIN (VALUES (0),(1),(2),(3),(4),(5),(6),(7),(8),(9),(10),(11)) AS o(k)
WHERE id%15=0
"""

DERIVED["predictions"] = """
SELECT loan_id, DATE '2001-12-31' AS prediction_date, 'rf' AS model_name, 'v1' AS model_version,
  CASE WHEN id%7=0 THEN 'fs0' ELSE 'fs1' END AS feature_set_version, stage AS original_stage,
  CASE WHEN id%20=0 THEN CASE stage WHEN 'STAGE_1' THEN 'STAGE_2' WHEN 'STAGE_2' THEN 'STAGE_3' ELSE 'STAGE_2' END ELSE stage END AS predicted_stage,
  (50 + (id*17)%50)/100.0E0 AS confidence,
  ((id*23)%1000)/1000.0E0 AS probability_default
FROM (SELECT loan_id, stage, CAST(substr(loan_id,2) AS BIGINT) AS id FROM {staged}) s
"""

DERIVED["features"] = """
SELECT loan_id, 'fs1' AS feature_set_version, credit_score AS behaviour_score,
  current_balance/loan_amount AS utilisation_rate, days_past_due AS delinquency_days
FROM {loans} WHERE CAST(substr(loan_id,2) AS BIGINT)%11<>0
"""

DERIVED["telemetry"] = """
SELECT event_id, ts, 'agent_' || CAST(user_id%6 AS STRING) AS agent, event_type AS task_id,
  CASE WHEN event_type='error' THEN 'failed' ELSE 'success' END AS status,
  CASE WHEN event_type='error' THEN CASE WHEN event_id%3=0 THEN 'critical' ELSE 'warning' END ELSE 'info' END AS severity,
  value AS duration_seconds, CAST(regexp_extract(props,'[0-9]+',0) AS INT) AS records_processed
FROM {events}
"""

DERIVED["loans_dirty"] = """
SELECT CASE WHEN id%101=1 THEN 'INVALID_ID' ELSE loan_id END AS loan_id, customer_id,
  CASE WHEN id%103=2 THEN -loan_amount ELSE loan_amount END AS loan_amount, interest_rate, term_months,
  CASE WHEN id%107=3 THEN 'INVALID_TYPE' ELSE loan_type END AS loan_type,
  CAST(CASE WHEN id%109=4 THEN 1000 WHEN id%113=5 THEN NULL ELSE credit_score END AS INT) AS credit_score,
  CAST(CASE WHEN id%127=6 THEN -5 ELSE days_past_due END AS INT) AS days_past_due,
  CASE WHEN id%131=7 THEN loan_amount*1.1E0 ELSE current_balance END AS current_balance,
  CASE WHEN id%137=8 THEN 'INVALID_STAGE' WHEN id%139=9 THEN 'STAGE_3' ELSE stage END AS provision_stage
FROM (SELECT s.*, CAST(substr(loan_id,2) AS BIGINT) AS id FROM {staged} s) q
UNION ALL
SELECT loan_id, customer_id, loan_amount, interest_rate, term_months, loan_type, credit_score, days_past_due, current_balance, stage
FROM {staged} WHERE CAST(substr(loan_id,2) AS BIGINT)%211=10
"""

# Spark-side text of tables whose portable SQL would need a cross join
SPARK_TEXT = {
    "transitions": DERIVED["transitions"].replace(
        "FROM (SELECT loan_id, stage, CAST(substr(loan_id,2) AS BIGINT) AS id FROM {staged}) s\n"
        "CROSS JOIN (VALUES (0),(1),(2),(3),(4),(5),(6),(7),(8),(9),(10),(11)) AS o(k)\n",
        "FROM (SELECT loan_id, stage, id, explode(sequence(0, 11)) AS k FROM "
        "(SELECT loan_id, stage, CAST(substr(loan_id,2) AS BIGINT) AS id FROM {staged}))\n",
    )
}

_REF = re.compile(r"\{([a-z]\w*)\}")


def references(sql: str) -> list[str]:
    """Table names a template refers to, in order of appearance."""
    return list(dict.fromkeys(_REF.findall(sql)))


_HANDLES: dict[tuple, Tables] = {}


class Tables:
    """Lazy access to base and derived tables of one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = str(sf_dir).rstrip("/")
        self._frames: dict[str, DataFrame] = {}
        apply_defaults(spark)

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Tables:
        """The session's handle for a directory: plans are analysed once and shared, data is never held."""
        key = (id(spark), spark.sparkContext.applicationId, str(sf_dir))
        if key not in _HANDLES:
            _HANDLES[key] = cls(spark, sf_dir)
        apply_defaults(spark)
        return _HANDLES[key]

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def get(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in DERIVED:
                sql = SPARK_TEXT.get(name, DERIVED[name])
                self._frames[name] = self.spark.sql(sql, **{r: self.get(r) for r in references(sql)})
            elif name in BASE_TABLES:
                self._frames[name] = self.base(name)
            else:
                raise KeyError(f"unknown table {name}")
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        try:
            return self.get(name)
        except KeyError as exc:
            raise AttributeError(name) from exc

    @cached_property
    def results(self) -> DataFrame:
        """Fully processed portfolio."""
        from lossgrid.plans.provisioning import process_portfolio

        return process_portfolio(self.loans)
