"""User-function surface: vectorised scoring, a two-level aggregate and a table function."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def udf_score(predict: Callable[[pd.DataFrame], pd.Series], features: Sequence[str]) -> Column:
    """Arrow-batched score of a caller-supplied model over the feature columns."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(predict(batch)).astype(float)

    return score(F.struct(*features))


SALTS = 64


def udaf_coverage(df: DataFrame, key: str, ecl: str, balance: str, salt_from: str) -> DataFrame:
    """Coverage ratio by a pandas aggregate.

    A pandas aggregate sees its whole group in one task, so rows are first summed
    per (key, salt): the Python side receives at most :data:`SALTS` rows per key.
    """

    @F.pandas_udf("double")
    def ratio(part_ecl: pd.Series, part_balance: pd.Series) -> float:
        total = part_balance.sum()
        return float(part_ecl.sum() / total) if total else float("nan")

    salted = df.groupBy(key, F.pmod(F.xxhash64(salt_from), F.lit(SALTS)).alias("_salt")).agg(
        F.sum(ecl).alias("_e"), F.sum(balance).alias("_b")
    )
    return salted.groupBy(key).agg(ratio("_e", "_b").alias("coverage"))


def payment_schedule(loans: DataFrame, months: int = 12) -> DataFrame:
    """First instalments of every loan, one row each, as a generated sequence."""
    return loans.select(
        "loan_id", "monthly_payment", "origination_date", F.explode(F.sequence(F.lit(0), F.lit(months - 1))).alias("month")
    ).select(
        "loan_id",
        "month",
        F.add_months("origination_date", F.col("month")).alias("payment_date"),
        F.col("monthly_payment").alias("scheduled_payment"),
    )


@F.arrow_udtf(returnType="loan_id string, month int, payment_date date, scheduled_payment double")
class PaymentSchedule:
    """Table function twin of :func:`payment_schedule` over a table of (loan_id, origination_date, monthly_payment, months).

    A batch of loans at a time: days are clipped to the end of shorter months, a loan without a date has null dates.
    """

    def eval(self, batch: pa.RecordBatch):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        loan, start, payment, months = (batch.column(k) for k in range(4))
        times = pc.fill_null(months, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(times)), times)
        month = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
        day = start.to_numpy(zero_copy_only=False).astype("datetime64[D]")[row]
        begins = day.astype("datetime64[M]")
        due = (begins + month).astype("datetime64[D]") + (day - begins.astype("datetime64[D]"))
        last = (begins + month + 1).astype("datetime64[D]") - np.timedelta64(1, "D")
        at = pa.array(row)
        yield pa.table(
            {
                "loan_id": loan.take(at),
                "month": pa.array(month, pa.int32()),
                "payment_date": pa.array(np.minimum(due, last), pa.date32(), from_pandas=True),
                "scheduled_payment": payment.take(at),
            }
        )
