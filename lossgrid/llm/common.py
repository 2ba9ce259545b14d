"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lossgrid.session import ship_package
from lossgrid.sources.scratch import fresh_path

#: White space between words and around lines, wherever a contract names ``[\x20\x09-\x0D]``.
SPACES = " \t\n\x0b\x0c\r"

#: Words and lines split on runs of it (Java regular expression).
SPACE_RUN = r"[\x20\x09-\x0D]+"


#: Rows handed to a Python worker at a time: whole texts are long, and several workers share an executor's memory.
BATCH_ROWS = "1000"


def prepare(spark: SparkSession) -> SparkSession:
    """Workers that know the package and get their rows in small batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return ship_package(spark)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{table}.parquet")


def free_names(df: DataFrame, *names: str) -> tuple[str, ...]:
    """The names, each with underscores in front until ``df`` has no such column in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return tuple(out)


def col(name: str) -> Column:
    """Column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def written(df: DataFrame, name: str) -> DataFrame:
    """A copy written to the shared scratch folder, for tables that several jobs read."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    copy = df.sparkSession.read.parquet(path)
    copy.scratch_path = path
    return copy


def discard(*copies: DataFrame) -> None:
    """Deletes tables of ``written`` that nothing reads any more: whatever was made of them is itself written."""
    for copy in copies:
        spark = copy.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(copy.scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
