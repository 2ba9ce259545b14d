"""Where intermediate tables and checkpoints go.

The cluster names one shared folder in ``spark.checkpoint.dir``.  Only a local
session without that setting gets a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and scratch tables."""
    conf = spark.sparkContext.getConf()
    named = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="lossgrid-")
    return _local[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has used yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialised(df: DataFrame, name: str) -> DataFrame:
    """A copy in the shared folder, for narrow tables that several passes read."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def spread(df: DataFrame, key: str, name: str) -> DataFrame:
    """A copy in the shared folder with a file for every core, rows by hash of ``key`` and in its order: passes that compute
    for long use all cores, however few files the rows came from."""
    dealt = df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)
    return materialised(dealt.sortWithinPartitions(key), name)


def version_of(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of all files below a folder: the same as long as its tables are."""
    root = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, True)
    found = []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later readers see the same rows after executor loss."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
