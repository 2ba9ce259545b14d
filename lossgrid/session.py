"""Session settings every plan here relies on."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: HotSpot leaves methods above 8000 bytes interpreted; past this size Spark had
#: better use its per-operator generated code, which the JIT does compile.
JIT_METHOD_BYTES = "8000"


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Date arithmetic in one zone; no generated method the JIT would refuse."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", JIT_METHOD_BYTES)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Gives the Python workers of this application the package, wherever the driver was started."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parent
        handle, archive = tempfile.mkstemp(prefix="lossgrid-", suffix=".zip")
        with os.fdopen(handle, "wb") as target, zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as made:
            for source in sorted(root.rglob("*.py")):
                made.write(source, source.relative_to(root.parent))
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)
    return spark
