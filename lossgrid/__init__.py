"""lossgrid: expected-credit-loss analytics as Spark DataFrame operators.

Layout
------
``config``      business parameters (frozen dataclass) and fixed value tables
``functions``   ``Column`` builders: no DataFrame, no job, whole-stage codegen only
``operators``   ``DataFrame -> DataFrame`` transformations
``sources``     schemas, table readers, sinks
``streaming``   windowed monitoring, usable on batch and streaming frames
``plans``       composed pipelines and the query registry
"""

from lossgrid.config import EclConfig

__all__ = ["EclConfig"]
