"""Session settings that suit wide text-and-metric rows."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Eleven metrics make one generated method larger than the JVM compiles, and
#: an uncompiled one runs several times slower.  With this limit, which is the
#: JVM's own, Spark splits such a stage by operator instead.
RECOMMENDED = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def apply_recommended(spark: SparkSession) -> SparkSession:
    """Set the runtime settings on a session."""
    for name, value in RECOMMENDED.items():
        spark.conf.set(name, value)
    return spark
