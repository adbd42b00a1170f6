"""The session the jobs run in."""

from __future__ import annotations

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Used where neither the cluster nor spark-submit says otherwise.  Lookup tables
# are stored before they are joined, so Spark's own broadcast threshold meets real
# sizes; it is left as it is, since a map takes several times its stored bytes.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def open_session(app_name: str) -> SparkSession:
    """The active session as it is, or a new one."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    conf = SparkConf()
    for name, value in _SETTINGS.items():
        conf.setIfMissing(name, value)
    return SparkSession.builder.appName(app_name).config(conf=conf).getOrCreate()
