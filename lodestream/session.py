"""The session settings that the library's results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: UTC keeps time resolution independent of the host; dynamic overwrite replaces only the partitions that are written.
#: A table of many files is opened by this many tasks at most, not by one for each file.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
}


def configured(spark: SparkSession) -> SparkSession:
    """``spark`` with the library's settings; all of them may change at run time."""
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    return spark
