"""Session settings that the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC: dates come from timestamps. Adaptive execution splits skewed joins and rebalanced partitions and turns small sides into
# broadcasts by their measured size; none of these depends on the scale. A shown plan has its filters whole: at Spark's 100 letters
# they are cut once a long session's column numbers have six digits.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.maxMetadataStringLength": "1000",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark
