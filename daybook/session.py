"""The Spark session the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC keeps instants and dates free of the machine's own zone, ANSI makes a
# malformed value fail the job, and AQE splits skewed shuffle partitions. VARIANT
# columns are written with their common fields as Parquet columns of their own, so
# a step that needs two fields of a payload does not read the rest.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
}


def build_session(app: str = "daybook", **conf: str) -> SparkSession:
    """A session with the engine's settings; ``conf`` adds or overrides."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the engine's runtime settings on a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
