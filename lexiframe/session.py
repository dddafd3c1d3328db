"""Session settings the jobs rely on; resources are left to spark-submit."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of an Arrow batch, if nothing else is set. A task holds several, in the JVM and in each of its Python workers.
BATCH_LIMIT = "8m"


def pin_batches(spark: SparkSession) -> None:
    """Spark's own limit lets texts leave in batches of 64 MB, whose copies of all tasks fill an executor; set a lower one."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, BATCH_LIMIT)


def session(name: str = "lexiframe", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
