"""Session factory."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Session defaults: adaptive planning with skew handling, Kryo and Snappy.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(
    app_name: str,
    *,
    master: str | None = None,
    default_fs: str | None = None,
    warehouse_dir: str | None = None,
    driver_memory: str | None = None,
    executor_memory: str | None = None,
    log_level: str = "WARN",
    **conf: object,
) -> SparkSession:
    """Build or get a session; extra keyword arguments are Spark settings.

    Setting names may be given as ``spark_sql_shuffle_partitions=8`` or, through
    ``**{...}``, in their dotted form.
    """
    settings = dict(DEFAULTS)
    named = {
        "spark.hadoop.fs.defaultFS": default_fs,
        "spark.sql.warehouse.dir": warehouse_dir,
        "spark.driver.memory": driver_memory,
        "spark.executor.memory": executor_memory,
    }
    settings.update({k: v for k, v in named.items() if v is not None})
    settings.update({k if "." in k else k.replace("_", "."): str(v) for k, v in conf.items()})

    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark
