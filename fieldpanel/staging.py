"""Written intermediate tables.

A result that several later passes read is written once, as Parquet, below the
shared folder named by ``spark.checkpoint.dir``. Reading it back cuts the
lineage, survives lost executors, keeps column pruning, and gives Catalyst true
file sizes to choose join strategies from. A scan of written files also yields
its rows in a fixed order per task, so row ids derived from it are repeatable.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def staging_root(spark: SparkSession) -> str:
    """The application's folder for intermediate tables."""
    app = spark.sparkContext.applicationId
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return f"{configured.rstrip('/')}/fieldpanel-{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="fieldpanel-")
    return _local_roots[app]


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one intermediate table."""
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` and return a scan of what was written."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Plans that a second reading repeats at the cost of a scan.
_CHEAP = {"LogicalRelation", "LocalRelation", "Project", "Filter", "Range", "LocalLimit"}


def reread(df: DataFrame) -> DataFrame:
    """``df`` for several readings: itself if it only scans a table, else a written copy."""
    plans = [df._jdf.queryExecution().optimizedPlan()]
    while plans:
        plan = plans.pop()
        if plan.nodeName() not in _CHEAP:
            return stage(df, "reread")
        children = plan.children()
        plans += [children.apply(i) for i in range(children.size())]
    return df


def clear_staged(spark: SparkSession) -> bool:
    """Delete every intermediate table this application wrote."""
    root = spark._jvm.org.apache.hadoop.fs.Path(staging_root(spark))
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.delete(root, True)
