"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # applicants are far more than the 65,536 groups the first-level map of an aggregate holds
    "spark.sql.codegen.aggregate.map.twolevel.enabled": "false",
    # no call-site capture per column expression; it costs milliseconds each
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(app: str = "riskloom", master: str | None = None, **conf) -> SparkSession:
    """Build or get a session; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the session's ``spark.checkpoint.dir``, else a folder of its warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"


def staged_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and return a scan of it.

    Several passes over the result then cost a column-pruned scan each instead of
    the whole upstream plan, and a lost executor loses no work.
    """
    path = staged_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(spark: SparkSession, path: str) -> None:
    """Delete a staged table that nothing reads any more."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)
