"""Session settings and the shared folder that written intermediates live in."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(app: str, cores: int | str = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_fallback_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a session that runs on one machine may fall back to a local folder: on
    a cluster the executors would each write to their own disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _fallback_dirs:
        _fallback_dirs[app] = tempfile.mkdtemp(prefix="civicloom-")
    return _fallback_dirs[app]


def _stage_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{_stage_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def clear_stage(spark: SparkSession) -> None:
    """Delete what this application staged, once nothing reads it any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_stage_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and return the table read back.

    Used where one frame feeds several branches or jobs. The read is columnar, so
    each branch still prunes columns and pushes filters down, its size is known to
    the optimizer, and a lost executor re-reads files instead of re-running the
    lineage above them.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
