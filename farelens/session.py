"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

def build_session(
    app_name: str = "farelens",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    broadcast_bytes: int = 64 * 1024 * 1024,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create a session with the settings every job here relies on.

    No join carries a broadcast hint: Catalyst compares each side's measured size with
    ``broadcast_bytes`` and falls back to a shuffle join, which AQE splits where keys are hot.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", str(broadcast_bytes))
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``.

    Only a local master, where one machine is the whole cluster, may do without; it uses the warehouse.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"


def _staging(spark: SparkSession, folder: str | None = None) -> str:
    return f"{folder or shared_folder(spark)}/farelens/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A path in the shared folder that nothing has written to yet."""
    return f"{_staging(spark, folder)}/{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table; call it once its readers are done."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def drop_staged(spark: SparkSession, folder: str | None = None) -> None:
    """Delete every staged table of this application; call it once their readers are done."""
    drop_path(spark, _staging(spark, folder))


def stage(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder (or another that all executors reach) and read it back.

    Cuts the lineage, survives lost executors, and gives Catalyst the table's true size, so a
    later join broadcasts it only when it really is small.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name, folder)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
