"""Session settings for tests and the bench (the library itself never creates a session)."""

from __future__ import annotations

import gc
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at any scale: AQE re-plans joins from real sizes (a shuffle side that turns
# out small becomes a broadcast), coalesces small shuffle partitions and splits skewed ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "tonalert", shared: str | None = None) -> SparkSession:
    """A local session; ``shared``: folder for intermediate tables (``spark.checkpoint.dir``)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("TONALERT_DRIVER_MEMORY", "16g"))
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir`` of the session or its context, else
    a folder inside the warehouse, which every executor reaches as well. Nothing is set on the
    caller's session."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/tonalert-intermediate"


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back (a job runs now): cuts the
    lineage, so that a lost executor does not recompute the side from scratch."""
    path = scratch_path(df.sparkSession, "checkpoint")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Have the driver collect its garbage, so that executors delete the files of shuffles that nothing needs any more. Else
    they stay on their disks until the driver happens to collect, which a driver with little to do does late."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name inside the shared folder, for tables a job writes and reads back (never
    a machine-local temporary folder). ``remove_scratch`` deletes them."""
    return f"{shared_folder(spark).rstrip('/')}/tonalert-io/{name}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of the shared folder, once nothing that reads them is left
    (DataFrames read them lazily, so the operators cannot do it themselves)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark).rstrip('/')}/tonalert-io")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
