"""Session set-up and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on; everything else is left to the cluster.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(threads: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{threads}]")
        .appName("basketlens")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", conf.pop("driver_memory", "12g"))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = apply_settings(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one process, gets a
    temporary folder of its own when the setting is missing.
    """
    context = spark.sparkContext
    root = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="basketlens-")
    context.setCheckpointDir(root)
    return (context.getCheckpointDir() or root).rstrip("/")


def working_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage with a written table, so values that depend on where a row
    happened to be placed stay as they are when a task is run again.
    """
    path = working_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    """Hadoop file system and path object of a folder, wherever it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it is not there."""
    files, target = _file_system(spark, path)
    if not files.exists(target):
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(target) if entry.isDirectory())


def remove_folder(spark: SparkSession, path: str) -> None:
    files, target = _file_system(spark, path)
    files.delete(target, True)
