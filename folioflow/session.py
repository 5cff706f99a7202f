"""Session defaults, table access and lineage cuts shared by every module."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "folioflow", master: str | None = None, shuffle_partitions: int | None = None, **more: str) -> SparkSession:
    """A session with adaptive execution and UTC; cluster settings are left to the cluster. ``more`` are settings with double underscores for dots."""
    builder = SparkSession.builder.appName(app_name).config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true").config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in more.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One Parquet table of a data directory (a file or a folder of part files)."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts: the session's ``spark.checkpoint.dir``; a temporary folder only where it is unset and the master is local."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="folioflow-checkpoints-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return folder


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` as a table written to the shared checkpoint folder, so that a lost executor costs a read and not a recomputation.

    The table is columnar and compressed, and readers take only the columns and rows they need. ``release`` deletes it when nothing
    reads it any more; what is left goes when the driver's JVM ends.
    """
    spark = df.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/folioflow-{uuid.uuid4().hex}"
    files, path = _file_system(spark, folder)
    files.deleteOnExit(path)
    df.write.option("compression", "zstd").parquet(folder)
    made = spark.read.schema(df.schema).parquet(folder)
    made._cut_folder = folder
    return made


def release(*frames: DataFrame | None) -> None:
    """Deletes the tables of frames that ``cut_lineage`` made; no frame that reads them may be used afterwards."""
    for df in frames:
        folder = getattr(df, "_cut_folder", None)
        if folder:
            files, path = _file_system(df.sparkSession, folder)
            files.delete(path, True)
            files.cancelDeleteOnExit(path)
