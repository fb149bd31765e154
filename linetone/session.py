"""Session helpers: where intermediate tables go."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def workspace(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder, which
    goes when the process ends.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    own = tempfile.mkdtemp(prefix="linetone-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    context.setCheckpointDir(own)
    return context.getCheckpointDir()


def run_folder(spark: SparkSession) -> str:
    """This application's own folder in the workspace."""
    return f"{workspace(spark)}/linetone/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the application's folder that nothing else uses."""
    return f"{run_folder(spark)}/{uuid.uuid4().hex}/{name}"


def _file_system(spark: SparkSession, path: str):
    """A path as Hadoop knows it, and the file system it is on."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(context._jsc.hadoopConfiguration())


def complete_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders in ``path`` that a finished write left; none if ``path`` is not there."""
    folder, files = _file_system(spark, path)
    if not files.exists(folder):
        return []
    inside = (status.getPath() for status in files.listStatus(folder) if status.isDirectory())
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return [p.toString() for p in inside if files.exists(done(p, "_SUCCESS"))]


def delete_folder(spark: SparkSession, path: str) -> None:
    folder, files = _file_system(spark, path)
    files.delete(folder, True)


def discard_run(spark: SparkSession) -> None:
    """Delete the application's folder, once nothing reads its tables any more."""
    delete_folder(spark, run_folder(spark))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the workspace and read it back.

    Cuts the lineage where several jobs start from the same rows. A lost executor
    then costs a re-read and not the whole plan, and later jobs read only the
    columns they use, which a checkpoint of rows would not allow.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
