"""Where intermediate tables go."""

from __future__ import annotations

import atexit
import shutil
import uuid

from pyspark.sql import DataFrame, SparkSession

#: For sessions of one machine without ``spark.checkpoint.dir``, as in tests.
LOCAL_FOLDER = "/tmp/checkpoints"


def shared_folder(spark: SparkSession) -> str:
    """The folder of this application below ``spark.checkpoint.dir``.

    A local session without that setting (tests) gets a folder of its own,
    removed at exit; a cluster without it is refused, because its executors
    share no other folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    own = f"postrank/{spark.sparkContext.applicationId}"
    if base:
        return f"{base.rstrip('/')}/{own}"
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    atexit.register(shutil.rmtree, f"{LOCAL_FOLDER}/{own}", ignore_errors=True)
    return f"{LOCAL_FOLDER}/{own}"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name every executor can reach; ``clear`` removes them all."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(table: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """The table stored in a scratch folder and read again: it cuts the lineage
    and fixes values that would differ when computed twice."""
    spark = table.sparkSession
    path = scratch_dir(spark, label)
    table.write.option("compression", compression).parquet(path)
    # The shuffles behind the table are of no use any more, but their files stay
    # until the driver's JVM collects its garbage, which may be hours.
    spark.sparkContext._jvm.System.gc()
    stored = spark.read.schema(table.schema).parquet(path)
    stored.stored_at = path
    return stored


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, on any store."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def free(*tables: DataFrame) -> None:
    """Delete tables that ``written`` stored, once everything made of them is stored.

    Other tables are left alone.
    """
    for table in tables:
        at = table.__dict__.pop("stored_at", None)
        if at:
            remove(table.sparkSession, at)


def publish(spark: SparkSession, made: str, path: str) -> None:
    """Let a finished folder take the place of the one at ``path``, by renaming.

    Both must be on one file system. The old folder goes last.
    """
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    new, target, old = place(made), place(path), place(f"{path}.old-{uuid.uuid4().hex}")
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(new):
        raise FileNotFoundError(made)
    replaced = store.exists(target)
    if replaced and not store.rename(target, old):
        raise OSError(f"cannot move {path} away")
    if not store.rename(new, target):
        if replaced:
            store.rename(old, target)
        raise OSError(f"cannot move {made} to {path}")
    if replaced:
        store.delete(old, True)


def clear(spark: SparkSession) -> None:
    """Delete every scratch folder of this application, once results are stored."""
    remove(spark, shared_folder(spark))
