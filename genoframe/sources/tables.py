"""Parquet tables, and tables written for reuse in the shared folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; in local mode one of our own where that is unset, on a cluster an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="genoframe-")
        spark.conf.set("spark.checkpoint.dir", root)
        atexit.register(shutil.rmtree, root.removeprefix("file://"), True)
    return root.rstrip("/")


def scratch(spark: SparkSession, what: str) -> str:
    """A new path below the shared folder, deleted when the session's process ends."""
    path = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"
    atexit.register(_forget, spark, path)
    return path


def _forget(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # the JVM may be gone already
        if path.startswith("file:"):
            shutil.rmtree("/" + path.removeprefix("file:").lstrip("/"), ignore_errors=True)


_PATHS: dict[int, tuple[DataFrame, str]] = {}


def settled(df: DataFrame, what: str = "table") -> DataFrame:
    """Written as Parquet in the shared folder and read again: the lineage ends here and survives lost executors."""
    path = scratch(df.sparkSession, what)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[id(out)] = (out, path)
    return out


def release(*frames: DataFrame) -> None:
    """Deletes the files of ``settled`` tables that no later plan reads."""
    for df in frames:
        _, path = _PATHS.pop(id(df))
        _forget(df.sparkSession, path)
