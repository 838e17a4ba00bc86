"""The folder that executors share, and cutting lineage through it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """This application's folder below spark.checkpoint.dir.

    Where the session names none, a local session (one process) gets a temporary folder; a cluster has to name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/{spark.conf.get('spark.app.id', 'app')}"


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it again, so that loops keep a short plan and survive lost executors."""
    path = f"{shared_dir(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Remove all that this application has cut. What was returned lazily from it must have been written or collected."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
