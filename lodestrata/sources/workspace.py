"""The shared folder for written intermediate tables, checkpoints and stream state."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    A local session without that setting uses a folder below its warehouse; on a cluster it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    return base.rstrip("/")


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; it is deleted when the driver's JVM ends."""
    path = f"{shared_folder(spark)}/lodestrata/{label}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, survives lost executors."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that :func:`materialise` wrote, once nothing reads them any more.

    The shuffle files of finished steps go as well: Spark deletes them when the driver's collector has
    seen that nothing refers to them, which on a large heap would come hours later.
    """
    spark = tables[0].sparkSession
    root = f"{shared_folder(spark)}/lodestrata/"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for df in tables for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if root.removeprefix("file://").removeprefix("file:") in folder:
            path.getFileSystem(conf).delete(path, True)
    gc.collect()
    jvm.System.gc()
