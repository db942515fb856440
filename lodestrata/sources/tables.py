"""Table scans and sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Batch scan of one of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """The same table as a file stream; each file is taken once, ``max_files`` per micro-batch."""
    reader = spark.readStream.schema(load(spark, sf_dir, name).schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{sf_dir}/{name}.parquet*")


def save_table(
    df: DataFrame, name: str, comment: str = "", properties: dict[str, str] | None = None
) -> None:
    """Append to a managed table; on creation set its comment and properties (such as quality)."""
    fresh = not df.sparkSession.catalog.tableExists(name)
    df.write.mode("append").format("parquet").saveAsTable(name)
    if fresh:
        _describe(df.sparkSession, name, comment, properties)


def publish_table(
    spark: SparkSession, name: str, path: str, comment: str = "", properties: dict[str, str] | None = None
) -> None:
    """Make a folder that a stream writes known as a table; new rows show after a refresh."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet", schema=spark.read.parquet(path).schema)
        _describe(spark, name, comment, properties)
    spark.catalog.refreshTable(name)


def _describe(spark: SparkSession, name: str, comment: str, properties: dict[str, str] | None) -> None:
    wanted = {**(properties or {}), **({"comment": comment} if comment else {})}
    if wanted:
        pairs = ", ".join(f"'{k}' = '{v}'" for k, v in wanted.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def append_rows(df: DataFrame, path: str) -> None:
    """Append to a parquet folder; the sink of run metrics and other logs."""
    df.write.mode("append").parquet(path)


def write_state(df: DataFrame, root: str) -> None:
    """Write ``df`` as the next full state of a small table such as the alias registry.

    States lie side by side as ``<root>/state=<n>``, so ``df`` may be derived from the last one.
    """
    last = _last_state(df.sparkSession, root)
    df.write.mode("overwrite").parquet(f"{root}/state={0 if last is None else last + 1}")


def read_state(spark: SparkSession, root: str, schema: str | None = None) -> DataFrame:
    """The latest state written by :func:`write_state`; before the first one an empty table of ``schema``."""
    last = _last_state(spark, root)
    if last is None and schema is not None:
        return spark.createDataFrame([], schema)
    return spark.read.parquet(f"{root}/state={last}")


def _last_state(spark: SparkSession, root: str) -> int | None:
    try:
        return spark.read.parquet(root).agg(F.max("state")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
