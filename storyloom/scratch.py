"""Intermediate tables in the folder that driver and executors share.

A written table cuts the lineage and survives the loss of executors, which a cache does not.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; one of our own only where that is unset in a local run."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="spark-storyloom-")
    return _own[app]


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None, **options: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.options(**{"compression": "zstd", **options})
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.storyloom_path = path
    return back


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over several tasks a core, for steps that take long over few bytes: Spark joins small parts to one task by their bytes."""
    session = df.sparkSession
    parts = max(int(session.conf.get("spark.sql.shuffle.partitions")), 4 * session.sparkContext.defaultParallelism)
    return df.repartition(parts, *keys)


def dropped(*tables: DataFrame) -> None:
    """Delete tables made by :func:`stored` which nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.storyloom_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
