"""Tables of one round of a loop, written to the folder that the cluster shares.

A written table cuts lineage like ``checkpoint()``, and its size is known to the planner, while a
checkpoint keeps the estimate of the plan before it, which every join multiplies.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

_folders: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir where the cluster names it, else our own, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        named = "/tmp/checkpoints"
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def kept(df: DataFrame) -> DataFrame:
    """df, written and read again. The files go when the driver ends, as results are lazy and may still read them."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/round-{uuid.uuid4().hex[:12]}"
    _folders[path] = spark
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


@atexit.register
def _clean() -> None:
    for path, spark in list(_folders.items()):
        try:
            delete(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone
            pass
    _folders.clear()
