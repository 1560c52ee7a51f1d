"""Session helpers: where intermediate tables go, how to write one, how to drop it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_scratch: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session,
    where that setting is absent, gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_scratch.setdefault(
        context.applicationId, tempfile.mkdtemp(prefix="feedmill-")
    )


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several actions need the same rows. The files outlive a lost
    executor, and the lineage ends here.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged._staged_path = path
    return staged


def drop_staged(*frames: DataFrame) -> None:
    """Delete the files of tables that ``stage`` returned and nothing reads any more."""
    for df in frames:
        drop_path(df.sparkSession, df._staged_path)


def drop_path(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
