"""Session helpers: the shared folder that all executors see, and lineage cuts that survive a lost executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where the setting is absent, a session on one machine (a test) takes a new
    temporary folder and sets it, so that ``checkpoint()`` works there too; on a cluster that is an error."""
    set_dir = spark.conf.get("spark.checkpoint.dir", None)
    if set_dir:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(set_dir)
        return set_dir
    got = spark.sparkContext.getCheckpointDir()
    if got is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="quadra-"))
        got = spark.sparkContext.getCheckpointDir()
    return got


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Run ``df`` once and go on from its checkpoint: later reads neither recompute it nor depend on one executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Like :func:`cut`, but as a Parquet table: compressed, and read with column pruning."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table of ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
