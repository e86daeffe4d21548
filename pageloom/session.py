"""Where jobs may put intermediate data, and how they cut long lineages."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder: on a
    cluster a machine-local folder is lost with its machine.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="pageloom-")
    sc.setCheckpointDir(made)
    return made


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, not yet existing folder below the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Give every core a part of a table that is stored in few files.

    Reading markup and text costs far more than reading the file, so a small
    file must not end up in one task. Tables with enough files are untouched.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder once and read it back. Unlike a
    checkpoint it is computed once and stays columnar, so that later steps read
    only the columns they use."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result is read back from the shared folder, so
    it survives the loss of executors and the plan stays short."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
