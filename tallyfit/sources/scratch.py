"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is made only where nothing is set and the session is local.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tallyfit-")
    context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call gets."""
    return f"{scratch_folder(spark)}/tallyfit-{name}-{uuid.uuid4().hex}"


def write_once(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Used before a result is read several times, so that the work behind it is done once
    and survives the loss of executors. ``compression`` is ``none`` where values are packed
    already; the session's codec is used if it is not given.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
