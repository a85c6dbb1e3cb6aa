"""Materialising a relation that several later jobs or passes read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[tempfile.TemporaryDirectory] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it in spark.checkpoint.dir.

    A session whose one process is its only executor may go without one, as in tests; it gets one
    temporary folder, which goes when the process ends. Any other session has to name a folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own:
        _own.append(tempfile.TemporaryDirectory(prefix="acctrisk-", ignore_cleanup_errors=True))
    return _own[0].name


def materialise(df: DataFrame) -> DataFrame:
    """Compute a relation once, write it to the shared folder and go on from the written table.

    The table outlives the executors that wrote it. (A checkpoint would compute it twice: once
    for the action that triggers it and once to write.)
    """
    path = f"{shared_folder(df.sparkSession)}/materialised-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
