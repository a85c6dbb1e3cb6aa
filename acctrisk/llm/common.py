"""Helpers that several operators of this package share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctrisk.functions.lineage import shared_folder

# Bytes of text that a task function works on at once; bounds the memory of a Python worker.
SLICE_BYTES = 1 << 22

# Rows of an Arrow batch, and bytes of a row group, while a table of texts is written: both are
# held in memory once per task.
BATCH_ROWS = 1024
ROW_GROUP = 1 << 24


def materialise(df: DataFrame) -> DataFrame:
    """Compute a relation once, write it to the shared folder and go on from the written table.

    The table outlives the executors that wrote it. The session's batch size is put back after.
    """
    spark, size = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    path = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    before = spark.conf.get(size)
    spark.conf.set(size, str(BATCH_ROWS))
    try:
        df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    finally:
        spark.conf.set(size, before)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds))


def held_out(doc_id: str, folds: int, remainder: int) -> Column:
    """Whether a row is kept from learning; a null id is in no fold and never learnt from."""
    return F.coalesce(fold(doc_id, folds) == remainder, F.lit(False))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts of Arrow batches with about `limit` bytes in the given column, and one row at least."""
    for batch in batches:
        values = batch.column(column)
        if isinstance(values, pa.ChunkedArray):
            values = values.combine_chunks()
        sizes = values.cast(pa.large_binary()).fill_null(b"")
        ends = np.frombuffer(sizes.buffers()[1], dtype=np.int64)[
            sizes.offset:sizes.offset + len(sizes) + 1]
        at = 0
        while at < len(batch):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def salted_join(large: DataFrame, small: DataFrame, keys: list[str], spread: str,
                salts: int = 32, how: str = "left") -> DataFrame:
    """Equi-join in which the rows of one key go to `salts` partitions instead of one.

    Rows of the large side are dealt by the hash of the column `spread`, which should vary within
    a key; each row of the small side, with few rows per key, is repeated per salt. Null keys meet
    nothing.
    """
    salt = F.pmod(F.xxhash64(F.col(spread)), F.lit(salts)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return (
        large.withColumn("_salt", salt)
        .join(small.withColumn("_salt", every), [*keys, "_salt"], how).drop("_salt")
    )
