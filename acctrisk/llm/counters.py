"""Large tables of counters of fixed size, filled by many tasks and added up by Spark."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Counters that travel together.
PIECE = 1 << 20
COLUMNS = "part int, piece int, counts binary"
# Groups of tasks whose counts are added up in each round.
ROUNDS = (4096, 64, 1)


def packed(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs, compressed; that width comes first."""
    largest = int(values.max(initial=0))
    width = next(x for x in (1, 2, 4, 8) if largest < 1 << 8 * x)
    return bytes([width]) + zlib.compress(values.astype(f"<u{width}").tobytes(), 1)


def unpacked(blob: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(memoryview(blob)[1:]), dtype=f"<u{blob[0]}")


def pieces(task: int, tables: list[np.ndarray]) -> Iterator[tuple[int, int, bytes]]:
    """A task's counts, of several tables in a row, as compressed rows of part, piece, counts."""
    waiting, size, piece = [], 0, 0
    for table in tables:
        at = 0
        while at < len(table):
            some = table[at:at + PIECE - size]
            waiting.append(some.astype(np.uint64))
            at, size = at + len(some), size + len(some)
            if size == PIECE:
                yield task, piece, packed(np.concatenate(waiting))
                waiting, size, piece = [], 0, piece + 1
    if size:
        yield task, piece, packed(np.concatenate(waiting))


def batch_of(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    part, piece, counts = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(piece, pa.int32()), pa.array(counts, pa.binary())],
        names=["part", "piece", "counts"])


def added_up(counted: DataFrame, size: int) -> np.ndarray:
    """The sums over all tasks.

    Added in as many rounds as the number of tasks needs, so that no group grows with it beyond
    the next round's fan-in. What reaches the driver are the `size` sums.
    """
    def add(table: pa.Table) -> pa.Table:
        if len(table) == 1:  # nothing to add, so the counts stay packed
            return table.select(["part", "piece", "counts"])
        total = None
        for blob in table["counts"]:
            values = unpacked(blob.as_py())
            if total is None:
                total = values.astype(np.uint64)
            else:
                total += values
        return pa.table({"part": table["part"][:1], "piece": table["piece"][:1],
                         "counts": pa.array([packed(total)], pa.binary())})

    tasks = counted.rdd.getNumPartitions()
    for parts in [x for x in ROUNDS if x == 1 or x < tasks]:
        counted = (
            counted.withColumn("part", F.pmod("part", F.lit(parts)).cast("int"))
            .groupBy("piece", "part").applyInArrow(add, COLUMNS)
        )
    out = np.zeros(size, dtype=np.int64)
    for row in counted.select("piece", "counts").toLocalIterator():
        values = unpacked(bytes(row.counts))
        out[row.piece * PIECE:row.piece * PIECE + len(values)] = values
    return out
