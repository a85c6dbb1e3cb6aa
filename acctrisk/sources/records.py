"""Text files read in many tasks although their records span lines.

Spark cuts large text files at line ends wherever a task's share ends. A record that lies across
such a cut comes as fragments, which are put together afterwards; all other records never leave
the task that reads them. Nothing here opens a file itself, so any store that Spark reads will do.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The functions travel to the workers as code, so they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PIECES = "file string, start long, row long, begins boolean, ends boolean, value string"


# What a reader makes of a line: whether it stays, whether it ends a record, and whether it begins
# one (and ends the one before), and its state after the line.
Reading = tuple[bool, bool, bool, bool]
Reader = Callable[[str, bool], Reading]


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """file, start (the offset of the file split that a line begins in) and value, in file order."""
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"), "value")


def plain_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same, whichever way the lines ended in the file."""
    value = F.regexp_replace("value", "\r\\z", "")
    return lines_of(spark, path).select(
        "file", "start", F.explode(F.split(value, "\r", -1)).alias("value"))


def pieces_of(lines: DataFrame, reader: Reader) -> DataFrame:
    """Lines to records within each file split: file, start, row, begins, ends and value.

    ``lines`` also say with what state of the reader their split is ``opened``, and whether a
    record begins there (``fresh``). Records that begin or end in another split are marked so.
    """
    names = [f.split()[0] for f in _PIECES.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, state, held, begins, row = None, False, [], True, 0
        out: list[tuple] = []

        def put(ends: bool) -> None:
            nonlocal held, begins, row
            out.append((*split, row, begins, ends, "\n".join(held)))
            held, begins, row = [], True, row + 1

        def batch() -> pa.RecordBatch:
            made = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(made, names=names)

        for lines in batches:
            for file, start, value, opened, fresh in zip(*(lines.column(c).to_pylist() for c in (
                    "file", "start", "value", "opened", "fresh")), strict=True):
                if (file, start) != split:
                    if held:
                        put(ends=False)
                    split, row, state, begins = (file, start), 0, opened, fresh
                stays, ends, starts, state = reader(value, state)
                if starts:
                    if held:
                        put(ends=True)
                    begins = True
                if stays:
                    held.append(value)
                if ends:
                    put(ends=True)
                if len(out) >= 4096:
                    yield batch()
        if held:
            put(ends=False)
        if out:
            yield batch()

    return lines.mapInArrow(run, _PIECES)


def _joined_pieces(pieces: DataFrame) -> DataFrame:
    """Whole records, and those made of the fragments on both sides of a cut: file, start, row, value.

    Only fragments are exchanged, at most two per file split and those within a long record.
    """
    names = ["file", "start", "row", "value"]
    whole = F.col("begins") & F.col("ends")
    upto = Window.partitionBy("file").orderBy("start", "row")
    parts = pieces.filter(~whole).withColumn("record", F.count_if("begins").over(upto))
    joined = parts.groupBy("file", "record").agg(
        F.sort_array(F.collect_list(F.struct("start", "row", "value"))).alias("p")).select(
        "file", F.col("p")[0]["start"].alias("start"), F.col("p")[0]["row"].alias("row"),
        F.array_join(F.col("p.value"), "\n").alias("value"))
    return pieces.filter(whole).select(*names).unionAll(joined.select(*names))


def _odd_quotes(value: Column) -> Column:
    return (F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))) % 2


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of CSV files whose quoted cells may span lines: file, start, row and value.

    A line begins inside a cell if the quotes before it in its file are odd in number. They are
    counted per file split, and running sums over the splits tell in which state each begins; this
    table, one row per split of the files, is broadcast. Quotes may stand in quoted cells only, where
    they are doubled. Blank lines between records are left out. A file whose first line ends with
    \\r\\n has line feeds in its cells, too.
    """
    def reader(value: str, inside: bool) -> Reading:
        inside ^= value.count('"') % 2 == 1
        return True, not inside, False, inside

    lines = lines_of(spark, path)
    of_file = Window.partitionBy("file").orderBy("start")
    before = of_file.rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        lines.withColumn("pos", F.monotonically_increasing_id()).groupBy("file", "start")
        .agg(F.sum(_odd_quotes(F.col("value"))).alias("odd"),
             F.min(F.struct("pos", F.col("value").endswith("\r").alias("crlf")))["crlf"]
             .alias("crlf"))
        .select("file", "start", F.first("crlf").over(of_file).alias("crlf"),
                (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("opened"))
    )
    ended = F.when(F.col("crlf"), F.regexp_replace("value", "\r\\z", "")).otherwise(F.col("value"))
    opened = lines.join(F.broadcast(splits), ["file", "start"]).select(
        "file", "start", ended.alias("value"), "opened", (~F.col("opened")).alias("fresh"))
    return _joined_pieces(pieces_of(opened, reader)).filter(F.trim("value") != "")


def separated_blocks(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """Blocks of text files between lines that match ``separator``: file, start, row and value.

    A separator takes the line feeds on both its sides, so of separators in a row every other one
    is text, and so is one in a file's first line; the last line of a file counts as one with or
    without a line feed. How many separators a split ends with is counted first, as that tells how
    the next one begins; this table, one row per split, is broadcast.
    """
    mark = re.compile(separator)

    def reader(value: str, after_mark: bool) -> Reading:
        if mark.fullmatch(value) and not after_mark:
            return False, True, False, True
        return True, False, False, False

    lines = plain_lines(spark, path)
    is_mark = F.col("value").rlike(f"^(?:{separator})\\z")
    counted = (
        lines.withColumn("pos", F.monotonically_increasing_id()).groupBy("file", "start")
        .agg(F.max("pos").alias("last"), F.min("pos").alias("first"),
             F.max(F.when(~is_mark, F.col("pos"))).alias("text"))
        # the marks that a split ends with, and whether it holds anything else
        .select("file", "start", F.col("text").isNotNull().alias("stops"),
                (F.col("last") - F.coalesce("text", F.col("first") - 1)).alias("run")))
    upto = Window.partitionBy("file").orderBy("start")
    before = Window.partitionBy("file", "group").orderBy("start").rowsBetween(
        Window.unboundedPreceding, 0)
    # marks in a row up to the end of each split; at the start of a file one line feed is taken
    runs = (
        counted.withColumn("group", F.count_if("stops").over(upto))
        .withColumn("run", F.sum("run").over(before) + F.when(F.col("group") == 0, 1).otherwise(0))
        .withColumn("opened", F.lag(F.col("run") % 2 == 1, 1, True).over(upto))
        .select("file", "start", "opened")
    )
    opened = lines.join(F.broadcast(runs), ["file", "start"]).withColumn("fresh", F.col("opened"))
    return _joined_pieces(pieces_of(opened, reader))


def headed_blocks(spark: SparkSession, path: str, header: str) -> DataFrame:
    """Blocks of text files that begin with lines that match ``header``: file, start, row and value.

    What precedes the first header of a file is a block, too.
    """
    mark = re.compile(header)

    def reader(value: str, state: bool) -> Reading:
        return True, False, mark.match(value) is not None, state

    lines = plain_lines(spark, path).withColumns(
        {"opened": F.lit(False), "fresh": F.col("start") == 0})
    return _joined_pieces(pieces_of(lines, reader))


def numbered(records: DataFrame, count: Column, name: str) -> DataFrame:
    """Records with the sum of ``count`` over all records before them in their file.

    Sums over the splits of a file and over the records of a split, so no file meets in one task.
    """
    counted = records.withColumn("_n", count)
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = counted.groupBy("file", "start").agg(F.sum("_n").alias("_sum")).select(
        "file", "start", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("file", "start").orderBy("row").rowsBetween(
        Window.unboundedPreceding, -1)
    return (
        counted.withColumn("_inner", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(splits, ["file", "start"])
        .withColumn(name, F.col("_base") + F.col("_inner")).drop("_n", "_base", "_inner")
    )
