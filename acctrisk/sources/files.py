"""Readers of the input files: four CSV tables, free-text notes and a changelog."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctrisk import fixed
from acctrisk.operators.notes import changelog_of_blocks, extract_entities, notes_of_blocks
from acctrisk.sources import schemas
from acctrisk.sources.records import headed_blocks, quoted_records, separated_blocks


def _csv(
    spark: SparkSession, path: str, schema: T.StructType, required: list[str], multi_line: bool,
    ordered: bool = False,
) -> DataFrame:
    """A CSV table with a header; bad values stop the read.

    The order of the columns is that of the first file's header, which is all that is read up
    front. A file of the folder whose header differs stops the read, too, as its columns would be
    taken for others.
    """
    options = {"header": True, "escape": '"', "multiLine": multi_line}
    known = {f.name: f for f in schema}
    text = T.StringType()
    header = spark.read.options(**options).csv(path).columns
    # dates may come with a time of day, so they are read as text and cast
    in_file = T.StructType([
        known[name] if name in known and known[name].dataType != T.DateType()
        else T.StructField(name, text) for name in header])
    if multi_line:
        df = _parsed(quoted_records(spark, path), in_file, header)
    else:
        df = spark.read.schema(in_file).options(
            **options, mode="FAILFAST", enforceSchema=False).csv(path)
        if ordered:
            df = with_ingest_order(df)
    names = [*header, *(["ingest_order"] if ordered else [])]
    dates = {c: F.col(c).cast("timestamp").cast("date") for c in df.columns
             if c in known and known[c].dataType == T.DateType()}
    present = {c: F.coalesce(F.col(c), F.raise_error(F.lit(f"{c} is missing")).cast("bigint"))
               for c in required}
    return df.withColumns({**dates, **present}).select(*names)


def _parsed(records: DataFrame, in_file: T.StructType, header: list[str]) -> DataFrame:
    """Columns of CSV records; the first record of every file has to be the header."""
    options = {"escape": '"', "multiLine": "true", "mode": "FAILFAST"}
    first = (F.col("start") == 0) & (F.col("row") == 0)
    names = F.from_csv("value", ", ".join(f"c{i} string" for i in range(len(header))), options)
    same = F.lit(True)
    for i, name in enumerate(header):
        same = same & names[f"c{i}"].eqNullSafe(F.lit(name))
    differs = F.raise_error(F.concat(F.lit("another CSV header in "), "file")).cast("boolean")
    cells = F.from_csv("value", in_file.simpleString()[7:-1].replace(":", " "), options)
    # a header that differs stops the read, one that does not goes
    rows = records.filter(F.when(~first, F.lit(True)).when(same, F.lit(False)).otherwise(differs))
    order = F.struct("file", "start", "row").alias("ingest_order")
    return rows.select(order, cells.alias("cells")).select("ingest_order", "cells.*")


def with_ingest_order(df: DataFrame) -> DataFrame:
    """Number file rows so that they sort in file order: path, place in the file, row."""
    return df.withColumn("ingest_order", F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row")))


def load_accounts(
    spark: SparkSession, path: str, ordered: bool = False, multi_line: bool = False
) -> DataFrame:
    """Accounts; with ``ordered`` also their place in the file, for keep-first checks.

    Here and below, ``multi_line`` allows line breaks inside quoted cells. Large files are read by
    several tasks all the same, at the price of a pass that counts their quotes.
    """
    return _csv(spark, path, schemas.ACCOUNTS, ["account_id", "arr"], multi_line, ordered)


def load_usage_metrics(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return _csv(spark, path, schemas.USAGE, ["account_id"], multi_line)


def load_support_tickets(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Tickets; a resolution time that is no number becomes null."""
    df = _csv(spark, path, schemas.TICKETS, ["account_id"], multi_line)
    return df.withColumn(
        "resolution_time_hours", F.expr("try_cast(resolution_time_hours AS DOUBLE)"))


def load_nps_responses(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Survey responses; a missing comment becomes empty text. Comments may span lines."""
    df = _csv(spark, path, schemas.NPS, ["account_id", "score"], multi_line)
    return df.withColumn("verbatim_comment", F.coalesce("verbatim_comment", F.lit("")))


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files, one row each with its file, in parallel over the files.

    Lines end with a line feed, whichever way they ended in the file.
    """
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"),
        F.regexp_replace("value", "\\r\\n?", "\n").alias("value"))


def load_notes(spark: SparkSession, path: str, strip_banner: bool = False) -> DataFrame:
    """Notes with the account id and name their text mentions, numbered per ``file``.

    Files are read in as many tasks as they have splits, whatever their size.
    """
    separator = fixed.NOTE_SEPARATOR.removeprefix(r"\n").removesuffix(r"\n")
    blocks = separated_blocks(spark, path, separator)
    return extract_entities(notes_of_blocks(blocks, strip_banner))


def load_changelog(spark: SparkSession, path: str) -> DataFrame:
    """Entries of all releases, in tasks by file splits; releases are numbered per file."""
    return changelog_of_blocks(headed_blocks(spark, path, fixed.CHANGELOG_HEADER)).drop("file")


@dataclass(frozen=True)
class Sources:
    """All input relations, lazy."""

    accounts: DataFrame
    usage: DataFrame
    tickets: DataFrame
    nps: DataFrame
    notes: DataFrame
    changelog: DataFrame


def load_all(spark: SparkSession, folder: str, ordered: bool = True) -> Sources:
    """The six inputs of a folder, under their usual file names, accounts with their place."""
    return Sources(
        accounts=load_accounts(spark, f"{folder}/accounts.csv", ordered),
        usage=load_usage_metrics(spark, f"{folder}/usage_metrics.csv"),
        tickets=load_support_tickets(spark, f"{folder}/support_tickets.csv"),
        nps=load_nps_responses(spark, f"{folder}/nps_responses.csv"),
        notes=load_notes(spark, f"{folder}/csm_notes.txt"),
        changelog=load_changelog(spark, f"{folder}/changelog.md"),
    )
