"""The scored accounts as a stored table laid out for the reports that read it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TIER = "risk_tier"
KEY = "account_id"


def write_risk(risk: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet with one folder per tier, in files that hold ranges of account ids.

    Rows are cut by ranges of (tier, account), so files are of like size however uneven the tiers
    are, and a tier is only in the files of its own ranges. Within a file they are sorted by
    account, so the smallest and largest id of a row group tell which to skip for an account. An
    account without a tier lies in a folder of its own; equal rows are all kept.
    """
    (risk.repartitionByRange(TIER, KEY).sortWithinPartitions(TIER, KEY)
     .write.mode(mode).partitionBy(TIER).parquet(path))


def read_risk(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The stored accounts with the columns, types and column order of the given schema.

    Filters on the tier prune folders, those on the account row groups, and only the columns that
    a report uses are read. A store without any account gives no rows.
    """
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def store_risk(risk: DataFrame, path: str) -> DataFrame:
    """Write the accounts once and go on from the stored table."""
    write_risk(risk, path)
    return read_risk(risk.sparkSession, path, risk.schema)
