"""Report queries over the scored accounts."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acctrisk import fixed
from acctrisk.operators.scoring import AT_RISK, SCORE_COLUMNS, by_risk


def filter_accounts(
    risk: DataFrame,
    tiers: Collection[str] | None = None,
    plans: Collection[str] | None = None,
    min_arr: int | None = None,
) -> DataFrame:
    """The accounts of the chosen tiers and plans with at least the given ARR."""
    if tiers is not None:
        risk = risk.filter(F.col("risk_tier").isin(list(tiers)))
    if plans is not None:
        risk = risk.filter(F.col("plan_tier").isin(list(plans)))
    if min_arr is not None:
        risk = risk.filter(F.col("arr") >= min_arr)
    return risk


def tier_counts(risk: DataFrame) -> DataFrame:
    return risk.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("n_accounts"))


def arr_by_tier(risk: DataFrame) -> DataFrame:
    return risk.groupBy("risk_tier").agg(F.sum("arr").alias("total_arr"))


def risk_map(risk: DataFrame) -> DataFrame:
    return risk.select(
        "account_name", "risk_tier", "composite_risk_score", "arr", "plan_tier",
        "days_until_renewal", "top_risk_drivers")


def account_detail(risk: DataFrame, name: str) -> DataFrame:
    """Everything known about one account, found by name; the riskiest if several share it."""
    return risk.filter(F.col("account_name") == name).orderBy(*by_risk()).limit(1)


def signal_breakdown(risk: DataFrame) -> DataFrame:
    """The six scores of each account as rows."""
    wide = risk.select("account_id", *[
        F.col(column).alias(label)
        for column, label in zip(SCORE_COLUMNS, fixed.BREAKDOWN_LABELS, strict=True)])
    return wide.unpivot("account_id", fixed.BREAKDOWN_LABELS, "signal", "score")


def heatmap(risk: DataFrame, limit: int = 20) -> DataFrame:
    """The six scores of the riskiest High and Medium accounts."""
    return (
        risk.filter(F.col("risk_tier").isin(AT_RISK))
        .orderBy(*by_risk()).limit(limit)
        .select("account_id", "account_name", *SCORE_COLUMNS)
    )


def counts_by_tier(risk: DataFrame, column: str) -> DataFrame:
    """Accounts per value of a column and tier; rows without a value are left out."""
    return risk.filter(F.col(column).isNotNull()).groupBy(column, "risk_tier").agg(
        F.count(F.lit(1)).alias("n_accounts"))


def top_accounts(risk: DataFrame, limit: int = 20) -> DataFrame:
    """The riskiest accounts with their rank; only those few rows are numbered."""
    top = risk.orderBy(*by_risk()).limit(limit)
    place = F.row_number().over(Window.orderBy(*by_risk())).cast("bigint")
    return top.select(
        place.alias("rank"), "account_name", "composite_risk_score", "risk_tier", "arr",
        "days_until_renewal", "sdk_version", "top_risk_drivers")
