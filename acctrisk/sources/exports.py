"""Result relations and their file sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctrisk import fixed


def risk_scored(risk: DataFrame) -> DataFrame:
    """The export columns, as far as the frame has them."""
    return risk.select(*[c for c in fixed.EXPORT_COLUMNS if c in risk.columns])


def detailed_signals(risk: DataFrame) -> DataFrame:
    return risk.drop("risk_explanation")


def account_briefings(risk: DataFrame) -> DataFrame:
    explanation = F.col("risk_explanation") if "risk_explanation" in risk.columns else F.lit("")
    return risk.select(
        "account_id", "account_name", "risk_tier",
        F.col("composite_risk_score").alias("risk_score"), "arr",
        explanation.alias("explanation"))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV part files with a header, one per partition; nothing passes through the driver."""
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False,
               "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(**options).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per line, missing values as null."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def export_all(risk: DataFrame, report: DataFrame, folder: str) -> None:
    """Write the four result sets; ``report`` is the one-row insights report.

    Every sink runs its own job over ``risk``, so hand over a persisted or written frame.
    """
    write_csv(risk_scored(risk), f"{folder}/risk_scored_accounts")
    write_csv(detailed_signals(risk), f"{folder}/detailed_signals")
    write_json(account_briefings(risk), f"{folder}/account_briefings")
    report.select("report").write.mode("overwrite").text(f"{folder}/insights")
