"""Composite score, tier, renewal window, drivers, confidence and summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctrisk import fixed
from acctrisk.functions.columns import rnd, sql_rnd, sql_text
from acctrisk.functions.skew import left_join_facts
from acctrisk.params import DEFAULT, ScoringParams

SCORE_COLUMNS = [column for column, _, _, _ in fixed.SIGNALS]
AT_RISK = ["High", "Medium"]


def with_days(accounts: DataFrame, params: ScoringParams = DEFAULT) -> DataFrame:
    """Add the whole days from the snapshot date to the end of the contract."""
    days = F.datediff("contract_end_date", F.lit(params.snapshot_date)).cast("bigint")
    return accounts.withColumn("days_until_renewal", days)


def renewal_window(accounts: DataFrame, params: ScoringParams = DEFAULT) -> DataFrame:
    """Accounts whose contract ends within the window, both edges included."""
    return with_days(accounts, params).filter(
        F.col("days_until_renewal").between(0, params.window_days))


def merge_signals(
    accounts: DataFrame,
    usage: DataFrame | None = None,
    tickets: DataFrame | None = None,
    nps: DataFrame | None = None,
    csm: DataFrame | None = None,
    sdk: DataFrame | None = None,
    engagement: DataFrame | None = None,
    nps_unique: bool = False,
) -> DataFrame:
    """Left join every signal frame to the accounts; ``None`` stands for an absent signal.

    A column two frames share comes from the earlier one. Every frame holds one row per account
    except the survey, which may hold any number: it is joined last and its hot accounts are
    spread, unless ``nps_unique`` says that it holds one row per account, too.
    """
    merged, layout, survey = accounts, list(accounts.columns), None
    for frame in (usage, tickets, nps, csm, sdk, engagement):
        if frame is None:
            continue
        new = [c for c in frame.columns if c not in layout]
        layout += new
        part = frame.select("account_id", *new)
        if frame is nps and not nps_unique:
            survey = part
        else:
            merged = merged.join(part, "account_id", "left")
    if survey is not None:
        merged = left_join_facts(merged, survey, "account_id")
    return merged.select(*layout)


def fill_defaults(merged: DataFrame) -> DataFrame:
    """Replace missing scores, or missing score columns, by the signal's default."""
    return merged.withColumns({
        column: F.expr(
            f"coalesce({column}, {default}D)" if column in merged.columns else f"{default}D")
        for column, _, _, default in fixed.SIGNALS
    })


def weighted_score(weights: Mapping[str, float] | None = None) -> str:
    """The unrounded weighted sum of the six scores, as SQL text."""
    weights = weights or DEFAULT.weights
    return " + ".join(f"{column} * {float(weights[name])}D" for column, name, _, _ in fixed.SIGNALS)


def risk_tier(score: Column, params: ScoringParams = DEFAULT) -> Column:
    return (
        F.when(score >= params.high_threshold, F.lit("High"))
        .when(score >= params.medium_threshold, F.lit("Medium"))
        .otherwise(F.lit("Low"))
    )


def top_drivers(limit: int = 3, above: float = 0.3) -> Column:
    """The largest scores above a level as text; ties keep the order of the signals."""
    entries = ", ".join(
        f"named_struct('k', -{column}, 'i', {i}, 'label', {sql_text(label)})"
        for i, (column, _, label, _) in enumerate(fixed.SIGNALS))
    ranked = f"sort_array(array({entries}))"
    texts = ", ".join(
        f"CASE WHEN -{ranked}[{place}].k > {above}D THEN concat({ranked}[{place}].label, ' (', "
        f"CAST(rint(-{ranked}[{place}].k * 100D) AS BIGINT), '%)') END"
        for place in range(limit))
    return F.expr(
        f"coalesce(nullif(concat_ws('; ', {texts}), ''), {sql_text(fixed.NO_DRIVERS)})")


def confidence_level() -> Column:
    """How many signals differ from their default."""
    real = " + ".join(
        f"if(abs({column} - {default}D) > 0.01D, 1, 0)" for column, _, _, default in fixed.SIGNALS)
    return F.expr(f"CASE WHEN {real} >= 4 THEN 'High' WHEN {real} >= 2 THEN 'Medium' "
                  "ELSE 'Low' END")


def score_merged(merged: DataFrame, params: ScoringParams = DEFAULT) -> DataFrame:
    """Fill in defaults and add composite score, tier, drivers and confidence."""
    score = F.expr(sql_rnd(weighted_score(params.weights), 3))
    return fill_defaults(merged).withColumn("composite_risk_score", score).withColumns({
        "risk_tier": risk_tier(F.col("composite_risk_score"), params),
        "top_risk_drivers": top_drivers(),
        "confidence_level": confidence_level(),
    })


def composite_risk(
    accounts: DataFrame,
    usage: DataFrame | None = None,
    tickets: DataFrame | None = None,
    nps: DataFrame | None = None,
    csm: DataFrame | None = None,
    sdk: DataFrame | None = None,
    engagement: DataFrame | None = None,
    params: ScoringParams = DEFAULT,
    nps_unique: bool = False,
) -> DataFrame:
    """The scored accounts of the renewal window; ``None`` stands for an absent signal.

    The window looks at accounts only, so it is applied before any join.
    """
    in_window = renewal_window(accounts, params)
    merged = merge_signals(in_window, usage, tickets, nps, csm, sdk, engagement, nps_unique)
    return score_merged(merged, params)


def by_risk() -> Sequence[Column]:
    """Ranking order: highest score first, account id as the tie-break."""
    return [F.desc("composite_risk_score"), F.asc("account_id")]


def rank_by_risk(risk: DataFrame) -> DataFrame:
    """Scored accounts in ranking order (a distributed range sort)."""
    return risk.orderBy(*by_risk())


def summary_columns() -> dict[str, Column]:
    """Counts per tier, ARR at risk, mean and median score as aggregates by name.

    Composite scores carry three decimals, so the exact median keeps at most about a thousand
    distinct values per task.
    """
    tier, score = F.col("risk_tier"), F.col("composite_risk_score")

    def arr_of(tiers: list[str]) -> Column:
        return F.coalesce(F.sum(F.when(tier.isin(tiers), F.col("arr"))), F.lit(0))

    # thousandths add up exactly, so the mean does not depend on the order of the rows
    thousandths = F.sum(F.rint(score * F.lit(1000.0)).cast("bigint"))
    columns = {
        "total_accounts_analyzed": F.count(F.lit(1)),
        "high_risk_count": F.count_if(tier == "High"),
        "medium_risk_count": F.count_if(tier == "Medium"),
        "low_risk_count": F.count_if(tier == "Low"),
        "total_arr_at_risk": arr_of(AT_RISK),
        "high_risk_arr": arr_of(["High"]),
        "avg_risk_score": rnd(F.try_divide(thousandths, F.count(score)) / F.lit(1000.0), 3),
        "median_risk_score": rnd(F.percentile(score, F.lit(0.5)), 3),
    }
    return {name: column.alias(name) for name, column in columns.items()}


def risk_summary(risk: DataFrame) -> DataFrame:
    """The summary of a scored frame as one row, from one aggregation."""
    return risk.agg(*summary_columns().values())
