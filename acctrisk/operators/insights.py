"""Cross-signal patterns and distributions over the scored accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctrisk import fixed
from acctrisk.functions.columns import fill, is_true, percent, whole
from acctrisk.operators.scoring import AT_RISK, by_risk, summary_columns

CATEGORIES = [
    p[0] for p in (
        fixed.SILENT_CHURN, fixed.SDK_CASCADE, fixed.CHAMPION_RISK, fixed.NPS_CONTRADICTION)
]


# columns of signals that may be absent, with their types
OPTIONAL_COLUMNS = {
    "nps_score": "bigint", "nps_comment": "string", "sdk_version": "string",
    "total_tickets": "bigint", "p1_p2_tickets": "bigint", "champion_status": "string",
    "csm_summary": "string", "competitor_mentions": "string", "plan_tier": "string",
    "industry": "string",
}


def with_optional_columns(risk: DataFrame) -> DataFrame:
    """Add the columns of absent signals as nulls, so that their patterns match nothing."""
    absent = {c: k for c, k in OPTIONAL_COLUMNS.items() if c not in risk.columns}
    return risk.withColumns({c: F.lit(None).cast(k) for c, k in absent.items()})


def _count(value: str) -> Column:
    return whole(F.coalesce(value, F.lit(0)))


# ---- what makes a pattern ---------------------------------------------------------------------

def silent_churn_condition(min_nps: int = 7, min_usage_risk: float = 0.4) -> Column:
    return (F.col("nps_score") >= min_nps) & (F.col("usage_risk_score") >= min_usage_risk)


def sdk_cascade_condition(min_tickets: int | None = None) -> Column:
    hit = F.col("sdk_version").startswith("v3")
    return hit if min_tickets is None else hit & (F.col("total_tickets") > min_tickets)


def champion_condition() -> Column:
    return F.col("champion_status").isin("at_risk", "lost")


def contradiction_condition(columns: list[str]) -> Column:
    """A mismatch flag that is true, under either of its two names; the first present counts."""
    present = [c for c in ("sentiment_score_mismatch", "score_contradicts") if c in columns]
    return F.col(present[0]) if present else F.lit(False)


# ---- details ----------------------------------------------------------------------------------

def _details(columns: list[str], shown_chars: int = 100, **limits) -> dict[str, tuple]:
    """Per category: condition, fixed pattern and detail text."""
    churn = {k: v for k, v in limits.items() if k in ("min_nps", "min_usage_risk")}
    quote = F.substring(F.coalesce("nps_comment", F.lit("")), 1, shown_chars)
    found = {
        fixed.SILENT_CHURN: (silent_churn_condition(**churn), [
            whole(F.col("nps_score")), percent(F.col("usage_risk_score"))]),
        fixed.SDK_CASCADE: (sdk_cascade_condition(limits.get("min_tickets")), [
            F.col("sdk_version"), _count("total_tickets"), _count("p1_p2_tickets")]),
        fixed.CHAMPION_RISK: (champion_condition(), [
            F.col("champion_status"), F.coalesce("csm_summary", F.lit("N/A"))]),
        fixed.NPS_CONTRADICTION: (contradiction_condition(columns), [_count("nps_score"), quote]),
    }
    return {
        category: (condition, kind, fill(template, *values))
        for (category, kind, template), (condition, values) in found.items()
    }


def _pattern(risk: DataFrame, pattern: tuple, shown: list[str], **limits) -> DataFrame:
    risk = with_optional_columns(risk)
    condition, kind, detail = _details(risk.columns, **limits)[pattern[0]]
    return risk.filter(condition).select(
        "account_id", "account_name", *shown,
        F.lit(kind).alias("insight_type"), detail.alias("insight_detail"))


def nps_usage_divergence(risk: DataFrame, **limits) -> DataFrame:
    """Satisfied accounts that use the product less and less."""
    return _pattern(risk, fixed.SILENT_CHURN, ["nps_score", "usage_risk_score"], **limits)


def sdk_deprecation_impact(risk: DataFrame, min_tickets: int | None = None) -> DataFrame:
    """Accounts on a deprecated SDK with their ticket load."""
    return _pattern(
        risk, fixed.SDK_CASCADE, ["sdk_version", "total_tickets", "p1_p2_tickets"],
        min_tickets=min_tickets)


def champion_at_risk(risk: DataFrame) -> DataFrame:
    """Accounts whose champion is at risk or lost."""
    return _pattern(risk, fixed.CHAMPION_RISK, ["champion_status", "csm_summary"])


def score_sentiment_contradictions(risk: DataFrame, shown_chars: int = 100) -> DataFrame:
    """Accounts whose survey score contradicts the comment; the text quotes its beginning."""
    return _pattern(risk, fixed.NPS_CONTRADICTION, ["nps_score"], shown_chars=shown_chars)


def all_insights(risk: DataFrame) -> DataFrame:
    """The four patterns as one long relation, from one pass over the scores."""
    risk = with_optional_columns(risk)
    entries = [
        F.when(condition, F.struct(
            F.lit(category).alias("category"), F.lit(kind).alias("insight_type"),
            detail.alias("insight_detail")))
        for category, (condition, kind, detail) in _details(risk.columns).items()
    ]
    return risk.select(
        "account_id", "account_name", F.inline(F.array_compact(F.array(*entries))))


def count_columns(columns: list[str]) -> list[Column]:
    """Accounts per pattern as aggregates."""
    conditions = [
        silent_churn_condition(), sdk_cascade_condition(), champion_condition(),
        contradiction_condition(columns),
    ]
    return [
        F.count_if(is_true(condition)).alias(category)
        for category, condition in zip(CATEGORIES, conditions, strict=True)
    ]


def insight_counts(risk: DataFrame) -> DataFrame:
    """Accounts per pattern, patterns without any included, from one pass over the scores."""
    counted = with_optional_columns(risk).agg(*count_columns(risk.columns))
    return counted.unpivot([], CATEGORIES, "category", "n_accounts")


# ---- distributions ----------------------------------------------------------------------------

def _at_risk() -> Column:
    return F.col("risk_tier").isin(AT_RISK)


def sdk_distribution(risk: DataFrame) -> DataFrame:
    """Accounts and at-risk accounts per SDK version."""
    known = with_optional_columns(risk).filter(F.col("sdk_version").isNotNull())
    return known.groupBy("sdk_version").agg(
        F.count(F.lit(1)).alias("n_accounts"),
        F.count_if(_at_risk()).alias("n_at_risk"),
    )


def nps_buckets(risk: DataFrame) -> DataFrame:
    """Detractors, passives and promoters; accounts without a score are left out."""
    score = F.col("nps_score")
    return with_optional_columns(risk).agg(
        F.count_if(score <= 6).alias("detractors"),
        F.count_if(score.between(7, 8)).alias("passives"),
        F.count_if(score >= 9).alias("promoters"),
    )


def industry_risk(risk: DataFrame) -> DataFrame:
    """At-risk accounts and their ARR per industry."""
    known = with_optional_columns(risk).filter(_at_risk() & F.col("industry").isNotNull())
    return known.groupBy("industry").agg(
        F.count(F.lit(1)).alias("n_at_risk"), F.sum("arr").alias("total_arr"))


def tier_distribution(risk: DataFrame) -> DataFrame:
    tier = F.col("risk_tier")
    return risk.agg(
        F.count(F.lit(1)).alias("n_accounts"),
        F.count_if(tier == "High").alias("n_high"),
        F.count_if(tier == "Medium").alias("n_medium"),
        F.count_if(tier == "Low").alias("n_low"),
    )


# ---- digest -----------------------------------------------------------------------------------

def _money(value: str) -> Column:
    return F.format_number(F.col(value), 0)


def top_digest(risk: DataFrame, limit: int = 15) -> DataFrame:
    """The riskiest accounts, one descriptive line each."""
    def or_text(column: str, text: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(text))

    # The layout of a digest line
    line = fill(
        "- {} (ID:{}): Risk={}% [{}], ARR=${}, Plan={}, SDK={}, NPS={}, "
        "Usage Decline Risk={}%, Tickets={} ({} P1/P2), Competitors={}, Champion={}, "
        "Renewal in {} days. CSM: {}",
        F.col("account_name"), whole(F.col("account_id")),
        percent(F.col("composite_risk_score")), F.col("risk_tier"), _money("arr"),
        or_text("plan_tier", "?"), or_text("sdk_version", "?"), or_text("nps_score", "N/A"),
        percent(F.col("usage_risk_score")), _count("total_tickets"), _count("p1_p2_tickets"),
        or_text("competitor_mentions", "none"), or_text("champion_status", "unknown"),
        whole(F.col("days_until_renewal")), or_text("csm_summary", "No notes"),
    )
    top = with_optional_columns(risk).orderBy(*by_risk()).limit(limit)
    # only those few rows are numbered
    place = F.row_number().over(Window.orderBy(*by_risk())).cast("bigint")
    return top.select(
        place.alias("rank"), "account_id", "composite_risk_score", line.alias("line"))


def dataset_digest(risk: DataFrame) -> DataFrame:
    """The dataset summary as lines: sort by section, -weight and text.

    Totals, versions and industries come from one aggregation over three grouping sets. Lines
    stay rows, so a long list of versions or industries is never gathered in one place.
    """
    risk = with_optional_columns(risk)
    tier, score = F.col("risk_tier"), F.col("nps_score")
    counted = risk.groupingSets(
        [[], ["sdk_version"], ["industry"]], "sdk_version", "industry",
    ).agg(
        F.grouping_id().alias("set"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(_at_risk()).alias("n_at_risk"),
        F.sum(F.when(_at_risk(), F.col("arr"))).alias("arr"),
        *[F.count_if(tier == t).alias(t) for t in ("High", "Medium", "Low")],
        F.count_if(score <= 6).alias("detractors"),
        F.count_if(score.between(7, 8)).alias("passives"),
        F.count_if(score >= 9).alias("promoters"),
    )
    n = {c: whole(F.col(c)) for c in (
        "n", "n_at_risk", "High", "Medium", "Low", "detractors", "passives", "promoters")}

    def line(section: int, text: Column, weight: Column | None = None) -> Column:
        return F.struct(
            F.lit(section).cast("bigint").alias("section"),
            (F.lit(0.0) if weight is None else weight.cast("double")).alias("weight"),
            text.alias("line"))

    # Section headings and line layouts
    totals = F.array(
        line(1, fill("Total accounts analyzed: {}", n["n"])),
        line(2, fill("Risk distribution: High={}, Medium={}, Low={}",
                     n["High"], n["Medium"], n["Low"])),
        line(3, F.lit("=== TOP 15 AT-RISK ACCOUNTS ===")),
        line(5, F.lit("=== SDK VERSION DISTRIBUTION ===")),
        line(7, F.lit("=== NPS SCORE DISTRIBUTION ===")),
        line(8, fill("Detractors (0-6): {}, Passives (7-8): {}, Promoters (9-10): {}",
                     n["detractors"], n["passives"], n["promoters"])),
        line(9, F.lit("=== INDUSTRY RISK BREAKDOWN ===")),
    )
    version = F.array(line(6, fill(
        "- {}: {} accounts ({} at-risk)", F.col("sdk_version"), n["n"], n["n_at_risk"]),
        F.col("n")))
    industry = F.array(line(10, fill(
        "- {}: {} at-risk accounts, total ARR=${}", F.col("industry"), n["n_at_risk"],
        _money("arr"))))
    # grouping_id: a bit is set for each column that is not part of the row's set
    lines = (
        F.when(F.col("set") == 3, totals)
        .when((F.col("set") == 1) & F.col("sdk_version").isNotNull(), version)
        .when((F.col("set") == 2) & F.col("industry").isNotNull() & (F.col("n_at_risk") > 0),
              industry)
    )
    top = top_digest(risk).select(
        F.lit(4).cast("bigint").alias("section"),
        (-F.col("rank")).cast("double").alias("weight"), "line")
    return counted.select(F.inline(lines)).unionAll(top)


# Sections of the digest that open with a heading, set off by a blank line.
_HEADINGS = (3, 5, 7, 9)


def digest_text(risk: DataFrame) -> DataFrame:
    """The dataset summary as one text, ``digest``: what goes into a prompt in one piece."""
    line = F.when(F.col("section").isin(*_HEADINGS), F.concat(F.lit("\n"), "line")).otherwise(
        F.col("line"))
    lines = F.sort_array(F.collect_list(
        F.struct("section", (-F.col("weight")).alias("w"), F.col("line").alias("o"),
                 line.alias("l"))))
    return dataset_digest(risk).agg(F.array_join(lines["l"], "\n").alias("digest"))


def insights_export(risk: DataFrame, model_text: str = "") -> DataFrame:
    """Summary, free text and pattern counts as one JSON record, from one aggregation."""
    summary = summary_columns()
    counted = with_optional_columns(risk).agg(*summary.values(), *count_columns(risk.columns))
    return counted.select(F.to_json(F.struct(
        F.struct(*summary).alias("summary"),
        F.lit(model_text).alias("llm_insights"),
        F.struct(*CATEGORIES).alias("structured_insight_counts"),
    )).alias("report"))
