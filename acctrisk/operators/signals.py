"""Per-account risk signals: usage trend, tickets, survey, note analysis, SDK and engagement."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctrisk import fixed
from acctrisk.functions.columns import clip01, missing_text, rnd, sql_rnd, sql_text
from acctrisk.functions.skew import left_join_lookup
from acctrisk.params import DEFAULT, ScoringParams

# Sorts after every YYYY-MM text, so rows without a month come last.
_NO_MONTH = "~"


# ---- usage history ---------------------------------------------------------------------------

def _descending(text: Column) -> Column:
    """A text that sorts the other way round: its bytes as complements, the longer text first."""
    digits = "0123456789ABCDEF"
    return F.concat(F.translate(F.hex(text), digits, digits[::-1]), F.lit("G"))


def _months(usage: DataFrame, unique_months: bool) -> DataFrame:
    """account_id, month and what each account-month holds.

    That is the number of rows, the smallest and the largest (``high``, null for a month with a
    single row, the usual case, so that it travels once), and the largest known users and SDK.
    """
    row = F.struct(*fixed.USAGE_METRICS, "sdk_version")
    month = F.coalesce("month", F.lit(_NO_MONTH)).alias("month")
    if unique_months:
        kind = usage.select(row).schema[0].dataType
        return usage.select(
            "account_id", month, F.lit(1).cast("bigint").alias("n"), row.alias("low"),
            F.lit(None).cast(kind).alias("high"), F.col("active_users").alias("users"),
            F.col("sdk_version").alias("sdk"))
    return usage.groupBy("account_id", month).agg(
        F.count(F.lit(1)).alias("n"), F.min(row).alias("low"), F.max(row).alias("high"),
        F.max("active_users").alias("users"), F.max("sdk_version").alias("sdk"),
    ).withColumn("high", F.when(F.col("n") > 1, F.col("high")))


def usage_profile(usage: DataFrame, unique_months: bool = False) -> DataFrame:
    """One row per account with its first two, last two and last known usage rows.

    Every month stands in up to four lists of its account: from the first month on, from the last
    one back, and back over the months with known users and with a known SDK. A limit on the
    rank in these lists holds in every task that reads months, before the exchange, so a few
    rows per account and task travel, however long a history is, and none is ever gathered.

    Rows that share a month have no order of their own: the smallest and the largest of them stand
    for the month. ``n_rows`` counts up to three. ``unique_months`` promises one row per account
    and month and saves the aggregation that finds those two.
    """
    months = _months(usage.filter(F.col("account_id").isNotNull()), unique_months)
    backwards = _descending(F.col("month")).alias("key")

    def listed(name: str, key: Column, known: str | None = None) -> Column:
        entry = F.struct(F.lit(name).alias("list"), key.alias("key"))
        return entry if known is None else F.when(F.col(known).isNotNull(), entry)

    lists = F.array_compact(F.array(
        listed("first", F.col("month")), listed("last", backwards),
        listed("users", backwards, "users"), listed("sdk", backwards, "sdk")))
    in_list = Window.partitionBy("account_id", "list").orderBy("key")
    # only the lists of ends need the rows of their months
    whole = F.col("list").isin("first", "last")
    ends = (
        months.select("*", F.inline(lists))
        .withColumns({c: F.when(whole, F.col(c)) for c in ("low", "high")})
        .withColumn("at", F.row_number().over(in_list))
        .filter("at <= 3")
    )

    def entry(name: str, at: int) -> Column:
        of = (F.col("list") == name) & (F.col("at") == at)
        return F.max(F.when(of, F.struct("n", "low", "high", "users", "sdk")))

    profile = ends.groupBy("account_id").agg(
        F.least(F.sum(F.when(F.col("list") == "first", F.col("n"))), F.lit(3)).alias("n_rows"),
        entry("first", 1).alias("first"), entry("first", 2).alias("second"),
        entry("last", 1).alias("last"), entry("last", 2).alias("before"),
        entry("users", 1)["users"].alias("known_users"),
        entry("sdk", 1)["sdk"].alias("known_sdk"))
    first, second, last, before = (F.col(c) for c in ("first", "second", "last", "before"))
    return profile.select(
        "account_id",
        "n_rows",
        first["low"].alias("first_row"),
        F.when(first["n"] > 1, first["high"]).otherwise(second["low"]).alias("second_row"),
        F.when(last["n"] > 1, last["low"])
        .otherwise(F.coalesce(before["high"], before["low"])).alias("previous_row"),
        F.coalesce(last["high"], last["low"]).alias("last_row"),
        "known_users",
        "known_sdk",
    )


def latest_usage(usage: DataFrame, unique_months: bool = False) -> DataFrame:
    """The last row of each account next to the last known value of each column."""
    return usage_profile(usage, unique_months).select(
        "account_id",
        F.col("last_row.api_calls").alias("api_calls_last"),
        F.col("last_row.active_users").alias("active_users_last"),
        F.col("last_row.sdk_version").alias("sdk_version_last"),
        F.col("known_users").alias("active_users_known"),
        F.col("known_sdk").alias("sdk_version_known"),
    )


def _decline(metric: str) -> str:
    """Share of the early level lost by the latest two rows, 0 to 1.

    An unknown or zero start counts as no decline, an unknown end as a full one.
    """
    early = f"((first_row.{metric} + second_row.{metric}) / 2D)"
    late = f"((previous_row.{metric} + last_row.{metric}) / 2D)"
    return f"""
        CASE WHEN {early} > 0 THEN
            CASE WHEN {late} IS NULL THEN 1D
                 ELSE greatest(0D, least(1D, -(({late} - {early}) / {early}))) END
        ELSE 0D END"""


def usage_columns() -> list[Column]:
    """Usage-trend columns over a usage profile."""
    score = " + ".join(f"{_decline(m)} * {share}D" for m, share in fixed.USAGE_METRICS.items())
    api_pct, users_pct = (
        f"{sql_rnd(_decline(m) + ' * -100D', 1)} + 0D" for m in ("api_calls", "active_users"))
    columns = {
        "usage_risk_score":
            f"CASE WHEN n_rows >= 3 THEN {sql_rnd(score, 3)} "
            f"WHEN n_rows IS NOT NULL THEN {fixed.SPARSE_USAGE_SCORE}D END",
        "api_calls_latest": "CASE WHEN n_rows >= 3 THEN last_row.api_calls END",
        "active_users_latest": "CASE WHEN n_rows >= 3 THEN last_row.active_users END",
        "api_calls_decline_pct": f"CASE WHEN n_rows >= 3 THEN {api_pct} END",
        "active_users_decline_pct": f"CASE WHEN n_rows >= 3 THEN {users_pct} END",
        "sdk_version": "CASE WHEN n_rows >= 3 THEN last_row.sdk_version END",
    }
    return [F.expr(text).alias(name) for name, text in columns.items()]


def usage_signals(usage: DataFrame, unique_months: bool = False) -> DataFrame:
    """Usage decline between the first and the last two rows of each account."""
    return usage_profile(usage, unique_months).select("account_id", *usage_columns())


# ---- SDK -------------------------------------------------------------------------------------

def sdk_columns(version: str, present: str = "true", rules=None) -> list[Column]:
    """SDK risk and its reasons from a table of version rules; null unless ``present``."""
    points, texts = ["0D"], []
    for kind, versions, risk, text in rules or fixed.SDK_RULES:
        if kind == "prefix":
            hit = " OR ".join(f"startswith({version}, {sql_text(v)})" for v in versions)
        else:
            hit = f"{version} IN ({', '.join(sql_text(v) for v in versions)})"
        points.append(f"CASE WHEN {hit} THEN {risk}D ELSE 0D END")
        texts.append(f"CASE WHEN {hit} THEN replace({sql_text(text)}, '{{v}}', {version}) END")
    total = f"least(1D, {' + '.join(points)})"
    return [
        F.expr(f"CASE WHEN {present} THEN {sql_rnd(total, 3)} END").alias("sdk_risk_score"),
        F.expr(f"CASE WHEN {present} THEN concat_ws('; ', {', '.join(texts)}) END")
        .alias("sdk_risk_factors"),
    ]


def sdk_risk(usage: DataFrame, rules=None) -> DataFrame:
    """Risk of the last known SDK version of each account.

    Only that version is needed, and a maximum shrinks on the map side, so no history is built.
    """
    known = (
        usage.filter(F.col("account_id").isNotNull())
        .groupBy("account_id")
        .agg(F.max(F.when(
            F.col("sdk_version").isNotNull(),
            F.struct(F.coalesce("month", F.lit(_NO_MONTH)), "sdk_version"),
        ))["sdk_version"].alias("sdk_version"))
    )
    risk, factors = sdk_columns("sdk_version", rules=rules)
    return known.select("account_id", risk, "sdk_version", factors)


# ---- engagement ------------------------------------------------------------------------------

def engagement_columns(users: str, present: str = "true") -> list[Column]:
    """Active users against what the plan tier should have; null unless ``present``."""
    tiers = " ".join(f"WHEN {sql_text(t)} THEN {n}L" for t, n in fixed.EXPECTED_USERS.items())
    expected = f"(CASE plan_tier {tiers} ELSE {fixed.EXPECTED_USERS_OTHER}L END)"
    ratio = f"(CAST({users} AS DOUBLE) / CAST({expected} AS DOUBLE))"
    steps = " ".join(f"WHEN {ratio} < {top}D THEN {risk}D" for top, risk in fixed.ENGAGEMENT_STEPS)
    # greatest() would skip an unknown number of users
    per_user = f"CAST(arr AS DOUBLE) / CAST(if({users} < 1, 1, {users}) AS DOUBLE)"
    columns = {
        "engagement_risk_score": sql_rnd(f"CASE {steps} ELSE {fixed.ENGAGEMENT_FULL}D END", 3),
        "active_users": users,
        "expected_users": expected,
        "engagement_ratio": sql_rnd(ratio, 2),
        "arr_per_active_user": sql_rnd(per_user, 0),
    }
    return [
        F.expr(f"CASE WHEN {present} THEN {text} END").alias(name)
        for name, text in columns.items()
    ]


def engagement_signals(usage: DataFrame, accounts: DataFrame) -> DataFrame:
    """Adoption risk of every account with usage."""
    known = (
        usage.filter(F.col("account_id").isNotNull())
        .groupBy("account_id")
        .agg(F.max(F.when(
            F.col("active_users").isNotNull(),
            F.struct(F.coalesce("month", F.lit(_NO_MONTH)), "active_users"),
        ))["active_users"].alias("users"))
    )
    joined = known.join(accounts.select("account_id", "plan_tier", "arr"), "account_id", "left")
    return joined.select("account_id", *engagement_columns("users"))


# ---- tickets ---------------------------------------------------------------------------------

def ticket_signals(tickets: DataFrame, params: ScoringParams = DEFAULT) -> DataFrame:
    """Support health from one map-side-combined aggregation."""
    since = F.date_sub(F.lit(params.snapshot_date), params.recent_days)
    counts = (
        tickets.filter(F.col("account_id").isNotNull())
        .groupBy("account_id")
        .agg(
            F.count(F.lit(1)).alias("total_tickets"),
            F.count_if(F.col("priority").isin("P1", "P2")).alias("p1_p2_tickets"),
            F.count_if(F.col("status").isin("Open", "Escalated")).alias("open_escalated"),
            F.avg("resolution_time_hours").alias("avg_hours"),
            F.count_if(F.col("created_date") >= since).alias("recent_ticket_count"),
        )
    )
    total = F.col("total_tickets")
    hours = F.coalesce("avg_hours", F.lit(0.0))
    slow = F.when(
        hours > 0, F.least(F.lit(1.0), hours / F.lit(fixed.SLOW_HOURS))
    ).otherwise(F.lit(fixed.UNRESOLVED_SLOWNESS))
    urgent, waiting, slowness, many = (F.lit(share) for share in fixed.TICKET_SHARES)
    score = (
        F.col("p1_p2_tickets") / total * urgent
        + F.col("open_escalated") / total * waiting
        + slow * slowness
        + F.least(F.lit(1.0), total / F.lit(fixed.MANY_TICKETS)) * many
    )
    return counts.select(
        "account_id",
        rnd(score, 3).alias("ticket_risk_score"),
        "total_tickets",
        "p1_p2_tickets",
        "open_escalated",
        rnd(hours, 1).alias("avg_resolution_hours"),
        "recent_ticket_count",
    )


# ---- survey ----------------------------------------------------------------------------------

def nps_base_risk(score: Column) -> Column:
    (low, low_risk, low_step), (mid, mid_risk, mid_step), (top, _, step) = fixed.NPS_BANDS
    return (
        F.when(score <= low, F.lit(low_risk) + (F.lit(low) - score) * F.lit(low_step))
        .when(score <= mid, F.lit(mid_risk) + (F.lit(mid) - score) * F.lit(mid_step))
        .otherwise(F.lit(step) * (F.lit(top) - score))
    )


def last_per_account(annotations: DataFrame, columns: list[str], order: str) -> DataFrame:
    """One annotation per account: the last one in ``order``."""
    return annotations.groupBy("account_id").agg(
        F.max(F.struct(order, *columns)).alias("a")
    ).select("account_id", *[F.col(f"a.{c}").alias(c) for c in columns])


def _translations(translations: DataFrame) -> DataFrame:
    supplied = last_per_account(translations, ["translated", "language"], "seq")
    return supplied.withColumn("has_translation", F.lit(True))


def _translation_columns() -> list[Column]:
    comment = F.col("verbatim_comment")
    return [
        F.when(F.col("has_translation"), F.coalesce("translated", comment, F.lit("")))
        .otherwise(comment).alias("translated_comment"),
        F.when(F.col("has_translation"), F.coalesce("language", F.lit("unknown")))
        .otherwise(F.lit("English")).alias("detected_language"),
    ]


def translated_nps(nps: DataFrame, translations: DataFrame | None = None) -> DataFrame:
    """Survey rows with the translated comment and its language where one was supplied.

    ``translations``: account_id, seq, translated, language; the last per account counts.
    """
    if translations is None:
        return nps.select(
            "*",
            F.col("verbatim_comment").alias("translated_comment"),
            F.lit("English").alias("detected_language"),
        )
    joined = left_join_lookup(nps, _translations(translations), "account_id")
    return joined.select(*nps.columns, *_translation_columns())


def nps_comments_to_annotate(
    nps: DataFrame, translations: DataFrame | None = None, min_length: int = 6
) -> DataFrame:
    """The survey comments worth a sentiment annotation: those longer than a few characters."""
    text = F.coalesce(missing_text(F.col("translated_comment")), F.col("verbatim_comment"))
    return (
        translated_nps(nps, translations)
        .select("account_id", "score", text.alias("comment"))
        .filter(F.length(F.trim("comment")) >= min_length)
    )


def nps_signals(
    nps: DataFrame,
    translations: DataFrame | None = None,
    sentiments: DataFrame | None = None,
    unique: bool = False,
) -> DataFrame:
    """Survey risk, one output row per survey row.

    ``sentiments``: account_id, seq, sentiment, score_contradicts, risk_boost. ``unique``
    promises at most one survey row per account, so that no account can be hot.
    """
    rows = nps.filter(F.col("account_id").isNotNull())
    supplied = []
    boost, mood, contradicts = F.lit(0.0), F.lit("neutral"), F.lit(False)
    comment, language = F.col("verbatim_comment").alias("translated_comment"), F.lit(
        "English").alias("detected_language")
    if translations is not None:
        supplied.append(_translations(translations))
        comment, language = _translation_columns()
    if sentiments is not None:
        supplied.append(last_per_account(
            sentiments, ["sentiment", "score_contradicts", "risk_boost"], "seq"))
        boost = F.coalesce("risk_boost", F.lit(0.0))
        mood = F.coalesce("sentiment", F.lit("neutral"))
        contradicts = F.coalesce("score_contradicts", F.lit(False))
    if supplied:
        # both annotations, one row per account each, meet before the many survey rows join them
        annotations = reduce(lambda a, b: a.join(b, "account_id", "full"), supplied)
        rows = (rows.join(annotations, "account_id", "left") if unique
                else left_join_lookup(rows, annotations, "account_id"))
    base = nps_base_risk(F.col("score"))
    return rows.select(
        "account_id",
        # a missing score has no risk; greatest/least would skip the null
        F.when(F.col("score").isNotNull(), rnd(clip01(base + boost), 3)).alias("nps_risk_score"),
        F.col("score").alias("nps_score"),
        F.col("verbatim_comment").alias("nps_comment"),
        comment,
        language,
        mood.alias("comment_sentiment"),
        contradicts.alias("sentiment_score_mismatch"),
    )


def latest_nps(nps: DataFrame, order: str) -> DataFrame:
    """Optional: one survey row per account, the last one in ``order``."""
    others = [c for c in nps.columns if c not in ("account_id", order)]
    return nps.groupBy("account_id").agg(
        F.max(F.struct(order, *others)).alias("r")
    ).select("account_id", *[F.col(f"r.{c}").alias(c) for c in others])


def non_latin_comments(
    nps: DataFrame, column: str = "verbatim_comment", max_codepoint: int = 255
) -> DataFrame:
    """Survey rows whose comment holds a character beyond ``max_codepoint``."""
    return nps.filter(F.col(column).rlike(rf"[^\x{{0}}-\x{{{max_codepoint:X}}}]"))


# ---- note analysis ---------------------------------------------------------------------------

def csm_signals(analyses: DataFrame) -> DataFrame:
    """Note-analysis columns from validated analyses, one row per account.

    An empty input gives an empty frame of the same type.
    """
    return analyses.select(
        "account_id",
        F.col("risk_score").alias("csm_risk_score"),
        F.col("sentiment").alias("csm_sentiment"),
        F.array_join("competitor_mentions", ", ").alias("competitor_mentions"),
        "champion_status",
        F.array_join("key_concerns", "; ").alias("key_concerns"),
        F.array_join("recommended_actions", "; ").alias("csm_recommended_actions"),
        F.col("summary").alias("csm_summary"),
    )
