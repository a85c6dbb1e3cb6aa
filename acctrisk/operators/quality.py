"""Data quality: schema checks, value repairs, counters and cross-table checks."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctrisk import fixed
from acctrisk.functions.columns import is_true

REPORT_SCHEMA = (
    "source string, is_valid boolean, errors array<string>, warnings array<string>, "
    "rows_before bigint, rows_after bigint"
)


# ---- schema ----------------------------------------------------------------------------------

def missing_columns(df: DataFrame, source: str) -> list[str]:
    """Required columns a frame lacks; looks at the schema only."""
    return [c for c in fixed.REQUIRED_COLUMNS[source] if c not in df.columns]


# ---- repairs ---------------------------------------------------------------------------------

def dedupe_accounts(accounts: DataFrame, order: str, copies: str | None = None) -> DataFrame:
    """Keep the first row of each account id in ``order``, which must be unique.

    A minimum combines on the map side, so a heavily repeated id costs one row per task.
    ``copies`` names a column for the number of rows the id had.
    """
    others = [c for c in accounts.columns if c not in ("account_id", order)]
    kept = accounts.groupBy("account_id").agg(
        F.min(F.struct(order, *others)).alias("r"), F.count(F.lit(1)).alias("n"))
    counted = [F.col("n").alias(copies)] if copies else []
    return kept.select(
        *["account_id" if c == "account_id" else F.col(f"r.{c}").alias(c)
          for c in accounts.columns], *counted)


def clamp_arr(accounts: DataFrame) -> DataFrame:
    return accounts.withColumn(
        "arr", F.when(F.col("arr") < 0, F.lit(0).cast("bigint")).otherwise(F.col("arr")))


def clamp_usage(usage: DataFrame) -> DataFrame:
    present = [m for m in fixed.USAGE_METRICS if m in usage.columns]
    return usage.withColumns({
        m: F.when(F.col(m) < 0, F.lit(0).cast(usage.schema[m].dataType)).otherwise(F.col(m))
        for m in present
    })


def clamp_nps(nps: DataFrame) -> DataFrame:
    score = F.col("score")
    kind = nps.schema["score"].dataType
    return nps.withColumn(
        "score",
        F.when(score < 0, F.lit(0).cast(kind)).when(score > 10, F.lit(10).cast(kind))
        .otherwise(score))


# ---- checks with their own result -------------------------------------------------------------

def unknown_values(accounts: DataFrame, tickets: DataFrame) -> DataFrame:
    """Every value outside its domain with its row count; null counts as a value.

    A relation rather than one list, so any number of bad values stays distributed.
    """
    checks = [
        (accounts, "accounts", "plan_tier", fixed.PLAN_TIERS),
        (tickets, "tickets", "priority", fixed.PRIORITIES),
        (tickets, "tickets", "status", fixed.STATUSES),
    ]
    parts = [
        df.filter(~is_true(F.col(column).isin(domain)))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(source).alias("source"), F.lit(column).alias("field"), "value", "n_rows")
        for df, source, column, domain in checks
    ]
    return reduce(DataFrame.unionAll, parts)


def duplicate_ids(df: DataFrame) -> DataFrame:
    """Account ids that occur more than once, with the number of surplus rows."""
    return (
        df.groupBy("account_id").agg((F.count(F.lit(1)) - 1).alias("surplus_rows"))
        .filter(F.col("surplus_rows") > 0)
    )


def sparse_accounts(usage: DataFrame, min_months: int = 3) -> DataFrame:
    """Accounts with fewer distinct months than a trend needs."""
    return (
        usage.filter(F.col("account_id").isNotNull())
        .groupBy("account_id").agg(F.countDistinct("month").alias("n_months"))
        .filter(F.col("n_months") < min_months)
    )


def orphan_ids(facts: DataFrame, accounts: DataFrame) -> DataFrame:
    """Distinct fact account ids that no account has; rows without an id are no orphans."""
    return facts.filter(F.col("account_id").isNotNull()).select("account_id").distinct().join(
        accounts.select("account_id"), "account_id", "left_anti")


def orphan_report(facts: dict[str, DataFrame], accounts: DataFrame, show: int = 5) -> DataFrame:
    """Per source: how many orphan ids there are and the smallest few of them.

    The distinct orphans are found once. They are dealt into as many buckets as there are shuffle
    partitions, each of which gives its count and its smallest ids; only these are put together.
    """
    spark = accounts.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    every = reduce(DataFrame.unionAll, [
        orphan_ids(df, accounts).select(F.lit(source).alias("source"), "account_id")
        for source, df in facts.items()])
    bucket = Window.partitionBy("source", F.pmod(F.xxhash64("account_id"), F.lit(buckets)))
    few = every.select(
        "source", "account_id", F.count(F.lit(1)).over(bucket).alias("n"),
        F.row_number().over(bucket.orderBy("account_id")).alias("at")).filter(F.col("at") <= show)
    found = few.groupBy("source").agg(
        F.sum(F.when(F.col("at") == 1, F.col("n"))).alias("n"),
        F.slice(F.sort_array(F.collect_list("account_id")), 1, show).alias("ids"))
    sources = spark.range(1).select(
        F.explode(F.array(*[F.lit(source) for source in facts])).alias("source"))
    return sources.join(found, "source", "left").select(
        "source",
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n_orphans"),
        F.coalesce(F.array_join("ids", ", "), F.lit("")).alias("smallest_ids"))


# ---- counters and report ----------------------------------------------------------------------

def account_counters(accounts: DataFrame, as_of: date) -> DataFrame:
    """All account checks in one pass over deduplicated accounts and their ``copies``."""
    arr = F.col("arr")
    stale = F.date_sub(F.lit(as_of), fixed.STALE_CONTRACT_DAYS)
    return accounts.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum("copies"), F.lit(0)).alias("before"),
        F.count_if(F.col("account_name").isNull()).alias("missing_name"),
        F.count_if(arr < 0).alias("negative_arr"),
        F.count_if(arr <= 0).alias("zero_arr"),
        F.count_if(F.col("contract_end_date") < stale).alias("stale_contract"),
        F.count_if(~is_true(F.col("plan_tier").isin(fixed.PLAN_TIERS))).alias("unknown_plan"),
    )


def _totals(
    per_account: DataFrame, accounts: DataFrame | None = None, show: int = 5
) -> DataFrame:
    """Sums of all counters per account; with ``accounts`` also the orphans, in the same pass.

    ``per_account``: account_id, which may be null, and counters. Ids are dealt into as many
    buckets as there are shuffle partitions, so that each task hands on its smallest orphans only.
    """
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in per_account.columns
            if c != "account_id"]
    if accounts is None:
        return per_account.agg(*sums)
    known = accounts.select("account_id", F.lit(True).alias("_known"))
    orphan = F.col("account_id").isNotNull() & F.col("_known").isNull()
    buckets = int(accounts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.xxhash64("account_id"), F.lit(buckets))
    ranked = per_account.join(known, "account_id", "left").withColumn("_orphan", orphan).withColumn(
        "_at", F.row_number().over(Window.partitionBy(bucket, "_orphan").orderBy("account_id")))
    smallest = F.collect_list(F.when(F.col("_orphan") & (F.col("_at") <= show), F.col("account_id")))
    return ranked.agg(
        *sums, F.count_if("_orphan").alias("n_orphans"),
        F.array_join(F.slice(F.sort_array(smallest), 1, show), ", ").alias("smallest_ids"))


def usage_counters(
    usage: DataFrame, min_months: int = 3, accounts: DataFrame | None = None
) -> DataFrame:
    """All usage checks in one pass: per account and month, per account, in total."""
    good_version = is_true(F.col("sdk_version").rlike(fixed.SDK_VERSION_PATTERN))
    checks = {
        "rows": F.count(F.lit(1)),
        **{f"negative_{m}": F.count_if(F.col(m) < 0)
           for m in fixed.USAGE_METRICS if m in usage.columns},
        "extreme_api_calls": F.count_if(F.col("api_calls") > fixed.MAX_API_CALLS),
        "invalid_sdk_version": F.count_if(~good_version),
    }
    per_account = (
        usage.groupBy("account_id", "month")
        .agg(*[column.alias(name) for name, column in checks.items()])
        .groupBy("account_id").agg(
            *[F.sum(name).alias(name) for name in checks], F.count("month").alias("n_months"))
    )
    sparse = F.col("account_id").isNotNull() & (F.col("n_months") < min_months)
    return _totals(
        per_account.withColumn("sparse", sparse.cast("bigint")).drop("n_months"), accounts)


def ticket_counters(tickets: DataFrame, accounts: DataFrame | None = None) -> DataFrame:
    """All ticket checks in one pass."""
    checks = [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~is_true(F.col("priority").isin(fixed.PRIORITIES))).alias("unknown_priority"),
        F.count_if(~is_true(F.col("status").isin(fixed.STATUSES))).alias("unknown_status"),
    ]
    if "resolution_time_hours" in tickets.columns:
        hours = F.col("resolution_time_hours")
        checks += [
            F.count_if(hours < 0).alias("negative_resolution"),
            F.count_if(hours > fixed.MAX_RESOLUTION_HOURS).alias("long_resolution"),
        ]
    if accounts is None:
        return tickets.agg(*checks)
    return _totals(tickets.groupBy("account_id").agg(*checks), accounts)


def nps_counters(nps: DataFrame, accounts: DataFrame | None = None) -> DataFrame:
    """All survey checks: one count per account, then one row."""
    score = F.col("score")
    empty = (
        F.count_if(F.col("verbatim_comment") == "") if "verbatim_comment" in nps.columns
        else F.count_if(F.lit(False))
    )
    per_account = nps.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if((score < 0) | (score > 10)).alias("out_of_range"),
        empty.alias("empty_comment"),
    )
    return _totals(per_account.withColumn("duplicates", F.col("rows") - 1), accounts)


def _orphan_warning() -> Column:
    return F.concat(
        F.col("n_orphans").cast("string"), F.lit(" account IDs in "), F.col("source"),
        F.lit(" not found in accounts.csv: ["), F.col("smallest_ids"), F.lit("]..."))


def _report(counters: DataFrame, source: str, rows_before, messages: list) -> DataFrame:
    """Report rows from one row of counters; a check is listed only when it counted rows.

    Counters that know of orphans give a second row if there are any.
    """
    listed = [
        F.when(F.col(name) > 0, F.concat(
            F.lit(head), F.col(name).cast("string"), F.lit(tail)))
        for name, head, tail in messages
    ]
    none, zero = F.array().cast("array<string>"), F.lit(0).cast("bigint")

    def row(name: Column, warnings: Column, before: Column, after: Column) -> Column:
        return F.struct(
            name.alias("source"), F.lit(True).alias("is_valid"), none.alias("errors"),
            warnings.alias("warnings"), before.alias("rows_before"), after.alias("rows_after"))

    rows = [row(F.lit(fixed.SOURCE_FILES[source]), F.array_compact(F.array(*listed)),
                rows_before.cast("bigint"), F.col("rows"))]
    if "n_orphans" in counters.columns:
        counters = counters.withColumn("source", F.lit(source))
        rows.append(F.when(F.col("n_orphans") > 0, row(
            F.lit(f"{source} (cross-ref)"), F.array(_orphan_warning()), zero, zero)))
    return counters.select(F.inline(F.array_compact(F.array(*rows))))


def _invalid(
    df: DataFrame, source: str, missing: list[str], accounts: DataFrame | None = None
) -> DataFrame:
    errors = [f"Missing required column: {c}" for c in missing]
    report = df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(fixed.SOURCE_FILES[source]).alias("source"),
        F.lit(False).alias("is_valid"),
        F.array(*[F.lit(e) for e in errors]).alias("errors"),
        F.array().cast("array<string>").alias("warnings"),
        F.col("rows").alias("rows_before"),
        F.col("rows").alias("rows_after"),
    )
    if accounts is None or "account_id" not in df.columns:
        return report
    return report.unionByName(cross_reference_report({source: df}, accounts))


def validate_accounts(
    accounts: DataFrame, as_of: date, order: str = "ingest_order"
) -> tuple[DataFrame, DataFrame]:
    """Repaired accounts and their report.

    The ``order`` column decides which copy of an id is kept and stays in the result; without one
    any single copy is kept.
    """
    missing = missing_columns(accounts, "accounts")
    if missing:
        return accounts, _invalid(accounts, "accounts", missing)
    ordered = order in accounts.columns
    if not ordered:
        accounts = accounts.withColumn(order, F.struct(*accounts.columns))
    kept = dedupe_accounts(accounts, order, copies="copies")
    counters = account_counters(kept, as_of).withColumn(
        "duplicates", F.col("before") - F.col("rows"))
    report = _report(counters, "accounts", F.col("before"), [
        ("duplicates", "Duplicate account IDs found: ", " rows. Keeping first occurrence."),
        ("missing_name", "", " accounts missing account_name"),
        ("negative_arr", "", " accounts have negative ARR. Setting to 0."),
        ("zero_arr", "", " accounts have zero ARR (free tier?)"),
        ("stale_contract", "",
         " accounts have contract_end_date > 1 year in the past (stale data)"),
        ("unknown_plan", "Unknown plan tiers: ", " rows"),
    ])
    return clamp_arr(kept.drop("copies") if ordered else kept.drop(order, "copies")), report


def validate_usage(
    usage: DataFrame, accounts: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Repaired usage rows and their report, with ``accounts`` also on ids that none of them has."""
    missing = missing_columns(usage, "usage")
    if missing:
        return usage, _invalid(usage, "usage", missing, accounts)
    messages = [
        (f"negative_{m}", "", f" rows have negative {m}. Clamping to 0.")
        for m in fixed.USAGE_METRICS if m in usage.columns
    ]
    messages += [
        ("extreme_api_calls", "", " rows have api_calls > 10M (potential data entry error)"),
        ("invalid_sdk_version", "", " rows have invalid SDK version format"),
        ("sparse", "", " accounts have < 3 months of data (trends may be unreliable)"),
    ]
    return clamp_usage(usage), _report(
        usage_counters(usage, accounts=accounts), "usage", F.col("rows"), messages)


def validate_tickets(
    tickets: DataFrame, accounts: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Tickets, unchanged, and their report, with ``accounts`` also on unknown ids."""
    missing = missing_columns(tickets, "tickets")
    if missing:
        return tickets, _invalid(tickets, "tickets", missing, accounts)
    messages = [
        ("unknown_priority", "Unknown priority values: ", " rows"),
        ("unknown_status", "Unknown status values: ", " rows"),
    ]
    if "resolution_time_hours" in tickets.columns:
        messages += [
            ("negative_resolution", "", " tickets have negative resolution time"),
            ("long_resolution", "", " tickets have resolution > 30 days (data quality issue?)"),
        ]
    return tickets, _report(ticket_counters(tickets, accounts), "tickets", F.col("rows"), messages)


def validate_nps(
    nps: DataFrame, accounts: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Survey rows with scores clamped to 0..10, and their report as for tickets."""
    missing = missing_columns(nps, "nps")
    if missing:
        return nps, _invalid(nps, "nps", missing, accounts)
    report = _report(nps_counters(nps, accounts), "nps", F.col("rows"), [
        ("out_of_range", "", " NPS scores outside 0-10 range. Clamping."),
        ("duplicates", "", " duplicate NPS responses. Using latest per account."),
        ("empty_comment", "", " NPS responses have no comment"),
    ])
    return clamp_nps(nps), report


def cross_reference_report(facts: dict[str, DataFrame], accounts: DataFrame) -> DataFrame:
    """Report rows for the sources that refer to unknown accounts."""
    found = orphan_report(facts, accounts).filter(F.col("n_orphans") > 0)
    return found.select(
        F.concat("source", F.lit(" (cross-ref)")).alias("source"),
        F.lit(True).alias("is_valid"),
        F.array().cast("array<string>").alias("errors"),
        F.array(_orphan_warning()).alias("warnings"),
        F.lit(0).cast("bigint").alias("rows_before"),
        F.lit(0).cast("bigint").alias("rows_after"),
    )


def validate_all(
    accounts: DataFrame, usage: DataFrame, tickets: DataFrame, nps: DataFrame, as_of: date,
    order: str = "ingest_order",
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Repaired relations and one report relation for all of them.

    Each of the fact sources is read once for its report: counters per account meet the known
    accounts, and what comes out are the sums and the orphans.
    """
    clean_accounts, r1 = validate_accounts(accounts, as_of, order)
    ids = clean_accounts.select("account_id") if "account_id" in accounts.columns else None
    clean_usage, r2 = validate_usage(usage, ids)
    clean_tickets, r3 = validate_tickets(tickets, ids)
    clean_nps, r4 = validate_nps(nps, ids)
    report = reduce(DataFrame.unionByName, [r1, r2, r3, r4])
    return {"accounts": clean_accounts, "usage": clean_usage, "tickets": clean_tickets,
            "nps": clean_nps}, report


def pipeline_counters(nps_frame: DataFrame, sdk_frame: DataFrame) -> DataFrame:
    """Run counters: rows per frame, translated comments, accounts on a v3 SDK."""
    v3 = is_true(F.col("sdk_version").startswith("v3"))
    sdk = sdk_frame.agg(
        F.count(F.lit(1)).alias("sdk_accounts"), F.count_if(v3).alias("v3_accounts"))
    nps = nps_frame.agg(
        F.count(F.lit(1)).alias("nps_rows"),
        F.count_if(F.col("detected_language") != "English").alias("translated_comments"))
    return reduce(DataFrame.unionAll, [
        counts.unpivot([], counts.columns, "counter", "n") for counts in (sdk, nps)])
