"""Entity resolution: free-text names to account ids, in tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctrisk.functions.columns import missing_text
from acctrisk.functions.lineage import materialise
from acctrisk.functions.skew import left_join_lookup, left_join_open
from acctrisk.functions.similarity import best_matches, token_sort

MIN_FUZZY_LENGTH = 3


def name_lookup(accounts: DataFrame, order: str = "account_id") -> DataFrame:
    """One row per case-insensitive account name.

    ``account_id`` and ``account_name`` come from the last account of that name in ``order``,
    ``first_name`` and ``first_order`` from the first.
    """
    return (
        accounts.filter(F.col("account_name").isNotNull())
        .groupBy(F.lower("account_name").alias("name_key"))
        .agg(
            F.max(F.struct(F.col(order).alias("o"), "account_id", "account_name")).alias("l"),
            F.min(F.struct(F.col(order).alias("o"), "account_name")).alias("f"),
        )
        .select(
            "name_key", "l.account_id", "l.account_name",
            F.col("f.account_name").alias("first_name"), F.col("f.o").alias("first_order"))
    )


def fuzzy_match(names: DataFrame, lookup: DataFrame, threshold: int = 65) -> DataFrame:
    """The most similar account name of each query name, if similar enough.

    ``names``: column ``query``. Similarity looks at lower-cased names with their words sorted,
    so equal spellings are matched once. Ties go to the earliest account.
    """
    queries = names.filter(F.length("query") >= MIN_FUZZY_LENGTH).select(
        "query", token_sort(F.lower("query")).alias("sorted"))
    canonical = (
        lookup.groupBy(token_sort(F.col("name_key")).alias("sorted"))
        .agg(F.min(F.struct("first_order", "first_name", "account_id")).alias("f"))
    )
    hits = best_matches(queries.select("sorted").distinct(), canonical, threshold)
    best = F.min(F.struct((-F.col("score")).alias("s"), "f"))
    found = hits.join(canonical, "sorted").groupBy("a").agg(best.alias("m")).select(
        F.col("a").alias("sorted"), F.col("m.f.first_name").alias("match_name"),
        "m.f.account_id", (-F.col("m.s")).alias("score"))
    return queries.join(found, "sorted").select("query", "match_name", "account_id", "score")


def valid_matches(matches: DataFrame, accounts: DataFrame) -> DataFrame:
    """External matches that name an existing account with high or medium confidence.

    Of several for one input name the more confident one counts, then the smaller id.
    """
    rank = F.when(F.col("confidence") == "high", 1).when(F.col("confidence") == "medium", 2)
    known = accounts.select(F.col("account_id").alias("matched_id"), "account_name")
    return (
        matches.withColumn("rank", rank).filter(F.col("rank").isNotNull())
        .select("input_name", F.col("matched_id").cast("bigint").alias("matched_id"), "rank")
        .join(known, "matched_id")
        .groupBy("input_name")
        .agg(F.min(F.struct("rank", "matched_id", "account_name")).alias("m"))
        .select("input_name", "m.matched_id", "m.account_name")
    )


def reconcile(
    notes: DataFrame,
    accounts: DataFrame,
    matches: DataFrame | None = None,
    threshold: int = 65,
    order: str = "account_id",
    all_or_nothing: bool = True,
) -> DataFrame:
    """Give every note its account: by id, exact name, external match or similar name.

    ``notes`` holds account_id and account_name as found in the text; ``accounts`` one row per
    id. A note no tier resolves keeps what it has. External matches that lack a row for any name
    still open are ignored as a whole, unless ``all_or_nothing`` is switched off. The tiers run on
    the distinct (id, name) pairs, so an account that a third of all notes mention is resolved once; the notes
    themselves are joined a single time.
    """
    kept = [c for c in notes.columns if c not in ("account_id", "account_name")]
    # pairs as structs are equal where both lack the same part
    keyed = notes.select(*kept, F.struct("account_id", "account_name").alias("pair"))
    pairs = keyed.select("pair").distinct().select("pair.*")
    by_id = accounts.select(
        F.col("account_id").alias("id_key"), F.col("account_name").alias("id_name"),
        F.lit(True).alias("by_id"))
    lookup = name_lookup(accounts, order)
    by_name = lookup.select(
        F.col("name_key").alias("exact_key"), F.col("account_id").alias("exact_id"),
        F.col("account_name").alias("exact_name"))
    tiers = left_join_open(pairs, by_id, F.col("account_id"), "id_key").drop("id_key")
    name = missing_text(F.col("account_name"))
    tiers = left_join_open(
        tiers, by_name, F.when(F.col("by_id").isNull(), F.lower(name)), "exact_key")
    unsettled = F.col("by_id").isNull() & F.col("exact_id").isNull()
    if matches is None:
        tiers = tiers.withColumns({
            "ext_id": F.lit(None).cast("bigint"), "ext_name": F.lit(None).cast("string")})
    else:
        external = valid_matches(matches, accounts).select(
            "input_name", F.col("matched_id").alias("ext_id"),
            F.col("account_name").alias("ext_name"))
        asked = F.when(unsettled, name)
        if all_or_nothing:
            answered = matches.select(F.col("input_name").alias("query")).distinct()
            unanswered = tiers.select(asked.alias("query")).filter("query IS NOT NULL").join(
                answered, "query", "left_anti")
            complete = unanswered.agg(F.count(F.lit(1)) == 0).scalar()
            external = external.withColumn("complete", complete).filter("complete")
        tiers = left_join_open(tiers, external, asked, "input_name")
    open_name = F.when(unsettled & F.col("ext_id").isNull(), name)
    open_names = tiers.select(open_name.alias("query")).filter("query IS NOT NULL").distinct()
    fuzzy = fuzzy_match(open_names, lookup, threshold).select(
        "query", F.col("account_id").alias("fuzzy_id"), "match_name")
    tiers = left_join_open(tiers, fuzzy, open_name, "query")

    def first(*found: tuple[str, Column]) -> Column:
        column = F.when(F.col(found[0][0]).isNotNull(), found[0][1])
        for key, value in found[1:]:
            column = column.when(F.col(key).isNotNull(), value)
        return column

    resolved = tiers.select(
        F.struct("account_id", "account_name").alias("pair"),
        first(("by_id", F.col("account_id")), ("exact_id", F.col("exact_id")),
              ("ext_id", F.col("ext_id")), ("fuzzy_id", F.col("fuzzy_id")),
              ("account_id", F.col("account_id"))).alias("new_id"),
        first(("by_id", F.col("id_name")), ("exact_id", F.col("exact_name")),
              ("ext_id", F.col("ext_name")), ("fuzzy_id", F.col("match_name")),
              ("account_name", F.col("account_name"))).alias("new_name"),
        first(("by_id", F.lit("id")), ("exact_id", F.lit("exact")),
              ("ext_id", F.lit("external")), ("fuzzy_id", F.lit("fuzzy")))
        .otherwise(F.lit("none")).alias("match_method"),
    )
    return left_join_lookup(keyed, resolved, "pair", hot_rows=None).select(
        *kept, F.col("new_id").alias("account_id"), F.col("new_name").alias("account_name"),
        "match_method")


def match_rate(reconciled: DataFrame) -> DataFrame:
    """How many notes carry an account id after all tiers."""
    matched = F.count("account_id")
    return reconciled.agg(
        matched.alias("n_matched"), F.count(F.lit(1)).alias("n_notes"),
        F.try_divide(matched, F.count(F.lit(1))).alias("match_rate"))


# Notes of an account that make up one text.
SEGMENT_NOTES = 1000
# Characters by which notes of one account, file and number are dealt over tasks in order.
HEAD = 256
# Numbers of rows within a task, as monotonically_increasing_id counts them.
_TASK_BITS = 33


def in_note_order(notes: DataFrame) -> DataFrame:
    """account_id, raw_text and place, which ascends in note order; written to the shared folder.

    The order is that of account, file (if there is one), number (null first) and text; texts
    alike in their first characters come in the order of a hash. Equal notes are dealt over tasks
    by a number of their own, so no account, file or number is too large for a task.
    """
    keys = ["account_id", *(["file"] if "file" in notes.columns else []), "note_idx"]
    rows = notes.filter(F.col("account_id").isNotNull()).select(
        *keys, "raw_text", F.monotonically_increasing_id().alias("row"))
    order = [*keys, F.left("raw_text", F.lit(HEAD)), F.xxhash64("raw_text"), "row"]
    return materialise(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("account_id", "raw_text", F.monotonically_increasing_id().alias("place")))


def notes_by_account(
    notes: DataFrame, accounts: DataFrame | None = None, segment_notes: int = SEGMENT_NOTES
) -> DataFrame:
    """The notes of each account as texts, in note order, with blank lines in between.

    Every account comes in segments of ``segment_notes`` notes, numbered from 0, whose texts in
    order make up the whole; most accounts have the one. Notes are ordered by file, number (nulls
    first) and text. They are range sorted; an account's slices of the sorted tasks are counted,
    and running sums over these counts give every note its place within the account. So neither an
    account nor a note number is ever ordered or gathered in one task, and no text is longer
    than its segment.
    """
    placed = in_note_order(notes).withColumn("slice", F.shiftright("place", _TASK_BITS))
    earlier = Window.partitionBy("account_id").orderBy("slice").rowsBetween(
        Window.unboundedPreceding, -1)
    slices = placed.groupBy("account_id", "slice").agg(
        F.min("place").alias("base"), F.count(F.lit(1)).alias("n")).select(
        "account_id", "slice", "base", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    at = F.col("before") + F.col("place") - F.col("base")
    texts = (
        placed.join(slices, ["account_id", "slice"])
        .groupBy("account_id", F.floor(at / segment_notes).alias("segment"))
        .agg(
            F.count(F.lit(1)).alias("n_notes"),
            F.sort_array(F.collect_list(F.struct("place", "raw_text"))).alias("t"))
        .select("account_id", "segment", "n_notes",
                F.array_join(F.col("t.raw_text"), "\n\n").alias("notes_text"))
    )
    if accounts is None:
        return texts
    fallback = F.concat(F.lit("Account "), F.col("account_id").cast("string"))
    return texts.join(accounts.select("account_id", "account_name"), "account_id", "left").select(
        "account_id", F.coalesce("account_name", fallback).alias("account_name"),
        "segment", "n_notes", "notes_text")
