"""Every registered query: operator calls over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctrisk import fixed
from acctrisk.functions.lineage import materialise, shared_folder
from acctrisk.operators import (
    annotate, backtest, insights, notes, quality, reconcile, report, scoring, signals,
)
from acctrisk.sources import exports, files
from acctrisk.plans import pipeline
from acctrisk.plans.views import PARAMS, view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def dataset(spark: SparkSession, sf_dir: str) -> pipeline.Dataset:
    """The run inputs as views over the given tables."""
    return pipeline.Dataset(
        accounts=view(spark, sf_dir, "accounts_v"),
        usage=view(spark, sf_dir, "usage_v"),
        tickets=view(spark, sf_dir, "tickets_v"),
        nps=view(spark, sf_dir, "nps_v"),
        analyses=view(spark, sf_dir, "analyses_v"),
        translations=view(spark, sf_dir, "translations_v"),
        sentiments=view(spark, sf_dir, "sentiments_v"),
        nps_unique=True,  # documents carry unique ids
        unique_months=True,  # the view groups by account and month
    )


def risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.score_dataset(dataset(spark, sf_dir), PARAMS)


# ---- sources ---------------------------------------------------------------------------------

def _as_csv(spark, df) -> str:
    """Write a view as CSV into the shared folder, to be read by a loader."""
    path = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    exports.write_csv(df, path)
    return path


@query
def load_accounts(spark, sf_dir):
    return files.load_accounts(spark, _as_csv(spark, view(spark, sf_dir, "accounts_v")))


@query
def load_usage(spark, sf_dir):
    return files.load_usage_metrics(spark, _as_csv(spark, view(spark, sf_dir, "raw_usage_v")))


@query
def load_tickets(spark, sf_dir):
    """Unresolved tickets have a resolution time that is no number."""
    tickets = view(spark, sf_dir, "tickets_v")
    text = F.coalesce(F.col("resolution_time_hours").cast("string"), F.lit("n/a"))
    path = _as_csv(spark, tickets.withColumn("resolution_time_hours", text))
    return files.load_support_tickets(spark, path)


@query
def load_nps(spark, sf_dir):
    nps = view(spark, sf_dir, "raw_nps_v").select("account_id", "score", "verbatim_comment")
    return files.load_nps_responses(spark, _as_csv(spark, nps))


def _as_text(spark, df) -> str:
    """Write the texts of a one-column frame as text files into the shared folder."""
    path = f"{shared_folder(spark)}/text-{uuid.uuid4().hex}"
    df.write.text(path)
    return path


@query
def load_notes(spark, sf_dir):
    """Notes of text files that hold many each; which file a note is in depends on the writer."""
    notes_text = view(spark, sf_dir, "part_notes_v").select(
        F.concat("raw_text", F.lit("\n---")))
    return files.load_notes(spark, _as_text(spark, notes_text)).select(
        "raw_text", "account_id", "account_name")


@query
def load_conversation_notes(spark, sf_dir):
    """The same from all turns of the given dialogues."""
    turns = view(spark, sf_dir, "notes_v").select(F.concat("raw_text", F.lit("\n-----")))
    return files.load_notes(spark, _as_text(spark, turns)).select("raw_text", "account_id")


@query
def load_changelog(spark, sf_dir):
    logs = view(spark, sf_dir, "part_changelogs_v").select("value")
    entries = files.load_changelog(spark, _as_text(spark, logs))
    return entries.select(
        "version", "date", "category", "description",
        F.array_join("affected_versions", "|").alias("affected_versions"), "deadline")


# ---- notes and names -------------------------------------------------------------------------

@query
def split_notes(spark, sf_dir):
    return notes.split_notes(view(spark, sf_dir, "part_files_v"))


@query
def split_notes_keep_banner_note(spark, sf_dir):
    return notes.split_notes(view(spark, sf_dir, "part_files_v"), strip_banner=True)


@query
def note_account_id(spark, sf_dir):
    return view(spark, sf_dir, "part_notes_v").select(
        "note_idx", notes.note_account_id(F.col("raw_text")).alias("account_id"))


@query
def note_account_name(spark, sf_dir):
    return view(spark, sf_dir, "part_notes_v").select(
        "note_idx", notes.note_account_name(F.col("raw_text")).alias("account_name"))


@query
def parse_changelog(spark, sf_dir):
    parsed = notes.parse_changelog(view(spark, sf_dir, "part_changelogs_v"))
    return parsed.withColumn("affected_versions", F.array_join("affected_versions", "|"))


@query
def note_entities(spark, sf_dir):
    found = notes.extract_entities(view(spark, sf_dir, "part_notes_v"))
    return annotate.note_entities(found, view(spark, sf_dir, "note_external_v"))


@query
def note_entities_unaligned(spark, sf_dir):
    """External entities that miss some notes are ignored as a whole."""
    found = notes.extract_entities(view(spark, sf_dir, "part_notes_v"))
    external = view(spark, sf_dir, "note_external_v").filter("csm_name <> ''")
    return annotate.note_entities(found, external)


@query
def name_lookup(spark, sf_dir):
    return reconcile.name_lookup(view(spark, sf_dir, "part_accounts_v"))


@query
def fuzzy_match(spark, sf_dir):
    lookup = reconcile.name_lookup(view(spark, sf_dir, "named_accounts_v"))
    return reconcile.fuzzy_match(view(spark, sf_dir, "misspelt_v"), lookup)


def _reconciled(spark, sf_dir, all_or_nothing=False):
    found = notes.extract_entities(view(spark, sf_dir, "part_notes_v"))
    return reconcile.reconcile(
        found, view(spark, sf_dir, "named_accounts_v"), view(spark, sf_dir, "name_matches_v"),
        all_or_nothing=all_or_nothing)


@query
def reconcile_notes(spark, sf_dir):
    return _reconciled(spark, sf_dir)


@query
def reconcile_notes_strict(spark, sf_dir):
    """External matches count only if they answer for every open name, as by default."""
    return _reconciled(spark, sf_dir, all_or_nothing=True)


@query
def reconcile_by_id(spark, sf_dir):
    return _reconciled(spark, sf_dir).filter("match_method = 'id'").select(
        "note_idx", "account_id", "account_name")


@query
def reconcile_exact(spark, sf_dir):
    return _reconciled(spark, sf_dir).filter("match_method = 'exact'").select(
        "note_idx", "account_id", "account_name")


@query
def reconcile_annotated(spark, sf_dir):
    return _reconciled(spark, sf_dir).filter("match_method = 'external'").select(
        "note_idx", "account_id", "account_name")


@query
def reconcile_rate(spark, sf_dir):
    return reconcile.match_rate(_reconciled(spark, sf_dir))


@query
def notes_by_account(spark, sf_dir):
    return reconcile.notes_by_account(
        view(spark, sf_dir, "notes_v"), view(spark, sf_dir, "accounts_v"))


@query
def reconciled_notes_by_account(spark, sf_dir):
    return reconcile.notes_by_account(
        _reconciled(spark, sf_dir), view(spark, sf_dir, "named_accounts_v"))


# ---- signals ---------------------------------------------------------------------------------

@query
def usage_signals(spark, sf_dir):
    return signals.usage_signals(view(spark, sf_dir, "usage_v"), unique_months=True)


@query
def usage_signals_any_rows(spark, sf_dir):
    """Any number of rows per account and month: here every order is a usage row."""
    return signals.usage_signals(view(spark, sf_dir, "order_usage_v"))


@query
def latest_usage(spark, sf_dir):
    return signals.latest_usage(view(spark, sf_dir, "usage_v"))


@query
def sdk_risk(spark, sf_dir):
    return signals.sdk_risk(view(spark, sf_dir, "usage_v"))


@query
def engagement_signals(spark, sf_dir):
    return signals.engagement_signals(
        view(spark, sf_dir, "usage_v"), view(spark, sf_dir, "accounts_v"))


@query
def ticket_signals(spark, sf_dir):
    return signals.ticket_signals(view(spark, sf_dir, "tickets_v"), PARAMS)


@query
def nps_signals(spark, sf_dir):
    d = dataset(spark, sf_dir)
    return signals.nps_signals(d.nps, d.translations, d.sentiments)


@query
def csm_signals(spark, sf_dir):
    return signals.csm_signals(annotate.account_analyses(view(spark, sf_dir, "analyses_v")))


# ---- scoring ---------------------------------------------------------------------------------

@query
def merged_signals(spark, sf_dir):
    """All signals of all accounts, window not applied."""
    d = dataset(spark, sf_dir)
    return pipeline.merge_dataset(d, scoring.with_days(d.accounts, PARAMS), PARAMS)


@query
def merged_stand_alone(spark, sf_dir):
    """The same merge from six stand-alone signal frames; three of them read the usage, written once."""
    d = dataset(spark, sf_dir)
    usage = materialise(d.usage)
    merged = scoring.merge_signals(
        scoring.with_days(d.accounts, PARAMS),
        signals.usage_signals(usage),
        signals.ticket_signals(d.tickets, PARAMS),
        signals.nps_signals(d.nps, d.translations, d.sentiments),
        signals.csm_signals(annotate.account_analyses(d.analyses)),
        signals.sdk_risk(usage),
        signals.engagement_signals(usage, d.accounts),
    )
    return scoring.fill_defaults(merged)


@query
def risk_scores(spark, sf_dir):
    return risk(spark, sf_dir)


@query
def renewal_window(spark, sf_dir):
    return scoring.renewal_window(view(spark, sf_dir, "accounts_v"), PARAMS)


@query
def composite_risk(spark, sf_dir):
    return risk(spark, sf_dir).select("account_id", "composite_risk_score", "risk_tier")


@query
def risk_ranking(spark, sf_dir):
    return scoring.rank_by_risk(risk(spark, sf_dir)).select(
        "account_id", "account_name", "composite_risk_score", "risk_tier")


@query
def top_drivers(spark, sf_dir):
    return risk(spark, sf_dir).select("account_id", "top_risk_drivers")


@query
def confidence(spark, sf_dir):
    return risk(spark, sf_dir).select("account_id", "confidence_level")


@query
def risk_summary(spark, sf_dir):
    return scoring.risk_summary(risk(spark, sf_dir))


@query
def tickets_only_risk(spark, sf_dir):
    """Absent signals take their defaults."""
    d = dataset(spark, sf_dir)
    return scoring.composite_risk(
        d.accounts, tickets=signals.ticket_signals(d.tickets, PARAMS), params=PARAMS)


# ---- data quality ----------------------------------------------------------------------------

@query
def dq_dedupe_accounts(spark, sf_dir):
    """Every order registers its customer again; the first registration stays."""
    return quality.dedupe_accounts(view(spark, sf_dir, "registrations_v"), "ingest_order")


@query
def dq_duplicate_ids(spark, sf_dir):
    return quality.duplicate_ids(view(spark, sf_dir, "registrations_v"))


@query
def dq_clamp_arr(spark, sf_dir):
    return quality.clamp_arr(view(spark, sf_dir, "accounts_v")).select("account_id", "arr")


@query
def dq_clamp_usage(spark, sf_dir):
    return quality.clamp_usage(view(spark, sf_dir, "raw_usage_v"))


@query
def dq_clamp_nps(spark, sf_dir):
    return quality.clamp_nps(view(spark, sf_dir, "raw_nps_v"))


@query
def dq_unknown_values(spark, sf_dir):
    return quality.unknown_values(
        view(spark, sf_dir, "accounts_v"), view(spark, sf_dir, "tickets_v"))


@query
def dq_sparse_accounts(spark, sf_dir):
    return quality.sparse_accounts(view(spark, sf_dir, "usage_v"))


@query
def dq_orphan_ids(spark, sf_dir):
    d = dataset(spark, sf_dir)
    # accounts without their in-window part, so that there are orphans at every scale
    rest = scoring.with_days(d.accounts, PARAMS).filter("days_until_renewal > 90")
    facts = {"usage": d.usage, "tickets": d.tickets, "nps": d.nps}
    return quality.orphan_report(facts, rest)


@query
def dq_report(spark, sf_dir):
    report = _validated(spark, sf_dir)[1]
    return report.select(
        "source", "is_valid", F.array_join("errors", " | ").alias("errors"),
        F.array_join("warnings", " | ").alias("warnings"), "rows_before", "rows_after")


def _validated(spark, sf_dir):
    return quality.validate_all(
        view(spark, sf_dir, "registrations_v"), view(spark, sf_dir, "raw_usage_v"),
        view(spark, sf_dir, "tickets_v"), view(spark, sf_dir, "raw_nps_v"),
        as_of=PARAMS.snapshot_date)


@query
def validated_risk(spark, sf_dir):
    """The full run: validate and repair the raw relations, then score them."""
    raw, d = _validated(spark, sf_dir)[0], dataset(spark, sf_dir)
    return pipeline.score_dataset(pipeline.Dataset(
        accounts=quality.clamp_arr(d.accounts), usage=raw["usage"], tickets=raw["tickets"],
        nps=raw["nps"], analyses=d.analyses), PARAMS).select(
            "account_id", "arr", "composite_risk_score", "risk_tier", "top_risk_drivers")


@query
def pipeline_counters(spark, sf_dir):
    d = dataset(spark, sf_dir)
    return quality.pipeline_counters(
        signals.nps_signals(d.nps, d.translations, d.sentiments), signals.sdk_risk(d.usage))


# ---- insights --------------------------------------------------------------------------------

@query
def insight_silent_churn(spark, sf_dir):
    return insights.nps_usage_divergence(risk(spark, sf_dir), min_usage_risk=0.2)


@query
def insight_sdk_cascade(spark, sf_dir):
    return insights.sdk_deprecation_impact(risk(spark, sf_dir))


@query
def insight_champion(spark, sf_dir):
    return insights.champion_at_risk(risk(spark, sf_dir))


@query
def insight_contradiction(spark, sf_dir):
    return insights.score_sentiment_contradictions(risk(spark, sf_dir))


@query
def all_insights(spark, sf_dir):
    return insights.all_insights(risk(spark, sf_dir)).select(
        "category", "account_id", "insight_type")


@query
def insight_counts(spark, sf_dir):
    return insights.insight_counts(risk(spark, sf_dir))


@query
def sdk_distribution(spark, sf_dir):
    return insights.sdk_distribution(risk(spark, sf_dir))


@query
def nps_buckets(spark, sf_dir):
    return insights.nps_buckets(risk(spark, sf_dir))


@query
def industry_risk(spark, sf_dir):
    return insights.industry_risk(risk(spark, sf_dir))


@query
def top15_digest(spark, sf_dir):
    return insights.top_digest(risk(spark, sf_dir))


@query
def dataset_digest(spark, sf_dir):
    return insights.dataset_digest(risk(spark, sf_dir))


@query
def digest_text(spark, sf_dir):
    return insights.digest_text(risk(spark, sf_dir))


# ---- back-test -------------------------------------------------------------------------------

@query
def ground_truth(spark, sf_dir):
    return backtest.ground_truth(risk(spark, sf_dir)).select(
        "account_id", "expected_high", "expected_low")


@query
def weight_metrics(spark, sf_dir):
    """The current weights alone."""
    current = {fixed.CURRENT_CONFIG: fixed.WEIGHT_CONFIGS[fixed.CURRENT_CONFIG]}
    return backtest.weight_metrics(risk(spark, sf_dir), current)


@query
def weight_sensitivity(spark, sf_dir):
    return backtest.weight_metrics(risk(spark, sf_dir))


@query
def weight_verdict(spark, sf_dir):
    return backtest.weight_verdict(backtest.weight_metrics(risk(spark, sf_dir)))


# ---- reports ---------------------------------------------------------------------------------

@query
def report_filter(spark, sf_dir):
    return report.filter_accounts(
        risk(spark, sf_dir), ["High", "Medium"], ["Starter", "Scale"], 10_000,
    ).select("account_id", "risk_tier", "plan_tier", "arr")


@query
def report_tier_counts(spark, sf_dir):
    return report.tier_counts(risk(spark, sf_dir))


@query
def report_arr_by_tier(spark, sf_dir):
    return report.arr_by_tier(risk(spark, sf_dir))


@query
def report_risk_map(spark, sf_dir):
    return report.risk_map(risk(spark, sf_dir))


@query
def report_account(spark, sf_dir):
    return report.account_detail(risk(spark, sf_dir), "Customer#000000003")


@query
def report_signal_breakdown(spark, sf_dir):
    return report.signal_breakdown(risk(spark, sf_dir))


@query
def report_heatmap(spark, sf_dir):
    return report.heatmap(risk(spark, sf_dir))


@query
def report_sdk_tier(spark, sf_dir):
    return report.counts_by_tier(risk(spark, sf_dir), "sdk_version")


@query
def report_plan_tier(spark, sf_dir):
    return report.counts_by_tier(risk(spark, sf_dir), "plan_tier")


@query
def report_top20(spark, sf_dir):
    return report.top_accounts(risk(spark, sf_dir))


def stored_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.stored_risk(risk(spark, sf_dir))


@query
def stored_filter(spark, sf_dir):
    """Reads the folders of two tiers and four columns."""
    return report.filter_accounts(
        stored_risk(spark, sf_dir), ["High", "Medium"], ["Starter", "Scale"], 10_000,
    ).select("account_id", "risk_tier", "plan_tier", "arr")


@query
def stored_tier_counts(spark, sf_dir):
    return report.tier_counts(stored_risk(spark, sf_dir))


@query
def stored_heatmap(spark, sf_dir):
    return report.heatmap(stored_risk(spark, sf_dir))


@query
def stored_export(spark, sf_dir):
    """All columns, in the order of the scored frame."""
    return exports.risk_scored(pipeline.stored_risk(_explained(spark, sf_dir)))


# ---- annotations and exports -----------------------------------------------------------------

@query
def annotation_defaults(spark, sf_dir):
    parsed = annotate.parse_analyses(view(spark, sf_dir, "analyses_v"))
    return parsed.select(
        "account_id", "sentiment", "risk_score", "champion_status", "summary",
        F.array_join("competitor_mentions", "|").alias("competitor_mentions"),
        F.array_join("key_concerns", "|").alias("key_concerns"),
        F.array_join("recommended_actions", "|").alias("recommended_actions"))


@query
def nps_translation(spark, sf_dir):
    d = dataset(spark, sf_dir)
    return signals.translated_nps(d.nps, d.translations).select(
        "account_id", "score", "translated_comment", "detected_language")


@query
def nps_annotation_requests(spark, sf_dir):
    d = dataset(spark, sf_dir)
    return signals.nps_comments_to_annotate(d.nps, d.translations)


@query
def non_latin_comments(spark, sf_dir):
    """Comments with characters beyond ASCII; the given texts hold none beyond Latin-1."""
    return signals.non_latin_comments(view(spark, sf_dir, "nps_v"), max_codepoint=127).select(
        "account_id", "verbatim_comment")


@query
def batch_annotate(spark, sf_dir):
    """A deterministic stand-in for a model: labels notes by their number of words."""
    def label(batch):
        words = batch["raw_text"].str.split().str.len()
        return batch[["account_id", "note_idx"]].assign(
            n_words=words, mood=words.gt(20).map({True: "long", False: "short"}))

    return annotate.batch_annotate(
        view(spark, sf_dir, "notes_v"), label,
        "account_id bigint, note_idx bigint, n_words bigint, mood string")


@query
def briefing_payload(spark, sf_dir):
    columns = ["account_id", "account_name", "contract_end_date", "arr", "sdk_version",
               "nps_score", "risk_tier", "total_tickets"]
    return annotate.briefing_payload(risk(spark, sf_dir).select(columns))


@query
def explanations(spark, sf_dir):
    return annotate.with_explanations(
        risk(spark, sf_dir), view(spark, sf_dir, "explanations_v"),
    ).select("account_id", "risk_tier", "risk_explanation")


def _explained(spark, sf_dir):
    return annotate.with_explanations(
        risk(spark, sf_dir), view(spark, sf_dir, "explanations_v"))


@query
def export_risk_scored(spark, sf_dir):
    return exports.risk_scored(_explained(spark, sf_dir))


@query
def export_detailed_signals(spark, sf_dir):
    return exports.detailed_signals(_explained(spark, sf_dir))


@query
def account_briefings(spark, sf_dir):
    return exports.account_briefings(_explained(spark, sf_dir))


@query
def insights_summary(spark, sf_dir):
    return insights.insights_export(risk(spark, sf_dir))
