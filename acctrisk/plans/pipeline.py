"""The assembled scoring pipeline."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctrisk.functions.lineage import materialise, shared_folder
from acctrisk.functions.prune import with_keys
from acctrisk.operators import (
    annotate, backtest, insights, quality, reconcile, scoring, signals,
)
from acctrisk.params import DEFAULT, ScoringParams
from acctrisk.sources import exports, stored
from acctrisk.sources.files import Sources

# What an analysis of notes returns: one or more responses per account, the last seq counts.
ANALYSES = "account_id long, seq long, response_json string"
# The inputs that hold facts about accounts.
FACTS = ("usage", "tickets", "nps", "analyses", "translations", "sentiments")


@dataclass(frozen=True)
class Dataset:
    """The lazy input relations of one run.

    ``analyses``: account_id, seq, response_json. ``translations``: account_id, seq, translated,
    language. ``sentiments``: account_id, seq, sentiment, score_contradicts, risk_boost.
    """

    accounts: DataFrame
    usage: DataFrame | None = None
    tickets: DataFrame | None = None
    nps: DataFrame | None = None
    analyses: DataFrame | None = None
    translations: DataFrame | None = None
    sentiments: DataFrame | None = None
    # promises that spare work: at most one survey row per account, one usage row per month
    nps_unique: bool = False
    unique_months: bool = False


def merge_dataset(
    data: Dataset, accounts: DataFrame, params: ScoringParams = DEFAULT
) -> DataFrame:
    """All signals of the given accounts with defaults filled in, each fact table read once.

    Usage, SDK and engagement come from one usage profile; engagement needs the plan and ARR,
    which the accounts bring along, so no second join with them.
    """
    usage = tickets = nps = csm = None
    if data.usage is not None:
        usage = signals.usage_profile(data.usage, data.unique_months).select(
            "account_id", *signals.usage_columns(),
            *signals.sdk_columns("known_sdk"), "known_users", F.lit(True).alias("has_usage"))
    if data.tickets is not None:
        tickets = signals.ticket_signals(data.tickets, params)
    if data.nps is not None:
        nps = signals.nps_signals(
            data.nps, data.translations, data.sentiments, data.nps_unique)
    if data.analyses is not None:
        csm = signals.csm_signals(annotate.account_analyses(data.analyses))
    merged = scoring.merge_signals(
        accounts, usage, tickets, nps, csm, nps_unique=data.nps_unique)
    if usage is not None:
        kept = [c for c in merged.columns if c not in ("known_users", "has_usage")]
        merged = merged.select(*kept, *signals.engagement_columns("known_users", "has_usage"))
    return scoring.fill_defaults(merged)


def facts_of(data: Dataset, accounts: DataFrame) -> Dataset:
    """The same inputs with the facts of the given accounts only, cut down where they are read."""
    facts = {name: getattr(data, name) for name in FACTS}
    return replace(data, accounts=accounts, **{
        name: with_keys(df, accounts, "account_id")
        for name, df in facts.items() if df is not None})


def score_dataset(data: Dataset, params: ScoringParams = DEFAULT) -> DataFrame:
    """Scored accounts of the renewal window; facts of other accounts go before any exchange."""
    accounts = scoring.renewal_window(data.accounts, params)
    facts = facts_of(data, accounts.select("account_id"))
    return scoring.score_merged(merge_dataset(facts, accounts, params), params)


def stored_risk(risk: DataFrame) -> DataFrame:
    """Scored accounts written once to the shared folder, by tier and account, and read from there."""
    return stored.store_risk(risk, f"{shared_folder(risk.sparkSession)}/risk-{uuid.uuid4().hex}")


@dataclass(frozen=True)
class Run:
    """What a run leaves behind; ``failed`` has the accounts whose analysis failed, and why."""

    report: DataFrame
    risk: DataFrame
    notes: DataFrame
    notes_by_account: DataFrame
    metrics: DataFrame
    verdict: DataFrame
    failed: DataFrame | None = None


def run(
    data: Sources,
    folder: str | None = None,
    params: ScoringParams = DEFAULT,
    analyses: DataFrame | None = None,
    translations: DataFrame | None = None,
    sentiments: DataFrame | None = None,
    name_matches: DataFrame | None = None,
    explanations: DataFrame | None = None,
    entities: DataFrame | None = None,
    analyse: Callable[[pd.DataFrame], pd.DataFrame] | None = None,
) -> Run:
    """The whole pipeline: validate, resolve names, score, explain, back-test and export.

    ``entities`` are external findings per note (see annotate.note_entities). ``analyse`` gets
    batches of notes_by_account rows, several at a time, and returns ANALYSES rows for them; it
    takes the place of ``analyses``, and accounts of a batch that fails go without. Accounts with ``ingest_order`` are taken in file order, when rows are
    deduplicated and where names are ambiguous. The scored accounts are stored once (sources/stored.py),
    because every later step reads them.
    """
    clean, report = quality.validate_all(
        data.accounts, data.usage, data.tickets, data.nps, params.snapshot_date)
    accounts = clean["accounts"]
    order = "ingest_order" if "ingest_order" in accounts.columns else "account_id"
    notes = reconcile.reconcile(
        annotate.note_entities(data.notes, entities), accounts, name_matches, order=order)
    by_account = reconcile.notes_by_account(notes, accounts)
    failed = None
    if analyse is not None:
        # written once, so that no account is analysed twice
        answers = materialise(annotate.batch_annotate(
            by_account, analyse, f"{ANALYSES}, error string", error_column="error"))
        failed = answers.filter("error IS NOT NULL").select("account_id", "error")
        analyses = answers.filter("error IS NULL").drop("error")
    scored = score_dataset(Dataset(
        accounts.drop("ingest_order"), clean["usage"], clean["tickets"], clean["nps"], analyses,
        translations, sentiments), params)
    risk = stored_risk(annotate.with_explanations(scored, explanations))
    metrics = backtest.weight_metrics(risk)
    if folder is not None:
        exports.export_all(risk, insights.insights_export(risk), folder)
    return Run(report, risk, notes, by_account, metrics, backtest.weight_verdict(metrics), failed)
