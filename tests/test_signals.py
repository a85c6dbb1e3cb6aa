import random

import pytest
from tests.conftest import by_key

from acctrisk.operators import signals
from acctrisk.params import ScoringParams

USAGE = ("account_id long, month string, api_calls long, content_entries_created long, "
         "active_users long, workflows_triggered long, sdk_version string")


def steady(account, month, api, users=10, sdk="v4.3.0"):
    return (account, month, api, 10, users, 10, sdk)


def test_three_rows_overlap_in_the_middle_month(frame):
    usage = frame(USAGE, *[steady(1, m, a) for m, a in
                           [("2025-12", 40), ("2025-10", 100), ("2025-11", 80)]])
    row = signals.usage_signals(usage).first()
    assert row.usage_risk_score == 0.1  # 0.30 * (90 - 60) / 90
    assert row.api_calls_decline_pct == -33.3
    assert (row.api_calls_latest, row.active_users_latest, row.sdk_version) == (40, 10, "v4.3.0")


def test_growth_is_no_risk_and_no_negative_zero(frame):
    usage = frame(USAGE, *[steady(1, f"2025-0{i}", 10 * i) for i in range(1, 7)])
    row = signals.usage_signals(usage).first()
    assert row.usage_risk_score == 0.0
    assert str(row.api_calls_decline_pct) == "0.0"


def test_fewer_than_three_rows_score_one_half(frame):
    usage = frame(USAGE, steady(1, "2025-01", 5), steady(1, "2025-02", 1))
    row = signals.usage_signals(usage).first()
    assert row.usage_risk_score == 0.5
    assert row.api_calls_latest is None and row.sdk_version is None


def test_unknown_start_counts_as_none_and_unknown_end_as_full_decline(frame):
    late = [steady(1, "1", 10), steady(1, "2", 10), steady(1, "3", 10), steady(1, "4", None)]
    early = [steady(2, "1", None), steady(2, "2", 10), steady(2, "3", 1), steady(2, "4", 1)]
    rows = by_key(signals.usage_signals(frame(USAGE, *late, *early)))
    assert rows[1].usage_risk_score == 0.3
    assert rows[2].usage_risk_score == 0.0


def test_rows_without_account_are_left_out(frame):
    usage = frame(USAGE, steady(None, "1", 10), steady(1, "1", 10))
    assert [r.account_id for r in signals.usage_signals(usage).collect()] == [1]


def test_usage_matches_brute_force_whatever_the_partitioning(frame):
    rng = random.Random(7)
    rows = []
    for account in range(40):
        for month in range(rng.randint(1, 14)):
            rows.append((account, f"2024-{month:02d}", rng.randint(0, 50), rng.randint(0, 9),
                         rng.randint(0, 30), rng.randint(0, 5), "v4.1.0"))
    expected = {}
    for account in range(40):
        mine = sorted(r for r in rows if r[0] == account)
        if len(mine) < 3:
            expected[account] = 0.5
            continue
        score = 0.0
        for column, share in ((2, 0.30), (3, 0.25), (4, 0.30), (5, 0.15)):
            early = (mine[0][column] + mine[1][column]) / 2
            late = (mine[-2][column] + mine[-1][column]) / 2
            score += share * (max(0.0, min(1.0, (early - late) / early)) if early > 0 else 0.0)
        expected[account] = score
    rng.shuffle(rows)
    for parts in (1, 7):
        got = by_key(signals.usage_signals(frame(USAGE, *rows).repartition(parts)))
        assert {a: r.usage_risk_score for a, r in got.items()} == pytest.approx(
            expected, abs=5.1e-4)


def test_rows_sharing_a_month_take_its_extremes(frame):
    """A hot account-month: thousands of rows between 20 and 60 in the first of two months."""
    rows = [steady(1, "2025-01", 20 + i % 41) for i in range(5000)]
    usage = frame(USAGE, *rows, steady(1, "2025-02", 20), steady(1, "2025-02", 20)).repartition(8)
    row = signals.usage_signals(usage).first()
    assert row.usage_risk_score == 0.15  # 0.30 * ((20 + 60) / 2 - 20) / 40
    assert row.api_calls_latest == 20


def test_latest_row_and_latest_known_value_differ(frame):
    usage = frame(USAGE, steady(1, "1", 5, 3, "v3.4.1"), steady(1, "2", 6, None, None))
    row = signals.latest_usage(usage).first()
    assert (row.sdk_version_last, row.sdk_version_known) == (None, "v3.4.1")
    assert (row.active_users_last, row.active_users_known) == (None, 3)


@pytest.mark.parametrize("version, risk, reasons", [
    ("v3.1.2", 0.85, 2), ("v3.2.0", 0.85, 2), ("v3.4.1", 0.7, 1), ("v4.0.0", 0.25, 1),
    ("v4.1.0", 0.15, 1), ("v4.2.3", 0.0, 1), ("v4.3.0", 0.0, 1), ("v5.0.0", 0.0, 0),
])
def test_sdk_rules(frame, version, risk, reasons):
    row = signals.sdk_risk(frame(USAGE, steady(1, "1", 5, sdk=version))).first()
    assert row.sdk_risk_score == risk
    assert len([t for t in row.sdk_risk_factors.split("; ") if t]) == reasons
    if version in ("v3.4.1", "v4.3.0"):
        assert version in row.sdk_risk_factors


def test_sdk_without_any_version(frame):
    row = signals.sdk_risk(frame(USAGE, steady(1, "1", 5, sdk=None))).first()
    assert (row.sdk_risk_score, row.sdk_version, row.sdk_risk_factors) == (0.0, None, "")


def test_engagement_steps_and_default_tier(frame):
    accounts = frame("account_id long, plan_tier string, arr long",
                     (1, "Starter", 900), (2, "Growth", 900), (3, "Scale", 900),
                     (4, "Enterprise", 900), (5, "Other", 905))
    users = {1: 3, 2: 3, 3: 26, 4: 40, 5: 0, 6: 8}
    usage = frame(USAGE, *[steady(a, "1", 5, n) for a, n in users.items()])
    rows = by_key(signals.engagement_signals(usage, accounts))
    assert {a: r.engagement_risk_score for a, r in rows.items()} == {
        1: 0.05, 2: 0.9, 3: 0.4, 4: 0.4, 5: 0.9, 6: 0.2}
    assert rows[4].engagement_ratio == 0.5
    assert (rows[5].expected_users, rows[5].arr_per_active_user) == (10, 905.0)
    assert rows[6].arr_per_active_user is None


TICKETS = ("account_id long, priority string, status string, created_date string, "
           "resolution_time_hours double")


def test_ticket_score(frame):
    tickets = frame(TICKETS, (1, "P1", "Open", "2026-04-01", None),
                    (1, "P3", "Closed", "2025-01-01", 24.0),
                    (1, "P2", "In Progress", "2026-01-10", 72.0),
                    (1, "P4", "Escalated", "2026-01-09", None),
                    (2, "P4", "Closed", "2026-12-01", None))
    tickets = tickets.withColumn("created_date", tickets.created_date.cast("date"))
    rows = by_key(signals.ticket_signals(tickets, ScoringParams()))
    assert rows[1].ticket_risk_score == 0.453  # 0.15 + 0.15 + 0.2 * 48 / 96 + 0.2 * 4 / 15
    assert (rows[1].total_tickets, rows[1].p1_p2_tickets, rows[1].open_escalated) == (4, 2, 2)
    assert (rows[1].avg_resolution_hours, rows[1].recent_ticket_count) == (48.0, 2)
    assert rows[2].ticket_risk_score == 0.073  # no resolution time counts 0.3
    assert (rows[2].avg_resolution_hours, rows[2].recent_ticket_count) == (0.0, 1)


NPS = "account_id long, score long, verbatim_comment string"


def test_nps_base_scores(frame):
    nps = frame(NPS, *[(s, s, "") for s in range(11)], (99, None, ""))
    rows = by_key(signals.nps_signals(nps))
    assert [rows[s].nps_risk_score for s in range(11)] == [
        0.998, 0.965, 0.932, 0.899, 0.866, 0.833, 0.8, 0.45, 0.3, 0.1, 0.0]
    assert rows[99].nps_risk_score is None


def test_nps_annotations(frame):
    nps = frame(NPS, (1, 8, "fell off a cliff"), (1, 2, ""), (2, 10, "谢谢"), (3, 0, "no"))
    sentiments = frame(
        "account_id long, seq long, sentiment string, score_contradicts boolean, risk_boost double",
        (1, 1, "positive", False, 0.0), (1, 2, "negative", True, 0.25), (3, 1, "negative", None, 9.0))
    translations = frame("account_id long, seq long, translated string, language string",
                         (2, 1, "thank you", "Chinese"))
    rows = signals.nps_signals(nps, translations, sentiments).collect()
    got = {(r.account_id, r.nps_score): r for r in rows}
    assert len(rows) == 4  # one row per response
    assert got[1, 8].nps_risk_score == 0.55 and got[1, 8].sentiment_score_mismatch
    assert got[1, 2].nps_risk_score == 1.0
    assert got[2, 10].translated_comment == "thank you"
    assert (got[2, 10].detected_language, got[1, 8].detected_language) == ("Chinese", "English")
    assert (got[2, 10].comment_sentiment, got[3, 0].nps_risk_score) == ("neutral", 1.0)
    asked = signals.nps_comments_to_annotate(nps, translations).collect()
    assert sorted(r.comment for r in asked) == ["fell off a cliff", "thank you"]


def test_latest_nps_keeps_one_row(frame):
    nps = frame(NPS + ", seq long", (1, 3, "old", 1), (1, 9, "new", 2))
    assert [tuple(r) for r in signals.latest_nps(nps, "seq").collect()] == [(1, 9, "new")]


def test_non_latin_comments(frame):
    nps = frame(NPS, (1, 5, "产品不错"), (2, 5, "español café"), (3, 5, ""), (4, 5, "ok 😀"))
    assert sorted(by_key(signals.non_latin_comments(nps))) == [1, 4]
    assert sorted(by_key(signals.non_latin_comments(nps, max_codepoint=127))) == [1, 2, 4]


@pytest.mark.parametrize("unique", [True, False])
def test_no_history_is_gathered(frame, unique):
    """Months of an account are cut to a few in every task, before the exchange."""
    usage = frame(USAGE, *[steady(1, f"{m:05d}", m) for m in range(3000)])
    found = signals.usage_profile(usage.repartition(5), unique)
    row = found.first()
    assert (row.first_row.api_calls, row.second_row.api_calls) == (0, 1)
    assert (row.previous_row.api_calls, row.last_row.api_calls) == (2998, 2999)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan
    assert "row_number(), 3, Partial" in plan


def test_months_of_any_text_sort_both_ways(frame):
    months = ["", "2025", "2025-1", "2025-10", "2025-2", "ä", "z", None, "\U0001f600", "2025-01-"]
    usage = frame(USAGE, *[steady(1, m, i) for i, m in enumerate(months)])
    order = sorted(range(len(months)), key=lambda i: (months[i] if months[i] is not None else "~")
                   .encode())
    row = signals.usage_profile(usage).first()
    assert [row.first_row.api_calls, row.second_row.api_calls] == order[:2]
    assert [row.previous_row.api_calls, row.last_row.api_calls] == order[-2:]
