import json

from tests.conftest import by_key

from acctrisk.operators import insights, report

RISK = ("account_id long, account_name string, arr long, plan_tier string, industry string, "
        "risk_tier string, composite_risk_score double, usage_risk_score double, "
        "ticket_risk_score double, nps_risk_score double, csm_risk_score double, "
        "sdk_risk_score double, engagement_risk_score double, nps_score long, nps_comment string, "
        "sdk_version string, total_tickets long, p1_p2_tickets long, champion_status string, "
        "csm_summary string, competitor_mentions string, sentiment_score_mismatch boolean, "
        "days_until_renewal long, top_risk_drivers string")


def risk_frame(frame):
    signals = (0.45, 0.2, 0.3, 0.4, 0.5, 0.6)
    return frame(
        RISK,
        (1, "One", 1234567, "Scale", "Retail", "High", 0.7, *signals, 8, "c" * 150, "v3.2.0", 12, 3,
         "lost", "Bad.", "Rival", True, 10, "x"),
        (2, "Two", 500, "Growth", "Retail", "Low", 0.1, *signals, 6, None, "v4.3.0", None, None,
         "active", None, None, False, 20, "x"),
        (3, "Three", 700, "Scale", "Media", "Medium", 0.4, *signals, None, None, "v3.4.1", None,
         None, "at_risk", None, "", None, 30, "x"),
        (4, "Four", 900, None, None, "Medium", 0.4, *signals, 9, "ok", None, 1, 0, None, None, None,
         None, 90, "x"),
    )


def test_patterns(frame):
    risk = risk_frame(frame)
    churn = by_key(insights.nps_usage_divergence(risk))
    assert set(churn) == {1, 4}
    assert churn[1].insight_detail.startswith(
        "NPS score is 8 (passive/promoter) but usage has declined significantly (risk: 45%).")
    cascade = by_key(insights.sdk_deprecation_impact(risk))
    assert set(cascade) == {1, 3}
    assert "v3.4.1 with 0 support tickets (0 P1/P2)" in cascade[3].insight_detail
    assert set(by_key(insights.sdk_deprecation_impact(risk, min_tickets=5))) == {1}
    champion = by_key(insights.champion_at_risk(risk))
    assert set(champion) == {1, 3} and "CSM notes: N/A." in champion[3].insight_detail
    mismatch = by_key(insights.score_sentiment_contradictions(risk))
    assert set(mismatch) == {1}
    assert '"' + "c" * 100 + '..."' in mismatch[1].insight_detail
    renamed = risk.withColumnRenamed("sentiment_score_mismatch", "score_contradicts")
    assert insights.score_sentiment_contradictions(renamed).count() == 1
    without = risk.drop("sentiment_score_mismatch")
    assert insights.score_sentiment_contradictions(without).count() == 0


def test_counts_keep_empty_patterns(frame):
    risk = risk_frame(frame).filter("account_id = 2")
    rows = by_key(insights.insight_counts(risk), "category")
    assert {k: r.n_accounts for k, r in rows.items()} == dict.fromkeys(insights.CATEGORIES, 0)
    long = insights.all_insights(risk_frame(frame)).groupBy("category").count().collect()
    assert {r.category: r["count"] for r in long} == {
        "silent_churn": 2, "sdk_cascade": 2, "champion_risk": 2, "nps_contradictions": 1}


def test_digest(frame):
    rows = insights.dataset_digest(risk_frame(frame)).collect()
    lines = [r.line for r in sorted(rows, key=lambda r: (r.section, -r.weight, r.line))]
    assert lines[:3] == ["Total accounts analyzed: 4",
                         "Risk distribution: High=1, Medium=2, Low=1",
                         "=== TOP 15 AT-RISK ACCOUNTS ==="]
    assert lines[3] == (
        "- One (ID:1): Risk=70% [High], ARR=$1,234,567, Plan=Scale, SDK=v3.2.0, NPS=8, "
        "Usage Decline Risk=45%, Tickets=12 (3 P1/P2), Competitors=Rival, Champion=lost, "
        "Renewal in 10 days. CSM: Bad.")
    assert lines[4].startswith("- Three (ID:3)") and "NPS=N/A" in lines[4]
    assert "Plan=?" in lines[5] and "SDK=?" in lines[5] and "CSM: No notes" in lines[6]
    assert lines[7:11] == ["=== SDK VERSION DISTRIBUTION ===", "- v3.2.0: 1 accounts (1 at-risk)",
                           "- v3.4.1: 1 accounts (1 at-risk)", "- v4.3.0: 1 accounts (0 at-risk)"]
    assert lines[12] == "Detractors (0-6): 1, Passives (7-8): 1, Promoters (9-10): 1"
    assert lines[14:] == ["- Media: 1 at-risk accounts, total ARR=$700",
                          "- Retail: 1 at-risk accounts, total ARR=$1,234,567"]


def test_report_json(frame):
    text = insights.insights_export(risk_frame(frame), "free text").first().report
    data = json.loads(text)
    assert data["summary"]["total_arr_at_risk"] == 1236167
    assert data["llm_insights"] == "free text"
    assert data["structured_insight_counts"]["sdk_cascade"] == 2


def test_reports(frame):
    risk = risk_frame(frame)
    assert set(by_key(report.filter_accounts(risk))) == {1, 2, 3, 4}
    assert set(by_key(report.filter_accounts(risk, ["High", "Medium"], ["Scale"], 700))) == {1, 3}
    assert by_key(report.tier_counts(risk), "risk_tier")["Medium"].n_accounts == 2
    assert by_key(report.arr_by_tier(risk), "risk_tier")["Medium"].total_arr == 1600
    assert report.account_detail(risk, "Three").first().account_id == 3
    wide = report.signal_breakdown(risk).filter("account_id = 1").collect()
    assert {r.signal: r.score for r in wide} == {
        "Usage Decline": 0.45, "Support Issues": 0.2, "NPS": 0.3, "CSM Sentiment": 0.4,
        "SDK Risk": 0.5, "Engagement": 0.6}
    assert [r.account_id for r in report.heatmap(risk, 2).collect()] == [1, 3]
    top = report.top_accounts(risk, 3).collect()
    assert [(r.rank, r.account_name) for r in top] == [(1, "One"), (2, "Three"), (3, "Four")]
    assert report.counts_by_tier(risk, "sdk_version").count() == 3
    assert report.risk_map(risk).count() == 4


def test_absent_signals_give_no_patterns(frame):
    risk = risk_frame(frame).drop(
        "nps_score", "nps_comment", "sdk_version", "champion_status", "csm_summary",
        "sentiment_score_mismatch", "total_tickets", "p1_p2_tickets", "competitor_mentions")
    assert insights.all_insights(risk).count() == 0
    assert insights.sdk_distribution(risk).count() == 0
    assert tuple(insights.nps_buckets(risk).first()) == (0, 0, 0)
    assert insights.dataset_digest(risk).filter("section = 6").count() == 0
