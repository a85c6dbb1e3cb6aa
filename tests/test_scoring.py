from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from tests.conftest import by_key

from acctrisk import fixed
from acctrisk.functions.skew import left_join_facts, left_join_lookup, left_join_open
from acctrisk.operators import scoring
from acctrisk.params import ScoringParams

ACCOUNTS = "account_id long, account_name string, arr long, contract_end_date date, plan_tier string"
SNAPSHOT = date(2026, 4, 10)


def account(key, days, arr=100):
    end = None if days is None else SNAPSHOT + timedelta(days=days)
    return (key, f"Account {key}", arr, end, "Growth")


def scores(frame, *rows):
    columns = ", ".join(f"{c} double" for c in scoring.SCORE_COLUMNS)
    return frame(f"account_id long, {columns}", *rows)


def test_params():
    params = ScoringParams()
    assert (params.high_threshold, params.medium_threshold) == (0.60, 0.35)
    assert sum(params.weights.values()) == pytest.approx(1.0)
    changed = ScoringParams.from_mapping({
        "WEIGHT_NPS": "0.2", "RENEWAL_WINDOW_DAYS": "30", "DATASET_DATE": "2025-01-31"})
    assert changed.weights["nps"] == 0.2 and changed.weights["sdk"] == 0.15
    assert (changed.window_days, changed.snapshot_date) == (30, date(2025, 1, 31))


def test_window_includes_both_edges(frame):
    accounts = frame(ACCOUNTS, *[account(i, d) for i, d in enumerate([-1, 0, 90, 91, None])])
    rows = by_key(scoring.renewal_window(accounts))
    assert {k: r.days_until_renewal for k, r in rows.items()} == {1: 0, 2: 90}


@pytest.mark.parametrize("score, tier", [
    (0.80, "High"), (0.65, "High"), (0.60, "High"), (0.55, "Medium"), (0.40, "Medium"),
    (0.35, "Medium"), (0.34, "Low"), (0.20, "Low"), (0.0, "Low"),
])
def test_tiers(spark, score, tier):
    assert spark.range(1).select(scoring.risk_tier(F.lit(score))).first()[0] == tier


def test_composite_of_extremes(frame):
    df = scores(frame, (1, *[0.0] * 6), (2, *[1.0] * 6))
    rows = by_key(scoring.score_merged(df))
    assert (rows[1].composite_risk_score, rows[2].composite_risk_score) == (0.0, 1.0)


def test_drivers_order_ties_and_rounding(frame):
    df = scores(frame, (1, 0.845, 0.855, 0.855, 0.1, 0.0, 0.31), (2, *[0.3] * 6),
                (3, 0.0, 0.0, 0.125, 0.0, 0.9, 0.0))
    rows = by_key(df.select("account_id", scoring.top_drivers().alias("d")))
    assert rows[1].d == "Support Issues (86%); Low NPS (86%); Usage Decline (84%)"
    assert rows[2].d == "No significant risk drivers"
    assert rows[3].d == "SDK Deprecation (90%)"


def test_confidence(frame):
    df = scores(frame, (1, 0.8, 0.6, 0.9, 0.7, 0.85, 0.3), (2, 0.3, 0.2, 0.5, 0.3, 0.2, 0.3),
                (3, 0.8, 0.6, 0.5, 0.3, 0.2, 0.3))
    rows = by_key(df.select("account_id", scoring.confidence_level().alias("c")))
    assert [rows[k].c for k in (1, 2, 3)] == ["High", "Low", "Medium"]


def test_absent_and_partial_signals_take_defaults(frame):
    accounts = frame(ACCOUNTS, account(1, 10), account(2, 20))
    usage = frame("account_id long, usage_risk_score double, sdk_version string", (1, 0.9, None))
    sdk = frame("account_id long, sdk_risk_score double, sdk_version string", (1, 0.7, "v3.4.1"))
    rows = by_key(scoring.composite_risk(accounts, usage=usage, sdk=sdk))
    assert rows[1].sdk_version is None  # the earlier frame's column wins
    assert (rows[1].usage_risk_score, rows[1].sdk_risk_score) == (0.9, 0.7)
    assert [rows[2][c] for c in scoring.SCORE_COLUMNS] == [d for *_, d in fixed.SIGNALS]
    assert rows[2].composite_risk_score == 0.29


def test_every_response_keeps_its_row_on_either_join_path(frame):
    accounts = frame(ACCOUNTS, account(1, 10), account(2, 20), account(3, 30))
    nps = frame("account_id long, nps_risk_score double, nps_score long",
                *[(1, i / 100, i) for i in range(50)], (2, 0.5, 7), (9, 0.1, 9))
    merged = scoring.composite_risk(accounts, nps=nps).groupBy("account_id").count()
    assert {r.account_id: r["count"] for r in merged.collect()} == {1: 50, 2: 1, 3: 1}
    plain = accounts.join(nps, "account_id", "left")
    for parts in (1, 9):
        split = left_join_facts(accounts, nps.repartition(parts), "account_id")
        assert sorted(map(str, split.select(plain.columns).collect())) == sorted(
            map(str, plain.collect()))


def test_hot_and_missing_keys_of_a_lookup_join(frame):
    facts = frame("k long, v long", *[(1, i % 3) for i in range(40)], (2, 1), (None, 5), (3, 6))
    lookup = frame("k long, name string", (1, "one"), (2, "two"), (4, "four"))
    plain = facts.join(lookup, "k", "left")
    for parts in (1, 9):
        split = left_join_lookup(facts.repartition(parts), lookup, "k")
        assert sorted(map(str, split.select(plain.columns).collect())) == sorted(
            map(str, plain.collect()))


def test_hot_keys_are_dealt_out_even_from_one_partition(frame):
    facts = frame("k long, v long", *[(1, i) for i in range(4000)]).coalesce(1)
    joined = left_join_lookup(facts, frame("k long, name string", (1, "one")), "k")
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and joined.filter("name = 'one'").count() == 4000
    from acctrisk.functions import skew
    per_salt = facts.select(skew._salt(facts, 16)).groupBy("_salt").count().collect()
    assert len(per_salt) == 16 and max(r["count"] for r in per_salt) < 400


def test_open_keys_match_nothing_and_are_spread(frame):
    left = frame("a long, b string", (1, "x"), (2, "y"), (None, "z"), (None, "z"))
    right = frame("k long, c string", (1, "one"), (3, "three"))
    got = left_join_open(left, right, F.when(F.col("a") < 2, F.col("a")), "k").collect()
    assert sorted(map(str, (r.c for r in got))) == ["None", "None", "None", "one"]
    assert [r.k for r in got if r.c] == [1]


def test_ranking_breaks_ties_by_id(frame):
    df = frame("account_id long, composite_risk_score double", (3, 0.5), (1, 0.5), (2, 0.9))
    assert [r.account_id for r in scoring.rank_by_risk(df).collect()] == [2, 1, 3]


def test_summary(frame):
    df = frame("account_id long, risk_tier string, arr long, composite_risk_score double",
               (1, "High", 100, 0.7), (2, "Medium", 50, 0.4), (3, "Low", 25, 0.1),
               (4, "Low", 25, 0.2))
    row = scoring.risk_summary(df).first()
    assert tuple(row) == (4, 1, 1, 2, 150, 100, 0.35, 0.3)
    assert scoring.risk_summary(df.limit(0)).first().total_arr_at_risk == 0


def test_only_hot_keys_are_repeated(frame):
    """Text that travels with a lookup or an account is not repeated where few rows meet it."""
    facts = frame("k long, v long", *[(1, i) for i in range(50)], *[(1, 7)] * 50,
                  *[(i, i) for i in range(2, 40)], (None, 5), (None, 6))
    lookup = frame("k long, name string", *[(i, f"name {i}") for i in range(60)], (None, "none"))
    from acctrisk.functions import skew
    counts = skew.key_counts(facts, "k")
    hot = skew._hot(counts, lookup, "k", 20)
    assert skew._repeated(lookup, hot, "k", 16).count() == 60 + 16
    assert skew._salted(facts, hot, "k", 16).filter("k = 1 and _salt > 0").count() > 50
    assert skew._hot(counts, lookup.select(F.col("k").cast("int")), "k", 20) is None
    for rows in (0, 20, 1000, None):
        got = left_join_lookup(facts, lookup, "k", hot_rows=rows)
        plain = facts.join(lookup, "k", "left")
        assert sorted(map(str, got.select(plain.columns).collect())) == sorted(
            map(str, plain.collect()))
    for rows in (0, 20, 1000):
        got = left_join_facts(lookup, facts, "k", hot_rows=rows)
        plain = lookup.join(facts, "k", "left")
        assert sorted(map(str, got.select(plain.columns).collect())) == sorted(
            map(str, plain.collect()))
