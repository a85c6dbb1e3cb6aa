import random

import pytest
from tests.conftest import by_key

from acctrisk import fixed
from acctrisk.operators import backtest
from acctrisk.operators.scoring import SCORE_COLUMNS

RISK = ("account_id long, account_name string, csm_sentiment string, competitor_mentions string, "
        "champion_status string, nps_score long, sdk_version string, total_tickets long, "
        + ", ".join(f"{c} double" for c in SCORE_COLUMNS))


@pytest.fixture
def mock(frame):
    return frame(
        RISK,
        (1, "Risky Co", "negative", "Rival", "lost", 2, "v3.2.0", 12, .8, .7, .9, .85, .85, .7),
        (2, "Safe Co", "positive", "", "active", 10, "v4.3.0", 1, .1, .1, .0, .1, .0, .05),
        (3, "Mixed Co", "neutral", "", "active", 7, "v4.1.0", 3, .4, .3, .4, .5, .15, .3),
        (4, "Unknown Co", None, "", None, 5, "v4.2.3", 2, .3, .2, .5, .3, .0, .3),
    )


def test_labels(mock):
    rows = by_key(backtest.ground_truth(mock))
    assert [rows[k].expected_high for k in (1, 2, 3, 4)] == [True, False, False, False]
    assert [rows[k].expected_low for k in (1, 2, 3, 4)] == [False, True, False, False]


def test_labels_of_missing_columns_and_the_sdk_rule(frame):
    df = frame("account_id long, sdk_version string, total_tickets long, nps_score long",
               (1, "v3.4.1", 6, 7), (2, "v3.4.1", 5, 7), (3, None, 9, 9), (4, "v4.3.0", 0, None))
    rows = by_key(backtest.ground_truth(df))
    assert [rows[k].expected_high for k in (1, 2, 3, 4)] == [True, False, False, False]
    assert [rows[k].expected_low for k in (1, 2, 3, 4)] == [False, False, True, False]


def test_metrics_of_the_mock_frame(mock):
    rows = by_key(backtest.weight_metrics(mock), "config")
    assert set(rows) == set(fixed.WEIGHT_CONFIGS)
    current = rows[fixed.CURRENT_CONFIG]
    # 0.805 for Risky Co and 0.07 for Safe Co
    assert (current.avg_high_score, current.avg_low_score, current.separation) == (
        0.805, 0.07, 0.735)
    assert (current.precision_at_k, current.recall) == (1.0, 1.0)
    assert (current.n_expected_high, current.n_expected_low) == (1, 1)


def test_nothing_expected(frame):
    df = frame(RISK, (1, "A", "neutral", "", "active", 7, "v4.3.0", 1, *[0.5] * 6))
    row = by_key(backtest.weight_metrics(df), "config")[fixed.CURRENT_CONFIG]
    assert tuple(row)[1:] == (0.0, 0.0, 0.0, 0.0, 0.0, 0, 0)


@pytest.mark.parametrize("ties", [1, 3, 1000])
def test_precision_equals_brute_force_with_ties(frame, ties):
    """Up to all accounts share one score, or none do; ties go by composite score, then by id."""
    rng = random.Random(ties)
    rows = []
    for i in rng.sample(range(5000), 200):
        level = rng.randint(0, 1000 // ties) / 1000
        mood = rng.choice(["negative", "neutral", "neutral"])
        rows.append((i, "n", mood, "", "active", 7, "v4.3.0", 1, *[level] * 6))
    composite = {r[0]: rng.randint(0, 3) / 10 for r in rows}
    scored = frame(RISK, *rows).join(
        frame("account_id long, composite_risk_score double", *composite.items()), "account_id")
    got = by_key(backtest.weight_metrics(scored.repartition(5)), "config")
    for name, weights in fixed.WEIGHT_CONFIGS.items():
        def score(row):
            total = row[8] * weights[0]
            for value, weight in zip(row[9:], weights[1:]):
                total = total + value * weight
            return total
        ranked = sorted(rows, key=lambda r: (-score(r), -composite[r[0]], r[0]))
        k = max(1, sum(r[2] == "negative" for r in rows))
        precision = sum(r[2] == "negative" for r in ranked[:k]) / k
        assert got[name].precision_at_k == pytest.approx(precision, abs=1e-4)


def test_verdict_ties_share_their_average_rank(frame):
    names = list(fixed.WEIGHT_CONFIGS)
    schema = "config string, separation double"

    def verdict(*values):
        return tuple(backtest.weight_verdict(frame(schema, *zip(names, values))).first())

    assert verdict(0.5, 0.4, 0.3, 0.2, 0.1) == (names[0], 1, True)
    assert verdict(0.5, 0.5, 0.6, 0.2, 0.1) == (names[2], 2, False)  # rank 2.5
    assert verdict(0.5, 0.1, 0.5, 0.2, 0.1) == (names[0], 1, True)
    assert verdict(0.1, 0.4, 0.3, 0.2, 0.4) == (names[1], 5, False)
