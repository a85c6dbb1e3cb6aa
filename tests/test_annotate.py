import json
import time
from datetime import date

import pytest
from pyspark.sql import functions as F
from tests.conftest import by_key

from acctrisk import fixed
from acctrisk.operators import annotate, signals

DEFAULTS = tuple(fixed.ANALYSIS_DEFAULTS.values())


def parse(frame, text):
    row = annotate.parse_analyses(frame("account_id long, response_json string", (1, text))).first()
    return tuple(row)[1:]


@pytest.mark.parametrize("text", [
    "{}", "no json", None, "[1]", '{"risk_score": 1.5}', '{"risk_score": -0.1}',
    '{"risk_score": null, "sentiment": "negative"}', '{"risk_score": "many"}',
    '{"sentiment": 5}', '{"competitor_mentions": "A"}', '{"key_concerns": [1]}',
    '{"summary": null, "sentiment": "negative"}', '{"competitor_mentions": ["A", null]}',
])
def test_missing_or_unusable_analyses_are_defaults(frame, text):
    assert parse(frame, text) == DEFAULTS


def test_complete_and_partial_analyses(frame):
    full = {"sentiment": "negative", "risk_score": 0.85, "competitor_mentions": ["A", "B"],
            "champion_status": "at_risk", "key_concerns": ["pricing"],
            "recommended_actions": [], "summary": "High."}
    assert parse(frame, json.dumps(full)) == tuple(full.values())
    assert parse(frame, '{"sentiment": "positive", "risk_score": "0.4", "other": 1}') == (
        "positive", 0.4, *DEFAULTS[2:])
    assert parse(frame, '{"risk_score": 1}')[1] == 1.0


def test_last_analysis_per_account_and_joined_lists(frame):
    df = frame("account_id long, seq long, response_json string",
               (1, 1, '{"risk_score": 0.1}'),
               (1, 2, '{"risk_score": 0.9, "competitor_mentions": ["A", "B"], '
                      '"key_concerns": ["x", "y"]}'))
    row = signals.csm_signals(annotate.account_analyses(df)).first()
    assert (row.csm_risk_score, row.competitor_mentions, row.key_concerns) == (0.9, "A, B", "x; y")
    empty = signals.csm_signals(annotate.account_analyses(df.limit(0)))
    assert empty.count() == 0 and "csm_summary" in empty.columns


NOTES = "note_idx long, raw_text string, account_id long, account_name string"
EXTERNAL = ("note_idx long, account_id long, account_name string, date_str string, "
            "csm_name string")


def test_external_entities_win_and_blanks_are_filled(frame):
    notes = frame(NOTES, (1, "a", 1001, "Text"), (2, "b", None, "Other"))
    external = frame(EXTERNAL, (1, None, "Model", "Mar 1", "Sam"), (2, 7, "", None, None))
    rows = by_key(annotate.note_entities(notes, external), "note_idx")
    assert tuple(rows[1])[2:] == (1001, "Model", "Mar 1", "Sam")
    assert tuple(rows[2])[2:] == (7, "Other", "", "")


@pytest.mark.parametrize("numbers", [[1], [1, 2, 3], [1, 1, 2]])
def test_unaligned_entities_are_ignored(frame, numbers):
    notes = frame(NOTES, (1, "a", 1001, "Text"), (2, "b", None, "Other"))
    external = frame(EXTERNAL, *[(i, 5, "Model", "d", "c") for i in numbers])
    rows = by_key(annotate.note_entities(notes, external), "note_idx")
    assert tuple(rows[1])[2:] == (1001, "Text", "", "")
    assert tuple(rows[2])[2:] == (None, "Other", "", "")


def test_batch_annotate_is_bounded_and_complete(spark):
    def label(batch):
        assert len(batch) <= 10
        return batch.assign(size=len(batch))

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10)
    try:
        rows = annotate.batch_annotate(spark.range(95), label, "id long, size long", 3).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(r.id for r in rows) == list(range(95))


def test_briefing_payload_and_explanations(frame):
    risk = frame("account_id long, risk_tier string, end date, nps double",
                 (1, "High", date(2026, 5, 1), None), (2, "Low", date(2026, 5, 1), 3.0),
                 (3, "Medium", None, 1.0))
    payload = by_key(annotate.briefing_payload(risk))
    assert json.loads(payload[1].payload) == {
        "account_id": 1, "risk_tier": "High", "end": "2026-05-01", "nps": None}
    assert set(payload) == {1, 3}
    texts = frame("account_id long, risk_explanation string", (1, "Act now"), (2, "unused"))
    rows = by_key(annotate.with_explanations(risk, texts))
    assert [rows[k].risk_explanation for k in (1, 2, 3)] == [
        "Act now", fixed.LOW_RISK_EXPLANATION, fixed.LOW_RISK_EXPLANATION]


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10)
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_batches_overlap_and_keep_their_order(spark, small_batches):
    """Twelve slow calls in one task, five at a time, the later ones of each five done first."""
    def slow(batch):
        began = time.time()
        time.sleep(0.3 if batch["id"].iloc[0] % 50 == 0 else 0.15)
        return batch.assign(began=began, ended=time.time())

    ids = spark.range(120).coalesce(1)
    schema = "id long, began double, ended double"
    rows = annotate.batch_annotate(ids, slow, schema).collect()
    assert [r.id for r in rows] == list(range(120))
    calls = sorted({(r.began, r.ended) for r in rows})
    assert len(calls) == 12
    together = [sum(b <= began < e for b, e in calls) for began, _ in calls]
    assert 3 <= max(together) <= annotate.IN_FLIGHT
    alone = annotate.batch_annotate(ids, slow, schema, in_flight=1).collect()
    calls = sorted({(r.began, r.ended) for r in alone})
    assert all(a[1] <= b[0] for a, b in zip(calls, calls[1:]))


def test_a_failing_batch_comes_back_with_its_error(spark, small_batches):
    def label(batch):
        if 20 <= batch["id"].iloc[0] < 30:
            raise TimeoutError("no answer")
        return batch[["id"]].assign(label="ok")

    ids = spark.range(60).withColumn("unused", F.lit("x")).coalesce(1)
    schema = "id long, label string, error string"
    rows = annotate.batch_annotate(ids, label, schema, error_column="error").collect()
    assert [r.id for r in rows] == list(range(60))
    failed = {r.id for r in rows if r.error == "TimeoutError: no answer" and r.label is None}
    assert failed == set(range(20, 30))
    assert all(r.label == "ok" and r.error is None for r in rows if r.id not in failed)
    with pytest.raises(Exception, match="no answer"):
        annotate.batch_annotate(ids, label, "id long, label string").collect()
    with pytest.raises(ValueError):
        annotate.batch_annotate(ids, label, "id long", error_column="error")


def test_no_batches(spark):
    none = spark.range(0)
    assert annotate.batch_annotate(none, lambda b: b, "id long").count() == 0
