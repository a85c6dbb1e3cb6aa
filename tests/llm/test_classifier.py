"""The factorisation machine: identity, held-out accuracy and odd rows."""

import numpy as np

from acctrisk.llm import classifier
from acctrisk.llm.common import held_out, table
from tests.llm.odd import ODD_TEXTS, no_documents, odd_documents

SF_DIR = "/root/testdata/sf0.01"


def test_scores_equal_the_sum_over_all_pairs():
    rng = np.random.default_rng(3)
    width = classifier.BUCKETS + classifier.STATISTICS
    machine = classifier.Machine(
        np.zeros(classifier.STATISTICS), np.ones(classifier.STATISTICS), 0.3,
        rng.standard_normal(width).astype(np.float32) * 0.1,
        rng.standard_normal((width, 8)).astype(np.float32) * 0.1)
    texts = ["One, two | three!! 4", "", "word " * 30]
    buckets = classifier.Buckets()
    x = machine.matrix([classifier.vector(t, buckets) for t in texts])
    for row, got in zip(x, machine.scores(x), strict=True):
        at = np.flatnonzero(row)
        pairs = sum(row[i] * row[j] * float(machine.factors[i] @ machine.factors[j])
                    for a, i in enumerate(at) for j in at[a + 1:])
        want = 1 / (1 + np.exp(-(0.3 + row @ machine.linear + pairs)))
        assert abs(want - got) < 1e-5


def test_held_out_accuracy(spark):
    docs, labels = (table(spark, SF_DIR, t) for t in ("documents", "labels"))
    machine = classifier.fit(docs, labels.where(~held_out("doc_id", 5, 0)))
    rows = (classifier.score(docs, machine).join(labels, "doc_id")
            .where(held_out("doc_id", 5, 0) & labels.quality.isNotNull()).collect())
    assert len(rows) > 50
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_odd_rows(frame):
    docs = odd_documents(frame)
    labels = frame("doc_id long, quality int", (1003, 1), (1003, 0), (1004, 0), (1005, None),
                   (None, 1), (1009, 1), (99, 1))
    machine = classifier.fit(docs, labels)
    rows = classifier.score(docs, machine).collect()
    assert len(rows) == len(ODD_TEXTS) + 3
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, set()).add(r.score)
    assert all(len(s) == 1 and 0 <= min(s) <= 1 for s in by_id.values())
    assert by_id[1000] == by_id[1001]  # null counts as empty


def test_no_rows_and_one_label(frame):
    labels = frame("doc_id long, quality int")
    machine = classifier.fit(no_documents(frame), labels)
    assert classifier.score(no_documents(frame), machine).count() == 0
    only = classifier.fit(odd_documents(frame), frame("doc_id long, quality int", (1003, 1)))
    scores = {r.score for r in classifier.score(odd_documents(frame), only).collect()}
    assert len(scores) == 1
