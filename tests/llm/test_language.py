"""Language identification: kernel by hand, held-out accuracy and odd rows."""

import numpy as np
import pytest

from acctrisk.llm import language
from acctrisk.llm.common import held_out, table
from tests.llm.odd import ODD_TEXTS, no_documents, odd_documents

SF_DIR = "/root/testdata/sf0.01"


def by_hand(text):
    low = text.lower()
    return {low[i:i + n] for n in (1, 2, 3) for i in range(len(low) - n + 1)}


def kernel_by_hand(a, b):
    x, y = by_hand(a), by_hand(b)
    return len(x & y) / (len(x) * len(y)) ** 0.5 if x and y else 0.0


def chinese(length, distinct=3000, seed=0):
    points = np.random.default_rng(seed).integers(0x4E00, 0x4E00 + distinct, length)
    return "".join(map(chr, points))


TEXTS = ["the house", "a mouse", "Größe", "", "a", "ab", "\U0010FFFF\U0010FFFF\U0010FFFF\0\0",
         "\0", chinese(300), "the house", "İstanbul"]


def test_grams_are_told_apart_exactly():
    for text in TEXTS:
        assert len(language.grams(text)) == len(by_hand(text))


@pytest.mark.parametrize("columns", [1 << 14, 7])
def test_kernel_counts_shared_grams(monkeypatch, columns):
    monkeypatch.setattr(language, "COLUMNS", columns)
    landmarks = language.Landmarks.of([language.grams(x) for x in TEXTS])
    near = landmarks.kernel([language.grams(x) for x in TEXTS])
    for i, a in enumerate(TEXTS):
        for j, b in enumerate(TEXTS):
            assert abs(near[i, j] - kernel_by_hand(a, b)) < 1e-12
    for found, text in zip(landmarks.sets(), TEXTS, strict=True):
        assert (found == language.grams(text)).all()


def test_kernel_of_a_long_text_of_many_grams():
    """60,000 characters with far more distinct n-grams than all landmarks have."""
    marks = ["the quick brown fox", chinese(200, seed=1), "もう一つ"]
    text = chinese(60_000)
    near = language.Landmarks.of([language.grams(x) for x in marks]).kernel([language.grams(text)])
    assert np.allclose(near[0], [kernel_by_hand(text, x) for x in marks], atol=1e-12)


def test_predictions_by_hand(frame):
    """The whole way against kernels of Python sets and a ridge regression per language."""
    words = {"en": "the of and house mouse street water", "de": "der die und haus maus strasse wasser",
             "zh": " ".join(chinese(3, 40, i) for i in range(12))}
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice(words[k].split(), 6)), k)
            for i, k in enumerate(["en", "de", "zh"] * 12)]
    docs = frame("doc_id long, text string, lang string", *rows)
    model = language.fit(docs, landmarks=9)
    chosen = [next(t for _, t, _ in rows if np.array_equal(language.grams(t), s))
              for s in model.landmarks.sets()]
    assert len(chosen) == 9
    near = np.array([[kernel_by_hand(a, b) for b in chosen] for a in chosen])
    full = np.array([[kernel_by_hand(t, b) for b in chosen] for _, t, _ in rows])
    again = language.train(model.landmarks, near, full, [k for _, _, k in rows])
    scores = full @ again.weights + again.offset
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, model).collect()}
    for (i, _, _), row in zip(rows, scores, strict=True):
        name, score = found[i]
        assert name == again.languages[row.argmax()]
        assert abs(score - min(max(row.max(), 0), 1)) < 1e-6


def test_long_texts_are_landmarks_of_bounded_size_and_told_apart(frame):
    rows = [(i, chinese(60_000, seed=i), "zh") for i in range(3)]
    rows += [(10 + i, "a short english text about houses " * (i + 1), "en") for i in range(5)]
    rows += [(20 + i, chinese(400, seed=100 + i), "zh") for i in range(5)]
    docs = frame("doc_id long, text string, lang string", *rows)
    model = language.fit(docs)
    assert sorted(model.landmarks.sizes)[-3:] == [language.LANDMARK_GRAMS] * 3
    assert all(set(x) <= set(language.grams(t)) for x, t in zip(
        [language.landmark_grams(t) for _, t, _ in rows], [t for _, t, _ in rows], strict=True))
    assert {r.doc_id: r.lang_pred for r in language.identify(docs, model).collect()} == {
        i: k for i, _, k in rows}


def test_held_out_accuracy(spark):
    docs = table(spark, SF_DIR, "documents")
    model = language.fit(docs.where(~held_out("doc_id", 3, 1)))
    rows = (language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
            .where(held_out("doc_id", 3, 1)).collect())
    assert len(rows) > 200
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(frame, spark):
    model = language.fit(table(spark, SF_DIR, "documents"), rows=50, landmarks=16)
    docs = odd_documents(frame)
    rows = language.identify(docs, model).collect()
    assert len(rows) == len(ODD_TEXTS) + 3
    got = {r.doc_id: (r.lang_pred, r.score) for r in rows}
    for i, text in enumerate(ODD_TEXTS):
        unknown = not any(c.isalpha() for c in text or "")
        assert (got[1000 + i][0] == "und") == unknown
        assert not unknown or got[1000 + i][1] == 0
    kept = language.keep(docs, model, 0.0)
    assert kept.columns == docs.columns
    assert all(got[r.doc_id][0] != "und" for r in kept.collect())


def test_nothing_to_learn_from(frame):
    model = language.fit(odd_documents(frame))  # no language is given
    assert {r.lang_pred for r in language.identify(odd_documents(frame), model).collect()} == {
        "und"}
    assert language.identify(no_documents(frame), language.fit(no_documents(frame))).count() == 0


def test_one_language_and_repeated_rows(frame):
    rows = [(1, "some words here", "en")] * 5 + [(2, "other words", "en"), (3, None, "en")]
    docs = frame("doc_id long, text string, lang string", *rows)
    found = language.identify(docs, language.fit(docs)).collect()
    assert sorted(r.lang_pred for r in found) == ["en"] * 6 + ["und"]
