"""Rule counts against a plain reckoning, the forest, and odd rows."""

import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from acctrisk.llm import rules
from acctrisk.llm.common import table
from tests.llm.odd import ODD_TEXTS, no_documents, odd_documents

SF_DIR = "/root/testdata/sf0.01"
WORD = r"[^\x20\x09-\x0D]+"


def plain(text):
    words = re.findall(WORD, text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\té#|\x0b\x1c", max_size=80))
def test_counts_equal_a_plain_reckoning(text):
    assert rules.statistics(text)[0] == plain(text)


def test_counts_of_odd_texts():
    for text in ODD_TEXTS[1:8]:
        assert rules.statistics(text)[0] == plain(text)


def test_many_distinct_words_are_ranked_exactly():
    words = [f"w{i}" for i in range(9000)] + [f"w{i}" for i in range(20, 40)]
    ids = np.array([int(w[1:]) for w in words])
    assert rules.covered_by_repeats(ids, 9000) == plain(" ".join(words))[4] == 40


def test_path_lengths_of_a_forest_single_out_the_outlier():
    rng = np.random.default_rng(0)
    x = np.concatenate((rng.standard_normal((400, 3)), [[9, -9, 9]]))
    scores = rules.fit_forest(x, trees=100).scores(x)
    assert scores.argmax() == 400 and scores[400] > 0.6 and np.median(scores) < 0.5


def test_calibration():
    scores = np.array([0.9, 0.8, 0.8, 0.4, 0.3, 0.2])
    good = np.array([False, False, False, True, True, True])
    assert 0.4 < rules.calibrate(scores, good) < 0.8
    assert rules.calibrate(scores, np.ones(6, bool)) == float("inf")
    assert rules.calibrate(np.ones(4), np.array([True, True, True, False])) == float("inf")


def test_given_documents(spark):
    docs, labels = (table(spark, SF_DIR, t) for t in ("documents", "labels"))
    measured = rules.measure(docs).cache()
    judged = rules.judge(measured, rules.fit(measured, labels)).join(labels, "doc_id").collect()
    open_ = [r for r in judged if not r.base_failed]
    assert np.mean([r.kept for r in open_ if r.quality == 1]) > 0.97
    assert np.mean([not r.kept for r in judged if r.quality == 0]) > 0.9
    texts = {r.doc_id: r.text for r in docs.limit(60).collect()}
    for r in judged:
        if r.doc_id in texts:
            counts = [r[c] for c in rules.COUNTS]
            assert counts == plain(texts[r.doc_id])
            assert r.base_failed == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])


def test_odd_rows(frame):
    docs = odd_documents(frame)
    labels = frame("doc_id long, quality int", (1004, 0), (1004, 1), (None, 0), (1008, None))
    measured = rules.measure(docs)
    forest = rules.fit(measured, labels)
    rows = {r.doc_id: r for r in rules.judge(measured, forest).collect()}
    assert len(rows) == len(ODD_TEXTS) + 1
    assert rows[1000].n_words == rows[1001].n_words == 0 and rows[1000].base_failed
    assert not rows[1000].kept and rows[1008].base_failed
    kept = rules.keep(docs, forest)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, r in rows.items() if r.kept}


def test_no_rows(frame):
    measured = rules.measure(no_documents(frame))
    forest = rules.fit(measured, frame("doc_id long, quality int"))
    assert rules.judge(measured, forest).count() == 0
    assert rules.keep(no_documents(frame), forest).count() == 0


def test_every_count_reaches_the_forest():
    """Texts that differ in one count alone differ in the features."""
    words = "some plain words make up this text without any marks at all".split()
    text = "\n".join(" ".join(words[i:] + words[:i]) for i in range(0, 8, 2))
    line = text.split("\n")[0]
    for other in (text.replace("some", "s|me"), text.replace("plain", "plainplainplain"),
                  text + "\n" + line, text + " more"):
        assert rules.statistics(other)[1] != rules.statistics(text)[1]
    at = rules.FEATURES.index
    one, two = rules.statistics(text)[1], rules.statistics(text + "\n" + line)[1]
    assert two[at("repeated")] > one[at("repeated")]
    assert np.isclose(two[at("n_words")], np.log1p(len(text.split()) + len(words)))
    assert rules.statistics("")[1] == [np.log(0.01)] * 6 + [0.0, 0.0]


def test_scores_are_mean_path_lengths_walked_by_hand():
    rng = np.random.default_rng(3)
    x = np.round(rng.standard_normal((300, 4)), 1)
    forest = rules.fit_forest(x, trees=20, rows=64, seed=2)

    def expected(n):  # mean path of an unsuccessful search
        if n < 2:
            return 0.0
        return 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n

    def walk(tree, row):
        node, steps = 0, 0
        while forest.left[tree, node] != node:
            smaller = row[forest.feature[tree, node]] < forest.split[tree, node]
            node = (forest.left if smaller else forest.right)[tree, node]
            steps += 1
        rest = forest.path[tree, node] - steps
        assert min(abs(rest - expected(n)) for n in range(1, 65)) < 1e-9
        return steps + rest

    want = [2 ** (-np.mean([walk(t, row) for t in range(20)]) / expected(64)) for row in x]
    assert np.allclose(forest.scores(x), want, atol=1e-12)


def test_threshold_of_a_table_equals_that_of_arrays(frame):
    rng = np.random.default_rng(4)
    for shift, digits in ((0.3, 12), (0.1, 2), (0.0, 12)):
        good = rng.random(3000) < 0.8
        scores = np.round(np.clip(0.45 + 0.1 * rng.standard_normal(3000) + shift * ~good, 0, 1), digits)
        rows = frame("score double, good boolean", *zip(scores.tolist(), good.tolist(), strict=True))
        assert rules.calibrate_all(rows) == rules.calibrate(scores, good)
    assert rules.calibrate_all(rows.where("good")) == float("inf")
    assert rules.calibrate_all(rows.limit(0)) == float("inf")


def measured_rows(spark, n):
    """n usual rows, every fifth a bad one far off; only ids above 20,000 are bad."""
    far = F.when((F.col("id") > 20_000) & (F.col("id") % 5 == 0), 9.0).otherwise(0.0)
    feature = far + F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    counts = [F.lit(0 if c == "n_repeat_words" else 100).cast("long").alias(c) for c in rules.COUNTS]
    measured = spark.range(n).select(
        F.col("id").alias("doc_id"), *counts,
        F.array(*[feature + k for k in range(len(rules.FEATURES))]).alias("features"))
    labels = spark.range(n).select(
        F.col("id").alias("doc_id"), F.when(far > 0, 0).otherwise(1).alias("quality"))
    return measured, labels


def test_every_labelled_row_counts(spark, monkeypatch):
    """Of 30,000 labelled rows, more than a bounded sample holds, none is left out."""
    seen = []
    whole = rules.calibrate_all
    monkeypatch.setattr(rules, "calibrate_all", lambda rows: seen.append(rows.count()) or whole(rows))
    measured, labels = measured_rows(spark, 30_000)
    forest = rules.fit(measured, labels)
    assert seen == [30_000]
    judged = rules.judge(measured, forest).join(labels, "doc_id")
    assert judged.where("kept <> (quality = 1)").count() == 0


def test_trees_draw_from_all_rows(spark):
    known = measured_rows(spark, 3000)[0].select("doc_id", F.array(
        *[F.col("doc_id").cast("double")] * len(rules.FEATURES)).alias("features"))
    samples = rules.tree_samples(known, trees=100, rows=64)
    assert [len(x) for x in samples] == [64] * 100
    assert all(len(np.unique(x[:, 0])) == 64 for x in samples)
    drawn = np.unique(np.concatenate(samples)[:, 0])
    assert len(drawn) > 2500 and drawn.max() > 2900  # 64 of 3000, a hundred times
    few = rules.tree_samples(known.where("doc_id < 10"), trees=3, rows=64)
    assert [sorted(x[:, 0]) for x in few] == [list(map(float, range(10)))] * 3
    assert [len(x) for x in rules.tree_samples(known.limit(0), trees=3)] == [0, 0, 0]
