"""Exact top-k against brute force."""

import numpy as np
import pytest

from acctrisk.llm import topk
from acctrisk.llm.common import table

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>, score string, rank string, label int"


def brute(vectors, k=20, every=20):
    width = max((len(v) for _, v in vectors), default=0)
    rows = [(i, [int(np.floor(64 * np.float64(x))) for x in v] + [0] * (width - len(v)))
            for i, v in vectors]
    out = []
    for i, q in rows:
        if i % every == 0:
            hits = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in rows if j != i)
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(hits[:k])]
    return sorted(out)


def test_given_vectors(spark):
    vectors = table(spark, SF_DIR, "embeddings")
    got = sorted(map(tuple, topk.search(vectors).collect()))
    assert got == brute([(r.vec_id, r.embedding) for r in vectors.collect()])


@pytest.mark.parametrize("seed,rings", [(0, 1), (1, 4)])
def test_clustered_vectors_with_many_annuli(frame, monkeypatch, seed, rings):
    monkeypatch.setattr(topk, "ANNULUS", 8 if rings > 1 else 4096)
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "ASKED", 4)
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, 5)) * 3
    x = centres[rng.integers(0, 6, 700)] + 0.05 * rng.standard_normal((700, 5))
    x[100:200] = x[100]  # many ties
    vectors = [(i, v.tolist()) for i, v in enumerate(x)]
    rows = frame(SCHEMA, *[(*v, "s", "r", 1) for v in vectors])
    assert sorted(map(tuple, topk.search(rows).collect())) == brute(vectors)


def test_bounds_spare_most_annuli():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((16, 8)) * 500
    x = centres[rng.integers(0, 16, 4000)] + rng.standard_normal((4000, 8))
    square = float((x * x).sum(1).max())
    layout = topk.fit(x, 4000, square)
    annulus, far = layout.place(x)
    rings = layout.edges.shape[1] + 1
    numbers = np.unique(annulus)
    known = topk.Directory(
        numbers, numbers // rings, np.array([far[annulus == a].min() for a in numbers]),
        np.array([far[annulus == a].max() for a in numbers]), np.ones(len(numbers)))
    query, scores = x[:1], x @ x[0]
    least = np.sort(scores)[-21]
    reach = np.sqrt((query * query).sum() + square - 2 * least)
    open_ = known.bounds(layout.asked(query))[0] <= reach + 1e-3
    assert open_.sum() < len(numbers) / 2
    assert set(annulus[scores >= least]) <= set(numbers[open_])


def test_odd_rows(frame):
    vectors = [(0, [1.0, 0.5]), (20, [0.25]), (40, [-1.0, 2.0]), (1, [0.5, 0.5]), (2, [3.0, -3.0])]
    odd = [(60, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (80, [float("inf"), 0.0]),
           (None, [9.0, 9.0])]
    rows = frame(SCHEMA, *[(*v, "s", "r", None) for v in vectors + odd])
    assert sorted(map(tuple, topk.search(rows).collect())) == brute(vectors)


def test_repeated_rows(frame):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (5, [0.5, 0.5]), (5, [0.5, 0.5])]
    got = sorted(map(tuple, topk.search(
        frame(SCHEMA, *[(*v, "s", "r", None) for v in rows])).collect()))
    assert got == [(0, 1, 5, 2048)] * 2 + [(0, 2, 5, 2048)] * 2


def test_large_numbers_stay_exact(frame):
    vectors = [(i, [1e6 + i, -1e6, 3.0 * i]) for i in range(41)]
    rows = frame(SCHEMA, *[(*v, "s", "r", None) for v in vectors])
    assert sorted(map(tuple, topk.search(rows).collect())) == brute(vectors)


@pytest.mark.parametrize("size", [1e7, 3e9, 1e14])
def test_huge_numbers_stay_exact(frame, size):
    """Products beyond 2^52 and, in part, beyond 2^63."""
    rng = np.random.default_rng(3)
    vectors = [(i, [1.0, 0.25 * (i % 3)]) for i in range(0, 60, 20)]
    vectors += [(i, (size * rng.uniform(-1, 1, 2)).tolist()) for i in range(1, 60) if i % 20]
    rows = frame(SCHEMA, *[(*v, "s", "r", None) for v in vectors])
    assert sorted(map(tuple, topk.search(rows).collect())) == brute(vectors)


def test_small_query_and_large_candidates(frame):
    vectors = [(0, [1.0, 0.0]), (1, [1e9, 0.0]), (2, [2e9, 0.0]), (3, [5e7, 0.0])]
    rows = frame(SCHEMA, *[(*v, "s", "r", None) for v in vectors])
    assert sorted(map(tuple, topk.search(rows).collect())) == [
        (0, 1, 2, 8_192_000_000_000), (0, 2, 1, 4_096_000_000_000), (0, 3, 3, 204_800_000_000)]


def test_scores_beyond_64_bits_stop(frame):
    rows = frame(SCHEMA, (0, [1e15], "s", "r", 1), (1, [1e16], "s", "r", 1))
    with pytest.raises(Exception, match="64 bits"):
        topk.search(rows).collect()
    with pytest.raises(Exception, match="64 bits"):
        topk.search(frame(SCHEMA, (0, [1e300], "s", "r", 1))).collect()


def test_no_rows(frame):
    assert topk.search(frame(SCHEMA)).count() == 0
    assert topk.search(frame(SCHEMA, (1, [], "s", "r", 1), (2, None, "s", "r", 1))).count() == 0
    assert topk.search(frame(SCHEMA, (1, [1.0], "s", "r", 1))).columns == [
        "query_id", "rank", "vec_id", "score"]
