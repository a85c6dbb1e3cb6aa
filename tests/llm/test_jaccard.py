"""Near duplicates against all pairs."""

import re
from itertools import combinations

import numpy as np
import pyarrow as pa

from acctrisk.llm import jaccard
from acctrisk.llm.common import table
from acctrisk.llm.components import components
from acctrisk.llm.hashing import Powers, hashed_words
from tests.llm.odd import ODD_TEXTS, no_documents, odd_documents

SF_DIR = "/root/testdata/sf0.001"


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(5))))


def brute(docs, percent=80):
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(docs)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            root[find(i)] = find(j)
    ids = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            ids[find(i)] = min(ids.get(find(i), doc_id), doc_id)
    return [(d, len(sets[i]), ids.get(find(i))) for i, (d, _) in enumerate(docs)]


def key(row):
    return tuple((x is not None, x) for x in row)


def check(frame, docs):
    rows = frame("doc_id long, text string, sig string, n string, root string",
                 *[(*d, "a", "b", "c") for d in docs])
    got = jaccard.join(rows).documents.select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(docs), key=key)


def test_given_documents(spark):
    docs = table(spark, SF_DIR, "documents")
    got = jaccard.join(docs).documents.select("doc_id", "n_shingles", "component_id").collect()
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(tuple, got)) == sorted(want)


def edited(rng, words, share):
    out = list(words)
    for i in np.flatnonzero(rng.random(len(out)) < share):
        out[i] = f"new{rng.integers(1 << 30)}"
    return out


def test_chains_boundaries_and_shared_passages(frame):
    """Near copies of all degrees, chains of edits, one passage in many texts, short texts."""
    rng = np.random.default_rng(4)
    texts, passage = [], [f"p{i}" for i in range(40)]
    for base in range(6):
        words = [f"w{base}x{i}" for i in range(60 + 40 * base)]
        chain = words
        for _ in range(12):
            texts.append(" ".join(edited(rng, words, rng.choice([0.01, 0.02, 0.03, 0.05]))))
            chain = edited(rng, chain, 0.02)
            texts.append(" ".join(chain))
            texts.append(" ".join(words[:int(rng.integers(40, len(words)))]))
    for i in range(40):
        own = [f"o{i}y{k}" for k in range(int(rng.integers(0, 60)))]
        texts.append(" ".join(passage + own if i % 2 else own + passage))
    texts += ["One two", "one TWO", "one two three four five", "one two three four five six",
              "a b c d e f g h i", "a b c d e f g h i j", "a b c d e f g h x"]
    order = rng.permutation(len(texts))
    check(frame, [(int(i), texts[i]) for i in order])


def test_exact_boundary(frame):
    words = [f"w{i}" for i in range(200)]
    docs = [(1, " ".join(words[:13])), (2, " ".join(words[:11] + ["x"]))]  # 9 and 8 shingles
    docs += [(3, " ".join(words[50:58])), (4, " ".join(words[50:59]))]  # 4 of 5: linked
    docs += [(5, " ".join(words[100:107])), (6, " ".join(words[100:108]))]  # 3 of 4: not
    check(frame, docs)


def test_odd_rows(frame):
    docs = [(1000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(1003, "one")] * 2
    got = jaccard.join(odd_documents(frame)).documents.select(
        "doc_id", "n_shingles", "component_id").collect()
    want = brute(docs + [(None, "no id")])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_no_rows(frame):
    joined = jaccard.join(no_documents(frame))
    assert joined.documents.count() == 0 and joined.links.count() == 0


def test_many_copies_cost_few_checks_each(frame):
    words = [f"w{i}" for i in range(120)]
    docs = [(0, " ".join(words))] + [
        (i, " ".join(words[:i % 90 + 5] + [f"v{i}"] + words[i % 90 + 6:])) for i in range(1, 300)]
    rows = frame("doc_id long, text string", *docs)
    met = jaccard.meetings(jaccard.prefixes(jaccard.measure(rows, 5, 4).cache(), 80), 80).cache()
    assert jaccard.first_round(met, 80).count() <= 300
    joined = jaccard.join(rows)
    assert {r.component_id for r in joined.documents.collect()} == {0}
    assert joined.links.count() < 600


def test_groups_across_batches():
    """Groups come out the same however rows are cut into batches."""
    rng = np.random.default_rng(0)
    rows = sorted({(int(s), int(n), int(c)) for s, n, c in zip(
        rng.integers(0, 9, 900), rng.integers(5, 40, 900), rng.integers(0, 70, 900))})
    x = np.array([(s, c, n, 0) for s, n, c in rows]).T
    group = np.unique(x[0], return_inverse=True)[1]
    ok = jaccard.with_partner(x, group, int(np.bincount(group).max()), 80)
    for i, (s, n, c) in enumerate(rows):
        want = any(s == t and (n, c) != (m, d) and 80 * max(n, m) <= 100 * min(n, m)
                   and 180 * min(n, m) >= 80 * (n + m) for t, m, d in rows)
        assert ok[i] == want


def test_prefixes_hold_the_rarest_shared_shingles(frame):
    docs = [(i, "a passage that all of the texts share " + f"x{i} " * 6 + f"pair {i // 2} of two here")
            for i in range(40)] + [(99, "nothing in common with any other text")]
    measured = jaccard.measure(frame("doc_id long, text string", *docs), 5, 3).cache()
    sizes = {r.sig: r.n for r in measured.where("chunk is null").collect()}
    rows = jaccard.prefixes(measured, 80).collect()
    times = {}
    for r in rows:
        times.setdefault(r.shingle, set()).add(r.sig)
        assert r.n == sizes[r.sig] and r.pos < jaccard.prefix_length(r.n, 80)
    alone = {i: sum(s not in set().union(*(shingles(t) for j, t in docs if j != i))
                    for s in shingles(text)) for i, text in docs}
    for r in measured.where("chunk is null").collect():
        want = max(jaccard.prefix_length(r.n, 80) - alone[r.doc_id], 0)
        assert sum(x.sig == r.sig for x in rows) == want


def test_packing():
    ids = np.sort(np.random.default_rng(1).integers(0, 1 << 36, 5000).astype(np.uint64))
    assert (np.cumsum(jaccard.unpacked(jaccard.packed(jaccard.steps(ids)))) == ids).all()
    assert len(jaccard.unpacked(jaccard.packed(ids[:0]))) == 0
    sigs = np.array([-5, 7, -(1 << 63)], dtype=np.int64)
    assert (jaccard.unpacked(jaccard.packed(sigs.view(np.uint64))).view(np.int64) == sigs).all()


def test_word_hashes():
    texts = ["The cat  the\tCAT", "", None, "x" * 3_000_000 + " the", "\n cat", "É é"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    hashes, upto = hashed_words(batch, Powers())
    parts = [h.tolist() for h in np.split(hashes, upto[:-1])]
    assert [len(p) for p in parts] == [4, 0, 0, 2, 1, 2]
    the, cat = parts[0][:2]
    assert parts[0] == [the, cat, the, cat] and parts[3][1] == the and parts[4] == [cat]
    assert parts[5][0] != parts[5][1]  # only A-Z are folded
    assert len({the, cat, *parts[3][:1], *parts[5]}) == 5


def test_components(frame, spark):
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(-60, 400, (260, 2))]
    links += [(i, i + 1) for i in range(1000, 1100)] + [(2000, 3000 + i) for i in range(200)]
    links += [(5, 5)] + links[:10]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.node: r.root for r in components(frame("a long, b long", *links)).collect()}
    assert got == {i: find(i) for i in list(root) if find(i) != i}
    assert components(frame("a long, b long")).count() == 0
