"""The language model: proper probabilities, the word model by hand, held-out scores, odd rows."""

import re
import zlib
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from acctrisk.llm import lm
from acctrisk.llm.common import held_out, table
from tests.llm.odd import ODD_TEXTS, no_documents, odd_documents

SF_DIR = "/root/testdata/sf0.01"


def base_model(texts):
    counts = Counter()
    for text in texts:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        counts.update(re.findall(r"[^\x20\x09-\x0D]+", low) + ["\n"])
    total = sum(counts.values())

    def score(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        tokens = re.findall(r"[^\x20\x09-\x0D]+", low) + ["\n"]
        logs = [np.log10((counts[t] + 0.1) / (total + 0.1 * (len(counts) + 1))) for t in tokens]
        return len(tokens), sum(counts[t] > 0 for t in tokens), total, sum(logs)

    return score


@pytest.fixture(scope="module")
def fitted(spark):
    docs = table(spark, SF_DIR, "documents")
    return docs, lm.fit(*lm.prepare(docs, ~held_out("doc_id", 10, 0)))


def scores(docs, model):
    return lm.score(*lm.prepare(docs, F.lit(False)), *model).collect()


def test_probabilities_of_all_continuations_add_up_to_one(fitted):
    model = fitted[1][0].model()
    rng = np.random.default_rng(0)
    for _ in range(5):
        window = rng.integers(0, lm.SYMBOLS, (1, 2 * lm.BLOCK))
        every = np.repeat(window, lm.SYMBOLS, axis=0)
        target = np.full((lm.SYMBOLS, lm.BLOCK), lm.PAD)
        place = int(rng.integers(0, lm.BLOCK))
        target[:, place] = np.arange(lm.SYMBOLS)
        assert abs((10 ** model.windows(every, target)[:, place]).sum() - 1) < 1e-4
    rare = model.symbol_of == lm.RARE
    assert abs((10 ** model.rare_log10[rare]).sum() - 1) < 1e-6


def test_counts_of_symbols_stay_within_texts(frame):
    texts = [[5, 6, 7, 5, 6], [], [7], [6, 7, 5]]
    rows = frame("ids binary", *[(np.array(x, "<u2").tobytes(),) for x in texts])
    symbol_of = np.full(10, lm.RARE)
    symbol_of[5:8] = [2, 3, 4]
    pair_of = np.full((lm.SYMBOLS + 1, lm.SYMBOLS + 1), -1, np.int32)
    pair_of[2, 3], pair_of[lm.END, 4], pair_of[4, lm.END] = 0, 1, 2
    subwords, pairs, triples = lm.count_symbols(rows, symbol_of, pair_of, np.dtype("<u2"))
    want = [np.zeros_like(pairs[0]), np.zeros_like(pairs[0])]
    after = np.zeros_like(triples)
    for text in texts:
        line = [lm.END, *symbol_of[text].tolist(), lm.END] if text else [lm.END, lm.END]
        for i, b in enumerate(line):
            for d in range(1, lm.FAR + 2):
                if i >= d:
                    want[min(d, 2) - 1][line[i - d], b] += 1
            if i >= 2 and pair_of[line[i - 2], line[i - 1]] >= 0:
                after[pair_of[line[i - 2], line[i - 1]], b] += 1
    assert (pairs == np.stack(want)).all() and (triples == after).all()
    assert subwords.tolist() == [0, 0, 0, 0, 0, 3, 3, 3, 0, 0]


def test_attention_is_causal_and_scores_each_token_once(fitted):
    model = fitted[1][0].model()
    rng = np.random.default_rng(1)
    ids = rng.integers(0, len(model.symbol_of), 100)
    changed = ids.copy()
    changed[60:] = rng.integers(0, len(model.symbol_of), 40)
    symbols = [np.concatenate(([lm.END], model.symbol_of[x], [lm.END])) for x in (ids, changed)]

    def by_hand(s, upto):
        """Token by token, with the context that its window holds."""
        total = 0.0
        for i in range(upto):
            block = i // lm.BLOCK
            window = np.full(2 * lm.BLOCK, lm.PAD)
            for k in range(2 * lm.BLOCK):
                j = (block - 1) * lm.BLOCK + k
                if 0 <= j <= i:
                    window[k] = s[j]
            target = np.full(lm.BLOCK, lm.PAD)
            target[i % lm.BLOCK] = s[i + 1]
            total += model.windows(window[None], target[None]).sum()
        return total

    for x, s in zip((ids, changed), symbols, strict=True):
        want = by_hand(s, len(x) + 1) + model.rare_log10[x].sum()
        assert abs(model.log10([x, x[:0]])[0] - want) < 1e-3
    assert by_hand(symbols[0], 59) == by_hand(symbols[1], 59)


def test_given_documents(fitted):
    docs, model = fitted
    rows = {r.doc_id: r for r in scores(docs, model)}
    texts = {r.doc_id: r.text for r in docs.collect()}
    out = {i for i in texts if zlib.crc32(str(i).encode()) % 10 == 0}
    score = base_model([t for i, t in texts.items() if i not in out])
    assert set(rows) == set(texts)
    for i, text in texts.items():
        r = rows[i]
        n_tokens, n_known, total, base = score(text)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n_tokens, n_known, total)
        assert abs(r.base_score - base) < 1e-6 * abs(base)
    # on text it has not seen, from few documents, the model keeps up with the word model
    assert sum(rows[i].score for i in out) > 1.01 * sum(rows[i].base_score for i in out)


def test_rare_words_are_joined(fitted, monkeypatch):
    monkeypatch.setattr(lm, "HOT_WORDS", 50)
    monkeypatch.setattr(lm.hot_words, "__defaults__", (50,))
    docs, model = fitted
    few = docs.where("doc_id < 40")
    rows = {r.doc_id: r for r in scores(few, model)}
    monkeypatch.undo()
    for r in scores(few, model):
        assert rows[r.doc_id].n_known == r.n_known
        assert abs(rows[r.doc_id].base_score - r.base_score) < 1e-6 * abs(r.base_score)


def test_odd_rows(frame, fitted):
    rows = scores(odd_documents(frame), fitted[1])
    assert len(rows) == len(ODD_TEXTS) + 3
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append((r.n_tokens, r.n_known, r.base_score, r.score))
        assert np.isfinite(r.score) and r.score < 0
    assert len(by_id[1003]) == 3 and len(set(by_id[1003])) == 1  # repeated rows
    assert by_id[1000] == by_id[1001] and by_id[1000][0][0] == 1  # the end alone
    assert by_id[1009][0][0] == 2


def test_nothing_to_learn_from(frame):
    model = lm.fit(*lm.prepare(no_documents(frame), F.lit(True)))
    assert scores(no_documents(frame), model) == []
    rows = scores(frame("doc_id long, text string", (1, "two words"), (2, None)), model)
    got = {r.doc_id: r for r in rows}
    assert got[1].n_known == 0 and got[1].train_tokens == 0 and got[1].n_tokens == 3
    assert abs(got[1].base_score) < 1e-9  # every token has the whole smoothing mass
    assert np.isfinite(got[2].score)


def test_window_reaches_beyond_eight_subwords(fitted):
    model = fitted[1][0].model()
    window = np.random.default_rng(2).integers(0, lm.SYMBOLS, (5, 2 * lm.BLOCK))
    weight = model.attend(window, window[:, lm.BLOCK:])[0]
    assert ((weight > 0).sum(2) >= np.arange(9, 17)).all()


def test_older_tokens_have_counts_of_more_than_one_distance(frame):
    rows = frame("ids binary", (np.array([5, 6, 7, 8], "<u2").tobytes(),))
    symbol_of = np.full(10, lm.RARE)
    symbol_of[5:9] = [2, 3, 4, 5]
    pair_of = np.full((lm.SYMBOLS + 1, lm.SYMBOLS + 1), -1, np.int32)
    far = lm.count_symbols(rows, symbol_of, pair_of, np.dtype("<u2"))[1][1]
    assert far[2, 4] == 1 and far[2, 5] == 1


def test_running_text_scores_as_single_windows(fitted):
    model = fitted[1][0].model()
    rng = np.random.default_rng(3)
    line = rng.integers(0, lm.SYMBOLS, (50, 2 * lm.BLOCK + 1))
    line[:10, :lm.BLOCK] = lm.PAD
    window, target = line[:, :-1], line[:, lm.BLOCK + 1:].copy()
    target[5, 3:] = lm.PAD
    assert np.allclose(model.running(window, target), model.windows(window, target), atol=1e-4)


def test_symbols_and_pairs_are_chosen_from_all_texts(spark, frame):
    """Subwords that only texts outside any small sample have, and late in a long text."""
    rows = [(i, f"common words in number {i % 7}", True) for i in range(6000)]
    late = "common words " * 3000 + "quartz zebra " * 400
    rows += [(9000 + i, "meadow violet " * 300, True) for i in range(2)] + [(9100, late, True)]
    prepared, path = lm.prepare(frame("doc_id long, text string, learn boolean", *rows),
                                F.col("learn"))
    weights, _ = lm.fit(prepared, path)
    encoding = lm.byte_bpe.load(path)
    for text in (" meadow violet meadow", " quartz zebra quartz"):
        symbols = weights.symbol_of[lm.byte_bpe.encode_text(encoding, text)]
        assert (symbols > lm.RARE).all()
        assert (weights.pair_of[symbols[:-1], symbols[1:]] >= 0).all()


def test_windows_grow_with_the_texts(frame):
    kind, sizes = np.dtype("<u2"), []
    for n in (200, 800):
        texts = frame("doc_id long, ids binary", *[
            (i, np.full(8 * 64, 7, "<u2").tobytes()) for i in range(n)])
        sizes.append(len(lm.fit_windows(texts, kind, 16)))
        assert abs(sizes[-1] - n * 65 / 16) < 0.1 * n
    lines = lm.fit_windows(texts, kind, 1)
    assert len(lines) == 800 * 65 and (lines[:, lm.BLOCK:] != -2).any(1).all()


def random_texts(frame, weights, lengths):
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, len(weights.symbol_of), n) for n in lengths]
    rows = frame("ids binary", *[(x.astype("<u2").tobytes(),) for x in texts])
    return texts, rows.coalesce(1)


def test_every_window_of_all_texts_trains_the_attention(fitted, frame):
    weights = fitted[1][0]
    texts, rows = random_texts(frame, weights, [0, 3, 500, 8, 7, 120, 1])
    subwords = sum(map(len, texts))
    got = lm.train(rows, weights, subwords, np.dtype("<u2"))
    own = replace(weights, **{
        k: getattr(weights, k).copy() for k in ("query", "key", "bias", "sink")})
    model, added, windows = weights.model(), lm.Slopes(), 0
    for ids in texts:
        line = np.concatenate((np.full(lm.BLOCK, lm.PAD), [lm.END], weights.symbol_of[ids],
                               [lm.END], np.full(2 * lm.BLOCK, lm.PAD)))
        for at in range(0, len(ids) + 1, lm.BLOCK):
            window = line[None, at:at + 2 * lm.BLOCK].copy()
            window[0, lm.BLOCK + max(0, len(ids) + 1 - at):] = lm.PAD  # the final end asks nothing
            target = line[None, at + lm.BLOCK + 1:at + 2 * lm.BLOCK + 1]
            added.add(model, window, target, model.attend(window, target))
            windows += 1
    assert added.targets == subwords + len(texts)
    lm.Adam(own.parameters()).step(added, lm.TASK_RATE * windows / lm.TASK_BATCH)
    for mine, hand in zip(got.parameters(), own.parameters(), strict=True):
        assert np.isclose(mine, hand, atol=1e-6).mean() > 0.999
    assert (got.query != weights.query).any() and (got.bias != weights.bias).any()
    assert lm.train(rows.limit(0), weights, 0, np.dtype("<u2")) is weights


def test_slopes_are_those_of_the_log_probability(fitted):
    weights = fitted[1][0]
    rng = np.random.default_rng(6)
    line = rng.integers(0, 60, (400, 2 * lm.BLOCK + 1))
    window, target = line[:, :-1], line[:, lm.BLOCK + 1:]
    model, added = weights.model(), lm.Slopes()
    added.add(model, window, target, model.attend(window, target))

    def loss(name, index, by):
        changed = getattr(weights, name).copy()
        changed[index] += by
        return -replace(weights, **{name: changed}).model().windows(
            window, target).sum(dtype=float) * np.log(10)

    by_pair = added.pairs.reshape(lm.SYMBOLS + 1, -1)[:lm.SYMBOLS, :lm.SYMBOLS] / np.sqrt(lm.DIMENSIONS)
    for name, index, slope in (
            ("bias", 1, added.distances[1]), ("bias", 9, added.distances[9]),
            ("sink", 7, added.sinks[7]), ("query", (5, 2), by_pair[5] @ weights.key[:, 2]),
            ("key", (9, 4), by_pair[:, 9] @ weights.query[:, 4])):
        want = (loss(name, index, 0.05) - loss(name, index, -0.05)) / 0.1
        assert abs(slope - want) < 0.03 * abs(want) + 0.05, name


def test_training_on_all_windows_makes_unseen_texts_likelier(spark, monkeypatch):
    """The start is a bounded sample; what it leaves out is learnt from, too."""
    prepared, path = lm.prepare(table(spark, SF_DIR, "documents"), ~held_out("doc_id", 10, 0))
    monkeypatch.setattr(lm, "FIT_WINDOWS", 1 << 10)
    trained, _ = lm.fit(prepared, path)
    monkeypatch.setattr(lm, "train", lambda texts, weights, *_: weights)
    start, _ = lm.fit(prepared, path)
    unseen = prepared.where("not learn").select("ids").toArrow()["ids"].to_pylist()
    unseen = [np.frombuffer(x, "<u2").astype(np.int64) for x in unseen]
    assert trained.model().log10(unseen).sum() > start.model().log10(unseen).sum()


def test_a_task_unpacks_little_of_the_model(fitted):
    arrays = [x for x in vars(fitted[1][0].model()).values() if isinstance(x, np.ndarray)]
    assert sum(x.nbytes for x in arrays) < 24 << 20


def test_counts_travel_in_few_bytes(spark):
    rng = np.random.default_rng(7)
    small, large = rng.integers(0, 256, 1 << 16), np.array([0, 3, (1 << 40) + 1, -5])
    rows = list(lm.counters.pieces(0, [small]))
    assert len(rows) == 1 and len(rows[0][2]) < 1.01 * len(small)
    for values in (small, large, np.zeros(3, np.int64)):
        rows = [row for task in range(70) for row in lm.counters.pieces(task, [values])]
        counted = spark.createDataFrame(rows, lm.counters.COLUMNS).repartition(70)
        assert (lm.counters.added_up(counted, len(values)) == 70 * values).all()
