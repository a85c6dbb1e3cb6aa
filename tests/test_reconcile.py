import random
import tracemalloc
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tests.conftest import by_key

from acctrisk.functions import similarity
from acctrisk.functions.similarity import lcs_lengths, token_sort
from acctrisk.operators import reconcile

NAMES = ["BrightPath Solutions", "Pinnacle Media Group", "Vanguard Retail", "Thunderbolt Motors",
         "Crescent Labs", "Meridian Health", "NovaTech Industries"]


@pytest.fixture
def accounts(frame):
    return frame("account_id long, account_name string",
                 *[(1001 + i, n) for i, n in enumerate(NAMES)])


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def ratio(a, b):
    a, b = (" ".join(sorted(t.lower().split())) for t in (a, b))
    return 200.0 * lcs(a, b) / (len(a) + len(b))


def test_lcs_on_mixed_lengths(frame):
    rng = random.Random(3)
    pairs = [("".join(rng.choices("abcé😀 ", k=rng.randint(1, n))),
              "".join(rng.choices("abcé😀 ", k=rng.randint(1, n)))) for n in (3, 9, 40, 90) * 10]
    found = lcs_lengths([a for a, _ in pairs], [b for _, b in pairs])
    assert found.tolist() == [lcs(a, b) for a, b in pairs]


def test_fuzzy_search_finds_the_best_of_thousands_of_names(frame):
    """Blocks, bands and the bound on common characters lose nothing; ties go to the first."""
    rng = random.Random(5)
    parts = "an ber cor dal en fir gra hol in jor kal lon mer nor tech net bio".split()

    def name():
        return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))).title()
                        for _ in range(rng.randint(1, 3)))

    names = sorted({name() for _ in range(9000)})[:6000]
    asked = [n[:len(n) // 2] + n[len(n) // 2 + 1:] + " co" for n in rng.sample(names, 300)]
    accounts = frame("account_id long, account_name string", *enumerate(names))
    got = by_key(reconcile.fuzzy_match(
        frame("query string", *[(q,) for q in asked]), reconcile.name_lookup(accounts)), "query")
    keys = [" ".join(sorted(n.lower().split())) for n in names]
    first = {}
    for i, key in enumerate(keys):
        first.setdefault(key, i)
    for q in rng.sample(asked, 40):
        key = " ".join(sorted(q.lower().split()))
        lengths = lcs_lengths([key] * len(keys), keys)
        scores = [200.0 * n / (len(key) + len(k)) for n, k in zip(lengths.tolist(), keys)]
        best = max(scores)
        want = min(first[keys[i]] for i, s in enumerate(scores) if s == best)
        assert best < 65 and q not in got or (got[q].account_id, got[q].score) == (want, best)


def test_token_sort(frame):
    df = frame("n string", ("motors  thunderbolt ",))
    assert df.select(token_sort(F.col("n"))).first()[0] == "motors thunderbolt"


def test_fuzzy_goldens(frame, accounts):
    queries = frame("query string", *[(q,) for q in [
        "BrightPath Solutions", "vanguard retail", "BritePath Solutions", "Pinacle Media",
        "Thunderbolt Moters", "Completely Unknown Corp", "", "AB"]])
    rows = by_key(reconcile.fuzzy_match(queries, reconcile.name_lookup(accounts)), "query")
    assert {q: (r.match_name, round(r.score, 3)) for q, r in rows.items()} == {
        "BrightPath Solutions": ("BrightPath Solutions", 100.0),
        "vanguard retail": ("Vanguard Retail", 100.0),
        "BritePath Solutions": ("BrightPath Solutions", 92.308),
        "Pinacle Media": ("Pinnacle Media Group", 78.788),
        "Thunderbolt Moters": ("Thunderbolt Motors", 94.444),
    }


@pytest.mark.parametrize("threshold", [40, 65, 90])
def test_fuzzy_equals_brute_force(frame, threshold):
    rng = random.Random(threshold)
    words = ["alpha", "alphas", "beta", "bet", "gamma ray", "gama", "delta", "d3lta", "x", "yy"]
    names = list(dict.fromkeys(
        " ".join(rng.choices(words, k=rng.randint(1, 3))) for _ in range(40)))
    queries = {"".join(c for c in rng.choice(names) if rng.random() > 0.2) for _ in range(60)}
    queries |= {"zzzzzz", "1234567890 alpha"}
    accounts = frame("account_id long, account_name string", *enumerate(names))
    got = by_key(reconcile.fuzzy_match(
        frame("query string", *[(q,) for q in queries]), reconcile.name_lookup(accounts),
        threshold), "query")
    expected = {}
    for q in queries:
        scored = [(ratio(q, n), -i) for i, n in enumerate(names)]
        best, place = max(scored)
        if len(q) >= 3 and best >= threshold:
            expected[q] = (-place, best)
    assert {q: r.account_id for q, r in got.items()} == {q: e[0] for q, e in expected.items()}
    assert {q: r.score for q, r in got.items()} == pytest.approx(
        {q: e[1] for q, e in expected.items()})


def test_name_lookup_last_wins(frame):
    df = frame("account_id long, account_name string", (1, "Acme"), (3, "ACME"), (2, "acme"))
    row = reconcile.name_lookup(df).first()
    assert tuple(row) == ("acme", 3, "ACME", "Acme", 1)


NOTES = "note_idx long, raw_text string, account_id long, account_name string"


def test_tiers(frame, accounts):
    notes = frame(NOTES, (1, "a", 1003, "whatever"), (2, "b", 9999, "crescent LABS"),
                  (3, "c", None, "the healthcare one"), (4, "d", None, "Thunderbolt Moters"),
                  (5, "e", 9999, "nobody knows"), (6, "f", None, ""), (7, "g", None, "low one"),
                  (8, "h", None, "ghost id"), (9, "i", None, None))
    matches = frame("input_name string, matched_id long, confidence string",
                    ("the healthcare one", 1006, "high"), ("the healthcare one", 1001, "medium"),
                    ("low one", 1001, "low"), ("ghost id", 4242, "high"))
    rows = by_key(reconcile.reconcile(notes, accounts, matches, all_or_nothing=False), "note_idx")
    got = {i: (r.account_id, r.account_name, r.match_method) for i, r in rows.items()}
    assert got == {
        1: (1003, "Vanguard Retail", "id"), 2: (1005, "Crescent Labs", "exact"),
        3: (1006, "Meridian Health", "external"), 4: (1004, "Thunderbolt Motors", "fuzzy"),
        5: (9999, "nobody knows", "none"), 6: (None, "", "none"), 7: (None, "low one", "none"),
        8: (None, "ghost id", "none"), 9: (None, None, "none")}
    done = reconcile.reconcile(notes, accounts, matches, all_or_nothing=False)
    rate = reconcile.match_rate(done).first()
    assert (rate.n_matched, rate.n_notes) == (5, 9)


def test_a_hot_account_keeps_all_its_notes(frame, accounts):
    rows = [(i, f"t{i}", 1001 if i % 3 == 0 else None, "Crescent Labs") for i in range(600)]
    done = reconcile.reconcile(frame(NOTES, *rows), accounts)
    assert {r.account_id: r["count"] for r in done.groupBy("account_id").count().collect()} == {
        1001: 200, 1005: 400}


def test_notes_by_account(frame, accounts):
    rows = [(3, "third", 1001, ""), (1, "first", 1001, ""), (2, "other", 7, ""), (4, "x", None, "")]
    got = by_key(reconcile.notes_by_account(frame(NOTES, *rows), accounts))
    assert set(got) == {1001, 7}
    assert got[1001].notes_text == "first\n\nthird" and got[1001].segment == 0
    assert got[7].account_name == "Account 7"


def test_long_accounts_come_in_segments_that_make_up_the_whole(frame):
    """Numbers that repeat and missing numbers, too, do not make a segment longer."""
    rows = [(i, f"note {i}", 1 if i % 2 else 2, "") for i in range(101)]
    rows += [(200, "short", 3, "")]
    rows += [(7, f"same number {i:02}", 4, "") for i in range(23)]
    rows += [(None, f"no number {i:02}", 4, "") for i in range(17)]
    notes = frame(NOTES, *rows).repartition(6)
    whole = by_key(reconcile.notes_by_account(notes))
    assert whole[4].notes_text.startswith("no number 00")
    parts = reconcile.notes_by_account(notes, segment_notes=10)
    pieces = {}
    for r in parts.orderBy("account_id", "segment").collect():
        pieces.setdefault(r.account_id, []).append(r.notes_text)
    assert len(pieces[1]) == 5 and len(pieces[3]) == 1 and len(pieces[4]) == 4
    assert all(text.count("\n\n") < 10 for texts in pieces.values() for text in texts)
    assert {k: "\n\n".join(v) for k, v in pieces.items()} == {
        k: r.notes_text for k, r in whole.items()}


def test_notes_of_several_files_keep_file_order(frame):
    """Notes are numbered per file, so the file comes before the number."""
    rows = [("b.txt", 1, "b1", 5), ("a.txt", 2, "a2", 5), ("b.txt", 2, "b2", 5),
            ("a.txt", 1, "a1", 5), (None, 9, "no file", 5), ("a.txt", 1, "other", 6)]
    notes = frame("file string, note_idx long, raw_text string, account_id long", *rows)
    got = by_key(reconcile.notes_by_account(notes))
    assert got[5].notes_text == "no file\n\na1\n\na2\n\nb1\n\nb2"
    assert got[6].n_notes == 1


def test_notes_with_few_numbers_are_ordered_in_many_tasks(spark, frame):
    """100,000 notes of one account that share three numbers, half of them the same text."""
    notes = spark.range(100_000).selectExpr(
        "7L as account_id", "if(id % 3 = 0, null, id % 3) as note_idx",
        "if(id % 2 = 0, 'the same', concat('note ', lpad(id, 6, '0'))) as raw_text")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = reconcile.in_note_order(notes)
        sizes = [r["count"] for r in placed.groupBy((placed.place / 2**33).cast("int")).count()
                 .collect()]
        assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert max(sizes) < 2 * 100_000 / len(sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    rows = reconcile.notes_by_account(notes).orderBy("segment").collect()
    assert [r.segment for r in rows] == list(range(100))
    assert all(r.n_notes == 1000 for r in rows)
    texts = "\n\n".join(r.notes_text for r in rows).split("\n\n")
    expected = sorted((r.note_idx or 0, r.raw_text) for r in notes.collect())
    assert texts == [text for _, text in expected]


def test_incomplete_external_matches_can_be_ignored(frame, accounts):
    notes = frame(NOTES, (1, "a", None, "the healthcare one"), (2, "b", None, "another"),
                  (3, "c", 1001, "not asked"))
    schema = "input_name string, matched_id long, confidence string"
    partly = frame(schema, ("the healthcare one", 1006, "high"))
    fully = frame(schema, ("the healthcare one", 1006, "high"), ("another", None, "low"))
    for matches, strict, expected in [
            (partly, False, 1006), (partly, True, None), (fully, True, 1006)]:
        rows = by_key(reconcile.reconcile(
            notes, accounts, matches, all_or_nothing=strict), "note_idx")
        assert (rows[1].account_id, rows[3].account_id) == (expected, 1001)


def test_lcs_of_long_and_odd_texts():
    rng = random.Random(6)
    sizes = [0, 1, 63, 64, 65, 200, 256, 257, 700]
    texts = ["".join(rng.choices("abé\U0001f600 ", k=k)) for k in sizes] + ["x" * 300, "\0a\0"]
    pairs = [(a, b) for a in texts for b in texts]
    found = lcs_lengths([a for a, _ in pairs], [b for _, b in pairs])
    assert found.tolist() == [lcs(a, b) if a and b else 0 for a, b in pairs]


def test_characters_in_common_are_never_underestimated():
    rng = random.Random(7)
    texts = ["".join(rng.choices("abcdefgh 日本語", k=rng.randint(1, 60))) for _ in range(80)]
    texts += ["a" * 500 + "b" * 9, "b" * 400, "", "abc" * 30]
    bound = similarity._in_common(texts[:40] + texts[-4:], texts)
    for i, a in enumerate(texts[:40] + texts[-4:]):
        for j, b in enumerate(texts):
            exact = sum((Counter(a) & Counter(b)).values())
            assert bound[i, j] >= exact
            if max([*Counter(a).values(), *Counter(b).values(), 0]) <= similarity.TIMES:
                assert bound[i, j] == exact


def test_a_block_with_a_very_long_name_stays_small():
    """A name of 1,000,000 characters among ordinary ones; the old matrices took 16 GB."""
    rng = random.Random(8)
    names = ["".join(rng.choices("abcdefg ", k=20)) for _ in range(300)]
    long = "ab " * 333_334
    tracemalloc.start()
    found = similarity.best_of_block([*names[:20], long], [*names, long], 65)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6
    best = {i: names[j] if j < 300 else long for i, j, score in zip(*found) if score == 100.0}
    assert best == {**dict(enumerate(names[:20])), 20: long}


def test_more_names_than_are_looked_at_first():
    """Many names with the same bound: the order beyond the first few loses none."""
    rng = random.Random(9)
    names = ["".join(rng.sample("abcdefghij", 10)) for _ in range(400)]
    query = "abcdefghij"
    exact = [200.0 * lcs(query, n) / 20 for n in names]
    top = max(exact)
    found = similarity.best_of_block([query], names, 40)
    assert sorted(found[1]) == [j for j, x in enumerate(exact) if x == top]
