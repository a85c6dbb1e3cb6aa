"""Repair of dialogues against a plain search over whole dialogues."""

import hashlib
import random
import zlib

import pytest

from acctrisk.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, place long, code string, first long"
WHITE = " \t\n\x0b\f\r"


def frame_of(frame, turns):
    return frame(SCHEMA, *[(*t, 5, "clash", 6) for t in turns])


def order(row):
    return tuple((x is not None, x) for x in row)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        by = zlib.crc32(key.encode()) % 20
        if by == 1:
            text = ""
        if by == 2:
            text = "".join(c for c in text if c not in ".!?")
        if by == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if by == 0 else 2 if by == 3 else 1)
    return out


def ways(row, p):
    """Edits of one row in state p: cost, letter, next state, role, text."""
    role, text, fault = row
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}[p]
    yield 3, "D", p, None, None
    if fault not in ("blank", "duplicate"):
        late = fault == "truncated"
        if role[:1] and role[:1] in follows:
            yield late, "K", role[0], role, text
        to = follows[-1]
        yield 2 + late, "R", to, {"u": "user", "a": "assistant"}[to], text


def solved(rows):
    """Cost, audit and repaired lines, by a search from the back over (cost, audit)."""
    best = {"": (0, "", ()), "s": (4, "II", ("user:", "assistant:")), "u": (2, "I", ("assistant:",)),
            "a": (0, "", ())}
    for row in reversed(rows):
        here = {}
        for p in best:
            here[p] = min((cost + best[q][0], letter + best[q][1],
                           ((f"{role}:{text}",) if letter != "D" else ()) + best[q][2])
                          for cost, letter, q, role, text in ways(row, p))
        for _ in range(3):  # insertions before the row
            for p in here:
                q, name = ("a", "assistant") if p == "u" else ("u", "user")
                cost, audit, lines = here[q]
                here[p] = min(here[p], (cost + 2, "I" + audit, (f"{name}:", *lines)))
        best = here
    return best[""]


def plain(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t, " " if r is None else r, " " if x is None else x)
                        for c, t, r, x in rows if c == conv), key=order)
        seen, marked, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in turns:
            said = text.rstrip(WHITE)
            fault = ("blank" if not said else "duplicate" if (role, text) in seen
                     else "truncated" if said[-1] not in ".!?" else None)
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            marked.append((role, text, fault))
        numbers = {t for t, _, _ in turns if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        initials = [r[:1] for _, r, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = solved(marked)
        out[conv] = (gaps, *counts.values(), illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def check(frame, turns):
    done = repair.repair(frame_of(frame, turns))
    digests = {r.conv_id: (r.audit, r.repaired_sha256)
               for r in repair.digests(done.turns).collect()}
    rows = done.conversations.collect()
    found = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost,
                         *digests[r.conv_id]) for r in rows}
    assert len(rows) == len(found) == len(digests)
    wanted = plain(turns)
    assert found.keys() == wanted.keys()
    for conv in wanted:
        assert found[conv] == wanted[conv], [t for t in turns if t[0] == conv]
    return done


def random_turns(rng, convs, most, roles=("system", "user", "assistant", "tool")):
    texts = ["Yes.", "No!", "cut off", "", " \t", "Why?\n", "end. ", "other", "and so on."]
    return [(c, t, rng.choice(roles), f"{rng.choice(texts)}" if rng.random() < .4
             else f"{t} {rng.choice(texts)}")
            for c in range(convs) for t in range(rng.randrange(1, most)) if rng.random() < .9]


def test_cases_by_hand(frame):
    done = check(frame, [
        (1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Yo!"),
        (2, 0, "user", "One."), (2, 5, "user", "Two."), (3, 0, "assistant", "First?"),
        (4, 0, "system", "Alone."), (5, 0, "user", ""), (6, 0, "user", "a cut"),
        (6, 1, "assistant", "fine."), (7, 0, "bot", "X."), (7, 1, "bot", "Y.")])
    turns = [tuple(r) for r in done.turns.orderBy("conv_id", "place", "step").select(
        "conv_id", "turn", "edit", "role", "text").collect()]
    assert [t for t in turns if t[0] == 2] == [
        (2, 0, "K", "user", "One."), (2, 5, "R", "assistant", "Two.")]
    assert [t for t in turns if t[0] == 3] == [
        (3, None, "I", "user", ""), (3, 0, "K", "assistant", "First?")]


def test_random_dialogues(frame):
    check(frame, random_turns(random.Random(1), 150, 12))


@pytest.mark.parametrize("roles", [("system", "user", "assistant", "tool"), ("user", "assistant")])
def test_dialogues_over_many_chunks(frame, monkeypatch, roles):
    monkeypatch.setattr(repair, "CHUNK", 4)
    check(frame, random_turns(random.Random(2), 40, 60, roles))


@pytest.mark.parametrize("role, text", [
    ("bot", "{}."), ("bot", "{}"), ("system", "{}."), ("user", "{}."), ("user", ""),
    ("user", "Same."), ("assistant", "{}")])
def test_costs_that_do_not_converge_within_a_chunk(frame, monkeypatch, role, text):
    """Every turn alike: what lies ahead matters however far away it is."""
    monkeypatch.setattr(repair, "CHUNK", 4)
    check(frame, [(c, t, role, text.format(t)) for c, n in enumerate((50, 51, 3)) for t in range(n)])


def test_fix_up_stops_where_costs_differ_by_a_constant():
    codes = bytes(random.Random(3).choices(range(8), k=500))
    start, total = repair.run(codes, repair.FINAL)
    for end in ((0, 1, 2, 0), (2, 0, 0, 3), (0, 0, 0, 0)):
        assert repair.run_again(codes, (repair.FINAL, start, total), end) == repair.run(codes, end)


def test_nulls_ties_and_repeated_rows(frame):
    check(frame, [(None, 1, "user", "No id."), (None, 2, "assistant", "Yes."), (1, None, "user", "x."),
                  (1, None, None, "y."), (1, 0, "user", None), (1, 0, "assistant", "tie."),
                  (1, 0, "assistant", "tie."), (1, 0, "assistant", "also a tie."), (1, 3, "", "z."),
                  (2, None, None, None), (2, None, None, None), (3, 1, "user", "w" * 100_000),
                  (3, 2, "User", "Größe 🙂."), (4, 1, "user", "\x1c"), (4, 2, "s", " .")])


def test_one_turn_number_in_all_rows(frame, monkeypatch):
    monkeypatch.setattr(repair, "CHUNK", 16)
    check(frame, [(1, 7, "user", "Same text.")] * 100
          + [(1, 7, "assistant", f"{i % 37}.") for i in range(200)])


def test_damage(frame):
    rng = random.Random(4)
    turns = random_turns(rng, 60, 9) + [
        (None, 3, "user", "x."), (None, None, None, None), (5, None, "user", "a. b! c?")]
    rows = repair.damage(frame_of(frame, turns))
    assert rows.columns == ["conv_id", "turn", "role", "text"]
    assert sorted(map(tuple, rows.collect()), key=order) == sorted(damaged(turns), key=order)


def test_no_rows(frame):
    done = repair.repair(frame_of(frame, []))
    assert done.conversations.count() == done.turns.count() == 0
    assert repair.digests(done.turns).count() == 0
