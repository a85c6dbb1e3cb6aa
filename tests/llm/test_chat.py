"""Perspective rotation against a plain rendering."""

from collections import defaultdict

from pyspark.sql import functions as F

from acctrisk.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, perspective string, start long"


def plain(turns):
    by_conv, out = defaultdict(list), []
    for conv, turn, role, text in turns:
        by_conv[conv].append((turn, role, text))
    for conv, rows in by_conv.items():
        for me in {r for _, r, _ in rows if r not in (None, "system")}:
            at = 0
            for turn, role, text in sorted(
                    rows, key=lambda r: tuple((x is not None, x) for x in r)):
                kind = "system" if role == "system" else "assistant" if role == me else "user"
                name = (role or "unknown").replace(" ", "_") if kind == "user" else None
                head = f"<|im_start|>{kind}" + (f" name={name}" if name else "") + "\n"
                said = (text or "").replace("<|", "< |") + "<|im_end|>"
                rendered = head + said + "\n"
                out.append((conv, me, turn, kind, name, rendered, at, len(head),
                            len(said) if kind == "assistant" else 0))
                at += len(rendered)
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def check(frame, turns):
    rows = chat.rotate(frame(SCHEMA, *[(*t, "clash", 9) for t in turns])).collect()
    assert sorted(map(tuple, rows), key=key) == sorted(plain(turns), key=key)
    return rows


def test_every_participant_gets_a_view(frame):
    turns = [(1, 0, "system", "be kind"), (1, 1, "ann lee", "hi"), (1, 2, "bob", "yo <|im_end|>"),
             (1, 3, "ann lee", "Größe 🙂"), (1, 4, "cy", ""), (2, 0, "ann lee", "alone")]
    rows = check(frame, turns)
    assert len(rows) == 3 * 5 + 1
    for r in rows:
        part = r.rendered[r.mask_start:r.mask_start + r.mask_length]
        assert (part.endswith("<|im_end|>") and r.role == "assistant") or part == ""


def test_nulls_ties_and_repeated_rows(frame):
    check(frame, [(1, None, "ann", "x"), (1, 1, None, "no speaker"), (1, 1, "bob", None),
                  (1, 1, "ann", "tie"), (1, 1, "ann", "tie"), (None, 0, "ann", "no dialogue"),
                  (None, 1, "bob", "no dialogue"), (3, 0, "system", "alone"), (4, 0, None, "x")])


def test_long_dialogue_spans_tasks(frame):
    turns = [(7, i, "ann" if i % 3 else "bob", f"turn {i}") for i in range(1100)]
    check(frame, turns + [(8, 0, "ann", "z" * 100_000)])


def test_one_turn_number_in_many_rows(spark, frame):
    """A third of them alike. No task orders more than its range of the rows."""
    rows = [(7, 3, "ann" if i % 2 else "bob", "same" if i % 3 else f"text {i}")
            for i in range(20_000)] + [(7, None, "ann", "first"), (9, 3, "bob", "other")]
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        check(frame, rows)
        placed = chat.in_order(frame(SCHEMA, *[(*t, "clash", 9) for t in rows]))
        parts = placed.groupBy(F.shiftright("place", chat.TASK_BITS)).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sum(r["count"] for r in parts) == len(rows)
    assert max(r["count"] for r in parts) < len(rows) / 2  # four tasks


def test_texts_alike_in_their_first_characters(frame):
    """All are rendered, one after the other, in some fixed order."""
    turns = [(1, 1, "ann", "x" * 2000 + c) for c in "dbca"]
    rows = chat.rotate(frame(SCHEMA, *[(*t, "clash", 9) for t in turns])).collect()
    rows.sort(key=lambda r: r.start)
    assert sorted(r.rendered[r.mask_start:][2000] for r in rows) == list("abcd")
    assert [r.start for r in rows] == [i * len(rows[0].rendered) for i in range(4)]


def test_no_rows(frame):
    assert chat.rotate(frame(SCHEMA)).count() == 0
