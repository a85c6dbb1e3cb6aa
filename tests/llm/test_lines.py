"""Line dedup against a plain version."""

import re
from collections import defaultdict

from acctrisk.llm import lines
from tests.llm.odd import no_documents, odd_documents

SCHEMA = "doc_id long, text string, key string, lines long, n_docs string, keeper long, sig long"


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\f\r"))


def plain(rows, min_chars=20, min_docs=3):
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(doc_id)
    shared = {k: max(x for x in v if x is not None) for k, v in holders.items()
              if len(v) >= min_docs}
    out = []
    for doc_id, text in rows:
        cut = (text or "").split("\n")
        kept = [x for x in cut if key(x) not in shared or shared[key(x)] == doc_id]
        out.append((doc_id, "\n".join(kept), len(cut), len(cut) - len(kept)))
    return out


def order(row):
    return tuple((x is not None, x) for x in row)


def check(df, rows=None, **params):
    rows = [(r.doc_id, r.text) for r in df.collect()] if rows is None else rows
    found = lines.dedup(df, **params)
    assert found.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    assert sorted(map(tuple, found.collect()), key=order) == sorted(
        plain(rows, **params), key=order)


def documents(frame, *rows):
    return frame(SCHEMA, *[(i, t, "clash", 1, "n", 2, 3) for i, t in rows])


def test_shared_lines_go_but_for_the_largest_id(frame):
    line, short = "A line that is shared by all", "short line"
    check(documents(
        frame, (1, f"{line}\nown text\n{short}"), (2, f"x\n\t{line.upper()} \r\ny\n{line}"),
        (7, f"{line}\n{line}\n{short}\n"), (4, line), (5, short), (6, f"not {line}")))


def test_two_documents_are_not_enough(frame):
    line = "é" * 20
    check(documents(frame, (1, line), (1, line), (2, line)))
    check(documents(frame, (1, line), (2, line), (3, "é" * 19 + "\n" + line)))
    check(documents(frame, (1, "ab\ncd"), (2, "ab")), min_chars=2, min_docs=2)


def test_nulls_repeated_rows_and_ties(frame):
    line = "the very same line in every document"
    check(documents(frame, (None, line), (None, line + "\nmore"), (3, line), (3, line),
                    (3, "other\n" + line), (2, line + "\n" + line), (9, None), (9, ""),
                    (9, "\n\n"), (None, None)))


def test_odd_documents(frame):
    check(odd_documents(frame))
    check(odd_documents(frame).unionByName(odd_documents(frame, 2000)).unionByName(
        odd_documents(frame, 3000)))


def test_long_text_that_loses_most_lines(frame):
    long = "\n".join(f"this is a numbered line, number {i}" for i in range(30_000))
    check(documents(frame, (1, long), (2, long), (3, long + "\nand one more")))


def test_no_rows(frame):
    assert lines.dedup(no_documents(frame)).count() == 0
