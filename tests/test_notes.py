import pytest
from pyspark.sql import functions as F

from acctrisk.operators import notes

FILE = """=== CSM Call Notes ===
(Internal.)

Mar 12 - Talked to First Corp. They are unhappy.

---

3/15 acct 1001 - BritePath Solutions (sic) call. No show.
Second line.

-----

   

---
-- two dashes are text
---

last note
"""


def split(frame, text=FILE, **options):
    rows = notes.split_notes(frame("value string", (text,)), **options).collect()
    return [(r.note_idx, r.raw_text) for r in rows]


def test_split_drops_banner_and_empty_blocks(frame):
    assert split(frame) == [
        (1, "3/15 acct 1001 - BritePath Solutions (sic) call. No show.\nSecond line."),
        (2, "-- two dashes are text"), (3, "last note")]


def test_split_can_keep_the_note_under_the_banner(frame):
    assert split(frame, strip_banner=True)[0] == (
        1, "Mar 12 - Talked to First Corp. They are unhappy.")
    assert split(frame, "=== CSM only a banner", strip_banner=True) == []


@pytest.mark.parametrize("text, expected", [
    ("3/15 acct 1001 - X", 1001), ("see Account  1016 and acct 1017", 1016), ("(#1007)", 1007),
    ("acct 12", None), ("evergreen media 1015", None), ("ACCT 10425", 1042),
])
def test_account_id(frame, text, expected):
    df = frame("t string", (text,))
    assert df.select(notes.note_account_id(F.col("t"))).first()[0] == expected


@pytest.mark.parametrize("text, expected", [
    ("2026-03-20 | NovaTech Industries | James O.\nmore", "NovaTech Industries"),
    ("2026-03-20 | NovaTech Industries", "NovaTech Industries"),
    ("march 25 -- meridian health -- priya", "meridian health"),
    ("Apr 1 - vanguard retail\njust a note", "vanguard retail"),
    ("March 30 - Thunderbolt Moters ", "Thunderbolt Moters"),
    ("3/15 acct 1001 - BritePath Solutions (sic) call. No show", "BritePath Solutions"),
    ("04/03 Atlas Financial", "Atlas Financial"),
    ("4/8 evergreen media 1015", "evergreen media 1015"),
    ("4/9 Northstar Logistics.", "Northstar Logistics"),
    ("3/10 - crescent labs", "- crescent labs"),
    ("april 2 - abc", ""), ("no date here", ""),
])
def test_account_name(frame, text, expected):
    df = frame("t string", (text,))
    assert df.select(notes.note_account_name(F.col("t"))).first()[0] == expected


CHANGELOG = """# Changelog
- 🔴 before any release

### v4.3.0 — December 15, 2025
**Deprecations**
- ⚠️ REST v2 endpoints will be sunset. SDK v3.x must migrate to v4.x before this date.
- Legacy engine is deprecated.

### v4.2.0 - October 15, 2025
- 🔴 SDK v4.2.0+ changes the response envelope. This is a BREAKING CHANGE below v4.2.0.
- Patched XSS in a field (CVE-2025-8834) for all
- Patched something without a number

### Upcoming — v4.4.0
- ⚠️ SDK v3.x stops receiving patches after April 30, 2026. Move to v4.2.3.
"""


def test_changelog(frame):
    rows = notes.parse_changelog(frame("value string", (CHANGELOG,))).collect()
    got = [(r.version, r.date, r.category, r.affected_versions, r.deadline) for r in rows]
    assert got == [
        ("v4.3.0", "December 15, 2025", "deprecation", ["v3.x", "v4.x"], ""),
        ("v4.2.0", "October 15, 2025", "breaking_change", ["v4.2.0", "v4.2.0"], ""),
        ("v4.2.0", "October 15, 2025", "breaking_change", ["v3.x", "v4.2.3"], "April 30, 2026"),
        ("v4.2.0", "October 15, 2025", "security", [], ""),
        ("v4.2.0", "October 15, 2025", "breaking_change", ["v4.2.0", "v4.2.0"], ""),
    ]
    # the mark is two code points; the second one stays with the text
    assert rows[0].description.startswith("️ REST v2")
    assert rows[3].description == "Patched XSS in a field (CVE-2025-8834) for all"
