"""Free text to rows: note blocks, the accounts they name, changelog entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctrisk import fixed
from acctrisk.functions.columns import missing_text
from acctrisk.sources.records import numbered

_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, _SPACE, "")


# ---- note blocks ------------------------------------------------------------------------------

def _without_banner(block: Column) -> Column:
    """A block without the paragraph that a banner opens."""
    banner = f"(?s)^{fixed.NOTE_BANNER}.*?(?:\\n\\s*\\n|$)"
    return strip(F.regexp_replace(block, banner, ""))


def _is_note(block: Column) -> Column:
    return (block != "") & ~block.startswith(fixed.NOTE_BANNER)


def split_notes(texts: DataFrame, text: str = "value", strip_banner: bool = False) -> DataFrame:
    """One row per note of each text; ``note_idx`` numbers the notes of a text from 1.

    Empty blocks and blocks that open with the banner are dropped. With ``strip_banner`` a
    banner only loses its own paragraph and the note below it stays.
    """
    blocks = F.transform(F.split(text, fixed.NOTE_SEPARATOR, -1), strip)
    if strip_banner:
        blocks = F.transform(blocks, _without_banner)
    kept = F.filter(blocks, _is_note)
    keys = [c for c in texts.columns if c != text]
    return texts.select(*keys, F.posexplode(kept).alias("note_idx", "raw_text")).withColumn(
        "note_idx", (F.col("note_idx") + 1).cast("bigint"))


def notes_of_blocks(blocks: DataFrame, strip_banner: bool = False) -> DataFrame:
    """The same from blocks that are already cut: file, start, row and value (sources/records.py)."""
    text = strip(F.col("value"))
    notes = blocks.select(
        "file", "start", "row", (_without_banner(text) if strip_banner else text).alias("raw_text")
    ).filter(_is_note(F.col("raw_text")))
    return numbered(notes, F.lit(1), "before").select(
        "file", (F.col("before") + 1).cast("bigint").alias("note_idx"), "raw_text")


def note_account_id(text: Column) -> Column:
    """The first four-digit account number a note mentions."""
    found = F.regexp_extract(text, fixed.NOTE_ID_PATTERN, 1)
    return missing_text(found).cast("bigint")


def note_account_name(text: Column) -> Column:
    """The account name on a note's first line: the first pattern with a long enough name."""
    first_line = F.substring_index(text, "\n", 1)
    names = []
    for pattern in fixed.NOTE_NAME_PATTERNS:
        name = strip(F.regexp_extract(first_line, "(?i)" + pattern, 1))
        for tail in (r"\.+$", r"\s*\(sic\).*", r"(?i)\s+call\b.*"):
            name = F.regexp_replace(name, tail, "")
        names.append(F.when(F.length(name) >= fixed.MIN_NOTE_NAME_LENGTH, name))
    return F.coalesce(*names, F.lit(""))


def extract_entities(notes: DataFrame) -> DataFrame:
    """Add the account id and name found in each note's text."""
    return notes.withColumns({
        "account_id": note_account_id(F.col("raw_text")),
        "account_name": note_account_name(F.col("raw_text")),
    })


# ---- changelog --------------------------------------------------------------------------------

def _entries(found: Column, category, versions: str | None, deadline: bool) -> Column:
    """Matched lines as entry structs."""
    def entry(line: Column) -> Column:
        text = strip(line)
        affected = F.array().cast("array<string>")
        if versions is not None:
            affected = F.transform(
                F.regexp_extract_all(text, F.lit(versions), F.lit(1)),
                lambda v: F.concat(F.lit("v"), v))
        until = F.lit("")
        if deadline:
            until = F.regexp_extract(text, fixed.CHANGELOG_DEADLINE, 1)
        return F.struct(
            category(text).alias("category"), text.alias("description"),
            affected.alias("affected_versions"), until.alias("deadline"))
    return F.transform(found, entry)


def parse_changelog(texts: DataFrame, text: str = "value") -> DataFrame:
    """Deprecations, security patches and breaking changes of every release in each text.

    A release runs from its header to the next one; what precedes the first header is ignored.
    Entries keep the order flagged lines, security lines, red breaking lines; a red breaking
    line thus shows up twice.
    """
    def lower_has(t: Column, *parts: str) -> Column:
        hit = F.lower(t).contains(parts[0])
        for part in parts[1:]:
            hit = hit | F.lower(t).contains(part)
        return hit

    def flagged_category(t: Column) -> Column:
        return F.when(lower_has(t, "deprecat", "sunset"), F.lit("deprecation")).otherwise(
            F.lit("breaking_change"))

    header = f"(?d){fixed.CHANGELOG_HEADER}(?=\\n)"
    keys = [c for c in texts.columns if c != text]
    releases = (
        texts.select(*keys, F.posexplode(F.split(text, f"(?={header})", -1)).alias("n", "part"))
        .withColumns({
            "version": F.regexp_extract("part", f"^{header}", 1),
            "date": strip(F.regexp_extract("part", f"^{header}", 2)),
        })
        .filter(F.col("version") != "")
        .withColumn("body", F.regexp_replace("part", f"^{header}", ""))
    )

    def all_of(pattern: str, group: int) -> Column:
        return F.regexp_extract_all("body", F.lit("(?d)" + pattern), F.lit(group))

    red = F.filter(all_of(fixed.CHANGELOG_RED, 1),
                   lambda t: lower_has(t, "breaking", "changes the response"))
    entries = F.concat(
        _entries(all_of(fixed.CHANGELOG_FLAGGED, 1), flagged_category,
                 fixed.CHANGELOG_VERSIONS, True),
        _entries(all_of(fixed.CHANGELOG_SECURITY, 0), lambda t: F.lit("security"), None, False),
        _entries(red, lambda t: F.lit("breaking_change"), fixed.CHANGELOG_RED_VERSIONS, False),
    )
    return releases.select(
        *keys, "n", "version", "date", F.posexplode(entries).alias("entry_no", "e"),
    ).select(
        *keys, F.col("n").cast("bigint").alias("release_no"),
        F.col("entry_no").cast("bigint").alias("entry_no"), "version", "date", "e.*")


def changelog_of_blocks(blocks: DataFrame) -> DataFrame:
    """The same from blocks that each begin at a release: file, start, row and value.

    Releases are numbered within their file, as if the file were one text.
    """
    header = f"(?d){fixed.CHANGELOG_HEADER}(?=\\n)"
    texts = blocks.withColumn("value", F.concat("value", F.lit("\n")))
    parts = F.size(F.split("value", f"(?={header})", -1))
    found = parse_changelog(numbered(texts, parts, "before"))
    return found.withColumn("release_no", F.col("release_no") + F.col("before")).drop(
        "start", "row", "before")
