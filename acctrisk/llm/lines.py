"""Lines that many documents share, taken out of all but one of them, with DataFrame functions.

1. Lines are exploded and normalised, and each gets a 128-bit hash.
2. Documents are counted per hash: pairs of hash and document first, so a line that a third of all
   documents have is counted by many tasks.
3. Lines that too many documents have are found by a salted join on the hash, and what comes back
   for each text are the places of its lines to drop. No line travels as text.
4. Every text is put together again from the lines at the other places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctrisk.functions.skew import left_join_lookup
from acctrisk.llm.common import salted_join

MIN_CHARS = 20
MIN_DOCS = 3
WHITE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SALTS = 16


def hashed(*values: Column) -> tuple[Column, Column]:
    """128 bits of a hash as two numbers; null does not equal any text."""
    marked = [x for v in values for x in (v.isNull(), v)]
    return F.xxhash64(*marked), F.xxhash64(F.lit(1), *marked)


def lines_of(text: Column) -> Column:
    """A text's lines; null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    """A line without the white space at its ends, A-Z as a-z."""
    return F.translate(F.trim(line, F.lit(WHITE)), UPPER, LOWER)


def long_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, sig (of id and text), place and the hash a, b of every line long enough to count."""
    low, high = hashed(F.col("doc_id").cast("string"), F.col("text"))
    lines = docs.select(
        "doc_id", F.struct(low.alias("low"), high.alias("high")).alias("sig"),
        F.posexplode(lines_of(F.col("text"))).alias("place", "line"))
    keyed = lines.select("doc_id", "sig", "place", key_of(F.col("line")).alias("key")).where(
        F.length("key") >= min_chars)
    a, b = hashed(F.col("key"))
    return keyed.select("doc_id", "sig", "place", a.alias("a"), b.alias("b"))


def shared_lines(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """a, b, n_docs and keeper (the largest doc_id) of the lines found in enough documents.

    Rows with one doc_id are one document, and so are all rows without.
    """
    return (
        lines.select("a", "b", "doc_id").distinct().groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))
        .where(F.col("n_docs") >= min_docs)
    )


def dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Every row of documents without the lines that `min_docs` documents or more share.

    docs: doc_id and text; other columns are ignored. Result: doc_id, text, n_lines (before) and
    n_dropped. Lines end at \\n. They are compared without the white space \\x20 and \\x09-\\x0D at
    both ends and with A-Z as a-z; shorter ones than `min_chars` code points always stay. The
    document with the largest doc_id keeps all its copies of a line.

    A null text counts as an empty one, which is one empty line; a text that loses all its lines
    becomes empty. Rows with the same doc_id are one document: each of them is cleaned, and the
    rows of the largest doc_id all keep their lines. Rows without an id are together one
    document, which never is the largest. No rows give no rows.
    """
    lines = long_lines(docs, min_chars)
    shared = shared_lines(lines, min_docs).drop("n_docs")
    dropped = (
        salted_join(lines, shared, ["a", "b"], "sig", SALTS, "inner")
        .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("sig").agg(F.collect_set("place").alias("dropped"))
    )
    # the lines are cut before the join, so that nothing cuts them again for every line
    low, high = hashed(F.col("doc_id").cast("string"), F.col("text"))
    rows = docs.select(
        "doc_id", F.struct(low.alias("low"), high.alias("high")).alias("sig"),
        lines_of(F.col("text")).alias("lines"))
    joined = left_join_lookup(rows, dropped, "sig", SALTS, None)
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    kept = F.transform(F.array_except(places, "dropped"), lambda i: F.get("lines", i))
    return joined.select(
        "doc_id",
        F.array_join(F.when(F.col("dropped").isNull(), F.col("lines")).otherwise(kept), "\n")
        .alias("text"),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("bigint").alias("n_dropped"))
