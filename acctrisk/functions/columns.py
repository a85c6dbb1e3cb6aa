"""Small column expressions; all stay inside Spark's generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rnd(value: Column, digits: int) -> Column:
    """Round half to even on the binary value, the way array libraries round floats."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def clip01(value: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))


def whole(value: Column) -> Column:
    """A number as text without decimals."""
    return value.cast("bigint").cast("string")


def percent(value: Column) -> Column:
    """A fraction as a whole percentage, without the sign."""
    return whole(F.rint(value * F.lit(100.0)))


def is_true(condition: Column) -> Column:
    """A condition that counts unknown as false."""
    return F.coalesce(condition, F.lit(False))


def fill(template: str, *values: Column) -> Column:
    """Put values into the ``{}`` marks of a fixed text."""
    parts = template.split("{}")
    pieces = [F.lit(parts[0])]
    for value, text in zip(values, parts[1:], strict=True):
        pieces += [value, F.lit(text)]
    return F.concat(*pieces)


def missing_text(value: Column) -> Column:
    """Empty text as null, so that it can be coalesced."""
    return F.nullif(value, F.lit(""))


# ---- the same as SQL text, for long expressions -------------------------------------------------

def sql_rnd(value: str, digits: int) -> str:
    return f"(rint(({value}) * {10**digits}D) / {10**digits}D)"


def sql_text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
