"""Joins that stay balanced when a few keys hold most of the rows.

Spark's adaptive skew handling only splits a join whose two inputs are both plain shuffles, which
an aggregated or already joined input is not. So the rows of a key with many rows are dealt over a
fixed number of salts, and the one row on the other side is repeated once per salt. Any number of
keys may be hot, and nothing depends on how large they are. As a hot key has HOT_ROWS rows at least,
what is repeated stays a small share of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctrisk.functions.prune import key_bit, key_set

SALTS = 16
# Keys with more rows are dealt out.
HOT_ROWS = 1000


def key_counts(facts: DataFrame, key: str) -> DataFrame:
    """Rows per key, as column ``n``."""
    return facts.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def _salt(facts: DataFrame, salts: int) -> Column:
    """The salt of a row, from all its values and the task that reads it.

    Different rows of a key part even if one task reads them all, equal rows if several do; a lost
    task that runs again gives the same salts.
    """
    return F.pmod(F.xxhash64(F.spark_partition_id(), *facts.columns), F.lit(salts)).alias("_salt")


def _with_hot(df: DataFrame, hot: DataFrame | None, key: str) -> DataFrame:
    """Add ``_hot``: whether the key is in a set of bits; without a set every key is hot.

    The set has all hot keys and may let others pass, so both sides of a join ask the same set.
    """
    if hot is None:
        return df.withColumn("_hot", F.lit(True))
    word, bit = key_bit(key)
    return (
        df.join(F.broadcast(hot), word == F.col("_word"), "left")
        .withColumn("_hot", F.coalesce(bit == 1, F.lit(False))).drop("_word", "_bits")
    )


def _salted(facts: DataFrame, hot: DataFrame | None, key: str, salts: int) -> DataFrame:
    """The facts with their salts; 0 for a key that is neither hot nor null."""
    dealt = F.col("_hot") | F.col(key).isNull()
    return _with_hot(facts.select("*", _salt(facts, salts)), hot, key).withColumn(
        "_salt", F.when(dealt, F.col("_salt")).otherwise(F.lit(0).cast("bigint"))).drop("_hot")


def _repeated(one: DataFrame, hot: DataFrame | None, key: str, salts: int,
              meets: Column | None = None) -> DataFrame:
    """The one row per key, repeated per salt where the key is hot (and ``meets`` holds)."""
    dealt = F.col("_hot") if meets is None else F.col("_hot") & meets
    none, last = F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")
    every = F.sequence(none, F.when(dealt, last).otherwise(none))
    return _with_hot(one, hot, key).select(*one.columns, F.explode(every).alias("_salt"))


def _hot(counts: DataFrame, other: DataFrame, key: str, hot_rows: int) -> DataFrame | None:
    """The set of keys with more rows than ``hot_rows``; None, for all, if the types differ."""
    if counts.schema[key].dataType != other.schema[key].dataType:
        return None  # equal keys may have unequal hashes
    return key_set(counts.filter(F.col("n") > hot_rows), key)


def left_join_lookup(
    facts: DataFrame, lookup: DataFrame, key: str, salts: int = SALTS,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """``facts`` (any number of rows per key) left join ``lookup`` (one row per key).

    Rows without a key are dealt over the salts, too, and match nothing. Rows per key are counted
    first, for which the facts have to give the same rows again; ``hot_rows`` None saves that and
    deals out every key, which suits a small and narrow lookup.
    """
    hot = None if hot_rows is None else _hot(key_counts(facts, key), lookup, key, hot_rows)
    return (
        _salted(facts, hot, key, salts)
        .join(_repeated(lookup, hot, key, salts), [key, "_salt"], "left").drop("_salt")
    )


def left_join_facts(
    base: DataFrame, facts: DataFrame, key: str, salts: int = SALTS, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``base`` (one row per key) left join ``facts`` (any number of rows per key)."""
    hot = _hot(key_counts(facts, key), base, key, hot_rows)
    has = facts.groupBy(key).agg(F.lit(True).alias("_has"))
    repeated = _repeated(
        base.join(has, key, "left"), hot, key, salts, F.coalesce("_has", F.lit(False)))
    right = _salted(facts, hot, key, salts).withColumn("_found", F.lit(True))
    joined = repeated.join(right, [key, "_salt"], "left")
    # a key with facts has no row of its own for a salt that none of them got
    return joined.filter("_has IS NULL OR _found").drop("_has", "_salt", "_found")


def left_join_open(left: DataFrame, right: DataFrame, on: Column, key: str) -> DataFrame:
    """Left join on an expression that is null for many rows, which then match nothing.

    Those rows are dealt over the partitions by their values instead of meeting in one.
    """
    spread = F.when(on.isNull(), F.xxhash64(*left.columns)).otherwise(F.lit(0))
    return (
        left.withColumns({"_on": on, "_spread": spread})
        .join(right.withColumn("_zero", F.lit(0).cast("bigint")),
              (F.col("_on") == F.col(key)) & (F.col("_spread") == F.col("_zero")), "left")
        .drop("_on", "_spread", "_zero")
    )
