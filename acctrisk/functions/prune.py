"""Facts cut down to a set of keys before they are aggregated or exchanged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of the set that stands for the keys; it has at most BITS / 64 rows of two numbers, 16 MB.
BITS = 1 << 26


def _place(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def key_bit(key: str, bits: int = BITS) -> tuple[Column, Column]:
    """The word of a key in a set of bits and its bit in the word's ``_bits``."""
    place = _place(key, bits)
    return F.shiftright(place, 6), F.getbit("_bits", place % 64)


def key_set(keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """The keys as a set of bits, one per hash: word and the 64 bits of each word that has any."""
    place = _place(key, bits)
    bit = F.expr("shiftleft(1L, cast(_place % 64 as int))")
    return (
        keys.filter(F.col(key).isNotNull()).select(place.alias("_place"))
        .groupBy(F.shiftright("_place", 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    )


def with_keys(facts: DataFrame, keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """The facts whose key is in ``keys``, and those few whose hash meets that of one which is.

    The set of keys is broadcast whatever their number, as the number of bits bounds its size:
    with more keys than bits it lets more and more facts pass, never too few. As a semi join it
    sinks below the aggregations and joins that a fact relation is made of, to the scan that has
    the key, so other facts are neither aggregated nor exchanged.
    """
    chosen = key_set(keys, key, bits)
    word, bit = key_bit(key, bits)
    return facts.join(F.broadcast(chosen), (word == F.col("_word")) & (bit == 1), "left_semi")
