"""Bloom filters built by a distributed aggregate, and joins that move only rows whose key may have a partner.

A key set beyond the broadcast bound makes a semi or anti join shuffle its big
side. A filter of bounded size decides most rows in place: those that it
excludes have no partner for certain, and only the others are moved to the
exact join. False positives cost a moved row, never a wrong one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY, PROBES = 12, 4
# The filter is one value of at most 8 MB, however many keys there are.
MIN_BITS, MAX_BITS = 1 << 13, 1 << 26


def filter_bits(n_keys: int, max_bits: int = MAX_BITS) -> int:
    """A power of two with about ``BITS_PER_KEY`` bits a key, within the bounds."""
    bits = MIN_BITS
    while bits < n_keys * BITS_PER_KEY and bits < max_bits:
        bits *= 2
    return bits


def _places(keys: Sequence[Column], bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(bits)) for seed in range(PROBES)]


def build(keys: DataFrame, bits: int) -> DataFrame:
    """One row ``words``: the filter of the rows of ``keys`` as an array of 64-bit values.

    Bits of equal words are united by a partial aggregate; at most
    ``bits / 64`` rows meet in the last step.
    """
    places = keys.select(F.explode(F.array(*_places([F.col(c) for c in keys.columns], bits))).alias("place"))
    words = places.groupBy(F.floor(F.col("place") / 64).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("place") % 64).cast("int"))).alias("bits"))
    every = keys.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    whole = words.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return whole.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("words"))


def may_contain(words: Column, keys: Sequence[Column], bits: int) -> Column:
    """Whether a key may be among those the filter was built of; a null key is a value like any other."""
    hit = F.lit(True)
    for place in _places(keys, bits):
        word = F.element_at(words, F.floor(place / 64).cast("int") + 1)
        hit = hit & (F.call_function("getbit", word, (place % 64).cast("int")) == 1)
    return hit


def key_filter(keys: DataFrame, on: Sequence[str] | str, max_bits: int = MAX_BITS, n_keys: int | None = None) -> Column:
    """A condition for any frame with the columns ``on``: false only where no row of ``keys`` has that key.

    Pass a written table: it is counted (unless ``n_keys`` is given) and read
    once when the condition is first used.
    """
    names = [on] if isinstance(on, str) else list(on)
    bits = filter_bits(keys.count() if n_keys is None else n_keys, max_bits)
    return may_contain(build(keys.select(*names), bits).scalar(), [F.col(c) for c in names], bits)


def filtered_semi(big: DataFrame, keys: DataFrame, on: Sequence[str] | str, max_bits: int = MAX_BITS,
                  n_keys: int | None = None) -> DataFrame:
    """``big`` semi-joined with ``keys``; only rows that pass the filter are shuffled to the exact join."""
    names = [on] if isinstance(on, str) else list(on)
    return big.where(key_filter(keys, names, max_bits, n_keys)).join(keys.select(*names), names, "left_semi")


def filtered_anti(big: DataFrame, keys: DataFrame, on: Sequence[str] | str, max_bits: int = MAX_BITS,
                  n_keys: int | None = None) -> DataFrame:
    """``big`` without the rows of ``keys``; rows that the filter excludes stay where they are.

    ``big`` is read twice; a row with a null key has no partner and stays.
    """
    names = [on] if isinstance(on, str) else list(on)
    hit = key_filter(keys, names, max_bits, n_keys)
    return big.where(~hit).unionByName(big.where(hit).join(keys.select(*names), names, "left_anti"))
