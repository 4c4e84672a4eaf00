"""Bloom filter of a key set, as an expression on the other side of a join.

A large event table that must be shuffled to meet a cohort is first thinned out: rows whose key is surely not
in the cohort go before the shuffle. The filter is one array of longs, made by Spark and handed to the
tasks as the value of a scalar subquery. Its size is set in bytes; a fuller filter lets more rows through and loses none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: bits for each key, up to ``BLOOM_BYTES`` in all; rows of the array a key sets
BITS_PER_KEY, PROBES, BLOOM_BYTES = 12, 3, 16 << 20


def _probes(on: list[str], longs: int) -> list[tuple[Column, Column]]:
    """(place in the array, bit mask) of each probe."""
    found = []
    for i in range(PROBES):
        h = F.xxhash64(F.lit(i), *on)
        found.append((F.pmod(h, F.lit(longs)).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 58).cast("int"))))
    return found


def longs_for(keys: int, limit: int = BLOOM_BYTES) -> int:
    """Length of the array for so many keys, within ``limit`` bytes."""
    return max(1, min(limit // 8, -(-keys * BITS_PER_KEY // 64)))


def bloom(keys: DataFrame, on: list[str], longs: int) -> DataFrame:
    """One row with the filter's array ``bits``. NULL keys are in no filter."""
    known = keys.select(*on).dropna()
    set_bits = F.inline(F.array(*[F.struct(at.alias("at"), bit.alias("bit")) for at, bit in _probes(on, longs)]))
    words = known.select(set_bits).groupBy("at").agg(F.bit_or("bit").alias("word"))
    every = keys.sparkSession.range(longs).select(F.col("id").cast("int").alias("at")).join(words, "at", "left")
    ordered = F.array_sort(F.collect_list(F.struct("at", F.coalesce("word", F.lit(0).cast("long")).alias("word"))))
    return every.agg(ordered.getField("word").alias("bits"))


def maybe_in(bits: Column, on: list[str], longs: int) -> Column:
    """Whether the row's key may be in the filter; false for NULL keys."""
    test = F.lit(True)
    for key in on:
        test = test & F.col(key).isNotNull()
    for at, bit in _probes(on, longs):
        test = test & (F.get(bits, at).bitwiseAND(bit) != 0)
    return test


def thinned(events: DataFrame, keys: DataFrame, on: list[str], n_keys: int, limit: int = BLOOM_BYTES) -> DataFrame:
    """Events whose key may be among ``keys``, a written table of ``n_keys`` rows."""
    longs = longs_for(n_keys, limit)
    return events.filter(maybe_in(bloom(keys, on, longs).scalar(), on, longs))
