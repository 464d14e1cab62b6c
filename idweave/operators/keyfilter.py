"""A bitmap of keys, to drop rows that can meet nothing before they are shuffled.

The bitmap has a fixed number of bits, whatever it is made from. A key that is in it is never missed; another one
passes if its bit happens to be set, and then costs a row in the shuffle and nothing else. The fuller the bitmap, the less it
saves; results are the same even when every bit is set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The bitmap has two to this power bits: half a million words of 64 bits (8 MB) are sent to the executors at most.
KEY_BITS = 25


def _place(columns: Sequence[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(1 << bits).cast("long"))


def key_bitmap(keys: DataFrame, columns: Sequence[str], bits: int = KEY_BITS) -> DataFrame:
    """``_word, _bits`` of all keys. Words are folded on the map side, so a key that repeats costs nothing."""
    place = keys.select(_place(columns, bits).alias("_place"))
    word, bit = F.shiftright("_place", 6).alias("_word"), F.expr("shiftleft(1L, cast(_place & 63 as int))")
    return place.select(word, bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))


def maybe_among(rows: DataFrame, columns: Sequence[str], bitmap: DataFrame, bits: int = KEY_BITS) -> DataFrame:
    """``rows`` without those whose key is surely not in ``bitmap`` (of ``key_bitmap`` with as many bits)."""
    placed = rows.withColumn("_place", _place(columns, bits)).withColumn("_word", F.shiftright("_place", 6))
    met = placed.join(F.broadcast(bitmap), "_word")  # bounded by ``bits``, see KEY_BITS
    return met.where("shiftright(_bits, cast(_place & 63 as int)) & 1 = 1").select(*rows.columns)
