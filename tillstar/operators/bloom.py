"""A Bloom filter of keys as a native expression: it tells which rows of a large table can't have one of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: At most 8 MiB of bits, whatever the number of keys.
MAX_BITS = 1 << 26
BITS_PER_KEY = 16
HASHES = 4


def filter_bits(keys: int) -> int | None:
    """A power of two with at least `BITS_PER_KEY` bits for each key; None where the bound leaves fewer than a quarter of that."""
    bits = 1 << max(12, (keys * BITS_PER_KEY - 1).bit_length())
    return min(bits, MAX_BITS) if 4 * MAX_BITS >= bits else None


def _places(cols: list[str], bits: int) -> list[Column]:
    return [F.xxhash64(F.lit(i), *cols).bitwiseAND(F.lit(bits - 1)) for i in range(HASHES)]


def bloom_filter(keys: DataFrame, cols: list[str], bits: int) -> DataFrame:
    """One row with the words of the filter. Tasks send partial words: bits/64 rows at most."""
    place = F.explode(F.array(*_places(cols, bits))).alias("_p")
    word = keys.select(place).select(
        F.shiftright("_p", 6).alias("_w"), F.expr("shiftleft(1L, cast(_p & 63 as int))").alias("_b")
    )
    empty = keys.sparkSession.range(bits >> 6).select(F.col("id").alias("_w"), F.lit(0).cast("bigint").alias("_b"))
    words = word.unionByName(empty).groupBy("_w").agg(F.bit_or("_b").alias("_b"))
    return words.agg(F.transform(F.array_sort(F.collect_list(F.struct("_w", "_b"))), lambda x: x["_b"]).alias("bloom"))


def may_be_among(keys: DataFrame, cols: list[str], count: int) -> Column | None:
    """Whether a row with the columns `cols` may have one of the keys: false only where it has none.

    None where the keys are too many for the filter's bound. `keys` is read once, when the filter is first used.
    """
    bits = filter_bits(count)
    if bits is None:
        return None
    bloom = bloom_filter(keys, cols, bits).scalar()
    held = [
        F.getbit(F.get(bloom, F.shiftright(place, 6).cast("int")), place.bitwiseAND(F.lit(63)).cast("int")) == 1
        for place in _places(cols, bits)
    ]
    return reduce(lambda a, b: a & b, held)
