"""Ranks of values among ranges of equal size, and the interleaving of several of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows, about, that the bounds of ranges are taken from, and the leading characters of a text that they keep.
BOUND_ROWS = 100_000
BOUND_CHARS = 64


def range_bounds(df: DataFrame, key: str, ranges: int, rows: int = BOUND_ROWS) -> list:
    """Values that cut `key` into ranges of about equal numbers of rows, from a sample of about `rows` rows.

    The sample decides where files begin, never what they hold.
    """
    text = df.schema[key].dataType.typeName() == "string"
    value = F.substring(key, 1, BOUND_CHARS) if text else F.col(key)
    count = df.count()
    picked = df.filter(F.col(key).isNotNull()).select(value.alias("v")).sample(min(1.0, rows / max(1, count)), seed=7)
    # ranks of the sample's values; each bound is the first value of a range
    counts = picked.groupBy("v").count().orderBy("v").collect()
    total, seen, bounds = sum(r["count"] for r in counts), 0, []
    for r in counts:
        if bounds and r["v"] == bounds[-1]:
            continue
        if seen * ranges // max(1, total) > len(bounds):
            bounds.append(r["v"])
        seen += r["count"]
    return bounds[: ranges - 1]


def range_rank(df: DataFrame, key: str, bits: int) -> Column:
    """The rank of `key` among at most 2^bits ranges, NULL as 0: a balanced tree of comparisons, of depth `bits`."""
    bounds = range_bounds(df, key, 1 << bits)
    kind = df.schema[key].dataType

    def rank(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col(key) < F.lit(bounds[middle]).cast(kind), rank(low, middle)).otherwise(rank(middle + 1, high))

    return F.when(F.col(key).isNull(), F.lit(0)).otherwise(rank(0, len(bounds))).cast("bigint")


def interleaved(ranks: list[Column], bits: int) -> Column:
    """One number whose bits are those of all ranks in turn, the first rank's leading."""
    parts = []
    for bit in range(bits):
        for i, rank in enumerate(ranks):
            place = bit * len(ranks) + (len(ranks) - 1 - i)
            parts.append(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)), place))
    return reduce(lambda a, b: a.bitwiseOR(b), parts)
