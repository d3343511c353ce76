"""Surrogate keys for whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.sources.tables import materialize

_OFFSET_BITS = 33  # monotonically_increasing_id: partition number above, row number in it below


def offset_key(df: DataFrame, name: str, start: int = 0) -> DataFrame:
    """Unique bigint keys above `start` without a shuffle. Not dense, not stable across runs."""
    return df.withColumn(name, F.monotonically_increasing_id() + F.lit(start + 1))


def dense_key(
    df: DataFrame, name: str, order: list[str | Column], start: int = 0, partitions: int | None = None
) -> DataFrame:
    """Keys start+1 .. start+n in `order`, which must be total, without a one-task window.

    One range shuffle sorts the rows; each row's place in its own range is known
    locally, and the row counts of the ranges give the offsets. The sorted rows
    are written once, so counts and rows agree.
    """
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    placed = materialize(
        ranged.sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()), name
    ).withColumn("_part", F.shiftright("_place", _OFFSET_BITS))
    # One row per shuffle partition, whatever the data size: safe for one window task and a broadcast.
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    place = F.col("_place").bitwiseAND(F.lit((1 << _OFFSET_BITS) - 1))
    key = (F.lit(start + 1) + F.col("_before") + place).cast("bigint")
    return placed.join(F.broadcast(offsets), "_part").select(key.alias(name), *df.columns)


def max_key(dim: DataFrame, name: str) -> int:
    return dim.agg(F.max(name)).first()[0] or 0


def extend_keys(dim: DataFrame, new: DataFrame, name: str, order: list[str | Column]) -> DataFrame:
    """Dense keys for new members, counted on from the largest key in `dim`."""
    return dense_key(new, name, order, start=max_key(dim, name))


def duplicate_keys(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def assert_unique(df: DataFrame, cols: list[str], what: str) -> None:
    """Raise when a key occurs more than once (one aggregate job, stops at the first finding)."""
    found = duplicate_keys(df, cols).head(1)
    if found:
        raise ValueError(f"{what}: {cols} is not unique, for example {found[0].asDict()}")
