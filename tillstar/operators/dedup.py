"""Deduplication. Each form ships at most one row per key and map task through its one shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.sources.tables import materialize


def _total_order(df: DataFrame, keys: list[str], order: list[str]) -> list[str]:
    """`order`, then every other column: copies that still tie are equal rows."""
    return [*order, *[c for c in df.columns if c not in order and c not in keys]]


def dedup_any(df: DataFrame, keys: list[str]) -> DataFrame:
    """One arbitrary row per key."""
    return df.dropDuplicates(keys)


def dedup_window(df: DataFrame, keys: list[str], order: list[str] = ()) -> DataFrame:
    """The first row per key by `order`, ties broken by all other columns (NULL first).

    The rank filter becomes a group limit before the shuffle as well as after
    it, so a key with very many copies does not travel.
    """
    window = Window.partitionBy(*keys).orderBy(*_total_order(df, keys, list(order)))
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def _ordinal(df: DataFrame, col: str) -> Column | None:
    """`col` as a long in the same order, NULL first; None for types without one."""
    kind = df.schema[col].dataType.typeName()
    if kind == "date":
        value = F.unix_date(col)
    elif kind == "timestamp":
        value = F.unix_micros(col)
    elif kind in ("byte", "short", "integer", "long"):
        value = F.col(col)
    else:
        return None
    return F.coalesce(value.cast("bigint"), F.lit(-(2**63)).cast("bigint"))


def dedup_hash(df: DataFrame, keys: list[str], order: list[str] = ()) -> DataFrame:
    """Same rows as `dedup_window`, by hashing: only copies that a fixed-width comparison can't tell apart are sorted.

    A hash aggregate finds each key's number of rows and its least value of the first column in `order`. Rows meet that in a
    hash join: the only row of its key stays as it is, a row beyond the least value goes, and what is left, rows of one key
    with the same first value, is ranked as in the window form. The rows are read twice and written once in between; keys with
    very many copies are split by the join's skew handling. Worth it where most keys have one row and rows are wide, so that
    the sort costs more than the second scan.
    """
    keys, order = list(keys), list(order)
    first = _ordinal(df, order[0]) if order else None
    least = [] if first is None else [F.min(first).alias("_least")]
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"), *least)
    found = counted.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_copies", *["_least" for _ in least])
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    kept = df.join(found.hint("shuffle_hash"), same)
    if least:
        kept = kept.filter((F.col("_copies") == 1) | (first == F.col("_least")))
    staged = materialize(kept.select(*df.columns, (F.col("_copies") == 1).alias("_single")), "dedup")
    single, several = staged.filter("_single").drop("_single"), staged.filter("NOT _single").drop("_single")
    return single.unionByName(dedup_window(several, keys, order))


def dedup_stats(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows in, rows kept, rows removed and the largest number of copies."""
    copies = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    kept = F.count(F.lit(1))
    rows: Column = F.coalesce(F.sum("copies"), F.lit(0))
    return copies.agg(
        rows.alias("rows_in"),
        kept.alias("rows_kept"),
        (rows - kept).alias("rows_removed"),
        F.coalesce(F.max("copies"), F.lit(0)).alias("max_copies"),
    )
