"""Dimension lookups, point-in-time lookup, change detection, unmatched keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024


def small_enough(
    frames: dict[str, DataFrame], max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> set[str]:
    """Names of the frames that are small enough to copy to every executor, measured in one job.

    Each frame is one partial aggregate. Texts and binaries count by length, arrays, maps and structs by that of their JSON,
    wide decimals as 16 bytes and other values as 8.
    """

    def size(field) -> Column:
        kind = field.dataType.typeName()
        if kind in ("string", "varchar", "char", "binary"):
            return F.coalesce(F.octet_length(field.name), F.lit(0))
        if kind in ("array", "map", "struct", "variant"):
            return F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))
        return F.lit(16 if kind == "decimal" and field.dataType.precision > 18 else 8)

    def size_of(name: str, df: DataFrame) -> DataFrame:
        sizes = [size(f) for f in df.schema.fields]
        width = reduce(lambda a, b: a + b, sizes).cast("bigint")
        return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(width).alias("bytes")).withColumn("name", F.lit(name))

    measured = reduce(DataFrame.union, [size_of(name, df) for name, df in frames.items()])
    fits = (F.col("rows") <= max_rows) & (F.coalesce("bytes", F.lit(0)) <= max_bytes)
    return {row["name"] for row in measured.filter(fits).collect()}


def lookup(
    left: DataFrame,
    dim: DataFrame,
    on: dict[str, str],
    take: dict[str, str] | list[str],
    how: str = "left",
    null_safe: tuple[str, ...] = (),
    between: tuple[str, str, str] | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Add the columns `take` of `dim` to `left`, matched on left column -> dim column.

    `between=(date, from, until)` adds the half-open test from <= date < until.
    The dimension is broadcast when it is known or (with `small` left open)
    measured to be small; otherwise both sides shuffle on the key and adaptive
    execution splits the partitions of hot keys.
    """
    take = take if isinstance(take, dict) else {c: c for c in take}
    needed = {*on.values(), *take, *(between[1:] if between else ())}
    side = dim.select(*[F.col(c).alias(f"_d_{c}") for c in sorted(needed)])
    if small_enough({"side": side}) if small is None else small:
        side = F.broadcast(side)

    def match(l: str, d: str) -> Column:
        return F.col(l).eqNullSafe(F.col(f"_d_{d}")) if l in null_safe else F.col(l) == F.col(f"_d_{d}")

    condition = reduce(lambda a, b: a & b, [match(l, d) for l, d in on.items()])
    if between:
        date, start, until = between
        condition = condition & (F.col(date) >= F.col(f"_d_{start}")) & (F.col(date) < F.col(f"_d_{until}"))
    return left.join(side, condition, how).select(
        *left.columns, *[F.col(f"_d_{c}").alias(alias) for c, alias in take.items()]
    )


def join_date(
    df: DataFrame, dim_date: DataFrame, how: str = "left", date_col: str = "transaction_date", small: bool | None = None
) -> DataFrame:
    """Key of the row's day. A calendar spans the dates of the data, one of which may lie far off, so it is measured."""
    return lookup(df, dim_date, {date_col: "full_date"}, ["date_key"], how, small=small)


def join_category(df: DataFrame, dim_category: DataFrame, how: str = "left", small: bool | None = None) -> DataFrame:
    return lookup(df, dim_category, {"merchant_category": "category_name"}, ["category_key"], how, small=small)


def join_merchant_current(df: DataFrame, dim_merchant: DataFrame, how: str = "left", small: bool | None = None) -> DataFrame:
    """Key of the merchant's open version; the dimension is filtered before the join."""
    current = dim_merchant.filter("is_current")
    return lookup(df, current, {"normalized_merchant": "merchant_name"}, ["merchant_key"], how, small=small)


def join_merchant_composite(
    df: DataFrame, dim_merchant: DataFrame, how: str = "left", name: str = "merchant_name", small: bool | None = None
) -> DataFrame:
    """Merchant by name and category together."""
    on = {name: "merchant_name", "merchant_category": "merchant_category"}
    return lookup(df, dim_merchant, on, ["merchant_key"], how, small=small)


def join_card(df: DataFrame, dim_card: DataFrame, how: str = "left", small: bool | None = None) -> DataFrame:
    """Card by its whole natural key; number alone would multiply rows when cards share one."""
    cols = ["card_number", "card_type", "card_company"]
    return lookup(
        df, dim_card, {c: c for c in cols}, ["card_key"], how, null_safe=("card_type", "card_company"), small=small
    )


def join_merchant_asof(
    df: DataFrame, dim_merchant: DataFrame, date_col: str = "transaction_date", small: bool | None = None
) -> DataFrame:
    """Merchant version that was in force on the row's date.

    Versions that are known or measured to be small are broadcast; others are merged with the rows by date.
    """
    on, take = {"normalized_merchant": "merchant_name"}, {"merchant_key": "merchant_key", "merchant_category": "category_then"}
    period = (date_col, "effective_date", "expiration_date")
    needed = dim_merchant.select("merchant_name", *take, *period[1:])
    if small_enough({"side": needed}) if small is None else small:
        return lookup(df, dim_merchant, on, take, between=period, small=True)
    return merge_asof(df, dim_merchant, on, take, period)


def merge_asof(
    left: DataFrame,
    versions: DataFrame,
    on: dict[str, str],
    take: dict[str, str],
    between: tuple[str, str, str],
    stretch: str = "quarter",
) -> DataFrame:
    """Add the columns `take` of the version in force, by one ordered pass over rows and versions together.

    Both are put in one table, ordered by date within a member, and each row
    takes the last version before it; no pair of a row and a version is made.
    A member's dates are cut into stretches of time, so that a member with much
    of the data is many groups; a version also enters at the start of every
    later stretch that it reaches, up to the last one with a row. Versions of a
    member may not overlap. Rows without a date or member get NULL.
    """
    date, start, until = between
    last = left.agg(F.max(date).alias("last")).scalar()
    first = left.agg(F.min(date).alias("first")).scalar()
    keys = [f"_k{i}" for i in range(len(on))]
    row = F.struct(*[F.col(c) for c in left.columns]).alias("_row")
    rows = left.select(
        *[F.col(c).alias(k) for c, k in zip(on, keys)],
        F.trunc(date, stretch).alias("_stretch"),
        F.col(date).cast("date").alias("_at"),
        F.lit(1).alias("_kind"),
        F.lit(None).cast("struct<" + ", ".join(f"{c}: {versions.schema[c].dataType.simpleString()}" for c in [*take, until]) + ">").alias("_version"),
        row,
    )
    # from the version's own stretch, or that of the first row, to that of its last day or of the last row
    began = F.greatest(F.col(start), F.least(first, F.col(until)))
    ends = F.least(F.date_sub(F.col(until), 1), last)
    months = F.expr(f"INTERVAL {dict(month=1, quarter=3, year=12)[stretch]} MONTHS")
    reached = F.when(began <= ends, F.sequence(F.trunc(began, stretch), F.trunc(ends, stretch), months))
    entries = versions.select(
        *[F.col(d).alias(k) for d, k in zip(on.values(), keys)],
        F.explode(reached).alias("_stretch"),
        F.col(start).alias("_at"),
        F.lit(0).alias("_kind"),
        F.struct(*[F.col(c) for c in [*take, until]]).alias("_version"),
        F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"),
    )
    window = Window.partitionBy(*keys, "_stretch").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    carried = rows.unionByName(entries).withColumn("_held", F.last("_version", ignorenulls=True).over(window))
    found = carried.filter("_kind = 1")
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], F.col("_at") < F.col(f"_held.{until}"))
    return found.select("_row.*", *[F.when(known, F.col(f"_held.{c}")).alias(alias) for c, alias in take.items()])


def categorize(
    df: DataFrame,
    mapping: DataFrame,
    name: str = "normalized_merchant",
    default: str = "Uncategorized",
    small: bool | None = None,
) -> DataFrame:
    """Add `assigned_category` from a table of `merchant_name` and `category`; merchants it lacks get the default.

    A name may stand in the table once. Which rows were found is in `is_mapped`.
    """
    found = lookup(df, mapping, {name: "merchant_name"}, {"category": "_category"}, small=small)
    return found.withColumns(
        {"assigned_category": F.coalesce("_category", F.lit(default)), "is_mapped": F.col("_category").isNotNull()}
    ).drop("_category")


def detect_changes(source: DataFrame, target: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """Source rows whose attributes differ from the target's, changes to and from NULL included."""
    old = target.select(F.col(key), *[F.col(a).alias(f"old_{a}") for a in attrs])
    differs = reduce(lambda a, b: a | b, [~F.col(a).eqNullSafe(F.col(f"old_{a}")) for a in attrs])
    return source.join(old, key).filter(differs)


def orphans(fact: DataFrame, fk: str, dim: DataFrame, pk: str | None = None) -> DataFrame:
    """Fact rows whose foreign key is NULL or has no member."""
    known = dim.select(F.col(pk or fk).alias(fk))
    return fact.join(known, fk, "left_anti")
