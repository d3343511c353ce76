"""Upserts and slowly changing dimensions on immutable tables: joins and unions, no row updates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.functions.keys import content_key
from tillstar.operators.bloom import may_be_among
from tillstar.operators.keys import assert_unique
from tillstar.operators.lookup import small_enough
from tillstar.sources.tables import materialize, read_table, remove_slice, replace_slices, within_slices

OPEN_END = date(9999, 12, 31)
BOOTSTRAP_START = date(2000, 1, 1)


def scd1_insert(target: DataFrame, source: DataFrame, key: list[str], with_keys) -> DataFrame:
    """Target unchanged, plus the source members it lacks, keyed by `with_keys(new_members)`.

    Natural keys compare NULL-safe, so a member with a NULL part is not added again.
    """
    known = target.select(*[F.col(c).alias(f"_t_{c}") for c in key])
    matched = [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in key]
    new = source.join(known, matched, "left_anti")
    return target.unionByName(with_keys(new))


def upsert(
    target: DataFrame, source: DataFrame, keys: list[str], check: bool = True, small: bool | None = None
) -> DataFrame:
    """Every source row, and the target rows whose key the source does not have.

    A source that is to be checked or measured is written once first, so that
    its lineage runs once. When its keys are known or measured to be small,
    they are broadcast and the target does not shuffle. Otherwise a Bloom
    filter of the keys parts the target: rows that can't have one of them stay
    without a shuffle, and only the others meet the source in a join. Sources
    with more keys than the filter takes shuffle both sides.
    """
    if check or small is None:
        source = materialize(source, "upsert_source")
    if check:
        assert_unique(source, keys, "upsert source")
    incoming = source.select(*keys)
    small = bool(small_enough({"keys": incoming})) if small is None else small
    return not_among(target, incoming, keys, small).unionByName(source)


def not_among(target: DataFrame, incoming: DataFrame, keys: list[str], small: bool) -> DataFrame:
    """The target rows that have none of the incoming keys, as `upsert` finds them."""
    if small:
        return target.join(F.broadcast(incoming), keys, "left_anti")
    held = may_be_among(incoming, keys, incoming.count())
    if held is None:
        return target.join(incoming, keys, "left_anti")
    return target.filter(~held).unionByName(target.filter(held).join(incoming, keys, "left_anti"))


def upsert_bucketed(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The upsert of a source of any size into a bucketed table: the source alone is shuffled, into the table's buckets.

    `target` comes from `read_bucketed`. A row of either side meets its counterpart in one full join, and a task of the result
    holds the rows of one bucket, so that `write_bucketed` makes one file of it.
    """
    source = materialize(source.select(*target.columns), "upsert_source")
    assert_unique(source, keys, "upsert source")
    rest = [c for c in target.columns if c not in keys]
    new = source.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in rest], F.lit(True).alias("_seen"))
    both = target.hint("merge").join(new, keys, "full_outer")
    return both.select(*[F.col(c) if c in keys else F.when(F.col("_seen"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in target.columns])


# --- type 2 dimensions ------------------------------------------------------------------------


def scd2_init(source: DataFrame, as_of: date | Column) -> DataFrame:
    """First load: every member is open from `as_of`."""
    return source.select(
        "*",
        _date(as_of).alias("effective_date"),
        _date(OPEN_END).alias("expiration_date"),
        F.lit(True).alias("is_current"),
    )


def scd2_bootstrap(target: DataFrame) -> DataFrame:
    """Give an older table the validity columns it lacks."""
    defaults = {
        "effective_date": _date(BOOTSTRAP_START),
        "expiration_date": _date(OPEN_END),
        "is_current": F.lit(True),
    }
    return target.withColumns({c: v for c, v in defaults.items() if c not in target.columns})


def scd2_merge(
    target: DataFrame,
    source: DataFrame,
    key: str,
    attrs: list[str],
    as_of: date | Column,
    surrogate: str = "merchant_key",
    check: bool = True,
) -> DataFrame:
    """Close current versions that the source changes, and open new versions and new members.

    Intervals are half-open: a version ends on the day the next one begins. A
    member absent from the source stays as it is, and applying the same batch
    twice changes nothing. The key of a version comes from member, attributes
    and start date, so a return to an earlier category is a new version. A
    change on the day its version began amends that version, which keeps its
    key; a change from before that day fails when the result is computed.
    """
    if check:
        assert_unique(source, [key], "type 2 source")
    start = _date(as_of)
    history = target.filter("NOT is_current")
    current = target.filter("is_current")

    incoming = source.select(
        F.col(key), *[F.col(a).alias(f"_new_{a}") for a in attrs], F.lit(True).alias("_seen")
    )
    changed = F.lit(False)
    for a in attrs:
        changed = changed | ~F.col(a).eqNullSafe(F.col(f"_new_{a}"))
    changed = F.coalesce("_seen", F.lit(False)) & changed
    amended, closed = changed & (F.col("effective_date") == start), changed & (F.col("effective_date") < start)
    late = F.raise_error(F.concat(F.lit("a change is dated before the version it changes: "), F.col(key).cast("string")))
    made = {
        "expiration_date": F.when(closed, start).when(changed & ~amended, late.cast("date")).otherwise(F.col("expiration_date")),
        "is_current": F.when(closed, False).otherwise(F.col("is_current")),
        **{a: F.when(amended, F.col(f"_new_{a}")).otherwise(F.col(a)) for a in attrs},
    }
    kept = current.join(incoming, key, "left").select(*[made.get(c, F.col(c)).alias(c) for c in target.columns])

    now = current.select(F.col(key), *[F.col(a).alias(f"_old_{a}") for a in attrs], F.col("effective_date").alias("_began"))
    same = F.lit(True)
    for a in attrs:
        same = same & F.col(a).eqNullSafe(F.col(f"_old_{a}"))
    opened = (
        source.join(now, key, "left")
        .filter(F.col("_began").isNull() | (~same & (F.col("_began") < start)))
        .select(key, *attrs)
    )
    opened = with_version_key(scd2_init(opened, as_of), key, attrs, surrogate)
    return history.unionByName(kept).unionByName(opened)


def with_version_key(df: DataFrame, key: str, attrs: list[str], surrogate: str) -> DataFrame:
    parts = [F.col(c) for c in (key, *attrs, "effective_date")]
    return df.select(content_key(*parts).alias(surrogate), *df.columns)


def _date(value: date | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


# --- incremental loads ------------------------------------------------------------------------


def newer_than(df: DataFrame, target: DataFrame, watermark: str) -> DataFrame:
    """Rows past the target's largest watermark; all rows when the target is empty.

    The watermark is one value, read first so that it reaches the scan as a pushed filter.
    """
    last = target.agg(F.max(watermark)).first()[0]
    return df if last is None else df.filter(F.col(watermark) > F.lit(last))


def touched_slices(target: DataFrame, source: DataFrame, keys: list[str], partitions: tuple[str, ...]) -> set[tuple]:
    """Partitions that the source writes to, and those of the target where its keys sit now.

    Of the target only keys are read, and a Bloom filter of the source's keys
    lets few of them reach the join. One tuple per partition, which is what a
    driver holds for any scan. `source` is read several times.
    """
    incoming = source.select(*keys)
    held = may_be_among(incoming, keys, incoming.count())
    there = target.select(*keys, *partitions)
    sits = (there if held is None else there.filter(held)).join(incoming, keys, "left_semi")
    places = source.select(*partitions).distinct().union(sits.select(*partitions).distinct())
    return {tuple(row) for row in places.distinct().collect()}


def upsert_slices(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: list[str],
    partitions: tuple[str, ...],
    keys_can_move: bool = True,
    staged: bool = False,
) -> None:
    """Upsert into the partitions of `path` that the source touches; all others stay unread.

    Touched are the partitions the source writes to and, as `keys_can_move`,
    those where its keys sit now (found by scanning the key column only). A
    partition that the upsert leaves empty is removed after the others are
    written; a run that dies in between leaves the moved rows in both places,
    and the same upsert again mends it. A source that is `staged` already, by
    the partitions, is read as it is. While its keys are too many to broadcast,
    its rows go from there to the table as they lie, and only the rows that
    stay are staged and shuffled.
    """
    target = read_table(spark, path)
    source = source.select(*target.columns)
    source = source if staged else materialize(source, "upsert_source", partitions)
    assert_unique(source, keys, "upsert source")
    if keys_can_move:
        touched = touched_slices(target, source, keys, partitions)
    else:
        touched = {tuple(row) for row in source.select(*partitions).distinct().collect()}
    if not touched:
        return
    few = bool(small_enough({"keys": source.select(*keys)}))
    there = within_slices(target, partitions, touched)
    if few:
        merged = materialize(upsert(there, source, keys, check=False, small=True), "merged")
    else:
        kept = materialize(not_among(there, source.select(*keys), keys, False), "kept", partitions)
        merged = kept.unionByName(source)
    filled = {tuple(row) for row in merged.select(*partitions).distinct().collect()}
    replace_slices(merged, path, partitions, clustered=not few)
    for place in touched - filled:
        remove_slice(spark, path, dict(zip(partitions, place)))
