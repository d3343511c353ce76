"""Calendar, category, merchant and card dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.functions.calendar import calendar_columns
from tillstar.functions.keys import content_key
from tillstar.operators.clean import members, split_category
from tillstar.operators.keys import dense_key, extend_keys
from tillstar.operators.merge import scd1_insert, scd2_init, scd2_merge, with_version_key

CARD_COLUMNS = ["card_number", "card_type", "card_company"]


def _calendar(bounds: DataFrame) -> DataFrame:
    days = bounds.select(F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY"))).alias("day"))
    return days.select(*calendar_columns(F.col("day")), F.lit(False).alias("is_holiday"))


def dim_date(spark: SparkSession, start: date = date(2023, 1, 1), end: date = date(2024, 12, 31)) -> DataFrame:
    """One row per calendar day from `start` to `end`, both included."""
    return _calendar(spark.range(1).select(F.lit(start).alias("first_day"), F.lit(end).alias("last_day")))


def grown_calendar(df: DataFrame, old: DataFrame | None, date_col: str = "transaction_date") -> DataFrame:
    """The calendar of all whole years of `df` and of an earlier calendar, which keeps its holidays."""
    if old is None:
        return dim_date_covering(df, date_col)
    both = df.select(F.col(date_col)).unionAll(old.select(F.col("full_date").alias(date_col)))
    holidays = old.filter("is_holiday").select("date_key", F.lit(True).alias("_holiday"))
    grown = dim_date_covering(both, date_col).join(holidays, "date_key", "left")
    return grown.withColumn("is_holiday", F.coalesce("_holiday", F.lit(False))).select(*old.columns)


def dim_date_covering(df: DataFrame, date_col: str = "transaction_date") -> DataFrame:
    """The calendar of all whole years that `df` touches."""
    first, last = F.trunc(F.min(date_col), "year"), F.trunc(F.max(date_col), "year")
    bounds = df.agg(first.alias("first_day"), F.date_sub(F.add_months(last, 12), 1).alias("last_day"))
    return _calendar(bounds.filter("first_day IS NOT NULL"))


def _content_keys(name: str, cols: list[str]):
    return lambda df: df.select(content_key(*[F.col(c) for c in cols]).alias(name), *df.columns)


def _dense_keys(name: str, cols: list[str], existing: DataFrame | None):
    if existing is None:
        return lambda df: dense_key(df, name, cols)
    return lambda df: extend_keys(existing, df, name, cols)


def _type1(source: DataFrame, existing: DataFrame | None, name: str, cols: list[str], keys: str) -> DataFrame:
    with_keys = _dense_keys(name, cols, existing) if keys == "dense" else _content_keys(name, cols)
    return with_keys(source) if existing is None else scd1_insert(existing, source, cols, with_keys)


def dim_category(silver: DataFrame, existing: DataFrame | None = None, keys: str = "content") -> DataFrame:
    """Type 1: existing members stay as they are, new ones are added."""
    names = members(silver.filter("merchant_category IS NOT NULL"), ["merchant_category"])
    source = split_category(names).withColumnRenamed("merchant_category", "category_name")
    return _type1(source, existing, "category_key", ["category_name"], keys)


def dim_card(silver: DataFrame, existing: DataFrame | None = None, keys: str = "dense") -> DataFrame:
    """Type 1 on number, type and company. Cards grow with the data, so their keys are dense."""
    source = members(silver.filter("card_number IS NOT NULL"), CARD_COLUMNS)
    return _type1(source, existing, "card_key", CARD_COLUMNS, keys)


def merchant_members(silver: DataFrame) -> DataFrame:
    """One row per merchant: its normalised name and the category it used last.

    The first grouping has only a date to carry, so it hashes and combines on
    the map side; the second sees one row per merchant and category.
    """
    used = silver.groupBy(F.col("normalized_merchant").alias("merchant_name"), "merchant_category").agg(
        F.max("transaction_date").alias("_last")
    )
    latest = F.max_by("merchant_category", F.struct("_last", "merchant_category"))
    return used.groupBy("merchant_name").agg(latest.alias("merchant_category")).filter("merchant_name IS NOT NULL")


def dim_merchant(silver: DataFrame, as_of: date, existing: DataFrame | None = None) -> DataFrame:
    """Type 2: a change of category closes the current version and opens the next."""
    source = merchant_members(silver)
    if existing is None:
        first = scd2_init(source, as_of)
        return with_version_key(first, "merchant_name", ["merchant_category"], "merchant_key")
    return scd2_merge(existing, source, "merchant_name", ["merchant_category"], as_of, check=False)
