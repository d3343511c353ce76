"""Validity, quarantine, column derivation and member extraction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.keys import row_key
from tillstar.functions.text import category_level, normalize_merchant, transaction_type
from tillstar.sources.tables import with_year_month

REQUIRED = ("transaction_date", "merchant_name")

SILVER_COLUMNS = (
    "transaction_id",
    "transaction_date",
    "year",
    "month",
    "merchant_name",
    "normalized_merchant",
    "merchant_category",
    "amount",
    "transaction_type",
    "card_number",
    "card_type",
    "card_company",
    "processed_at",
)


def is_valid(required: tuple[str, ...] = REQUIRED) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required], F.col("amount") > 0)


def filter_valid(df: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """Positive amount and no NULL in `required`; plain comparisons, so they reach the scan."""
    return df.filter(is_valid(required))


def rejects(df: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """What `filter_valid` drops, with the first reason that applies."""
    reason = F.when(F.col("amount").isNull(), "amount is null").when(
        F.col("amount") <= 0, "amount not positive"
    )
    for name in required:
        reason = reason.when(F.col(name).isNull(), f"{name} is null")
    return df.filter(~F.coalesce(is_valid(required), F.lit(False))).withColumn("reject_reason", reason)


def with_silver_columns(df: DataFrame) -> DataFrame:
    return with_year_month(df).withColumns(
        {
            "normalized_merchant": normalize_merchant(F.col("merchant_name")),
            "transaction_type": transaction_type(F.col("amount")),
        }
    )


def select_silver(df: DataFrame) -> DataFrame:
    """Silver columns in their order; audit columns that `df` does not have are left out."""
    present = set(df.columns)
    return df.select(*[c for c in SILVER_COLUMNS if c in present])


def with_audit_time(df: DataFrame, name: str = "processed_at") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def members(df: DataFrame, cols: list[str | Column]) -> DataFrame:
    """Distinct combinations: map-side combined, so a hot member costs one row per task."""
    return df.select(*cols).distinct()


def split_category(df: DataFrame, category: str = "merchant_category") -> DataFrame:
    col = F.col(category)
    return df.withColumns({"level_1": category_level(col, 1), "level_2": category_level(col, 2)})


def with_holidays(dim_date: DataFrame, holidays: DataFrame) -> DataFrame:
    """Set `is_holiday` from a table with a `holiday_date` column."""
    listed = holidays.select(F.col("holiday_date").alias("full_date"), F.lit(True).alias("_listed")).distinct()
    columns = [c for c in dim_date.columns if c != "is_holiday"]
    return dim_date.join(listed, "full_date", "left").select(
        *columns, F.coalesce("_listed", F.lit(False)).alias("is_holiday")
    )


def sample_for_checks(df: DataFrame, fraction: float, key: str = "transaction_id", digest=row_key) -> DataFrame:
    """A repeatable share of the keys, the same under every partitioning; all copies of a key together."""
    return df.filter(F.pmod(digest(F.col(key)), F.lit(10_000)) < round(fraction * 10_000))
