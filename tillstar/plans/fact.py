"""The fact table: surrogate keys in place of natural ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.operators.keys import dense_key, offset_key
from tillstar.operators.lookup import (
    join_card,
    join_category,
    join_date,
    join_merchant_asof,
    join_merchant_current,
    small_enough,
)

FACT_COLUMNS = [
    "date_key",
    "year",
    "month",
    "category_key",
    "merchant_key",
    "card_key",
    "transaction_id",
    "amount",
    "quantity",
    "created_at",
]


LOOKUPS = ("dim_date", "dim_category", "dim_merchant", "dim_card")


def small_dimensions(dims: dict[str, DataFrame]) -> set[str]:
    return small_enough({name: dims[name] for name in LOOKUPS})


def fact_transactions(
    silver: DataFrame,
    dims: dict[str, DataFrame],
    transaction_key: str = "offset",
    start: int = 0,
    as_of: bool = False,
    created_at: str | None = None,
    small: set[str] | None = None,
) -> DataFrame:
    """One fact per silver row. Unmatched rows stay, with a NULL key.

    Year and month come from the transaction, so a date outside the calendar
    loses only its `date_key`. Offset keys need no shuffle; `dense` ones follow
    the transaction ids. Keys start above `start`. With `as_of`, a row points
    to the merchant version of its own date instead of the current one. `small`
    names the dimensions known to be small enough to broadcast; by default they
    are measured.
    """
    small = small_dimensions(dims) if small is None else small
    rows = silver.select(
        "transaction_id", "transaction_date", "year", "month", "normalized_merchant", "merchant_category", "amount",
        "card_number", "card_type", "card_company",
        (F.col(created_at) if created_at else F.current_timestamp()).alias("created_at"),
    )
    rows = join_date(rows, dims["dim_date"], small="dim_date" in small)
    rows = join_category(rows, dims["dim_category"], small="dim_category" in small)
    join_merchant = join_merchant_asof if as_of else join_merchant_current
    rows = join_merchant(rows, dims["dim_merchant"], small="dim_merchant" in small)
    rows = join_card(rows, dims["dim_card"], small="dim_card" in small)
    rows = rows.withColumn("quantity", F.lit(1)).select(*FACT_COLUMNS)
    if transaction_key == "dense":
        return dense_key(rows, "transaction_key", ["transaction_id"], start)
    return offset_key(rows, "transaction_key", start).select("transaction_key", *FACT_COLUMNS)
