"""Bronze and silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.operators.clean import REQUIRED, SILVER_COLUMNS, filter_valid, select_silver, with_silver_columns
from tillstar.operators.dedup import dedup_window
from tillstar.sources.tables import with_lineage, with_year_month

KEY = ["transaction_id"]


def build_bronze(raw: DataFrame) -> DataFrame:
    """Raw rows with lineage and partition columns. `raw` must be a plain file scan."""
    return with_year_month(with_lineage(raw))


def build_silver(
    bronze: DataFrame,
    required: tuple[str, ...] = REQUIRED,
    dedup=dedup_window,
    filter_first: bool = True,
    processed_at: str | None = None,
) -> DataFrame:
    """One valid, normalised row per transaction.

    Filtering first (the default) keeps a transaction whose copies are partly
    invalid; deduplicating first can lose it. Bronze columns that silver does
    not keep are not read. `processed_at` names a column to use in place of the
    current time.
    """
    stamp = F.col(processed_at) if processed_at else F.current_timestamp()
    kept = [c for c in bronze.columns if c in SILVER_COLUMNS or c == processed_at]
    rows = bronze.select(*[c for c in kept if c not in ("year", "month")])
    rows = dedup(filter_valid(rows, required), KEY, ["transaction_date"]) if filter_first else filter_valid(
        dedup(rows, KEY, ["transaction_date"]), required
    )
    return select_silver(with_silver_columns(rows).withColumn("processed_at", stamp))
