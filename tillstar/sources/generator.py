"""Synthetic card transactions, computed per row from its id: no driver loop, no random state."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.functions.text import BRANCH_TOKENS
from tillstar.operators.keys import dense_key
from tillstar.operators.lookup import lookup

CARD_TYPES = ("Credit", "Debit")
CARD_COMPANIES = ("Aspen Card", "Birch Card", "Cedar Card", "Dahlia Card", "Elm Card", "Fern Card", "Grove Card")



def price_groups(categories: int = 6, kinds: int = 3, merchants: int = 4) -> list[tuple[str, str, int, int, int]]:
    """An invented catalogue by rule: category, subcategory, merchants, least and greatest amount, dearer group by group."""
    groups = []
    for i in range(categories):
        for j in range(kinds):
            low = 500 * 2**i * (j + 1)
            groups.append((f"Category {i + 1}", f"Kind {i + 1}-{j + 1}", merchants, low, 12 * low))
    return groups


def merchant_catalog(spark: SparkSession, groups=None) -> DataFrame:
    """Merchants by rule: so many per subcategory, every second one with a branch in its name."""
    rows, serial = [], 0
    for category, subcategory, count, low, high in groups or price_groups():
        for i in range(1, count + 1):
            branch = f" {BRANCH_TOKENS[serial % len(BRANCH_TOKENS)]}" if serial % 2 else ""
            rows.append((f"{subcategory} {i:02d}{branch}", category, subcategory, low, high))
            serial += 1
    return spark.createDataFrame(
        rows, "name string, category string, subcategory string, min_amount bigint, max_amount bigint"
    )


def merchants_by_category(catalog: DataFrame, category: str) -> DataFrame:
    return catalog.filter(F.col("category") == category)


def _draw(digest: Column, slot: int) -> Column:
    """The slot-th 32-bit number of an md5 digest."""
    return F.conv(F.substring(digest, slot * 8 + 1, 8), 16, 10).cast("bigint")


def generate_transactions(
    spark: SparkSession,
    rows: int | DataFrame,
    start: date = date(2023, 1, 1),
    end: date = date(2024, 12, 31),
    seed: int = 42,
    catalog: DataFrame | None = None,
) -> DataFrame:
    """`rows` transactions (or one per `id` of a DataFrame), uniform over merchants, days and amounts.

    Each value is cut from a digest of (seed, id), so a row is the same in every
    run and under every partitioning.
    """
    ids = spark.range(rows) if isinstance(rows, int) else rows.select("id")
    catalog = merchant_catalog(spark) if catalog is None else catalog
    text = F.concat_ws("|", F.lit(str(seed)), F.col("id").cast("string"))
    # Merchants are numbered from 0, so that a drawn number names one, whatever the catalogue's size.
    columns = ["name", "category", "subcategory", "min_amount", "max_amount"]
    indexed = dense_key(catalog.select(*columns), "_merchant", columns, start=-1)
    merchants = indexed.count()
    days = (end - start).days + 1
    drawn = (
        ids.select(F.md5(text).alias("_a"), F.md5(F.concat(text, F.lit("|card"))).alias("_b"))
        .withColumn("_merchant", _draw(F.col("_a"), 0) % merchants)
    )
    drawn = lookup(drawn, indexed, {"_merchant": "_merchant"}, columns, how="inner")
    a, b = F.col("_a"), F.col("_b")
    span = F.col("max_amount") - F.col("min_amount") + 1
    return drawn.select(
        F.concat_ws(
            "-", a.substr(1, 8), a.substr(9, 4), a.substr(13, 4), a.substr(17, 4), a.substr(21, 12)
        ).alias("transaction_id"),
        F.date_add(F.lit(start), (_draw(a, 1) % days).cast("int")).alias("transaction_date"),
        F.col("name").alias("merchant_name"),
        F.concat_ws("-", "category", "subcategory").alias("merchant_category"),
        (F.col("min_amount") + _draw(a, 2) % span).cast("decimal(15,2)").alias("amount"),
        F.concat(F.lit("****"), (_draw(b, 0) % 9000 + 1000).cast("string")).alias("card_number"),
        F.element_at(F.array(*[F.lit(t) for t in CARD_TYPES]), (_draw(b, 1) % 2 + 1).cast("int")).alias("card_type"),
        F.element_at(
            F.array(*[F.lit(c) for c in CARD_COMPANIES]), (_draw(b, 2) % len(CARD_COMPANIES) + 1).cast("int")
        ).alias("card_company"),
        F.current_timestamp().alias("created_at"),
    )
