"""The raw card feed, derived from the order tables.

Every order line is one card transaction: the supplier is the merchant, the
customer holds the card. Line numbers repeat, so transaction ids do, with
copies that differ; some merchants are NULL and some amounts negative.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.functions.money import AMOUNT
from tillstar.functions.text import BRANCH_TOKENS


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def merchants(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers with nation and region."""
    return (
        table(spark, folder, "supplier")
        .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )


def category_of(key: str = "s_suppkey") -> F.Column:
    return F.when(F.col(key) % 25 == 7, F.col("r_name")).otherwise(F.concat_ws("-", "r_name", "n_name"))


def card_feed(spark: SparkSession, folder: str) -> DataFrame:
    """No join hints: the planner broadcasts the sides whose files are small and shuffles the rest.

    Orders meet their customers before they meet the lines, and the wide merchant columns come last, so that where all these are
    shuffled the lines move once, as narrow as they are read.
    """
    branch = F.get(F.array(*[F.lit(t) for t in BRANCH_TOKENS[:4]]), F.col("l_partkey") % 4)
    price = F.col("l_extendedprice").cast(AMOUNT)
    bad = (F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "R")
    held = table(spark, folder, "orders").join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return (
        table(spark, folder, "lineitem")
        .join(held, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(merchants(spark, folder), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias(
                "transaction_id"
            ),
            F.col("l_shipdate").cast("date").alias("transaction_date"),
            F.when(F.col("l_suppkey") % 50 != 49, F.concat_ws(" ", "s_name", branch)).alias("merchant_name"),
            category_of("l_suppkey").alias("merchant_category"),
            F.when(bad, -price).otherwise(price).cast(AMOUNT).alias("amount"),
            F.concat(F.lit("****"), F.lpad((F.col("c_custkey") % 997).cast("string"), 4, "0")).alias("card_number"),
            F.when(F.col("c_custkey") % 2 == 0, "Credit").otherwise("Debit").alias("card_type"),
            F.col("c_mktsegment").alias("card_company"),
            F.col("l_shipdate").alias("created_at"),
        )
    )
