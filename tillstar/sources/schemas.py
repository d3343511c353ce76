"""Declared schemas of the raw feeds and conformity by cast."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_MONEY = DecimalType(15, 2)


def _struct(*fields) -> StructType:
    return StructType([StructField(name, dtype, nullable) for name, dtype, nullable in fields])


# Column names, types and nullability of the three feeds.
CARD_TRANSACTION = _struct(
    ("transaction_id", StringType(), False),
    ("transaction_date", DateType(), False),
    ("merchant_name", StringType(), False),
    ("merchant_category", StringType(), True),
    ("amount", _MONEY, False),
    ("card_number", StringType(), True),
    ("card_type", StringType(), True),
    ("card_company", StringType(), True),
    ("created_at", TimestampType(), False),
)
BANK_TRANSACTION = _struct(
    ("transaction_id", StringType(), False),
    ("transaction_date", DateType(), False),
    ("description", StringType(), False),
    ("amount", _MONEY, False),
    ("balance", _MONEY, True),
    ("account_number", StringType(), True),
    ("created_at", TimestampType(), False),
)
STOCK_TRANSACTION = _struct(
    ("transaction_id", StringType(), False),
    ("transaction_date", DateType(), False),
    ("stock_code", StringType(), False),
    ("stock_name", StringType(), False),
    ("transaction_type", StringType(), False),
    ("quantity", IntegerType(), False),
    ("price", _MONEY, False),
    ("total_amount", _MONEY, False),
    ("created_at", TimestampType(), False),
)


def conform(df: DataFrame, schema: StructType, rejects_column: str | None = None) -> DataFrame:
    """Select the schema's columns in its order, cast to its types.

    A value that does not cast becomes NULL. With `rejects_column`, that column
    lists (as an array) the fields that had a value but lost it, or miss a
    value the schema requires.
    """
    present = set(df.columns)
    cols = [
        (F.col(f.name) if f.name in present else F.lit(None)).try_cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    if rejects_column is None:
        return df.select(*cols)
    bad = []
    for field, cast in zip(schema.fields, cols):
        lost = F.col(field.name).isNotNull() & cast.isNull() if field.name in present else F.lit(False)
        missing = cast.isNull() if not field.nullable else F.lit(False)
        bad.append(F.when(lost | missing, F.lit(field.name)))
    return df.select(*cols, F.array_compact(F.array(*bad)).alias(rejects_column))


def align_schema(df: DataFrame, target: StructType, defaults: dict | None = None) -> DataFrame:
    """Give `df` the columns of `target`, missing ones filled by default (else NULL), extras kept last."""
    defaults = defaults or {}
    present = set(df.columns)
    cols = []
    for field in target.fields:
        default = F.lit(defaults.get(field.name)).cast(field.dataType)
        value = F.col(field.name).cast(field.dataType) if field.name in present else default
        cols.append((F.coalesce(value, default) if field.name in defaults else value).alias(field.name))
    extras = [F.col(c) for c in df.columns if c not in target.fieldNames()]
    return df.select(*cols, *extras)


def merge_all(*frames: DataFrame) -> DataFrame:
    """Union by name; a column missing on one side is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def type_mismatches(df: DataFrame, schema: StructType) -> list[str]:
    """Names of declared columns that are present with another type."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    return [f.name for f in schema.fields if f.name in actual and actual[f.name] != f.dataType]
