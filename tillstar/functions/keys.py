"""Content keys: surrogate keys that depend on the natural key alone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_HEX_DIGITS = 15  # 60 bits, always a positive bigint


def natural_key_text(*cols: Column) -> Column:
    """One string per combination of values: `length:value` per column, `~` for NULL."""
    parts = []
    for col in cols:
        text = col.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~")))
    return F.concat(*parts)


def content_key(*cols: Column) -> Column:
    """60-bit bigint key, the same in every run and under every partitioning.

    For ten million members, the chance that any two share a key is about one
    in 23,000. `operators.keys.assert_unique` finds that; tables that grow with
    the data (cards, transactions) use dense or offset keys instead.
    """
    digest = F.md5(natural_key_text(*cols))
    return F.conv(F.substring(digest, 1, KEY_HEX_DIGITS), 16, 10).cast("bigint")


def row_key(*cols: Column) -> Column:
    """64-bit content key that costs a fifth of `content_key`; for keys taken on every row."""
    return F.xxhash64(natural_key_text(*cols))


def if_known(key, *cols: Column) -> Column:
    """The key, or NULL when a part of the natural key is NULL (as an equi-join would give)."""
    known = reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])
    return F.when(known, key(*cols))
