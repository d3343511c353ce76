"""String expressions on merchants, categories and transaction signs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Branch names that are cut out of merchant names, in the order they are cut.
BRANCH_TOKENS = (
    "강남점",
    "역삼점",
    "선릉점",
    "코엑스점",
    "월계점",
    "서울역점",
    "명동점",
    "성수점",
    "광화문점",
)

# The characters a Unicode-aware strip removes from both ends.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def normalize_merchant(col: Column, tokens: tuple[str, ...] = BRANCH_TOKENS) -> Column:
    """Delete every occurrence of each token, in order, and strip the ends.

    A token without whitespace can only match between the outer blanks, so one
    strip at the end equals a strip after every deletion. Tokens that hold
    whitespace get the strip after each step.
    """
    if any(ch in WHITESPACE for token in tokens for ch in token):
        return reduce(lambda c, t: strip(F.replace(c, F.lit(t), F.lit(""))), tokens, col)
    return strip(reduce(lambda c, t: F.replace(c, F.lit(t), F.lit("")), tokens, col))


def transaction_type(amount: Column) -> Column:
    return F.when(amount > 0, "EXPENSE").otherwise("INCOME")


def category_level(category: Column, level: int, delimiter: str = "-") -> Column:
    """Level 1, 2, ... of a delimited category; NULL where the level is missing."""
    return F.get(F.split(category, delimiter), level - 1)


def day_type(is_weekend: Column) -> Column:
    return F.when(is_weekend, "Weekend").otherwise("Weekday")
