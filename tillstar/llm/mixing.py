"""Mixing sources by temperature: tempered token shares, realised as budgeted block permutations.

A source's share of all tokens is raised to an exponent from 0 (all alike) to 1
(as found). Bisection takes the exponent at which the entropy of the weights
meets its target, or a larger one that keeps every source within the limit of
epochs. Without a budget, the mix is the smallest that uses every document at
least once. Each source runs through whole epochs, and through blocks of its
last epoch until its budget is met; each epoch deals the documents into blocks
by a hash and orders them in a block by another. A document knows its block and
order by itself, so the cut is a block number and a hash for each source, and
no text moves.

Defined results: null sources are one source of their own; null or empty texts
have no tokens and run in every whole epoch; repeated rows are dealt alike; a
table without tokens is returned as it is; other columns are kept as they are,
whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import staged

ENTROPY_SHARE = 0.9
MAX_EPOCHS = 4.0
BLOCK_DOCS = 1000
SMALL_TABLE = 100_000


def n_tokens(text: str | Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def weights(shares: list[float], exponent: float) -> list[float]:
    tempered = [p**exponent for p in shares]
    return [x / sum(tempered) for x in tempered]


def entropy(values: list[float]) -> float:
    return -sum(x * math.log(x) for x in values if x > 0)


def epochs(shares: list[float], w: list[float], budget_share: float | None) -> float:
    """The most epochs of any source; the budget is a share of all tokens, or what gives every source one epoch."""
    ratio = [a / b for a, b in zip(w, shares)]
    return max(ratio) * (budget_share if budget_share is not None else 1 / min(ratio))


def bisect_exponent(shares: list[float], target: float, max_epochs: float, budget_share: float | None = None) -> float:
    """The least exponent in [0, 1] at which entropy is at most the target and no source has more epochs than the limit."""

    def least(meets) -> float:
        if meets(0.0):
            return 0.0
        low, high = 0.0, 1.0
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (low, middle) if meets(middle) else (middle, high)
        return high

    by_entropy = least(lambda a: entropy(weights(shares, a)) <= target)
    return max(by_entropy, least(lambda a: epochs(shares, weights(shares, a), budget_share) <= max_epochs))


def plan(docs: DataFrame, entropy_share: float, max_epochs: float, budget: int | None):
    """Per source: tokens, documents, budget and whole epochs. Sources are counted over all rows; there is one row for each."""
    sums = docs.groupBy(F.col("_source")).agg(F.sum("_tokens").alias("tokens"), F.count("*").alias("docs"))
    sums = staged(sums, "sources")
    total = sums.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        return sums, None
    # shares that are equal weigh alike: distinct token sums with their number are all that the exponent depends on
    kinds = [(r["tokens"], r["count"]) for r in sums.filter("tokens > 0").groupBy("tokens").count().collect()]
    shares = [t / total for t, n in kinds for _ in range(n)]
    exponent = bisect_exponent(shares, entropy_share * math.log(len(shares)), max_epochs, budget / total if budget else None)
    norm = sum(p**exponent for p in shares)
    whole = float(budget) if budget else max(t / ((t / total) ** exponent / norm) for t, _ in kinds)
    share = F.pow(F.col("tokens") / F.lit(float(total)), F.lit(exponent)) / F.lit(norm)
    own = F.when(F.col("tokens") > 0, share * F.lit(whole)).otherwise(0.0)
    full = F.when(F.col("tokens") > 0, F.floor(own / F.col("tokens") + F.lit(1e-9))).otherwise(1).cast("long")
    sums = sums.select("*", own.alias("budget"), full.alias("full"), F.ceil(F.col("docs") / F.lit(BLOCK_DOCS)).cast("long").alias("blocks"))
    return sums, exponent


def _block(epoch: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), epoch, "_key"), F.col("blocks"))


def _order(epoch: Column) -> Column:
    return F.xxhash64(F.lit("order"), epoch, "_key")


def _with_source(docs: DataFrame, sources: DataFrame, n_sources: int) -> DataFrame:
    side = sources.withColumnRenamed("_source", "_name")
    side = F.broadcast(side) if n_sources <= SMALL_TABLE else side
    return docs.join(side, docs["_source"].eqNullSafe(side["_name"]) if n_sources <= SMALL_TABLE else docs["_source"] == side["_name"]).drop("_name")


def mix(
    docs: DataFrame,
    entropy_share: float = ENTROPY_SHARE,
    max_epochs: float = MAX_EPOCHS,
    budget: int | None = None,
    places: bool = False,
) -> DataFrame:
    """The rows of `docs` as often as the mix uses them.

    `places` adds epoch, block, tokens and mix_at, the place in the mix from 0 to
    1: in its order, every stretch of the mix holds the sources by their weights.
    """
    columns = ["_row.*"]
    held = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("_row"),
        F.coalesce(F.col("source").cast("string"), F.lit("\x00null")).alias("_source"),
        n_tokens(F.col("text").cast("string")).alias("_tokens"),
        F.xxhash64("doc_id", "text").alias("_key"),
    )
    sources, exponent = plan(held.select("_source", "_tokens"), entropy_share, max_epochs, budget)
    if exponent is None:
        extra = [F.lit(0).alias("epoch"), F.lit(0).cast("long").alias("block"), F.col("_tokens").alias("tokens"), F.lit(0.0).alias("mix_at")]
        return held.select(*columns, *(extra if places else []))
    sources = staged(sources, "plan")
    n_sources = sources.count()
    last = _with_source(held.select("_source", "_tokens", "_key"), sources, n_sources).withColumns(
        {"_block": _block(F.col("full")), "_order": _order(F.col("full"))}
    )
    rest = F.round(F.col("budget") - F.col("full") * F.col("tokens"))
    sums = last.groupBy("_source", "_block").agg(F.sum("_tokens").alias("own"), F.first(rest).alias("rest"))
    before = Window.partitionBy("_source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("start", F.coalesce(F.sum("own").over(before), F.lit(0)))
    at_cut = sums.filter((F.col("start") < F.col("rest")) & (F.col("start") + F.col("own") >= F.col("rest")))
    at_cut = at_cut.select("_source", "_block", "start", "rest")
    inside = last.select("_source", "_block", "_order", "_tokens").join(at_cut, ["_source", "_block"])
    by_order = Window.partitionBy("_source", "_block").orderBy("_order").rangeBetween(Window.unboundedPreceding, -1)
    reached = F.col("start") + F.coalesce(F.sum("_tokens").over(by_order), F.lit(0))
    cuts = inside.withColumn("reached", reached).filter(F.col("reached") < F.col("rest"))
    cuts = cuts.groupBy("_source").agg(F.max("_block").alias("cut_block"), F.max("_order").alias("cut_order"))
    cuts = staged(sources.join(cuts, "_source", "left"), "cuts")

    own = _with_source(held, cuts, n_sources)
    block, order = _block(F.col("full")), _order(F.col("full"))
    more = (block < F.col("cut_block")) | ((block == F.col("cut_block")) & (order <= F.col("cut_order")))
    copies = F.col("full") + F.when(F.coalesce(more, F.lit(False)), 1).otherwise(0)
    own = own.withColumn("_copies", copies.cast("int")).filter("_copies > 0")
    out = own.withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
    if not places:
        return out.select(*columns)
    out = out.withColumns({"_block": _block(F.col("_epoch").cast("long")), "_order": _order(F.col("_epoch").cast("long"))})
    part = Window.partitionBy("_source", "_epoch", "_block").orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    starts = out.groupBy("_source", "_epoch", "_block").agg(F.sum("_tokens").alias("own"))
    run = Window.partitionBy("_source", "_epoch").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("_source", "_epoch", "_block", F.coalesce(F.sum("own").over(run), F.lit(0)).alias("start"))
    placed = out.withColumn("_within", F.coalesce(F.sum("_tokens").over(part), F.lit(0))).join(starts, ["_source", "_epoch", "_block"])
    mix_at = (F.col("_epoch") * F.col("tokens") + F.col("start") + F.col("_within")) / F.col("budget")
    return placed.select(
        *columns,
        F.col("_epoch").alias("epoch"),
        F.col("_block").alias("block"),
        F.col("_tokens").alias("tokens"),
        F.coalesce(mix_at, F.lit(0.0)).alias("mix_at"),
    )
