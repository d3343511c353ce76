"""A training-data pipeline over `documents`: each stage is written as Parquet and read back as the next one's input.

Defined results: an empty table gives no rows; a null text is empty and packed as its end token; rows without a doc_id or source
pass through like others; rows that share a doc_id are judged, and lose passages, by their own texts; columns that `documents`
has beyond those named are kept up to the packing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillstar.llm import mixing, near_duplicates, packing, quality, substring_dedup
from tillstar.llm.common import staged, table
from tillstar.llm.queries import tokenizer_path

NEAR_PERCENT = 80


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model doesn't reject."""
    judged = quality.classify(docs, table(spark, sf_dir, "labels"))
    return judged.filter(~judged["rejected"]).select("row.*")


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates, and one row of it."""
    return near_duplicates.first_of_each(docs, NEAR_PERCENT)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one holds."""
    return substring_dedup.remove_passages(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources uses them, each at least once."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 2048 tokens."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_good),
    ("near-duplicate removal", keep_one),
    ("passage removal", cut_passages),
    ("source mixing", mix_sources),
    ("packing", pack),
]

#: The stages learn models and walk sequences, which SQL can't express. The tests hold near duplicates, passages, mixing and the
#: packing's subset sums against brute-force versions, the classifier against held-out labels, and the whole against its rules.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
