"""The layers the registered queries stand on, each written once per session and input folder."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tillstar.plans.dimensions import dim_card, dim_category, dim_date_covering, dim_merchant
from tillstar.plans.fact import fact_transactions
from tillstar.plans.layers import build_bronze, build_silver
from tillstar.plans.reports import Star
from tillstar.sources.card_feed import card_feed
from tillstar.sources.tables import is_complete, read_table, scratch_path, stamp, write_table

FIRST_LOAD = date(1995, 1, 1)
MONTHS = ("year", "month")
#: Tables that the feed is derived from.
INPUTS = ("lineitem", "orders", "customer", "supplier", "nation", "region")

_known: dict[tuple[str, str], Prepared] = {}


class Prepared:
    """Raw feed, silver, dimensions and fact of one input folder, built on first use.

    As in any layered warehouse, the layers are tables in the shared folder;
    what reads them scans the whole table again. A table that was removed is
    built anew, and so are all when an input's files have changed.
    """

    def __init__(self, spark: SparkSession, folder: str, inputs: tuple = ()):
        self.spark = spark
        self.folder = folder
        self.inputs = inputs
        self._paths: dict[str, str] = {}
        self._frames: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> Prepared:
        key = (spark.sparkContext.applicationId, folder)
        inputs = tuple(stamp(spark, f"{folder}/{name}.parquet") for name in INPUTS)
        if key not in _known or _known[key].spark is not spark or _known[key].inputs != inputs:
            _known[key] = cls(spark, folder, inputs)
        return _known[key]

    def path(self, name: str) -> str:
        path = self._paths.get(name)
        if path is None or not is_complete(self.spark, path):
            path = scratch_path(self.spark, name)
            partitions = MONTHS if name in ("bronze", "silver", "fact_transactions") else ()
            write_table(self._build(name), path, partitions)
            self._paths[name] = path
            self._frames[name] = read_table(self.spark, path)
        return path

    def table(self, name: str) -> DataFrame:
        self.path(name)
        return self._frames[name]

    def _build(self, name: str) -> DataFrame:
        if name == "raw":
            return card_feed(self.spark, self.folder)
        if name == "bronze":
            return build_bronze(self.raw)
        if name == "silver":
            return build_silver(self.raw, processed_at="created_at")
        if name == "dim_date":
            return dim_date_covering(self.silver)
        if name == "dim_category":
            return dim_category(self.silver)
        if name == "dim_merchant":
            return dim_merchant(self.silver, FIRST_LOAD)
        if name == "dim_card":
            return dim_card(self.silver)
        if name == "fact_transactions":
            return fact_transactions(self.silver, self.dims)
        raise KeyError(name)

    @property
    def raw(self) -> DataFrame:
        return self.table("raw")

    @property
    def silver(self) -> DataFrame:
        return self.table("silver")

    @property
    def dims(self) -> dict[str, DataFrame]:
        return {n: self.table(n) for n in ("dim_date", "dim_category", "dim_merchant", "dim_card")}

    @property
    def tables(self) -> dict[str, DataFrame]:
        return {**self.dims, "fact_transactions": self.table("fact_transactions")}

    @property
    def star(self) -> Star:
        return Star.of(self.tables)
