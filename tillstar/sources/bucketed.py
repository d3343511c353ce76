"""Bucketed Parquet tables: rows dealt to files by a hash of their key, so that joins on it need not shuffle them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int, dealt: bool = False) -> None:
    """Write `df` in `buckets` buckets of its keys, each sorted by them.

    Rows are dealt to the buckets' tasks first, so that a bucket is one file; rows that are `dealt` by an upsert into as many
    buckets already skip this shuffle.
    """
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    rows = df if dealt else df.repartition(buckets, *keys)
    rows.write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the entry in this session's catalog; the files stay


def read_bucketed(spark: SparkSession, path: str, keys: list[str], buckets: int) -> DataFrame:
    """A table that `write_bucketed` made with these keys and buckets, known as such to the planner."""
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    listed = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({listed}) SORTED BY ({listed}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)
