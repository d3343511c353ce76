"""Streams of raw files, each taken once: into bronze alone, or on through silver to the star schema."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillstar.plans.layers import build_bronze
from tillstar.plans.medallion import merge_rows, run_incremental
from tillstar.sources.tables import is_complete, run_scratch, with_lineage, with_year_month, write_table

MONTHS = ("year", "month")


def ingest_new_files(
    spark: SparkSession, source: str, schema: StructType, bronze: str, checkpoint: str, files_per_batch: int = 10_000
) -> None:
    """Append the files of `source` that earlier calls have not taken, then stop.

    `checkpoint` remembers the files taken and the sink's log makes each batch
    count once, so a call that died can be repeated. Raw files arrive day by
    day, so a task writes few months and no shuffle is needed.
    """
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    (
        with_year_month(with_lineage(raw))
        .writeStream.format("parquet")
        .option("path", bronze)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*MONTHS)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def batch_merger(out: str, name: str, as_of: date | Callable[[], date], history: bool = False) -> Callable[[DataFrame, int], None]:
    """What a stream does with each batch: its rows become a load of bronze, then of silver and the next fact version.

    The load is named after the stream and the batch. A batch that comes again after its load was finished adds nothing and
    only brings the fact up to date; one that died half-way writes the same load again, and the upserts replace what they had
    put in. So a batch may run any number of times.
    """

    def merge(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        load = f"load={name}-{batch}"
        listing = f"{out}/bronze/_files/{load}"
        if not is_complete(spark, listing):
            with run_scratch(spark):
                merge_rows(spark, rows, out, load)
            write_table(spark.read.parquet(f"{out}/bronze/{load}").select("source_file").distinct(), listing)
        run_incremental(spark, out, as_of if isinstance(as_of, date) else as_of(), history=history)

    return merge


def merge_new_files(
    spark: SparkSession,
    source: str,
    schema: StructType,
    out: str,
    checkpoint: str,
    as_of: date | Callable[[], date] = date.today,
    history: bool = False,
    files_per_batch: int = 10_000,
    name: str = "stream",
) -> None:
    """Bring the files of `source` that earlier calls have not taken into bronze, silver, dimensions and fact, then stop.

    Transactions that come again replace their earlier copy, in every layer but bronze. `checkpoint` remembers the files and
    belongs to `name`; a call that died can be repeated.
    """
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    (
        build_bronze(raw)
        .writeStream.foreachBatch(batch_merger(out, name, as_of, history))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
