"""Parquet tables: reads, partitioned writes, versions, slices, compaction, lineage cuts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.functions.ranks import interleaved, range_rank

_local_folders: dict[str, str] = {}
_session_folders: dict[str, str] = {}
#: The scratch folder of the run under way, if any.
_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir` of the session.

    Only a local master without that setting gets a temporary folder, removed at exit.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # the workers of local-cluster are other processes
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tillstar-")
        atexit.register(shutil.rmtree, _local_folders[app], ignore_errors=True)
    return _local_folders[app]


def _session_folder(spark: SparkSession) -> str:
    """This session's part of the shared folder, removed when its JVM ends."""
    app = spark.sparkContext.applicationId
    if app not in _session_folders:
        made = f"{shared_folder(spark)}/tillstar/{uuid.uuid4().hex}"
        fs, folder = _path_handle(spark, made)
        fs.mkdirs(folder)
        fs.deleteOnExit(folder)
        _session_folders[app] = made
    return _session_folders[app]


#: Spark's setting to delete the shuffle files of a query when it ends, not when the driver's collector finds them unused.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs inside leave no shuffle files behind, so that a run of many writes holds the disk of one at a time.

    A frame that runs twice makes its shuffles again in any case, as each run is planned anew.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


@contextmanager
def run_scratch(spark: SparkSession) -> Iterator[str]:
    """What is materialised inside belongs to this run, and is removed when it ends, also when it fails.

    Frames that a run hands on must read published tables.
    """
    made = f"{_run_folder.get() or _session_folder(spark)}/{uuid.uuid4().hex}"
    outer = _run_folder.set(made)
    try:
        with dropping_shuffles(spark):
            yield made
    finally:
        _run_folder.reset(outer)
        fs, folder = _path_handle(spark, made)
        fs.delete(folder, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{_run_folder.get() or _session_folder(spark)}/{uuid.uuid4().hex}/{label}"


def materialize(
    df: DataFrame,
    label: str = "stage",
    partitions: tuple[str, ...] = (),
    over: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts lineage, survives lost executors.

    With `partitions` it is laid out as a table of them is, and its rows can go into one without a further shuffle.
    """
    path = scratch_path(df.sparkSession, label)
    write_table(df, path, partitions, over=over)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def _path_handle(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to `path` has finished."""
    fs, folder = _path_handle(spark, f"{path}/_SUCCESS")
    return fs.exists(folder)


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of a few rows that the plan itself holds: no job and no Python worker makes it."""
    names = [part.strip().split(" ")[0] for part in schema.split(",")]
    columns = [pa.array([r[i] for r in rows]) for i in range(len(names))]
    return spark.createDataFrame(pa.table(columns, names=names), schema) if rows else spark.createDataFrame([], schema)


def stamp(spark: SparkSession, path: str) -> tuple:
    """Name, size and time of the files of a table: it changes when the table does."""
    fs, folder = _path_handle(spark, path)
    if not fs.exists(folder):
        return ()
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(folder)))


def read_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def with_lineage(df: DataFrame) -> DataFrame:
    """Ingestion time and source file. Apply it directly to the scan."""
    return df.withColumns(
        {"ingestion_timestamp": F.current_timestamp(), "source_file": F.col("_metadata.file_path")}
    )


def with_year_month(df: DataFrame, date_col: str = "transaction_date") -> DataFrame:
    return df.withColumns({"year": F.year(date_col), "month": F.month(date_col)})


def write_table(
    df: DataFrame,
    path: str,
    partitions: tuple[str, ...] = (),
    mode: str = "overwrite",
    codec: str | None = None,
    clustered: bool = False,
    publish: bool = True,
    over: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Full (`overwrite`) or additive (`append`) write, partitioned by columns.

    The rebalance hint gathers each partition value into few files and lets
    adaptive execution split a value that holds much of the data, so neither a
    file per task and month nor one task for a hot month arises. Rows that come
    `clustered`, straight from a scan with the same partitions, skip its shuffle.
    Without `publish`, the folder isn't marked as complete. `over` is put on
    the rows last, right before they are written, such as a watch.
    """
    if partitions and not clustered:
        df = df.hint("rebalance", *partitions)
    df = over(df) if over else df
    writer = df.write.mode(mode)
    if not publish:
        writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "static")
    if codec:
        writer = writer.option("compression", codec)
    if partitions:
        writer = writer.partitionBy(*partitions)
    with dropping_shuffles(df.sparkSession):
        writer.parquet(path)


def export(df: DataFrame, path: str, codec: str = "snappy") -> None:
    """Columnar export with a chosen codec (`snappy`, `uncompressed`, `zstd`, ...)."""
    write_table(df, path, codec=codec)


def copy_table(spark: SparkSession, source: str, target: str) -> None:
    """Read everything, write everything: the input/output floor of any job on the table."""
    write_table(read_table(spark, source), target)


def read_floor(df: DataFrame) -> None:
    """Read every column and keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


# --- versions ---------------------------------------------------------------------------------
#
# Version N of a table is whole, in `version=N`, or it is a list of slices in `_slices/version=N`: the folder of every partition,
# in its own `version=N` where it was written anew, else in that of an earlier version. Either becomes visible by its success
# file alone, and nothing that is visible ever changes.


def _listing(base: str, version: int) -> str:
    return f"{base}/_slices/version={version}"


def finished_folders(spark: SparkSession, base: str, prefix: str) -> list[str]:
    """Names of the complete folders under `base` that begin so."""
    fs, path = _path_handle(spark, base)
    if not fs.exists(path):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(path))
    return [n for n in names if n.startswith(prefix) and is_complete(spark, f"{base}/{n}")]


def versions(spark: SparkSession, base: str) -> list[int]:
    """Finished versions under `base`, oldest first."""
    names = [n for folder in (base, f"{base}/_slices") for n in finished_folders(spark, folder, "version=")]
    return sorted({int(n.split("=", 1)[1]) for n in names})


def next_version(spark: SparkSession, base: str) -> int:
    return max(versions(spark, base), default=0) + 1


def write_version(
    df: DataFrame,
    base: str,
    partitions: tuple[str, ...] = (),
    clustered: bool = False,
    publish: bool = True,
    over: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Write `df` as the next immutable version; `df` may read any earlier one.

    Without `publish` it stays invisible until `publish_version`.
    """
    version = next_version(df.sparkSession, base)
    write_table(df, f"{base}/version={version}", partitions, clustered=clustered, publish=publish, over=over)
    return version


def publish_table(spark: SparkSession, path: str) -> None:
    """Mark a folder as complete that was written without its success file."""
    fs, marker = _path_handle(spark, f"{path}/_SUCCESS")
    fs.create(marker, True).close()


def publish_version(spark: SparkSession, base: str, version: int) -> None:
    """Make a whole version visible that was written without its success file."""
    publish_table(spark, f"{base}/version={version}")


def slice_folder(place: dict[str, int | None]) -> str:
    """The folder of a partition of whole numbers, such as a year and month."""
    return "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else int(v)}" for c, v in place.items())


def _written_slices(spark: SparkSession, path: str, partitions: tuple[str, ...]) -> list[str]:
    """The partition folders below `path`."""
    fs, pattern = _path_handle(spark, "/".join([path, *[f"{c}=*" for c in partitions]]))
    found = [str(s.getPath()) for s in fs.globStatus(pattern) or []]
    return ["/".join(f.split("/")[-len(partitions) :]) for f in found]


def slices_of(spark: SparkSession, base: str, version: int, partitions: tuple[str, ...]) -> dict[str, int]:
    """For each partition folder of a version, the version that wrote it. One entry per partition, as in any file listing."""
    if not is_complete(spark, _listing(base, version)):
        return {name: version for name in _written_slices(spark, f"{base}/version={version}", partitions)}
    return {r["folder"]: r["written"] for r in read_table(spark, _listing(base, version)).collect()}


def write_slices(
    df: DataFrame,
    base: str,
    partitions: tuple[str, ...],
    clustered: bool = False,
    over: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Write the partitions of `df` in the folder of the next version, which stays invisible until `publish_slices`.

    A folder that a write left behind when it died is written over by the next attempt.
    """
    version = next_version(df.sparkSession, base)
    write_table(df, f"{base}/version={version}", partitions, clustered=clustered, publish=False, over=over)
    return version


def publish_slices(spark: SparkSession, base: str, version: int, partitions: tuple[str, ...], touched: set[tuple]) -> None:
    """Make a version visible: the partitions `touched` as `write_slices` wrote them, all others as the version before has them.

    A touched partition that was not written is not in the new version.
    """
    replaced = {slice_folder(dict(zip(partitions, place))) for place in touched}
    kept = {name: v for name, v in slices_of(spark, base, version - 1, partitions).items() if name not in replaced}
    kept.update((name, version) for name in _written_slices(spark, f"{base}/version={version}", partitions))
    listing = small_table(spark, sorted(kept.items()), "folder string, written int")
    listing.coalesce(1).write.mode("overwrite").parquet(_listing(base, version))


def read_snapshot(spark: SparkSession, base: str, version: int | None = None) -> DataFrame | None:
    """A given version, or the newest finished one (None when there is none)."""
    known = versions(spark, base)
    if version is None:
        if not known:
            return None
        version = known[-1]
    elif version not in known:
        raise ValueError(f"{base} has no version {version}")
    if not is_complete(spark, _listing(base, version)):
        return read_table(spark, f"{base}/version={version}")
    held = read_table(spark, _listing(base, version)).collect()
    if not held:
        return read_snapshot(spark, base, known[0]).filter("false")
    folders = [f"{base}/version={r['written']}/{r['folder']}" for r in held]
    return spark.read.option("basePath", base).parquet(*folders).drop("version")


# --- slices and layout ------------------------------------------------------------------------


def replace_slices(df: DataFrame, path: str, partitions: tuple[str, ...], clustered: bool = False) -> None:
    """Replace exactly the partitions that occur in `df`; all others stay.

    `df` must not read `path` (stage it with `materialize`). A partition that
    should become empty does not occur in `df` and is left to `remove_slice`.
    Columns take the types the table has. `clustered` is as for `write_table`.
    """
    stored = read_table(df.sparkSession, path).schema
    df = df.select(*[F.col(f.name).cast(f.dataType) for f in stored.fields])
    df = df if clustered else df.hint("rebalance", *partitions)
    with dropping_shuffles(df.sparkSession):
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def remove_slice(spark: SparkSession, path: str, place: dict[str, int | None]) -> None:
    """Remove one partition of whole numbers, such as a year and month, whose rows have all moved."""
    fs, folder = _path_handle(spark, f"{path}/{slice_folder(place)}")
    fs.delete(folder, True)
    spark.catalog.refreshByPath(path)


def within_slices(df: DataFrame, partitions: tuple[str, ...], places: set[tuple]) -> DataFrame:
    """The rows of the given partitions. As literals the values prune folders, so that the others are not read."""
    if not places:
        return df.limit(0)

    def here(place: tuple):
        return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(partitions, place)])

    return df.filter(reduce(lambda a, b: a | b, [here(place) for place in sorted(places, key=repr)]))


FILE_BYTES = 256 << 20


def rebuild_slice(source: DataFrame, transform, path: str, period, partitions=("year", "month")) -> None:
    """Run `transform` on one period of `source` and replace that period's partitions, in one job."""
    replace_slices(transform(source.filter(period)), path, partitions)


#: Bytes of rows, as a task holds them to sort them, that one range of `compact` and `zorder` may have. Compressed
#: files unpack to many times their size, so FILE_BYTES of them alone could fill a task's memory.
TASK_BYTES = 512 << 20

_FIXED = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType,
          T.TimestampType, T.TimestampNTZType)


def _files_for(spark: SparkSession, source: str) -> int:
    """So many files that each has about FILE_BYTES of what is read."""
    fs, path = _path_handle(spark, source)
    return max(1, -(-fs.getContentSummary(path).getLength() // FILE_BYTES))


def _row_bytes(field: T.StructField) -> Column:
    """Bytes a value takes beside its fixed 8 in a row as Spark sorts it: its text or bytes, rounded up to 8."""
    kind = field.dataType
    if isinstance(kind, _FIXED) or (isinstance(kind, T.DecimalType) and kind.precision <= 18):
        return F.lit(0)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(F.col(f"`{field.name}`"))
    else:
        size = F.lit(kind.defaultSize)
    return F.coalesce(F.ceil(size / 8) * 8, F.lit(0))


def _ranges_for(spark: SparkSession, source: str, df: DataFrame, files: int | None) -> int:
    """The files asked for, or those of FILE_BYTES, but at least so many that no range holds over TASK_BYTES in memory.

    A row costs 8 bytes a column, its null bits, its texts and about 40 bytes of the sorter's own.
    """
    fields = df.schema.fields
    fixed = 8 * len(fields) + 8 * -(-len(fields) // 64) + 40
    held = df.select(F.sum(reduce(lambda a, b: a + b, [_row_bytes(f) for f in fields], F.lit(fixed)))).first()[0] or 0
    return max(files or _files_for(spark, source), -(-held // TASK_BYTES), 1)


def compact(spark: SparkSession, source: str, target: str, keys: tuple[str, ...], files: int | None = None) -> None:
    """Rewrite a table into `files` files of about equal size, each a range of the keys, or more if a range would
    hold over TASK_BYTES in memory: one task sorts each range, so that its memory stays bounded whatever the table.

    Parquet row-group minima and maxima then let scans skip files. The row's
    hash comes last in the range order, so a key value that holds much of the
    table fills several files instead of one.
    """
    df = read_table(spark, source)
    (
        df.repartitionByRange(_ranges_for(spark, source, df, files), *keys, F.xxhash64(*df.columns))
        .sortWithinPartitions(*keys)
        .write.mode("overwrite")
        .parquet(target)
    )


def zorder(
    spark: SparkSession, source: str, target: str, keys: tuple[str, ...], files: int | None = None, bits: int = 8
) -> None:
    """Rewrite a table so that filters on any of several keys skip files.

    Each key's value is replaced by its rank among 2^bits ranges of about equal numbers of rows, and the ranks' bits are
    interleaved: rows that are close in all keys are close in that order. Linear order serves its first key alone. As in
    `compact`, the row's hash splits a place that holds much of the table.
    """
    df = read_table(spark, source)
    z = interleaved([range_rank(df, key, bits) for key in keys], bits)
    (
        df.withColumn("_z", z)
        .repartitionByRange(_ranges_for(spark, source, df, files), "_z", F.xxhash64(*df.columns))
        .sortWithinPartitions("_z", *keys)
        .drop("_z")
        .write.mode("overwrite")
        .parquet(target)
    )
