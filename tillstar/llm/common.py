"""Helpers that the operators share: word bytes and hashes, staged tables, stable seeds."""

from __future__ import annotations

import tempfile
import uuid
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()

#: Rows of whole texts that a worker turns into Python objects at a time.
TEXTS = 1000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_roots: dict[str, str] = {}


def words_of(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` of a text with A-Z in lower case; bytes know no other blanks or capitals."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def hashes_of(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    values = values ^ (values >> np.uint64(32))
    values = values * _MIX
    return values ^ (values >> np.uint64(29))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k words; of the whole sequence where it is shorter; none without words."""
    n = len(words)
    if n == 0:
        return words
    k_here = min(k, n)
    out = np.full(n - k_here + 1, np.uint64(k_here), dtype=np.uint64)
    for i in range(k_here):
        out = mix(out ^ words[i : n - k_here + 1 + i]) + np.uint64(i)
    return mix(out)


def strings(column: pa.Array) -> list:
    return column.to_pylist()


def signed(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return values.view(np.int64)


def crc_of_id(value) -> int:
    return zlib.crc32(str(value).encode())


def mapped(df: DataFrame, function, schema: str, rows: int | None = None) -> DataFrame:
    """Apply a function of one Arrow batch to every batch; it returns a batch, or None for no rows.

    With `rows`, it gets at most so many rows at a time, which bounds what it holds of whole texts.
    """

    def over(batches):
        for batch in batches:
            step = rows or max(1, batch.num_rows)
            for at in range(0, batch.num_rows, step):
                made = function(batch.slice(at, step))
                if made is not None:
                    yield made

    return df.mapInArrow(over, schema)


def scratch_root(spark: SparkSession) -> str:
    """This process's folder below spark.checkpoint.dir, gone when the session's JVM ends.

    Without that setting, a session whose tasks run in this process gets a temporary folder.
    """
    app = spark.sparkContext.applicationId
    if app not in _roots:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            master = spark.sparkContext.master
            if not (master == "local" or master.startswith("local[")):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = "file://" + tempfile.mkdtemp(prefix="tillstar-llm-")
        root = f"{base.rstrip('/')}/tillstar-llm-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _roots[app] = root
    return _roots[app]


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several steps read and read it back; a lost executor costs only its own tasks."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(column):
    """A-Z in lower case, all other letters as they are."""
    return F.translate(column, ASCII_UPPER, ASCII_LOWER)
