"""Lempel-Ziv phrase fingerprints.

A text's UTF-8 bytes are parsed into dictionary phrases: each phrase is the
shortest run that is not in the dictionary yet, and joins it. The fingerprint
holds the `size` smallest 32-bit hashes of the phrase set, as hexadecimal
digits; likeness is the share of common hashes among the smallest of both,
which estimates the overlap of the phrase sets and equals it for small ones.

Neighbours by doc_id meet by dealing the texts into ranges of doc_id: the first
text of each range also goes to the range before it, so every text but those is
moved once and no window spans the table.

Defined results: a null or empty text has the empty fingerprint, and two empty
ones have likeness 1; equal texts have equal fingerprints; repeated doc_ids
follow one another by text; rows without a doc_id come before all others, by
text (a doc_id of -2^63 stands for them); a lone document is its own next one; other columns are not
read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import mapped, strings

SIZE = 128
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
BYTES_PER_RANGE = 16 << 20
#: Stands for a missing doc_id.
NO_ID = -(2**63)


def parse(seen: set[bytes], pending: bytes, data: bytes) -> bytes:
    """Add the phrases of `data` to `seen`, going on from an unfinished phrase; returns the one left unfinished."""
    add, begin, n = seen.add, 0, len(pending)
    data = pending + data
    for end in range(n + 1, len(data) + 1):
        phrase = data[begin:end]
        if phrase not in seen:
            add(phrase)
            begin = end
    return data[begin:]


def smallest(phrases: set[bytes], size: int = SIZE) -> str:
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, phrases), dtype=np.uint64, count=len(phrases)) >> np.uint64(32)
    hashes = np.unique(np.partition(hashes, size - 1)[:size] if len(hashes) > size else hashes)
    return hashes.astype(">u4").tobytes().hex()


def likeness(a: str, b: str, size: int = SIZE) -> float:
    if a == b:
        return 1.0
    one, other = ({x[i : i + 8] for i in range(0, len(x), 8)} for x in (a, b))
    both = sorted(one | other)[:size]
    return sum(x in one and x in other for x in both) / len(both)


def fingerprint(text: str | None, size: int = SIZE) -> str:
    seen: set[bytes] = set()
    parse(seen, b"", (text or "").encode("utf-8", "surrogatepass"))
    return smallest(seen, size)


def with_edit(text: str, following: str, size: int = SIZE) -> tuple[str, str, str]:
    """The fingerprints of a text and of its edit, and the edited text; both parses share the part that stays."""
    half = len(text) // 2
    stays, end, put = text[: len(text) - half], text[len(text) - half :], following[:half]
    seen: set[bytes] = set()
    pending = parse(seen, b"", stays.encode("utf-8", "surrogatepass"))
    edited = set(seen)
    parse(seen, pending, end.encode("utf-8", "surrogatepass"))
    parse(edited, pending, put.encode("utf-8", "surrogatepass"))
    return smallest(seen, size), smallest(edited, size), stays + put


def in_ranges(docs: DataFrame) -> DataFrame:
    """doc_id, text, bucket, extra: texts dealt by ranges of doc_id, each range with the text that follows it as an extra row."""
    doc_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID).cast("long")).alias("doc_id")
    rows = docs.select(doc_id, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("double"))).first()[0] or 0.0
    ranges = max(8, int(size // BYTES_PER_RANGE))
    fractions = [i / ranges for i in range(ranges)]
    firsts = rows.agg(F.percentile_approx("doc_id", fractions, 10 * ranges), F.min("doc_id")).first()
    splits = np.unique(np.array([*(firsts[0] or []), *([firsts[1]] if firsts[1] is not None else [])], dtype=np.int64))

    def deal(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column("doc_id").to_numpy()
        bucket = np.searchsorted(splits, ids, side="right") - 1
        edge = np.flatnonzero(splits[bucket] == ids)
        take = pa.array(np.concatenate([np.arange(len(ids)), edge]))
        before = (bucket[edge] - 1) % len(splits)
        extra = np.concatenate([np.zeros(len(ids), dtype=bool), np.ones(len(edge), dtype=bool)])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(take), batch.column("text").take(take), pa.array(np.concatenate([bucket, before])), pa.array(extra)],
            ["doc_id", "text", "bucket", "extra"],
        )

    dealt = mapped(rows, deal, "doc_id long, text string, bucket long, extra boolean")
    # the number of a range is that of its partition
    return dealt.repartitionById(len(splits) or 1, F.col("bucket").cast("int")).sortWithinPartitions("bucket", "extra", "doc_id", "text")


def fingerprint_documents(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """One row per document: its fingerprint, that of its edit, and how like the edit and the next document are."""

    def over(batches):
        held = None  # the row whose next one is awaited: bucket, doc_id, text
        waiting = None  # the finished row that lacks the fingerprint of the one after it
        for batch in batches:
            cols: list[list] = [[], [], [], [], [], [], []]

            def put(row, next_print):
                for column, value in zip(cols, (None if row[0] == NO_ID else row[0], *row[1:], likeness(row[3], next_print, size))):
                    column.append(value)

            for doc_id, text, bucket, extra in zip(*(strings(batch.column(i)) for i in range(4))):
                if held is not None and held[0] == bucket:
                    own, edited, changed = with_edit(held[2], text, size)
                    if waiting is not None:
                        put(waiting, own)
                    digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
                    waiting = (held[1], len(held[2]), digest, own, edited, likeness(own, edited, size))
                if extra:
                    if held is not None and held[0] == bucket and waiting is not None:
                        put(waiting, fingerprint(text, size))
                    held = waiting = None
                else:
                    held = (bucket, doc_id, text)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], [f.split()[0] for f in SCHEMA.split(", ")])

    return in_ranges(docs).mapInArrow(over, SCHEMA)
