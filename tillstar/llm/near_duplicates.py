"""Near duplicates by MinHash and a multi-index Hamming join.

Texts with equal shingle sets are one node with a number of its own, as several
texts may share a doc_id; its first row is the one of least doc_id and text
hash. A node has a signature of `SYMBOLS` minimum hashes of `BITS` bits. Two signatures that
differ in at most r symbols must, when cut into m = r // 2 + 1 chunks, agree in
some chunk but for one symbol; so each chunk is looked up once for each of its
symbols left out, which finds all pairs within distance r. r lies `SIGMAS`
standard deviations above the distance expected at the threshold. Every link is
confirmed on the full sets.

Only components are asked for, so a bucket never gives all its pairs. First
each node meets the least node of its buckets. Nodes that this leaves in
different components meet within their buckets: in small ones as filtered
pairs; large ones are cut into blocks, each pair of blocks is one task that
carries the full sets and returns the links that join what is still apart.
Within a task a pair is looked at only in the first chunk it agrees in.

Defined results: a null or empty text has no shingles and is linked with
nothing; a text of fewer words than a shingle has its whole sequence as one;
repeated rows are one node and each row is returned; rows that share a doc_id
are judged by their own texts; a null doc_id is linked with nothing and not kept as another's representative; other columns are not
read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import TEXTS, hashes_of, mapped, mix, shingle_hashes, signed, staged, strings, words_of
from tillstar.llm.components import components

SHINGLE = 5
SYMBOLS = 64
BITS = 16
SIGMAS = 4.7
SMALL_BUCKET = 32
BLOCK_ROWS = 4096
BLOCK_BYTES = 32 << 20
#: Nodes whose ids, signatures and set keys (about 250 bytes each) are broadcast: 64 MB at most.
SMALL_IDS = 250_000

_seeds = mix(np.arange(1, SYMBOLS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def shingles(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text."""
    return np.unique(shingle_hashes(hashes_of(words_of(text)), k))


def signature(values: np.ndarray) -> np.ndarray:
    """`SYMBOLS` minimum hashes, `BITS` bits of each."""
    least = np.array([(values * s).min() for s in _seeds], dtype=np.uint64)
    return (mix(least) & np.uint64((1 << BITS) - 1)).astype(np.uint16)


def radius(percent: int) -> int:
    """The signature distance that all but a vanishing share of pairs at the threshold keep."""
    p = 1 - percent / 100
    return min(SYMBOLS, math.ceil(SYMBOLS * p + SIGMAS * math.sqrt(SYMBOLS * p * (1 - p))))


def chunks(r: int) -> list[np.ndarray]:
    """So many chunks that two signatures within r differ in at most one symbol of some chunk."""
    return np.array_split(np.arange(SYMBOLS), min(SYMBOLS, r // 2 + 1))


def bucket_keys(signatures: np.ndarray, r: int) -> np.ndarray:
    """A key for each symbol: of its chunk without it."""
    out = np.empty(signatures.shape, dtype=np.uint64)
    wide = signatures.astype(np.uint64)
    for chunk in chunks(r):
        for symbol in chunk:
            key = np.full(len(signatures), mix(np.array([symbol + 1], dtype=np.uint64))[0])
            for other in chunk:
                if other != symbol:
                    key = mix(key ^ wide[:, other]) + np.uint64(other)
            out[:, symbol] = mix(key)
    return out


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, h, text: h tells apart the texts of one doc_id."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))


def _prints(docs: DataFrame, k: int) -> DataFrame:
    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, keys, signs = [], [], []
        for text in strings(batch.column("text")):
            values = shingles(text, k)
            n.append(len(values))
            keys.append(hashlib.md5(values.tobytes()).digest() if len(values) else None)
            signs.append(signature(values).tobytes() if len(values) else None)
        cols = [batch.column("doc_id"), batch.column("h"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(signs, pa.binary())]
        return pa.RecordBatch.from_arrays(cols, ["doc_id", "h", "n_shingles", "set_key", "signature"])

    return mapped(_texts(docs), of, "doc_id long, h long, n_shingles long, set_key binary, signature binary", TEXTS)


def _sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """node, signature, values (sorted hashes as bytes) of the nodes in `ids` (node, doc_id, h, set_key, signature), from their first rows."""
    n = ids.count()
    chosen = _texts(docs).join(F.broadcast(ids) if n <= SMALL_IDS else ids, ["doc_id", "h"])

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, keys, sets = [], batch.column("set_key").to_pylist(), []
        for i, text in enumerate(strings(batch.column("text"))):
            values = shingles(text, k)
            if hashlib.md5(values.tobytes()).digest() == keys[i]:
                found.append(i)
                sets.append(values.tobytes())
        ids, signs = (batch.column(c).take(pa.array(found, pa.int64())) for c in ("node", "signature"))
        return pa.RecordBatch.from_arrays([ids, signs, pa.array(sets, pa.binary())], ["node", "signature", "values"])

    return mapped(chosen, of, "node long, signature binary, values binary", TEXTS).dropDuplicates(["node"])


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = overlap(a, b)
    return 100 * common >= percent * (len(a) + len(b) - common)


def _near(pairs: DataFrame, nodes: DataFrame, percent: int, r: int) -> DataFrame:
    """Of distinct pairs (a, b), those whose sizes and signatures allow a link."""
    one = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("signature").alias("s_a"))
    other = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("signature").alias("s_b"))
    sized = pairs.join(one, "a").join(other, "b").filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))

    def close(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(-1, SYMBOLS) for c in ("s_a", "s_b"))
        keep = pa.array(np.flatnonzero((a != b).sum(axis=1) <= r))
        return pa.RecordBatch.from_arrays([batch.column("a").take(keep), batch.column("b").take(keep)], ["a", "b"])

    return mapped(sized, close, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    one, other = (sets.select(F.col("node").alias(c), F.col("values").alias(f"v_{c}")) for c in ("a", "b"))

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b = ([np.frombuffer(x, dtype=np.uint64) for x in batch.column(c).to_pylist()] for c in ("v_a", "v_b"))
        keep = pa.array([i for i, (x, y) in enumerate(zip(a, b)) if linked(x, y, percent)], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("a").take(keep), batch.column("b").take(keep)], ["a", "b"])

    return mapped(pairs.join(one, "a").join(other, "b"), check, "a long, b long")


def _find(parent: dict, x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def block_links(table: pa.Table, percent: int, r: int) -> list[tuple[int, int]]:
    """Links between the nodes of one or two blocks of a bucket that join what is apart."""
    nodes, parts = table.column("node").to_numpy(), table.column("part").to_numpy()
    groups = table.column("component").to_pylist()
    signs = np.frombuffer(b"".join(table.column("signature").to_pylist()), dtype=np.uint16).reshape(-1, SYMBOLS)
    sets = [np.frombuffer(x, dtype=np.uint64) for x in table.column("values").to_pylist()]
    sizes = np.array([len(x) for x in sets])
    symbol, cuts = table.column("symbol")[0].as_py(), chunks(r)
    mine = next(i for i, c in enumerate(cuts) if symbol in c)
    place = symbol - cuts[mine][0]
    crossing = table.column("i")[0].as_py() != table.column("j")[0].as_py()
    candidates = []
    for x in range(len(nodes) - 1):
        differs = signs[x + 1 :] != signs[x]
        distance = differs.sum(axis=1)
        small, great = np.minimum(sizes[x + 1 :], sizes[x]), np.maximum(sizes[x + 1 :], sizes[x])
        inside = differs[:, cuts[mine]]
        # a pair belongs to its first chunk with at most one difference, there to the symbol that differs, or else to the first
        odd = inside.sum(axis=1)
        ok = (distance <= r) & (100 * small >= percent * great) & (((odd == 1) & inside[:, place]) | ((odd == 0) & (place == 0)))
        for c in cuts[:mine]:
            ok &= differs[:, c].sum(axis=1) > 1
        if crossing:
            ok &= parts[x + 1 :] != parts[x]
        at = np.flatnonzero(ok)
        candidates += zip(distance[at].tolist(), [x] * len(at), (at + x + 1).tolist())
    parent = {g: g for g in groups}
    found = []
    for _, x, y in sorted(candidates):
        one, other = _find(parent, groups[x]), _find(parent, groups[y])
        if one != other and linked(sets[x], sets[y], percent):
            parent[one] = other
            found.append((int(nodes[x]), int(nodes[y])))
    return found


def links(docs: DataFrame, nodes: DataFrame, percent: int, k: int) -> DataFrame:
    """Links (a, b) between nodes (node, n, signature, set_key) that connect every pair of linked nodes."""
    r = radius(percent)

    def spread(batch: pa.RecordBatch) -> pa.RecordBatch:
        signs = np.frombuffer(b"".join(batch.column("signature").to_pylist()), dtype=np.uint16).reshape(-1, SYMBOLS)
        keys = bucket_keys(signs, r)
        cols = [
            pa.array(signed(keys.ravel())),
            pa.array(np.repeat(batch.column("node").to_numpy(), SYMBOLS)),
            pa.array(np.tile(np.arange(SYMBOLS, dtype=np.int32), len(signs))),
        ]
        return pa.RecordBatch.from_arrays(cols, ["bucket", "node", "symbol"])

    keys = mapped(nodes.select("node", "signature"), spread, "bucket long, node long, symbol int")
    shared = keys.groupBy("bucket").agg(F.min("node").alias("lead"), F.count("*").alias("size")).filter("size > 1")
    members = staged(keys.join(staged(shared, "shared"), "bucket"), "members")

    stars = members.filter("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    stars = staged(_near(stars, nodes, percent, r), "stars")
    active = members.select("node").distinct().join(nodes.select("node", "doc_id", "h", "set_key", "signature"), "node")
    sets = staged(_sets(docs, active, k), "sets")
    first = staged(_confirmed(stars, sets, percent), "first")

    groups = staged(components(first), "groups")
    known = nodes.select("node", "n").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    grouped = members.join(known, "node")
    apart = grouped.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("bucket")
    left = staged(grouped.join(apart, "bucket"), "left")

    gathered = left.filter(F.col("size") <= SMALL_BUCKET).groupBy("bucket")
    gathered = gathered.agg(F.collect_list(F.struct("node", "component", "n")).alias("all"))  # at most SMALL_BUCKET

    def pair(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: set[tuple[int, int]] = set()
        for members in batch.column("all").to_pylist():
            members = sorted((m["node"], m["component"], m["n"]) for m in members)
            for i, (a, own, n) in enumerate(members):
                found.update((a, b) for b, other, m in members[i + 1 :] if own != other and 100 * min(n, m) >= percent * max(n, m))
        a, b = zip(*found) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    pairs = mapped(gathered.select("all"), pair, "a long, b long").distinct().join(stars, ["a", "b"], "left_anti")
    second = _confirmed(_near(pairs, nodes, percent, r), sets, percent)

    large = left.filter(F.col("size") > SMALL_BUCKET)
    parts = large.groupBy("bucket").agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(8 * F.sum("n") / BLOCK_BYTES)).cast("int").alias("blocks"))
    large = large.join(parts, "bucket").withColumn("part", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("part", o).alias("i"), F.greatest("part", o).alias("j")))
    large = large.select("bucket", "node", "component", "symbol", "part", F.explode(others).alias("pair"))
    large = large.select("bucket", "node", "component", "symbol", "part", "pair.i", "pair.j")
    large = large.join(sets, "node")

    def block(table: pa.Table) -> pa.Table:
        a, b = zip(*found) if (found := block_links(table, percent, r)) else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    third = large.groupBy("bucket", "i", "j").applyInArrow(block, "a long, b long")
    return first.unionAll(second).unionAll(third)


def _judged(docs: DataFrame, percent: int, k: int) -> DataFrame:
    """doc_id, h, n_shingles, first (doc_id, h of its component's first row) of every row; `first` is null for what is linked with nothing."""
    prints = staged(_prints(docs, k), "prints")
    full = prints.filter(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
    nodes = full.groupBy("set_key").agg(F.min(F.struct("doc_id", "h")).alias("least"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature"))
    nodes = nodes.select(F.monotonically_increasing_id().alias("node"), "set_key", "least.doc_id", "least.h", "n", "signature")
    nodes = staged(nodes, "nodes")
    joined = components(links(docs, nodes, percent, k))
    named = nodes.select("set_key", "node", F.struct("doc_id", "h").alias("least")).join(joined, "node", "left")
    named = staged(named.select("set_key", "least", F.coalesce("component", "node").alias("component")), "named")
    first = named.groupBy("component").agg(F.min("least").alias("first"))
    named = named.select("set_key", "component").join(first, "component").select("set_key", "first")
    out = prints.join(named, "set_key", "left")
    return out.select("doc_id", "h", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("first")).alias("first"))


def near_duplicates(docs: DataFrame, percent: int = 85, k: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    out = _judged(docs, percent, k).select("doc_id", "n_shingles", F.coalesce("first.doc_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def first_of_each(docs: DataFrame, percent: int = 80, k: int = SHINGLE) -> DataFrame:
    """The rows of `docs` that stay when each component keeps its first row; rows that repeat a doc_id with its text are kept once.

    Rows without a doc_id stay. The rows that go are broadcast only while they are few.
    """
    judged = _judged(docs, percent, k).filter(F.col("first").isNotNull())
    key = ["_id", "_h"]
    gone = judged.filter(F.struct("doc_id", "h") != F.col("first")).select(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).distinct()
    gone = staged(gone, "gone")
    n = gone.count()
    keyed = docs.withColumns({"_id": F.col("doc_id").cast("long"), "_h": F.xxhash64(F.col("text").cast("string"))})
    rows = keyed.join(F.broadcast(gone) if n <= SMALL_IDS else gone, key, "left_anti").select(*keyed.columns)
    again = rows.groupBy(*key).count().filter((F.col("count") > 1) & F.col("_id").isNotNull()).select(*key)
    again = staged(again, "again")
    if again.isEmpty():
        return rows.select(*docs.columns)
    once = rows.join(again, key, "left_anti").select(*docs.columns)
    return once.unionByName(rows.join(again, key, "left_semi").select(*keyed.columns).dropDuplicates(key).select(*docs.columns))
