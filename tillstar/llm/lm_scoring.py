"""Language-model scoring by prediction by partial matching over bytes.

Training texts (all but the held-out fold) are counted in one pass: words for a
unigram base, and byte contexts of `ORDER` bytes with the byte that follows.
A shorter context counts in how many longer ones its symbol was seen, the
symbols it would have to tell after an escape. A context's symbols are always
among its suffix's; this lets the exclusion sums be held per context. Every
context-symbol pair counts, and the model stays on the executors: pairs whose
contexts agree in their last `NEAR` bytes meet in one run of a partition, which
gives the probability of each distinct code. Only pairs of contexts shorter than
that are broadcast; bytes, not the corpus, bound their number (256^NEAR). Texts
form batches of about `BATCH` bytes, and the probabilities of a batch's distinct
codes come back to its texts by joins.

Escapes follow method C: with T the counts and q the number of symbols not yet
excluded, a symbol has count / (T + q) and the escape q / (T + q). Below the
empty context, the bytes that were never seen share the rest evenly. Byte 0xFF,
which UTF-8 never holds, stands before and after every text.

The base needs the count of every word. The `frequent` commonest words are
broadcast; all others meet their counts in a join.

Defined results: a null or empty text has the end token alone; a null doc_id
counts as the empty text for the fold; repeated rows are each scored; an empty
table gives no rows; without training texts every byte has 1/256.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import TEXTS, mix, signed, staged, strings

ORDER = 5
NEAR = 3
BATCH = 32 << 20
RUN = 500_000
FREQUENT = 200_000
FOLDS = 5
HELD_OUT = 1
END = b""
BOUND = b"\xff"
CHUNK = 1 << 21


def is_held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


def _bytes_of(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass").lower() if text else b""


def _codes(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of each text and its end: the context and the byte as one number; where each text begins."""
    pad = BOUND * order
    raw = np.frombuffer(pad + (BOUND + pad).join(texts) + BOUND, dtype=np.uint8)
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
    code = np.zeros(len(raw) - order, dtype=np.uint64)
    for i in range(order + 1):
        code |= raw[i : len(raw) - order + i].astype(np.uint64) << np.uint64(8 * (order - i))
    keep = np.ones(len(code), dtype=bool)
    begins = np.concatenate([[0], np.cumsum(sizes + order)[:-1]])
    gaps = begins[1:, None] - order + np.arange(order)
    keep[gaps.ravel()] = False
    return code[keep], np.concatenate([[0], np.cumsum(sizes)[:-1]])


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(back, weights=np.concatenate([p[1] for p in parts]), minlength=len(codes)).astype(np.int64)


def _squeezed(rows: pa.Table) -> bytes:
    """Whole texts travel compressed, many in one value."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(rows)
    return sink.getvalue().to_pybytes()


def count_corpus(docs: DataFrame, order: int = ORDER) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words (word, n) counted over all training texts; codes (batch, code, n) of each batch, with how often its training texts have them; texts (batch, texts), compressed slices of rows."""
    schema = pa.schema([("batch", pa.int64()), ("texts", pa.binary()), ("word", pa.binary()), ("code", pa.int64()), ("n", pa.int64())])

    def made(size: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(size, f.type) for f in schema], schema=schema)

    def words_batch(counter: Counter) -> pa.RecordBatch:
        return made(len(counter), word=pa.array(counter.keys(), pa.binary()), n=pa.array(counter.values(), pa.int64()))

    def codes_batch(batch: int, codes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return made(len(codes), batch=pa.array(np.full(len(codes), batch)), code=pa.array(signed(codes)), n=pa.array(n))

    def distinct(train: list[bytes], held_out: list[bytes]):
        if train:
            yield np.unique(_codes(train, order)[0], return_counts=True)
        if held_out:
            codes = np.unique(_codes(held_out, order)[0])
            yield codes, np.zeros(len(codes), dtype=np.int64)

    def over(batches):
        row = own = TaskContext.get().partitionId() << 40
        counter, parts, train, held_out, size, whole = Counter(), [], [], [], 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                ids, texts, owners, first = strings(part.column("doc_id")), strings(part.column("text")), [], row
                for doc_id, text in zip(ids, texts):
                    raw = _bytes_of(text)
                    if is_held_out(doc_id):
                        held_out.append(raw)
                    else:
                        train.append(raw)
                        counter.update(raw.split())
                        counter[END] += 1
                    owners.append(own)
                    size += len(raw)
                    row += 1
                    if size >= CHUNK:
                        parts += distinct(train, held_out)
                        train, held_out, whole, size = [], [], whole + size, 0
                        if sum(len(p[0]) for p in parts) > 3_000_000:
                            parts = [_merged(parts)]
                    if whole >= BATCH:
                        yield codes_batch(own, *_merged(parts))
                        parts, whole, own = [], 0, row
                    if len(counter) > 400_000:
                        yield words_batch(counter)
                        counter = Counter()
                rows = pa.table({"row": pa.array(range(first, row), pa.int64()), "doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string())})
                ends = [i for i in range(1, len(owners)) if owners[i] != owners[i - 1]] + [len(owners)]
                for begin, end in zip([0, *ends], ends):
                    yield made(1, batch=pa.array([owners[begin]]), texts=pa.array([_squeezed(rows.slice(begin, end - begin))], pa.binary()))
        parts += distinct(train, held_out)
        if parts:
            yield codes_batch(own, *_merged(parts))
        if counter:
            yield words_batch(counter)

    seen = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    seen = staged(seen.mapInArrow(over, "batch long, texts binary, word binary, code long, n long"), "counts")
    words = seen.filter(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n"))
    codes = seen.filter(F.col("code").isNotNull()).select("batch", "code", "n")
    return staged(words, "words"), codes, seen.filter(F.col("texts").isNotNull()).select("batch", "texts")


class Table:
    """Places of 64-bit keys, by open addressing in two arrays."""

    FREE = np.uint64(0xFFFFFFFFFFFFFFFF)

    def __init__(self, keys: np.ndarray):
        size = 1 << max(4, (2 * max(1, len(keys)) - 1).bit_length())
        self.mask = np.uint64(size - 1)
        self.keys = np.full(size, self.FREE, dtype=np.uint64)
        self.place = np.full(size, -1, dtype=np.int32)
        left, slot = np.arange(len(keys)), mix(keys) & self.mask
        while len(left):
            free = self.keys[slot] == self.FREE
            taken, first = np.unique(slot[free], return_index=True)
            who = left[free][first]
            self.keys[taken] = keys[who]
            self.place[taken] = who
            more = np.ones(len(left), dtype=bool)
            more[np.flatnonzero(free)[first]] = False
            left, slot = left[more], (slot[more] + np.uint64(1)) & self.mask

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        out = np.full(len(keys), -1, dtype=np.int32)
        slot = mix(keys) & self.mask
        left = None
        while True:
            here = self.keys[slot]
            hit = here == (keys if left is None else keys[left])
            at = np.flatnonzero(hit)
            out[at if left is None else left[at]] = self.place[slot[at]]
            on = np.flatnonzero(~hit & (here != self.FREE))
            if not len(on):
                return out
            left = on if left is None else left[on]
            slot = (slot[on] + np.uint64(1)) & self.mask


def _tag(level: int, code: np.ndarray) -> np.ndarray:
    return code | np.uint64((level + 1) << 56)


class Trie:
    """Byte contexts up to `order` bytes with their symbols' counts; log10 probabilities of whole texts."""

    def __init__(self, order: int, level: np.ndarray, code: np.ndarray, count: np.ndarray):
        self.order = order
        key = _tag(0, code) + (level.astype(np.uint64) << np.uint64(56))
        rank = np.argsort(key)
        level, code, count, key = level[rank], code[rank], count[rank].astype(np.float64), key[rank]
        self.pairs, self.count = Table(key), count
        context = (code >> np.uint64(8)) + ((level.astype(np.uint64) + np.uint64(1)) << np.uint64(56))
        contexts, of = np.unique(context, return_inverse=True)
        self.contexts = Table(contexts)
        self.total = np.bincount(of, weights=count, minlength=len(contexts))
        self.symbols = np.bincount(of, minlength=len(contexts)).astype(np.float64)
        shorter = np.zeros(len(code))
        for j in range(1, order + 1):
            at = np.flatnonzero(level == j)
            if len(at):
                shorter[at] = count[self.pairs.find(_tag(j - 1, code[at] & np.uint64((1 << 8 * j) - 1)))]
        #: Of each context, its symbols' counts in the next shorter context: what exclusion takes off there.
        self.excluded = np.bincount(of, weights=shorter, minlength=len(contexts))
        self.direct = np.log10(count / (self.total[of] + self.symbols[of]))

    def log10(self, code: np.ndarray) -> np.ndarray:
        """The log10 probability of each code's last byte after the bytes before it."""
        first = self.pairs.find(_tag(self.order, code))
        out = self.direct[first] if len(self.direct) else np.zeros(len(code))
        left = np.flatnonzero(first < 0)
        out[left] = 0
        child = np.full(len(left), -1, dtype=np.int32)
        for j in range(self.order, -1, -1):
            if not len(left):
                return out
            part = code[left] & np.uint64((1 << 8 * (j + 1)) - 1)
            own = self.contexts.find(_tag(j, part >> np.uint64(8)))
            has = own >= 0
            below = has & (child >= 0)
            total = np.where(has, self.total[own], 0.0) if len(self.total) else np.zeros(len(left))
            kinds = np.where(has, self.symbols[own], 0.0) if len(self.total) else np.zeros(len(left))
            total[below] -= self.excluded[child[below]]
            kinds[below] -= self.symbols[child[below]]
            pair = self.pairs.find(_tag(j, part))
            hit = pair >= 0
            at = np.flatnonzero(hit)
            out[left[at]] += np.log10(self.count[pair[at]] / (total[at] + kinds[at]))
            escape = np.flatnonzero(~hit & (kinds > 0))
            out[left[escape]] += np.log10(kinds[escape] / (total[escape] + kinds[escape]))
            child = np.where(has, own, child)[~hit]
            left = left[~hit]
        if len(left):
            seen = np.where(child >= 0, self.symbols[child], 0.0) if len(self.symbols) else np.zeros(len(left))
            out[left] -= np.log10(256.0 - seen)
        return out


def scores(texts: list[bytes], order: int, log10) -> np.ndarray:
    """The log10 probability of each text, from that of each code."""
    out = np.zeros(len(texts))
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size < CHUNK):
            size += len(texts[to])
            to += 1
        code, begins = _codes(texts[at:to], order)
        out[at:to] = np.add.reduceat(log10(code), begins)
        at = to
    return out


def _mask(level: int) -> int:
    return (1 << 8 * (level + 1)) - 1


def _shorter(level: int, code: np.ndarray, least: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Level, code and count of the pairs below `level` down to `least`, from that level's distinct codes."""
    out = []
    for j in range(level - 1, least - 1, -1):
        code, n = np.unique(code & np.uint64(_mask(j)), return_counts=True)
        out.append((np.full(len(code), j, dtype=np.uint8), code, n))
    return out


def code_probabilities(codes: DataFrame, order: int = ORDER) -> DataFrame:
    """code, log: the log10 probability of each distinct code, from all pairs with a count."""
    near = min(NEAR, order)
    counted = staged(codes.groupBy("code").agg(F.sum("n").alias("n")), "codes")
    shared = [(np.empty(0, dtype=np.uint8), np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64))]
    if near:
        pairs = counted.filter("n > 0").select(F.col("code").bitwiseAND(F.lit(_mask(near))).alias("code")).distinct()
        pairs = pairs.groupBy(F.col("code").bitwiseAND(F.lit(_mask(near - 1))).alias("code")).count().toArrow()  # at most 256^near
        code = pairs.column("code").to_numpy().astype(np.int64).view(np.uint64)
        shared = [(np.full(len(code), near - 1, dtype=np.uint8), code, pairs.column("count").to_numpy().astype(np.int64))]
        shared += _shorter(near - 1, code, 0)
    shared = codes.sparkSession.sparkContext.broadcast(shared)

    def scored(table: pa.Table) -> pa.RecordBatch:
        code, n = table.column("code").to_numpy().astype(np.int64).view(np.uint64), table.column("n").to_numpy()
        seen = code[n > 0]
        own = [(np.full(len(seen), order, dtype=np.uint8), seen, n[n > 0]), *_shorter(order, seen, near)]
        model = Trie(order, *map(np.concatenate, zip(*own, *shared.value)))
        return pa.RecordBatch.from_arrays([pa.array(signed(code)), pa.array(model.log10(code))], ["code", "log"])

    def over(batches):
        held, size, limit = [], 0, RUN
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= limit:
                table = pa.Table.from_batches(held)
                keys = table.column("key").to_numpy()
                cut = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
                if cut:
                    yield scored(table.slice(0, cut))
                held, size = table.slice(cut).to_batches(), size - cut
                limit = max(RUN, 2 * size)
        if size:
            yield scored(pa.Table.from_batches(held))

    key = F.shiftright("code", 8).bitwiseAND(F.lit((1 << 8 * near) - 1)).alias("key")
    return counted.select(key, "code", "n").repartition("key").sortWithinPartitions("key").mapInArrow(over, "code long, log double")


def score_documents(docs: DataFrame, order: int = ORDER, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every text."""
    spark = docs.sparkSession
    words, codes, texts = count_corpus(docs, order)
    logs = codes.select("batch", "code").join(code_probabilities(codes, order), "code").select(F.col("batch").alias("own"), "code", "log")
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    train_tokens, rest = sums["n"], math.log10(sums["n"] + 0.5 * (sums["v"] + 1))
    common = words.orderBy(F.desc("n"), "word").limit(frequent).toArrow()
    known = {w: math.log10(n + 0.5) for w, n in zip(common.column("word").to_pylist(), common.column("n").to_pylist())}
    known = spark.sparkContext.broadcast(known)
    schema = (
        "row long, doc struct<doc_id: long, held_out: boolean, n_tokens: long, n_known: long, base: double, score: double>, "
        "rare array<struct<word: binary, times: long>>"
    )
    doc = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())]
    rare = pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())]))
    made_schema = pa.schema([("row", pa.int64()), ("doc", pa.struct(doc)), ("rare", rare)])

    def of(texts: pa.Table, logs: pa.Table) -> pa.Table:
        get = known.value
        table, log = Table(logs.column("code").to_numpy().astype(np.int64).view(np.uint64)), logs.column("log").to_numpy()
        made = [made_schema.empty_table()]
        slices = (pa.ipc.open_stream(value.as_buffer()).read_all() for value in texts.column("texts"))
        for part in (rows.slice(at, 500) for rows in slices for at in range(0, rows.num_rows, 500)):
            ids = strings(part.column("doc_id"))
            raws = [_bytes_of(t) for t in strings(part.column("text"))]
            found = scores(raws, order, lambda code: log[table.find(code)])
            docs_out, rare_out = [], []
            for doc_id, text, score in zip(ids, raws, found.tolist()):
                own = text.split()
                own.append(END)
                known_logs = [get.get(w) for w in own]
                rare = Counter([w for w, x in zip(own, known_logs) if x is None])
                n_rare = sum(rare.values())
                docs_out.append(
                    {
                        "doc_id": doc_id,
                        "held_out": is_held_out(doc_id),
                        "n_tokens": len(own),
                        "n_known": len(own) - n_rare,
                        "base": math.fsum([x for x in known_logs if x is not None]),
                        "score": score,
                    }
                )
                rare_out.append([{"word": None, "times": 0}, *({"word": w, "times": n} for w, n in rare.items())])
            cols = [strings(part.column("row")), docs_out, rare_out]
            made.append(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, made_schema)], schema=made_schema))
        return pa.concat_tables(made)

    scored = texts.groupBy("batch").cogroup(logs.groupBy("own")).applyInArrow(of, schema)
    each = scored.select("row", "doc", F.explode("rare").alias("x"))
    each = each.select("row", F.when(F.col("x.word").isNull(), F.col("doc")).alias("doc"), F.col("x.word").alias("word"), F.col("x.times").alias("times"))
    met = each.join(words, "word", "left")
    c = F.coalesce(F.col("n"), F.lit(0))
    summed = met.groupBy("row").agg(
        F.max_by("doc", F.when(F.col("doc").isNotNull(), 1)).alias("doc"),
        F.sum(F.col("times") * F.log10(c + 0.5)).alias("base"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known"),
    )
    return summed.select(
        "doc.doc_id",
        "doc.held_out",
        "doc.n_tokens",
        (F.col("doc.n_known") + F.col("known")).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("doc.base") + F.col("base") - F.col("doc.n_tokens") * F.lit(rest)).alias("base_score"),
        F.col("doc.score").alias("score"),
    )
