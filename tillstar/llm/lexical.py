"""Ranked lexical search with MaxScore over pair bounds.

Documents are cut into blocks of `BLOCK`, each with its own posting lists: for
every term of the items the documents that hold it, their impacts, and the
largest of these. For pairs of terms that an item names together a block also
keeps their intersection list with the largest joint impact. The index is
written before it is searched.

An item's terms are ordered by weight and paired with their neighbours. A pair
adds to no document more than the largest of its joint impact, where both terms
occur, and its two single ones, where one does; that is less than the sum of
two independent maxima whenever the terms peak in different documents. The sums
of these bounds say which blocks, which lists and which documents can't reach
the k-th best score found so far: a block below it is skipped, lists whose
bounds together stay below it are looked up for candidates of the others only,
and a candidate is dropped once its score and the bounds left fall short. What
ties with the k-th best is kept, so that ascending ids decide.

The index needs no shuffle: a task's documents make its blocks. A task keeps k
documents per item; these few rows meet in one window. Items are collected in
batches of about `ITEM_BYTES` of text, the bound of all that is broadcast; each
batch has an index of its own terms.

Defined results: null and empty texts have no terms, so that such documents
count nowhere and such items have no rows; items that repeat an id and its text
are one, with another text they are ranked apart under the same id; each row of
documents is a document, whether ids repeat or not; a null doc_id comes after
all others of its score; other columns don't matter; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import mapped, staged

BEST = 20
#: Documents of a block; places in it are 16 bits wide.
BLOCK = 1024
#: Text of the items that are searched at a time.
ITEM_BYTES = 4 << 20
#: Documents that a worker turns into Python objects at a time.
TEXTS = 1000

#: Bytes of words `[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+` stay, A-Z in lower case; all others separate.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

POSTINGS = "doc_id long, n long, terms array<int>, counts array<int>"
INDEX = "ids binary, no_id binary, terms binary, starts binary, docs binary, impacts binary, tops binary, pairs binary, joint binary, pair_starts binary, pair_docs binary"


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(TERM_BYTES).split() if text else []


def _lists(flat: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    starts = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=starts[1:])
    return pa.ListArray.from_arrays(pa.array(starts), pa.array(flat.astype(np.int32)))


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Each document's number of terms, and how often it holds those of the vocabulary."""
    size = max(1, len(vocabulary))

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        lengths, found = [], []
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            words = terms_of(text)
            lengths.append(len(words))
            found.append(np.fromiter(map(vocabulary.get, words, repeat(-1)), dtype=np.int64, count=len(words)))
        doc = np.repeat(np.arange(len(lengths)), lengths)
        ids = np.concatenate(found) if found else doc
        keys, counts = np.unique((doc * size + ids)[ids >= 0], return_counts=True)
        held = np.bincount(keys // size, minlength=len(lengths))
        columns = [batch.column("doc_id"), pa.array(lengths, pa.int64()), _lists(keys % size, held), _lists(counts, held)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "counts"])

    return mapped(docs.select(F.col("doc_id").cast("long"), "text"), count, POSTINGS, TEXTS)


@dataclass
class Items:
    """Items of a batch: their distinct terms in ascending order of weight, paired with their neighbours.

    Pair `p` of an item has the terms `a[p]` and `b[p]`, which occur `ca[p]` and `cb[p]` times in it; `unique[p]` numbers the
    pairs of terms of all items. The pairs of item `i` are `first[i]` to `first[i + 1]`. A last odd term has `none` as partner.
    """

    weights: np.ndarray
    a: np.ndarray
    b: np.ndarray
    ca: np.ndarray
    cb: np.ndarray
    unique: np.ndarray
    first: np.ndarray
    pairs: np.ndarray = field(repr=False)

    @property
    def none(self) -> int:
        return len(self.weights) - 1

    def __len__(self) -> int:
        return len(self.first) - 1


def arrange(items: list[dict[int, int]], weights: np.ndarray) -> Items:
    """Pair the terms of each item; `weights` has one more entry, of the term that stands for none."""
    none = len(weights) - 1
    flat: list[tuple[int, int, int, int]] = []
    first = [0]
    for counts in items:
        by_weight = sorted((int(weights[t]) * c, t) for t, c in counts.items() if weights[t] > 0)
        terms = [t for _, t in by_weight]
        if len(terms) % 2:
            terms.insert(0, none)  # the odd one is the lightest
        flat += [(a, b, counts.get(a, 0), counts[b]) for a, b in zip(terms[::2], terms[1::2])]
        first.append(len(flat))
    a, b, ca, cb = (np.array(x, dtype=np.int64) for x in zip(*flat)) if flat else (np.zeros(0, dtype=np.int64),) * 4
    low, high = np.minimum(a, b), np.maximum(a, b)
    both, unique = np.unique(low * (none + 1) + high, return_inverse=True)
    pairs = np.stack([both // (none + 1), both % (none + 1)], axis=1)
    return Items(weights, a, b, ca, cb, unique, np.array(first), pairs)


class Block:
    """Posting lists, intersection lists and their maxima, of one block of documents."""

    def __init__(self, row: dict[str, bytes]):
        self.ids, self.no_id = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["no_id"], np.bool_)
        self.terms, self.starts = np.frombuffer(row["terms"], np.int32), np.frombuffer(row["starts"], np.int32)
        self.docs, self.impacts = np.frombuffer(row["docs"], np.uint16), np.frombuffer(row["impacts"], np.int32)
        self.tops = np.frombuffer(row["tops"], np.int32)
        self.pairs, self.joint = np.frombuffer(row["pairs"], np.int32), np.frombuffer(row["joint"], np.int64)
        self.pair_starts, self.pair_docs = np.frombuffer(row["pair_starts"], np.int32), np.frombuffer(row["pair_docs"], np.uint16)

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        at = int(np.searchsorted(self.terms, term))
        if at == len(self.terms) or self.terms[at] != term:
            return self.docs[:0], self.impacts[:0]
        here = slice(self.starts[at], self.starts[at + 1])
        return self.docs[here], self.impacts[here]

    def together(self, pair: int) -> np.ndarray:
        at = int(np.searchsorted(self.pairs, pair))
        if at == len(self.pairs) or self.pairs[at] != pair:
            return self.pair_docs[:0]
        return self.pair_docs[self.pair_starts[at] : self.pair_starts[at + 1]]


def build_block(ids, n, terms, counts, items: Items, n_docs: int, total: int) -> dict[str, bytes]:
    """The index of one block, from its documents' ids, lengths, terms and counts as Arrow arrays."""
    doc = np.repeat(np.arange(len(n), dtype=np.int64), np.diff(terms.offsets.to_numpy()))
    term = terms.flatten().to_numpy().astype(np.int64)
    tf = counts.flatten().to_numpy().astype(np.int64)
    m = 75 + (25 * n * n_docs) // total
    impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m[doc])
    order = np.lexsort((doc, term))
    doc, term, impact = doc[order].astype(np.uint16), term[order], impact[order].astype(np.int32)
    held, starts = np.unique(term, return_index=True)
    starts = np.append(starts, len(term)).astype(np.int32)
    tops = np.maximum.reduceat(impact, starts[:-1]) if len(held) else impact
    place = np.full(len(items.weights), -1, dtype=np.int64)
    place[held] = np.arange(len(held))
    left, right = place[items.pairs[:, 0]], place[items.pairs[:, 1]]
    pairs, joint, lists = [], [], []
    for pair in np.flatnonzero((left >= 0) & (right >= 0)):
        x, y = slice(*starts[left[pair] : left[pair] + 2]), slice(*starts[right[pair] : right[pair] + 2])
        shared, i, j = np.intersect1d(doc[x], doc[y], assume_unique=True, return_indices=True)
        if len(shared):
            wx, wy = items.weights[items.pairs[pair]]
            pairs.append(pair)
            joint.append(int((wx * impact[x][i].astype(np.int64) + wy * impact[y][j]).max()))
            lists.append(shared)
    pair_starts = np.zeros(len(lists) + 1, dtype=np.int32)
    np.cumsum([len(x) for x in lists], out=pair_starts[1:])
    no_id = ids.is_null().to_numpy(zero_copy_only=False)
    made = {
        "ids": ids.fill_null(0).to_numpy().astype(np.int64),
        "no_id": no_id,
        "terms": held.astype(np.int32),
        "starts": starts,
        "docs": doc,
        "impacts": impact,
        "tops": tops,
        "pairs": np.array(pairs, dtype=np.int32),
        "joint": np.array(joint, dtype=np.int64),
        "pair_starts": pair_starts,
        "pair_docs": np.concatenate(lists) if lists else np.zeros(0, dtype=np.uint16),
    }
    return {name: values.tobytes() for name, values in made.items()}


def build_index(counted: DataFrame, items: Items, n_docs: int, total: int, block: int = BLOCK) -> DataFrame:
    """Blocks of the documents that hold any of the items' terms."""
    names = [part.split(" ")[0] for part in INDEX.split(", ")]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows: pa.Table) -> pa.RecordBatch:
            ids, terms, counts = (rows.column(c).combine_chunks() for c in ("doc_id", "terms", "counts"))
            row = build_block(ids, rows.column("n").to_numpy(), terms, counts, items, n_docs, total)
            return pa.RecordBatch.from_arrays([pa.array([row[name]], pa.binary()) for name in names], names)

        kept: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, block - n)
                at, n = at + part.num_rows, n + part.num_rows
                kept.append(part)
                if n == block:
                    yield made(pa.Table.from_batches(kept))
                    kept, n = [], 0
        if kept:
            yield made(pa.Table.from_batches(kept))

    return counted.filter(F.size("terms") > 0).mapInArrow(build, INDEX)


def pair_bounds(block: Block, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What each pair of each item adds at most: to any document, to one with both terms, and to one with a single term."""
    top = np.zeros(len(items.weights), dtype=np.int64)
    top[block.terms] = block.tops
    top *= items.weights
    joint = np.zeros(len(items.pairs), dtype=np.int64)
    joint[block.pairs] = block.joint
    ua, ub, j = top[items.a], top[items.b], joint[items.unique]
    # c times the joint maximum of single occurrences, and the maximum of the term that occurs more often for the rest
    fewer = np.minimum(items.ca, items.cb)
    both = np.where(j > 0, np.minimum(fewer * j + (items.ca - fewer) * ua + (items.cb - fewer) * ub, items.ca * ua + items.cb * ub), 0)
    one = np.maximum(items.ca * ua, items.cb * ub)
    return np.maximum(both, one), both, one


class Top:
    """The best documents of each item so far, by score, then id; null ids last."""

    def __init__(self, n: int, best: int):
        self.best = best
        self.least = np.ones(n, dtype=np.int64)  # scores below it don't enter
        none = np.zeros(0, dtype=np.int64)
        self.held = [(none, none, none.astype(bool))] * n

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        held = self.held[item]
        scores, ids, no_id = (np.concatenate(x) for x in zip(held, (scores, ids, no_id)))
        order = np.lexsort((ids, no_id, -scores))[: self.best]
        self.held[item] = (scores[order], ids[order], no_id[order])
        if len(order) == self.best:
            self.least[item] = max(self.least[item], scores[order[-1]])


def search_block(block: Block, items: Items, top: Top, counter: dict[str, int] | None = None) -> None:
    """Rank a block's documents for all items."""
    counter = {} if counter is None else counter
    bound, both_bound, one_bound = pair_bounds(block, items)
    running = np.concatenate([[0], np.cumsum(bound)])
    whole = running[items.first[1:]] - running[items.first[:-1]]
    lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def postings_of(term: int) -> tuple[np.ndarray, np.ndarray]:
        if term not in lists:
            docs, impacts = block.postings(term)
            lists[term] = docs, items.weights[term] * impacts
        return lists[term]

    counter["items"] = counter.get("items", 0) + len(items)
    for i in np.flatnonzero(whole >= top.least):
        least, lo, hi = top.least[i], items.first[i], items.first[i + 1]
        upto = running[lo : hi + 1] - running[lo]  # bounds of all lighter pairs
        cut = int(np.searchsorted(upto, least))  # pairs before it can't reach the score without the others
        cut = max(0, cut - 1)
        scores = np.zeros(len(block.ids), dtype=np.int64)
        for p in range(lo + cut, hi):
            for term, times in ((items.a[p], items.ca[p]), (items.b[p], items.cb[p])):
                if times:
                    docs, added = postings_of(term)
                    scores[docs] += times * added
        at = np.flatnonzero(scores + upto[cut] >= least)
        score = scores[at]
        counter["searched"] = counter.get("searched", 0) + 1
        for p in range(lo + cut - 1, lo - 1, -1):
            rest = upto[p - lo]
            may = score + rest + bound[p] >= least
            at, score = at[may], score[may]
            if not len(at):
                break
            # the intersection list tells which candidates the joint bound is for
            both = np.isin(at, block.together(items.unique[p]))
            may = score + rest + np.where(both, both_bound[p], one_bound[p]) >= least
            at, score = at[may], score[may]
            counter["looked up"] = counter.get("looked up", 0) + 2 * len(at)
            for term, times in ((items.a[p], items.ca[p]), (items.b[p], items.cb[p])):
                docs, added = postings_of(term) if times else ((), ())
                if len(docs):
                    place = np.minimum(np.searchsorted(docs, at), len(docs) - 1)
                    score = score + np.where(docs[place] == at, times * added[place], 0)
        may = score >= least
        if may.any():
            at, score = at[may], score[may]
            top.add(int(i), score, block.ids[at], block.no_id[at])


def search(index: DataFrame, items: Items, best: int) -> DataFrame:
    """The best documents of each item that a task's blocks hold."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = Top(len(items), best)
        for batch in batches:
            for at in range(batch.num_rows):
                search_block(Block(batch.slice(at, 1).to_pylist()[0]), items, top)
        sizes = [len(scores) for scores, _, _ in top.held]
        if sum(sizes):
            scores, ids, no_id = (np.concatenate(x) for x in zip(*top.held))
            item = pa.array(np.repeat(np.arange(len(items), dtype=np.int32), sizes))
            yield pa.RecordBatch.from_arrays([item, pa.array(scores), pa.array(ids, mask=no_id)], ["item", "score", "doc_id"])

    return index.mapInArrow(look, "item int, score long, doc_id long")


def _rank_batch(docs: DataFrame, batch: DataFrame, best: int) -> DataFrame:
    spark = docs.sparkSession
    rows = [(r["item_id"], terms_of(bytes(r["text"]))) for r in batch.withColumn("text", F.encode("text", "utf-8")).collect()]
    vocabulary = {term: i for i, term in enumerate(sorted({t for _, terms in rows for t in terms}))}
    counted = staged(postings(docs, vocabulary), "term-counts")
    n_docs, total = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(len(vocabulary) + 1, dtype=np.int64)
    for term, df in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most one row per term of the items
        weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    counts: list[dict[int, int]] = []
    for _, terms in rows:
        own: dict[int, int] = {}
        for term in terms:
            own[vocabulary[term]] = own.get(vocabulary[term], 0) + 1
        counts.append(own)
    items = arrange(counts, weights)
    index = staged(build_index(counted, items, n_docs, total), "block-index")
    found = search(index, items, best)
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    top = found.withColumn("rank", place).filter(F.col("rank") <= best)
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(rows)], f"item int, item_id {dict(batch.dtypes)['item_id']}")
    return top.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def rank(docs: DataFrame, items: DataFrame, best: int = BEST, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The `best` documents of each item with a score above 0: item_id, rank (from 1), doc_id, score."""
    asked = items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).filter("text <> ''").distinct()
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = max(1, math.ceil(size / item_bytes))
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(batches))
    ranked = [_rank_batch(docs, asked.filter(number == i), best) for i in range(batches)]
    out = ranked[0]
    for more in ranked[1:]:
        out = out.unionByName(more)
    return out
