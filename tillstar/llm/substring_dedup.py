"""Fuzzy repeated passages by collinear chaining of k-mer seeds.

One in three of a text's k-mers is a seed, chosen by the k-mer's hash alone, and
the least of every `WINDOW` consecutive k-mers without one, so that every run of
`WINDOW` + K - 1 words that two texts share gives both a seed; and one in eight
of its `LONG`-word runs, which point past common phrases. Texts
with the same words are one node, whose earliest row speaks for all; copies of
it are passages as a whole. Nodes that share a seed match: all earlier holders
of a seed with up to `FEW` of them, the first holder of a more frequent one. A
task that meets a frequent seed links its holders itself and passes on the first
of them, so that a hot seed is one entry per task in the shuffle. Seeds travel
as packed arrays by hash partition.

The matches of two nodes are chained in order of both by a Fenwick tree, with
linear gap costs, and chains are parted where more than `REACH` words lie
between two matches; of exact runs, only the ends and every k-th match are
chained. Every chain, also of one match, fetches the words of the earlier node
around it and is aligned with those of the later one: gaps between seeds word by
word, or by longest common subsequence where their lengths differ, ends by
extension until mismatches outweigh matches, with more words while the fetched
ones run out. A chain that is not alike as a whole is parted at its widest gap,
and one that is at a hole: over `TRIMMED` words between two matches, under half
of which agree.
Chains of a node that overlap or touch make a passage. Words are compared by
32-bit hashes.

What a frequent seed finds is the first text that holds it: true for a repeated
passage, whose seeds are frequent together, and a stranger for a common phrase.
A copy with many edits is therefore found by its rarer seeds; see the recall in
the README.

Defined results: null and empty texts, and texts under K words, have no
passages; rows are told apart by doc_id and words, so that texts that share a
doc_id are texts of their own, the earlier one by a hash of its words, and a row
that repeats both is the same document; rows without a doc_id come before all
others; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import TEXTS, hashes_of, mapped, mix, shingle_hashes, staged, strings, words_of

K = 5
#: One k-mer in so many is a seed, and one run of LONG words in so many.
EVERY = 3
#: So many consecutive k-mers hold a seed at least: their least one where none is chosen by hash.
WINDOW = 5
LONG = 10
EVERY_LONG = 8
#: Marks the place of a long seed; texts have fewer words.
LONG_PLACE = 1 << 30
#: Words that the matches of a chain cover at least: fewer are a phrase.
COVERED = 8
#: A seed that comes again within so many words is one place.
PERIOD = 20
FEW = 6
REACH = 50
MIN_WORDS = 50
#: So many words of a passage may be lost at its edited ends.
TRIMMED = 10
MIN_CHAIN = 20
SIMILARITY = 0.8
MATCH = 4.0
GAP = 0.15
#: Words around a chain that are fetched at first, and how many times as many whenever they run out.
EXTEND = 60
FURTHER = 8
DROP = 8
SMALL_IDS = 1_000_000
#: Chains, with the words around them, that a worker turns into Python objects at a time.
CHAINS = 200
#: Words that a task gathers before it sends their seeds, and text bytes of a hash partition, about.
FLUSH = 1 << 19
PART_BYTES = 16 << 20
#: Stands for a missing doc_id: before all others.
NO_ID = -(2**63)
WORD = re.compile(rb"[^ \t\n\r\x0b\x0c]+")

PACKED = "part int, own binary, other binary, doc binary, x binary, y binary"
PACKED_NAMES = ["part", "own", "other", "doc", "x", "y"]


def node_of(words: np.ndarray) -> tuple[int, int]:
    """Two hashes of a text's words."""
    raw = words.tobytes()
    return xxhash.xxh3_64_intdigest(raw), xxhash.xxh3_64_intdigest(raw, 1)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def sampled(texts: list[np.ndarray], k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The seeds of texts, given as hashes of their words: seed, number of the text, place."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    words = np.concatenate(texts) if texts else np.zeros(0, dtype=np.uint64)
    if len(words) < k:
        none = np.zeros(0, dtype=np.int64)
        return none.view(np.uint64), none, none.astype(np.int32)
    text = np.repeat(np.arange(len(texts)), lengths)
    place = (np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
    left = np.repeat(lengths, lengths) - place
    short = shingle_hashes(words, k)
    at = _winnowed(short, left[: len(short)], lengths, k)
    found, of, places = [short[at]], [text[at]], [place[at]]
    if len(short) > LONG - k:
        long = mix(short[: len(short) - LONG + k] ^ mix(short[LONG - k :] + np.uint64(LONG)))
        at = np.flatnonzero((left[: len(long)] >= LONG) & (long % np.uint64(EVERY_LONG) == 0))
        found.append(long[at])
        of.append(text[at])
        places.append(place[at] | np.int32(LONG_PLACE))
    return np.concatenate(found), np.concatenate(of), np.concatenate(places)


def _winnowed(short: np.ndarray, left: np.ndarray, lengths: np.ndarray, k: int) -> np.ndarray:
    """Places of the k-mers chosen by hash, and of the least k-mer of every WINDOW consecutive ones, or of a text with
    fewer, that hold none of them."""
    chosen = (left >= k) & (short % np.uint64(EVERY) == 0)
    extra = []
    if len(short) >= WINDOW:
        held = np.concatenate([[0], np.cumsum(chosen)])
        starts = np.flatnonzero((left[: len(short) - WINDOW + 1] >= k + WINDOW - 1) & (held[WINDOW:] == held[: -WINDOW]))
        if len(starts):  # windows inside one text without a seed
            least = np.lib.stride_tricks.sliding_window_view(short, WINDOW)[starts].argmin(axis=1)
            extra.append(starts + least)
    few = np.flatnonzero((lengths >= k) & (lengths < k + WINDOW - 1))
    for start, n in zip((np.cumsum(lengths) - lengths)[few], lengths[few]):
        if not chosen[start : start + n - k + 1].any():
            extra.append(np.array([start + int(np.argmin(short[start : start + n - k + 1]))]))
    return np.unique(np.concatenate([np.flatnonzero(chosen), *extra]))


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((mix(hashes) >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


def _packed(part: np.ndarray, own: np.ndarray, other: np.ndarray, doc: np.ndarray | None, x: np.ndarray, y: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Rows of packed arrays, one per hash partition; rows of one node stand together, which compresses well."""
    order = np.lexsort((x, own, part))
    columns = [None if c is None else c[order] for c in (own, other, doc, x, y)]
    numbers, starts = np.unique(part[order], return_index=True)
    ends = np.append(starts[1:], len(part))
    for at in range(0, len(numbers), 64):
        spans = list(zip(starts[at : at + 64], ends[at : at + 64]))
        made = [pa.nulls(len(spans), pa.binary()) if c is None else pa.array([c[i:j].tobytes() for i, j in spans], pa.binary()) for c in columns]
        yield pa.RecordBatch.from_arrays([pa.array(numbers[at : at + 64].astype(np.int32)), *made], PACKED_NAMES)


def _groups(seed: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of entries sorted by seed and node: whether each is its node's first, its node's number among all seeds' nodes, the
    number of the seed's first node, and how many nodes the seed has."""
    new_seed = np.ones(len(seed), dtype=bool)
    new_seed[1:] = seed[1:] != seed[:-1]
    new_node = new_seed.copy()
    new_node[1:] |= rank[1:] != rank[:-1]
    group = np.cumsum(new_seed) - 1
    node = np.cumsum(new_node) - 1
    nodes = np.bincount(group, weights=new_node, minlength=1).astype(np.int64) if len(seed) else np.zeros(0, dtype=np.int64)
    first = (np.cumsum(nodes) - nodes)[group] if len(seed) else node
    return new_node, node, first, nodes[group] if len(seed) else node


def _texts(docs: DataFrame) -> DataFrame:
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID).cast("long"))
    text = F.col("text").cast("string")
    return docs.select(doc.alias("doc"), text.alias("text"), F.xxhash64(text).alias("h"))


def matches(docs: DataFrame, parts: int, k: int = K) -> DataFrame:
    """Packed matches by partition of the later node: own node, earlier node, place in both."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray]] = {}  # node -> its first row so far, and its words
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            rows = sorted((doc, node) for node, (doc, _) in held.items())
            doc = np.array([d for d, _ in rows], dtype=np.int64)
            node = np.array([n for _, n in rows], dtype=np.uint64)
            seed, rank, place = sampled([held[n][1] for _, n in rows], k)
            order = np.lexsort((place, rank, seed))
            seed, rank, place = seed[order], rank[order], place[order]
            again = np.zeros(len(seed), dtype=bool)  # words that repeat with a short period: the first place stands for the run
            again[1:] = (seed[1:] == seed[:-1]) & (rank[1:] == rank[:-1]) & (np.diff(place) <= PERIOD)
            seed, rank, place = seed[~again], rank[~again], place[~again]
            new_node, number, first, nodes = _groups(seed, rank)
            hot = nodes > FEW
            leads = np.flatnonzero(new_node)
            linked = np.flatnonzero(hot & (number > first))
            if len(linked):
                lead = leads[first[linked]]
                own, other = node[rank[linked]], node[rank[lead]]
                yield from _packed(_part(own, parts), own, other, None, place[linked], place[lead])
            kept = np.flatnonzero(~hot | (new_node & (number == first)))
            if len(kept):
                low = seed[kept].astype(np.uint32)  # the partition tells as much again
                yield from _packed(_part(seed[kept], parts), node[rank[kept]], low, doc[rank[kept]], place[kept], None)

        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                for doc, text in zip(strings(part.column("doc")), strings(part.column("text"))):
                    words = hashes_of(words_of(text))
                    if len(words) < k:
                        continue
                    node = node_of(words)[0]
                    if node not in held:
                        size += len(words)
                        held[node] = (doc, words)
                    elif doc < held[node][0]:
                        held[node] = (doc, words)
                    if size >= FLUSH:
                        yield from flush()
                        held, size = {}, 0
        if held:
            yield from flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols: list[list[np.ndarray]] = [[], [], [], []]
        for batch in batches:
            made = []
            for i in range(batch.num_rows):
                if batch.column("y")[i].is_valid:
                    made.append(i)  # matches that a task has made already
                    continue
                for column, name, kind in zip(cols, ("own", "other", "doc", "x"), (np.uint64, np.uint32, np.int64, np.int32)):
                    column.append(np.frombuffer(batch.column(name)[i].as_buffer(), dtype=kind).copy())
            if made:
                yield batch.take(pa.array(made))
        if not cols[0]:
            return
        own, seed, doc, place = (np.concatenate(c) for c in cols)
        order = np.argsort(seed, kind="stable")
        same = seed[order][1:] == seed[order][:-1]
        shared = order[np.append(same, False) | np.append(False, same)]  # most seeds have one entry
        own, seed, doc, place = own[shared], seed[shared], doc[shared], place[shared]
        every, number = np.unique(own, return_inverse=True)
        earliest = np.full(len(every), np.iinfo(np.int64).max)
        np.minimum.at(earliest, number, doc)
        by_age = np.empty(len(every), dtype=np.int64)
        by_age[np.lexsort((every, earliest))] = np.arange(len(every))
        rank = by_age[number]
        order = np.lexsort((place, rank, seed))
        own, seed, rank, place = own[order], seed[order], rank[order], place[order]
        again = np.zeros(len(seed), dtype=bool)  # copies of a node, from several tasks
        again[1:] = (seed[1:] == seed[:-1]) & (rank[1:] == rank[:-1]) & (place[1:] == place[:-1])
        own, seed, rank, place = own[~again], seed[~again], rank[~again], place[~again]
        new_node, number, first, nodes = _groups(seed, rank)
        leads = np.flatnonzero(new_node)
        at, partner = [np.flatnonzero((nodes > FEW) & (number > first))], []
        partner.append(first[at[0]])
        for back in range(1, FEW):
            some = np.flatnonzero((nodes <= FEW) & (number - back >= first))
            at.append(some)
            partner.append(number[some] - back)
        at, lead = np.concatenate(at), leads[np.concatenate(partner)]
        if len(at):
            yield from _packed(_part(own[at], parts), own[at], own[lead], None, place[at], place[lead])

    packed = _texts(docs).select("doc", "text").mapInArrow(send, PACKED)
    return packed.repartitionById(parts, F.col("part")).mapInArrow(meet, PACKED)


class Fenwick:
    """Best value, with its owner, of all places up to one."""

    def __init__(self, n: int):
        self.best: list[tuple[float, int]] = [(float("-inf"), -1)] * (n + 1)

    def put(self, at: int, value: tuple[float, int]) -> None:
        while at < len(self.best):
            if value > self.best[at]:
                self.best[at] = value
            at += at & -at

    def get(self, at: int) -> tuple[float, int]:
        out = (float("-inf"), -1)
        while at > 0:
            if self.best[at] > out:
                out = self.best[at]
            at -= at & -at
        return out


def chain(x: np.ndarray, y: np.ndarray, k: int = K, match: float = MATCH, gap: float = GAP) -> list[list[int]]:
    """Chains of matches with rising places in both texts, best first; each match is in one.

    A chain's worth is `match` for each match less `gap` for each word between
    their places in either text; a match that gains by no chain starts its own.
    """
    order = np.lexsort((y, x))
    rank = {v: i + 1 for i, v in enumerate(sorted(set(y.tolist())))}
    tree, worth, back = Fenwick(len(rank)), {}, {}
    xs, ys = x.tolist(), y.tolist()
    waiting: list[int] = []
    for i in order.tolist():
        while waiting and xs[waiting[0]] < xs[i]:
            j = waiting.pop(0)
            tree.put(rank[ys[j]], (worth[j] + gap * (xs[j] + ys[j]), j))
        best, j = tree.get(rank[ys[i]] - 1)
        best -= gap * (xs[i] + ys[i])
        worth[i], back[i] = (match + best, j) if j >= 0 and best > 0 else (match, -1)
        waiting.append(i)
    used: set[int] = set()
    out = []
    for i in sorted(worth, key=lambda i: (-worth[i], i)):
        path = []
        while i >= 0 and i not in used:
            used.add(i)
            path.append(i)
            i = back[i]
        if path:
            out.append(path[::-1])
    return out


def thinned(x: np.ndarray, y: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """The matches without those inside exact runs, but for every k-th."""
    order = np.lexsort((x, x - y))
    x, y = x[order], y[order]
    begins = np.ones(len(x), dtype=bool)
    begins[1:] = (np.diff(x) != 1) | (np.diff(x - y) != 0)
    ends = np.append(begins[1:], True)
    since = np.arange(len(x)) - np.flatnonzero(begins)[np.cumsum(begins) - 1]
    keep = ends | (since % k == 0)
    return x[keep], y[keep]


def common_length(a: list, b: list) -> int:
    """Length of the longest common subsequence; a bit per word of `b` in one whole number, a step per word of `a`."""
    if not a or not b:
        return 0
    places: dict[int, int] = {}
    for j, y in enumerate(b):
        places[y] = places.get(y, 0) | 1 << j
    every = (1 << len(b)) - 1
    row = every
    for x in a:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & every
    return len(b) - row.bit_count()


def _extend(a: list, b: list) -> int:
    """How many words from the start of both to take: up to the best sum of matches less twice the mismatches."""
    best = at = total = 0
    for i, (p, q) in enumerate(zip(a, b), 1):
        total += 1 if p == q else -2
        if total > best:
            best, at = total, i
        elif total < best - DROP:
            break
    return at


def align(mine: list, other: list, x: list[int], y: list[int], k: int = K) -> tuple[int, int, int, int, float]:
    """From a chain's places: first word and number of words in both texts, and the share of words that agree.

    Seeds agree word by word; of overlapping seeds the later one counts from where the earlier one ends.
    """
    left = _extend(mine[: x[0]][::-1], other[: y[0]][::-1])
    agree, at_x, at_y = left - sum(p != q for p, q in zip(mine[x[0] - left : x[0]], other[y[0] - left : y[0]])), x[0], y[0]
    for i, j in zip(x, y):
        if i < at_x or j < at_y:  # overlaps what is aligned already
            skip = max(at_x - i, at_y - j)
            if skip >= k:
                continue
            i, j, size = i + skip, j + skip, k - skip
        else:
            size = k
        gap_x, gap_y = mine[at_x:i], other[at_y:j]
        level = sum(p == q for p, q in zip(gap_x, gap_y)) if len(gap_x) == len(gap_y) else 0
        agree += level if 2 * level >= len(gap_x) == len(gap_y) else common_length(gap_x, gap_y)
        agree += size
        at_x, at_y = i + size, j + size
    right = _extend(mine[at_x:], other[at_y:])
    agree += right - sum(p != q for p, q in zip(mine[at_x : at_x + right], other[at_y : at_y + right]))
    n_x, n_y = at_x + right - x[0] + left, at_y + right - y[0] + left
    return x[0] - left, n_x, y[0] - left, n_y, agree / max(n_x, n_y)


def hole(mine: list, other: list, x: list[int], y: list[int], k: int = K) -> int:
    """Number of the first match after a hole: over TRIMMED words between two matches in either text, under half of which
    agree; else 0."""
    at_x, at_y = x[0] + k, y[0] + k
    for n, (i, j) in enumerate(zip(x[1:], y[1:]), 1):
        gap_x, gap_y = mine[at_x:i], other[at_y:j]
        wide = max(len(gap_x), len(gap_y))
        if wide > TRIMMED and 2 * common_length(gap_x, gap_y) < wide:
            return n
        at_x, at_y = max(at_x, i + k), max(at_y, j + k)
    return 0


def pair_chains(x: np.ndarray, y: np.ndarray, k: int = K) -> list[tuple[list[int], list[int]]]:
    """The chains of two nodes' matches, parted where more than REACH words lie between two."""
    x, y = thinned(x, y, k)
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    on_one_line = len(x) == 1 or (x[0] - y[0] == x - y).all()
    paths = [list(range(len(x)))] if on_one_line else chain(x, y, k, gap=MATCH / (2 * REACH))
    out = []
    for path in paths:
        px, py = x[path], y[path]
        cuts = np.flatnonzero((np.diff(px) > REACH) | (np.diff(py) > REACH)) + 1
        for cx, cy in zip(np.split(px, cuts), np.split(py, cuts)):
            out.append((cx.tolist(), cy.tolist()))
    return out


def _chains(docs: DataFrame, k: int) -> DataFrame:
    """own, source (nodes) and the places of each chain."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(size / PART_BYTES))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["own", "source", "x", "y"])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols: list[list[np.ndarray]] = [[], [], [], []]
        for batch in batches:
            for column, name, kind in zip(cols, ("own", "other", "x", "y"), (np.uint64, np.uint64, np.int32, np.int32)):
                column += [np.frombuffer(v.as_buffer(), dtype=kind).copy() for v in batch.column(name)]
        if not cols[0]:
            return
        own, source, x, y = (np.concatenate(c) for c in cols)
        long = x >= LONG_PLACE
        x, y = x & (LONG_PLACE - 1), y & (LONG_PLACE - 1)
        order = np.lexsort((~long, y, x, source, own))
        own, source, x, y, long = own[order].view(np.int64), source[order].view(np.int64), x[order], y[order], long[order]
        new = np.ones(len(own), dtype=bool)
        new[1:] = (own[1:] != own[:-1]) | (source[1:] != source[:-1])
        kept = new.copy()
        kept[1:] |= (x[1:] != x[:-1]) | (y[1:] != y[:-1])
        own, source, x, y, long, new = own[kept], source[kept], x[kept], y[kept], long[kept], new[kept]
        starts = np.append(np.flatnonzero(new), len(new))
        # pairs that share a phrase alone are most, and need no chain
        pair = np.cumsum(new) - 1
        spread = np.maximum.reduceat(x, starts[:-1]) - np.minimum.reduceat(x, starts[:-1]) + k
        some_long = np.bincount(pair, weights=long) > 0
        rows: list[tuple] = []
        for p in np.flatnonzero(some_long | (spread >= COVERED)).tolist():
            i, j = int(starts[p]), int(starts[p + 1])
            sure = set(zip(x[i:j][long[i:j]].tolist(), y[i:j][long[i:j]].tolist()))
            for cx, cy in pair_chains(x[i:j], y[i:j], k):
                if cx[-1] - cx[0] + k >= COVERED or (cx[0], cy[0]) in sure or (cx[-1], cy[-1]) in sure:
                    rows.append((int(own[i]), int(source[i]), cx, cy))
            if len(rows) >= 4096:
                yield batch_of(rows)
                rows = []
        if rows:
            yield batch_of(rows)

    by_own = matches(docs, parts, k).repartitionById(parts, F.col("part"))
    return by_own.mapInArrow(of, "own long, source long, x array<int>, y array<int>")


def _rows(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """doc, h (hash of the text), node, check and n_words of every row with words; and the words of rows of the given nodes.

    Up to SMALL_IDS nodes go to the tasks as a sorted array of 8 bytes each; with more, every row has its words.
    """
    few = nodes.count() <= SMALL_IDS
    listed = np.sort(nodes.toArrow().column(0).to_numpy()) if few else None
    wanted = docs.sparkSession.sparkContext.broadcast(listed)

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = wanted.value
        made: list[tuple] = []
        for doc, h, text in zip(strings(batch.column("doc")), strings(batch.column("h")), strings(batch.column("text"))):
            words = hashes_of(words_of(text))
            if len(words) < K:
                continue
            node, check = map(_signed, node_of(words))
            at = 0 if known is None else int(np.searchsorted(known, node))
            has = known is None or (at < len(known) and known[at] == node)
            made.append((doc, h, node, check, len(words), words.astype(np.uint32).tobytes() if has else None))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        names = ["doc", "h", "node", "check", "n", "words"]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in made], t) for i, t in enumerate(kinds)], names)

    return mapped(_texts(docs), of, "doc long, h long, node long, check long, n int, words binary", TEXTS)


def aligned(found: DataFrame, rows: DataFrame, k: int = K, similarity: float = SIMILARITY) -> DataFrame:
    """own, start, n_words, source_doc, source_start, source_words, similarity of every aligned chain."""
    # copies of a node have the same words, whichever comes first
    texts = rows.filter("words IS NOT NULL").groupBy("node").agg(F.min("doc").alias("source_doc"), F.first("words").alias("words"))
    source = texts.withColumnRenamed("node", "source")
    later = texts.select(F.col("node").alias("own"), "words")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        """The earlier node's words around the chain, and how many it has."""
        begins, totals, parts = [], [], []
        for y, extend, raw in zip(batch.column("y").to_pylist(), batch.column("extend").to_pylist(), batch.column("words")):
            raw = raw.as_buffer()
            begin, end = max(0, y[0] - extend), min(len(raw) // 4, y[-1] + k + extend)
            begins.append(begin)
            totals.append(len(raw) // 4)
            parts.append(raw[4 * begin : 4 * end].to_pybytes())
        cols = [batch.column(c) for c in (*names, "source_doc")]
        return pa.RecordBatch.from_arrays(
            [*cols, pa.array(begins, pa.int32()), pa.array(totals, pa.int32()), pa.array(parts, pa.binary())],
            [*names, "source_doc", "begin", "total", "part"],
        )

    names = ["own", "source", "x", "y", "extend"]
    chained = "own long, source long, x array<int>, y array<int>, extend int"
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64())
    results = ["source_doc", "start", "n_words", "source_start", "source_words", "similarity"]

    def match(batch: pa.RecordBatch) -> pa.RecordBatch:
        """The chain's alignment; or the chain, to come with more words around it, where those fetched ran out."""
        made = []
        cols = [strings(batch.column(c)) for c in (*names, "source_doc", "begin", "total", "part")]
        for own, other_node, xs, ys, extend, doc, begin, total, part, raw in zip(*cols, batch.column("words")):
            whole = np.frombuffer(raw.as_buffer(), dtype=np.uint32)
            low = max(0, xs[0] - extend)
            high = min(len(whole), xs[-1] + k + extend)
            mine, other = whole[low:high].tolist(), np.frombuffer(part, dtype=np.uint32).tolist()
            waiting = [(xs, ys)]
            while waiting:
                x, y = waiting.pop()
                here_x, here_y = [v - low for v in x], [v - begin for v in y]
                start, n, y0, m, share = align(mine, other, here_x, here_y, k)
                ran_out = start == 0 < low or y0 == 0 < begin or start + n == len(mine) < len(whole) - low or y0 + m == len(other) < total - begin
                split = hole(mine, other, here_x, here_y, k) if share >= similarity else 0
                if share < similarity and len(x) > 1:
                    at = 1 + int(np.argmax(np.diff(x) + np.diff(y)))
                    waiting += [(x[:at], y[:at]), (x[at:], y[at:])]
                elif split:  # words between two matches that are not alike: two passages
                    waiting += [(x[:split], y[:split]), (x[split:], y[split:])]
                elif ran_out:
                    made.append((own, other_node, x, y, FURTHER * extend, None, None, None, None, None, None))
                elif share >= similarity and n >= MIN_CHAIN:
                    made.append((own, other_node, None, None, None, doc, start + low, n, y0 + begin, m, share))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in made], t) for i, t in enumerate(kinds)], [*names, *results])

    done, left, wanted = None, found.withColumn("extend", F.lit(EXTEND)), (source, later)
    while True:
        placed = mapped(left.join(wanted[0], "source"), cut, f"{chained}, source_doc long, begin int, total int, part binary", CHAINS)
        schema = f"{chained}, source_doc long, start int, n_words int, source_start int, source_words int, similarity double"
        made = staged(mapped(placed.join(wanted[1], "own"), match, schema, CHAINS), "aligned")
        ended = made.filter(F.col("extend").isNull()).select("own", "start", "n_words", "source_doc", "source_start", "source_words", "similarity")
        done = ended if done is None else done.unionAll(ended)
        left = made.filter(F.col("extend").isNotNull()).select(*names)
        few = left.select(F.col("own").alias("node")).unionAll(left.select("source")).distinct()
        n = few.count()
        if not n:
            return done
        few = staged(few, "few")
        if n <= SMALL_IDS:  # the words of these nodes alone go on
            named = [F.broadcast(few.withColumnRenamed("node", name)) for name in ("source", "own")]
            wanted = source.join(named[0], "source", "left_semi"), later.join(named[1], "own", "left_semi")


def merge(spans: list[tuple[int, int, int, float]], min_words: int, slack: int = 2) -> list[tuple[int, int, list[int], float]]:
    """Spans (start, words, source, similarity) that overlap or nearly touch, as passages of enough words."""
    out: list[list] = []
    for start, n, source, share in sorted(spans):
        if out and start <= out[-1][1] + slack:
            out[-1][1] = max(out[-1][1], start + n)
            out[-1][2].add(source)
            out[-1][3] = min(out[-1][3], share)
        else:
            out.append([start, start + n, {source}, share])
    return [(a, b - a, sorted(s), v) for a, b, s, v in out if b - a >= min_words - TRIMMED]


def _passages(docs: DataFrame, min_words: int, k: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """doc, node, start_word, n_words, source_docs, similarity of each passage; and the rows of `_rows`."""
    found = staged(_chains(docs, k), "chains")
    nodes = found.select(F.col("own").alias("node")).unionAll(found.select("source")).distinct()
    rows = staged(_rows(docs, staged(nodes, "nodes")), "rows")
    spans = aligned(found, rows, k, similarity)
    gathered = spans.groupBy("own").agg(F.collect_list(F.struct("start", "n_words", "source_doc", "similarity")).alias("all"))

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = []
        for node, own in zip(strings(batch.column("own")), strings(batch.column("all"))):
            made += [(node, *p) for p in merge([tuple(s.values()) for s in own], min_words)]
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.float64())
        names = ["node", "start_word", "n_words", "source_docs", "similarity"]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in made], t) for i, t in enumerate(kinds)], names)

    parts = mapped(gathered, of, "node long, start_word int, n_words int, source_docs array<bigint>, similarity double")
    first = rows.groupBy("node", "check").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.max("n").alias("n"))
    known = first.select("node", F.col("first").alias("doc"))
    in_firsts = parts.join(known, "node").select("doc", "node", "start_word", "n_words", "source_docs", "similarity")
    several = first.filter((F.col("last") > F.col("first")) & (F.col("n") >= min_words)).select("node", "check", "first")
    copies = rows.select("doc", "node", "check", "n").join(several, ["node", "check"]).filter(F.col("doc") > F.col("first")).distinct()
    whole = copies.select("doc", "node", F.lit(0).alias("start_word"), F.col("n").alias("n_words"), F.array("first").alias("source_docs"), F.lit(1.0).alias("similarity"))
    return in_firsts.unionByName(whole), rows


def passages(docs: DataFrame, min_words: int = MIN_WORDS, k: int = K, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, text_key, start_word, n_words, source_doc_ids, similarity of each passage that an earlier document holds too.

    `text_key` tells texts apart that share a doc_id.
    """
    found, _ = _passages(docs, min_words, k, similarity)
    return found.select(
        F.nullif(F.col("doc"), F.lit(NO_ID).cast("long")).alias("doc_id"),
        F.col("node").alias("text_key"),
        "start_word",
        "n_words",
        F.transform("source_docs", lambda d: F.nullif(d, F.lit(NO_ID).cast("long"))).alias("source_doc_ids"),
        "similarity",
    )


def without(text: str, cuts: list[tuple[int, int]]) -> str:
    """A text without words [start, start + n) of each cut, and the blanks up to the next word."""
    raw = text.encode("utf-8", "surrogatepass")
    places = [m.start() for m in WORD.finditer(raw)] + [len(raw)]
    out, at = [], 0
    for start, n in sorted(cuts):
        out.append(raw[at : places[start]])
        at = max(at, places[min(start + n, len(places) - 1)])
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")


def remove_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of `docs` (doc_id, text, n_chars, ...) without their repeated passages; rows that lose all words go.

    A passage is cut from the rows with its doc_id and words, so that other texts of that doc_id stay as they are.
    """
    found, known = _passages(docs, min_words, K, SIMILARITY)
    cuts = found.groupBy("doc", "node").agg(F.collect_list(F.struct("start_word", "n_words")).alias("cuts"))
    texts = known.select("doc", "node", "h").distinct()  # texts of the same words can differ in capitals and blanks
    cuts = staged(cuts.join(texts, ["doc", "node"]).select(F.col("doc").alias("_doc"), F.col("h").alias("_h"), "cuts"), "cuts")
    few = (cuts.agg(F.sum(F.size("cuts") + 1)).first()[0] or 0) <= SMALL_IDS
    text = F.col("_row.text").cast("string")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    keyed = rows.select("_row", F.coalesce(F.col("_row.doc_id").cast("long"), F.lit(NO_ID).cast("long")).alias("_doc"), F.xxhash64(text).alias("_h"))
    both = keyed.join(F.broadcast(cuts) if few else cuts, ["_doc", "_h"], "left")
    same = both.select("_row", text.alias("text"), F.coalesce("cuts", F.array().cast("array<struct<start_word:int,n_words:int>>")).alias("cuts"))

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, cuts = strings(batch.column("text")), strings(batch.column("cuts"))
        made = [without(t, [tuple(c.values()) for c in own]) if own and t is not None else t for t, own in zip(texts, cuts)]
        gone = [bool(own) and not (t or "").strip() for t, own in zip(made, cuts)]
        return pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(made, pa.string()), pa.array(gone, pa.bool_())], ["_row", "text", "gone"])

    kind = same.schema["_row"].dataType.simpleString()
    cleaned = mapped(same, of, f"_row {kind}, text string, gone boolean", TEXTS).filter(~F.col("gone"))
    made = {"text": F.col("text"), "n_chars": F.coalesce(F.length("text").cast("long"), F.col("_row.n_chars") if "n_chars" in docs.columns else F.lit(0))}
    return cleaned.select(*[made[c].alias(c) if c in made else F.col(f"_row.`{c}`") for c in docs.columns])
