"""Phrase collocations: frequent word pairs and triples by mergeable Misra-Gries summaries, then exact counts.

First pass: words are counted per language, and every phrase of two or three
words adds to the mass of its hash partition. Second pass: each task counts the
phrases it sees, by 64-bit hash and hash partition, which is a summary without
error; a partition merges the summaries of all tasks into one whose capacity is
`SLACK` times its mass divided by the threshold. Merging adds counts and, beyond
the capacity, takes the first count that finds no room from all; what was taken
in sum is the error, which stays below the threshold, so that every phrase that
occurs often enough has a count over the threshold less the error. Phrases with
a rarer word can't reach the threshold and are left out from the start. Third
pass: phrases whose hash survived are counted exactly, by their text.

What tasks know of frequent words and surviving phrases is a bit map of at most
`MAP_BITS` bits; a phrase that shares a bit with a survivor is counted and found
too rare, so that the bound on its size costs time and no result. Summaries
travel as packed arrays, one row per task and partition. A partition has about
`PART_MASS` phrases, however large the corpus; a common phrase is one entry per
task.

Defined results: a null or empty text has no words; a null language is `und`;
repeated rows count as often as they occur; ids and other columns don't matter;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstar.llm.common import mix, staged

THRESHOLD = 10
BEST = 2000
#: A candidate goes if a longer one that holds it has at least this percentage of its occurrences.
WITHIN = 50
#: Capacity of a merged summary in units of its mass divided by the threshold.
SLACK = 4
#: Phrases of a hash partition, about.
PART_MASS = 1 << 21
#: Largest bit map of hashes; 16 MiB.
MAP_BITS = 1 << 27
#: Words that a task counts before it sends a summary, and texts it turns into objects at a time.
FLUSH = 1 << 20
TEXTS = 500

_BREAKS = b".,;:!?\n\x0b\x0c\r"
#: A-Z in lower case, breaks as line ends, tabs as blanks; no other byte separates words.
BYTES = bytes(10 if c in _BREAKS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Stands for a break among words; the byte occurs in no UTF-8 text.
BREAK = b"\xff"


def words_of(texts: list[bytes]) -> list[bytes]:
    """Words of all texts in order, with `BREAK` wherever a piece or a text ends."""
    return b"\n".join(texts).translate(BYTES).replace(b"\n", b" " + BREAK + b" ").split()


def _seed(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode()) & ((1 << 63) - 1)


class Bits:
    """A set of hashes by their leading bits; it may hold more than was put in."""

    def __init__(self, packed: np.ndarray):
        self.packed = packed
        self.shift = np.uint64(64 - (len(packed) * 8).bit_length() + 1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes >> self.shift).astype(np.int64)
        return (self.packed[at >> 3] >> (at & 7).astype(np.uint8)) & np.uint8(1) > 0


def bits_for(n: int) -> int:
    """Bits of a map for n hashes, a power of two: at least 16 for each, up to the bound."""
    return int(min(MAP_BITS, max(1 << 10, 1 << (16 * max(1, n) - 1).bit_length())))


class Words:
    """Numbers, hashes and frequency of the words of one language that a task has met."""

    def __init__(self, lang: str, frequent: Bits | None):
        self.lang, self.seed, self.frequent = lang, _seed(lang), frequent
        self.ids: dict[bytes, int] = {BREAK: 0}
        self.runs: list[np.ndarray] = []
        self.n = 0

    def add(self, texts: list[bytes]) -> None:
        words = words_of(texts)
        ids = self.ids
        for word in set(words).difference(ids):
            ids[word] = len(ids)
        self.runs.append(np.fromiter(map(ids.__getitem__, words), dtype=np.int32, count=len(words)))
        self.runs.append(np.zeros(1, dtype=np.int32))
        self.n += len(words)

    def phrases(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For two and three words: the phrases' words as numbers (one row each place) and hashes; rare words are left out."""
        run = np.concatenate(self.runs)
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w, self.seed) for w in self.ids), dtype=np.uint64, count=len(self.ids))
        good = np.ones(len(hashes), dtype=bool) if self.frequent is None else self.frequent.holds(hashes)
        good[0] = False
        ok, h = good[run], hashes[run]
        pair = ok[:-1] & ok[1:]
        two = mix(h[:-1] ^ mix(h[1:] + np.uint64(2)))
        at = np.flatnonzero(pair)
        yield 2, run, at, two[at]
        at = np.flatnonzero(pair[:-1] & ok[2:])
        yield 3, run, at, mix(two[at] ^ mix(h[2:][at] + np.uint64(3)))


def _languages(batches: Iterator[pa.RecordBatch], frequent: Bits | None) -> Iterator[Words]:
    """The words of a task's texts, language by language, whenever `FLUSH` words have come together, and at the end."""
    held: dict[str, Words] = {}
    for batch in batches:
        for start in range(0, batch.num_rows, TEXTS):
            part = batch.slice(start, TEXTS)
            texts = part.column("text").cast(pa.binary())
            langs = part.column("lang").fill_null("und")
            for lang in langs.unique().to_pylist():
                words = held.setdefault(lang, Words(lang, frequent))
                words.add(texts.filter(pc.equal(langs, lang)).fill_null(b"").to_pylist())
            while sum(w.n for w in held.values()) >= FLUSH:
                yield held.pop(max(held, key=lambda lang: held[lang].n))
    yield from (w for w in held.values() if w.n)


def _parts_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The hash partition of each hash: equal stretches in ascending order."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def count_words(docs: DataFrame, fine: int) -> DataFrame:
    """Occurrences of each word per language, with the words' hashes; and, as rows without a word, each fine hash partition's mass of phrases."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass = np.zeros(fine, dtype=np.int64)
        names = ["lang", "word", "part", "n"]
        for words in _languages(batches, None):
            for _, _, _, hashes in words.phrases():
                mass += np.bincount(_parts_of(hashes, fine), minlength=fine)
            n = np.bincount(np.concatenate(words.runs), minlength=len(words.ids))[1:]
            found = pa.array(list(words.ids)[1:], pa.binary())
            for at in range(0, len(n), 1 << 16):
                some = found[at : at + (1 << 16)]
                columns = [pa.array([words.lang] * len(some)), some.cast(pa.string()), pa.nulls(len(some), pa.int32()), pa.array(n[at : at + (1 << 16)])]
                yield pa.RecordBatch.from_arrays(columns, names)
        at = np.flatnonzero(mass)
        columns = [pa.nulls(len(at), pa.string()), pa.nulls(len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(mass[at])]
        yield pa.RecordBatch.from_arrays(columns, names)

    counted = docs.mapInArrow(count, "lang string, word string, part int, n long")
    return counted.groupBy("lang", "word", "part").agg(F.sum("n").alias("n"))


def bit_map(hashes: DataFrame, n: int) -> Bits:
    """The bit map of a column `h` of hashes: executors fill slices of it, and the driver joins them (`MAP_BITS` at most)."""
    bits = bits_for(n)
    shift = np.uint64(64 - bits.bit_length() + 1)
    slice_bits = min(bits, 1 << 20)

    def fill(table: pa.Table) -> pa.Table:
        number = table.column("slice")[0].as_py()
        flags = np.zeros(slice_bits, dtype=bool)
        flags[table.column("bit").to_numpy() - number * slice_bits] = True
        return pa.table({"slice": pa.array([number], pa.int64()), "bits": pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())})

    bit = F.shiftrightunsigned("h", int(shift))
    # one row per bit: a slice is a group of at most as many rows as it has bits
    at = hashes.select(bit.alias("bit")).distinct().select((F.col("bit") / slice_bits).cast("long").alias("slice"), "bit")
    packed = np.zeros(bits // 8, dtype=np.uint8)
    for row in at.groupBy("slice").applyInArrow(fill, "slice long, bits binary").collect():
        start = row["slice"] * slice_bits // 8
        packed[start : start + slice_bits // 8] = np.frombuffer(row["bits"], dtype=np.uint8)
    return Bits(packed)


def summaries(docs: DataFrame, frequent: Broadcast, parts: int) -> DataFrame:
    """Each task's counts of phrases by hash partition: sorted hashes and their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _languages(batches, frequent.value):
            hashes, n = np.unique(np.concatenate([h for _, _, _, h in words.phrases()]), return_counts=True)
            part = _parts_of(hashes, parts)
            numbers, starts = np.unique(part, return_index=True)
            ends = np.append(starts[1:], len(part))
            for at in range(0, len(numbers), 256):
                some = list(zip(starts[at : at + 256], ends[at : at + 256]))
                columns = [
                    pa.array(numbers[at : at + 256].astype(np.int32)),
                    pa.array([hashes[i:j].tobytes() for i, j in some], pa.binary()),
                    pa.array([n[i:j].astype(np.uint32).tobytes() for i, j in some], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["part", "hashes", "counts"])

    return docs.mapInArrow(count, "part int, hashes binary, counts binary")


class Summary:
    """A Misra-Gries summary: hashes, what is left of their counts, and what was taken from all."""

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.hashes, self.counts = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        """Merge with the next summaries, as soon as they are as many as those that are held."""
        self.waiting.append((hashes, counts))
        self.size += len(hashes)
        if self.size >= max(1 << 18, len(self.hashes)):
            self.fold()

    def fold(self) -> None:
        if self.waiting:
            hashes, counts = (np.concatenate(x) for x in zip(*self.waiting))
            self.waiting, self.size = [], 0
            self.merge(hashes, counts)

    def merge(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        """Add another summary's counts; beyond the capacity take the largest count without room from all."""
        both = np.concatenate([self.hashes, hashes])
        self.hashes, place = np.unique(both, return_inverse=True)
        self.counts = np.bincount(place, weights=np.concatenate([self.counts, counts.astype(np.int64)])).astype(np.int64)
        over = len(self.hashes) - self.capacity
        if over > 0:
            taken = int(np.partition(self.counts, over - 1)[over - 1])
            self.error += taken
            self.counts -= taken
            left = self.counts > 0
            self.hashes, self.counts = self.hashes[left], self.counts[left]

    def at_least(self, threshold: int) -> np.ndarray:
        """Hashes that may have occurred so often; all that did are among them while the error is below the threshold."""
        self.fold()
        if self.error >= threshold:
            raise AssertionError("a summary's capacity is too small for its mass")
        return self.hashes[self.counts + self.error >= threshold]


def survivors(sent: DataFrame, capacities: Broadcast, parts: int, threshold: int) -> DataFrame:
    """Hashes of phrases that may reach the threshold, from each partition's merged summary."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged: dict[int, Summary] = {}
        for batch in batches:
            for at in range(batch.num_rows):
                number, hashes, counts = (batch.column(i)[at].as_py() for i in range(3))
                if number not in merged:
                    merged[number] = Summary(int(capacities.value[number]))
                merged[number].add(np.frombuffer(hashes, np.uint64), np.frombuffer(counts, np.uint32))
        for summary in merged.values():
            found = summary.at_least(threshold).view(np.int64)
            for at in range(0, len(found), 1 << 18):
                yield pa.RecordBatch.from_arrays([pa.array(found[at : at + (1 << 18)])], ["h"])

    # the number of a hash partition is that of the Spark partition, so that a task merges one
    return sent.repartitionById(parts, F.col("part")).mapInArrow(merge, "h long")


def count_phrases(docs: DataFrame, frequent: Broadcast, survived: Broadcast, threshold: int) -> DataFrame:
    """Exact counts of the phrases at or over the threshold: lang, phrase, words, a."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _languages(batches, frequent.value):
            text = list(words.ids)
            for size, run, at, hashes in words.phrases():
                at = at[survived.value.holds(hashes)]
                if not len(at):
                    continue
                places = [run[at + k].astype(np.int64) for k in range(size)]
                code = places[0] * len(text) + places[1]
                if size == 3:
                    code = np.unique(code, return_inverse=True)[1] * len(text) + places[2]
                _, where, n = np.unique(code, return_index=True, return_counts=True)
                phrases = np.stack([place[where] for place in places], axis=1)
                for start in range(0, len(n), 1 << 16):
                    some = phrases[start : start + (1 << 16)].tolist()
                    columns = [
                        pa.array([words.lang] * len(some)),
                        pa.array([b" ".join([text[i] for i in row]) for row in some], pa.binary()).cast(pa.string()),
                        pa.array(n[start : start + (1 << 16)]),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "n"])

    counted = docs.mapInArrow(count, "lang string, phrase string, n long")
    return counted.groupBy("lang", "phrase").agg(F.sum("n").alias("a")).filter(F.col("a") >= threshold)


def score(candidates: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """Each candidate's lowest-scoring cut. Products are decimals of up to 38 digits."""
    w = F.split("phrase", " ")
    split = candidates.withColumn("w", w)
    pairs = split.filter(F.size("w") == 2).select("lang", "phrase", "a", F.lit(1).alias("k"), F.get("w", F.lit(0)).alias("left"), F.get("w", F.lit(1)).alias("right"))
    triples = split.filter(F.size("w") == 3)
    cuts = F.array(
        *(
            F.struct(
                F.lit(k).alias("k"),
                F.concat_ws(" ", F.slice("w", 1, k)).alias("left"),
                F.concat_ws(" ", F.slice("w", k + 1, 3 - k)).alias("right"),
            )
            for k in (1, 2)
        )
    )
    cut = pairs.unionByName(triples.select("lang", "phrase", "a", F.inline(cuts)))
    # a part is a frequent word or a frequent pair; its count is looked up by language and text
    parts = words.select("lang", F.col("word").alias("part"), "n").unionByName(
        split.filter(F.size("w") == 2).select("lang", F.col("phrase").alias("part"), F.col("a").alias("n"))
    )
    left = parts.select("lang", F.col("part").alias("left"), F.col("n").alias("l"))
    right = parts.select("lang", F.col("part").alias("right"), F.col("n").alias("r"))
    known = cut.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    wide = "cast({} as decimal(15,0))".format
    ratio = F.expr(f"cast({wide('a')} * {wide('a')} * cast(1000000 as decimal(7,0)) div ({wide('l')} * {wide('r')}) as long)")
    lowest = F.min(F.struct(ratio.alias("score"), "k", "l", "r")).alias("cut")
    scored = known.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    return scored.join(totals, "lang")


def drop_parts(scored: DataFrame, within: int) -> DataFrame:
    """Candidates without those that a longer one holds nearly as often."""
    w = F.split("phrase", " ")
    triples = scored.select("lang", "a", w.alias("w")).filter(F.size("w") == 3)
    inside = triples.select("lang", "a", F.explode(F.array(F.concat_ws(" ", F.slice("w", 1, 2)), F.concat_ws(" ", F.slice("w", 2, 2)))).alias("phrase"))
    longer = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    held = scored.join(longer, ["lang", "phrase"], "left")
    return held.filter(F.col("longer").isNull() | (100 * F.col("longer") < within * F.col("a"))).drop("longer")


def best_of(scored: DataFrame, best: int) -> DataFrame:
    """The first phrases of each language. Each language is ranked in slices by hash first, so that no task sorts it whole."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    slices = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = scored.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(slices)))
    near = sliced.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).filter(F.col("rank") <= best)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= best)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, best: int = BEST, within: int = WITHIN, part_mass: int = PART_MASS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first phrases."""
    spark: SparkSession = docs.sparkSession
    texts = docs.select(F.col("lang").cast("string"), "text")
    fine = 1 << 12
    counted = staged(count_words(texts, fine), "phrase-words")
    words = counted.filter("part IS NULL")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    often = words.filter(F.col("n") >= threshold)
    mass = np.zeros(fine, dtype=np.int64)
    for row in counted.filter("part IS NOT NULL").select("part", "n").collect():  # one row per fine partition
        mass[row["part"]] = row["n"]
    # the number of hash partitions divides or multiplies the fine ones, so that their masses bound those of the parts
    parts = 1
    while parts < max(int(spark.conf.get("spark.sql.shuffle.partitions")), mass.sum() / part_mass) and parts < 1 << 20:
        parts *= 2
    masses = mass.reshape(parts, -1).sum(axis=1) if parts <= fine else np.repeat(mass, parts // fine)
    capacities = spark.sparkContext.broadcast(SLACK * (masses // threshold + 1))
    frequent = spark.sparkContext.broadcast(bit_map(hashes_of_words(often), often.count()))
    survived = staged(survivors(summaries(texts, frequent, parts), capacities, parts, threshold), "phrase-survivors")
    kept = spark.sparkContext.broadcast(bit_map(survived, survived.count()))
    candidates = staged(count_phrases(texts, frequent, kept, threshold), "phrase-counts")
    return best_of(drop_parts(score(candidates, often.select("lang", "word", "n"), totals), within), best)


def hashes_of_words(words: DataFrame) -> DataFrame:
    """The hashes of words as tasks compute them."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("lang").to_pylist(), batch.column("word").cast(pa.binary()).to_pylist())
            seeds: dict[str, int] = {}
            out = [xxhash.xxh3_64_intdigest(word, seeds.get(lang) or seeds.setdefault(lang, _seed(lang))) for lang, word in pairs]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(out, dtype=np.uint64).view(np.int64))], ["h"])

    return words.select("lang", "word").mapInArrow(hashed, "h long")
