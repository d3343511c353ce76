"""Best-fit packing by minimum bin slack.

Documents become token pieces of at most `capacity` tokens. Only the number of
pieces of each length matters for packing, so the plan is made from a histogram
of at most `capacity` rows: each bin takes the longest piece left, and a bitset
subset-sum over the lengths left finds the fullest combination for the rest of
it. That combination is removed as often as the counts allow, which is what
repeating the search would do. Ranks within a length then tell every piece its
bin and place, so the pieces themselves never leave the executors.

Defined results: a null or empty text is the end token alone; a null or
repeated doc_id, or a repeated row, is packed like any other; columns other
than the two named are not read; an empty table gives no rows. A very long
text is cut into full pieces, the last of which may be shorter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import TEXTS, mapped, staged, strings

END_ID = 0
CAPACITY = 2048
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"
PIECES_PER_BUCKET = 20_000


class WordIds:
    """Token ids of blank-separated words as little-endian bytes, each distinct word encoded once while it is kept.

    The tokenizer drops blanks and never joins across them, so a text's ids are
    those of its words in order. Plain Latin words go through the same merges
    without the normaliser; all others through the tokenizer as it is.
    """

    KEEP = 400_000
    PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?|%&*$#\"()\[\]-]*)")
    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer, models, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.fast = None
        model, kinds = spec["model"], [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        if kinds == ["NFC", "Replace", "Lowercase"] and model.get("end_of_word_suffix") == "</w>":
            merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
            self.fast = Tokenizer(models.BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix="</w>", cache_capacity=0))
            self.fast.pre_tokenizer = pre_tokenizers.Sequence(
                [pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
            )
            ends = [i for token, i in model["vocab"].items() if token.endswith("</w>")]
            self.ends = np.zeros(max(model["vocab"].values()) + 1, dtype=bool)
            self.ends[ends] = True
        self.words: dict[bytes, bytes] = {}
        self.runs: dict[str, bytes] = {}

    def _encode_runs(self, runs: list[str]) -> None:
        """Runs of letters or of signs are one word of the model each, which its last token tells."""
        for at in range(0, len(runs), 2000):
            part = runs[at : at + 2000]
            ids = np.array(self.fast.encode(" ".join(part), add_special_tokens=False).ids, dtype="<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part):
                raise ValueError("a run of letters did not end in one end-of-word token")
            raw, begin = ids.tobytes(), 0
            for run, cut in zip(part, cuts.tolist()):
                self.runs[run] = raw[4 * begin : 4 * cut]
                begin = cut

    def learn(self, words: set[bytes]) -> None:
        """Encode the words, given in UTF-8, that are not kept yet."""
        if len(self.words) > self.KEEP:
            self.words.clear()
        if len(self.runs) > self.KEEP:
            self.runs.clear()
        plain, rest, wanted, runs = [], [], set(), self.runs
        match = self.PLAIN.fullmatch if self.fast else lambda word: None
        for raw in words.difference(self.words):
            word = raw.decode("utf-8", "surrogatepass")
            m = match(word)
            if m:
                letters, signs = m.groups()
                letters = letters.lower()
                plain.append((raw, letters, signs))
                if letters not in runs:
                    wanted.add(letters)
                if signs and signs not in runs:
                    wanted.add(signs)
            else:
                rest.append(word)
        if wanted:
            self._encode_runs(list(wanted))
        runs[""] = b""
        for raw, letters, signs in plain:
            self.words[raw] = runs[letters] + runs[signs]
        for at in range(0, len(rest), 2000):
            part = rest[at : at + 2000]
            for word, made in zip(part, self.whole.encode_batch_fast(part, add_special_tokens=False)):
                self.words[word.encode("utf-8", "surrogatepass")] = np.array(made.ids, dtype="<u4").tobytes()

    def of(self, texts: list[bytes | None]) -> list[bytes]:
        """Ids of texts in UTF-8; bytes know no other blanks than ASCII's."""
        out = []
        for at in range(0, len(texts), 500):
            split = [t.split() if t else [] for t in texts[at : at + 500]]
            self.learn(set().union(*split))
            get = self.words.__getitem__
            out += [b"".join(map(get, ws)) for ws in split]
        return out


_kept: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One instance for each worker process."""
    if path not in _kept:
        _kept[path] = WordIds(path)
    return _kept[path]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Cut the ids of each text and the end token into pieces; a piece's ids are told by their CRC-32."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows: list[list] = [[], [], [], [], []]
        encoded = word_ids(tokenizer).of(strings(batch.column("text").cast(pa.binary())))
        for doc_id, ids in zip(strings(batch.column("doc_id")), encoded):
            ids = memoryview(ids + end)
            for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at : at + 4 * capacity]
                for column, value in zip(rows, (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part))):
                    column.append(value)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return mapped(docs.select("doc_id", F.col("text").cast("string").alias("text")), cut, PIECES, TEXTS)


def fullest(available: dict[int, int], room: int) -> dict[int, int]:
    """The lengths, with their numbers, that fill most of the room: bounded subset sums as bits of one integer."""
    mask = (1 << (room + 1)) - 1
    reach, steps, full = 1, [], 1 << room
    for length in sorted((x for x in available if x <= room), reverse=True):
        left, chunk = min(available[length], room // length), 1
        while left:
            take = min(chunk, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, chunk = left - take, chunk * 2
        if reach & full:
            break
    at, chosen = reach.bit_length() - 1, Counter()
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            chosen[length] += take
            at -= length * take
    return dict(chosen)


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Combinations of lengths and how many bins take each; together they use every piece once."""
    left, plan = {k: v for k, v in histogram.items() if v > 0}, []
    while left:
        longest = max(left)
        others = dict(left)
        others[longest] -= 1
        combination = Counter(fullest({k: v for k, v in others.items() if v}, capacity - longest))
        combination[longest] += 1
        times = min(left[k] // n for k, n in combination.items())
        plan.append((dict(combination), times))
        for k, n in combination.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return plan


def _slots(plan: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """For each length, ranges of ranks: first rank, pieces to a bin, first bin, first offset."""
    ranges: dict[int, list[tuple[int, int, int, int]]] = {}
    used: Counter = Counter()
    bins = 0
    for combination, times in plan:
        offset = 0
        for length in sorted(combination, reverse=True):
            n = combination[length]
            ranges.setdefault(length, []).append((used[length], n, bins, offset))
            used[length] += n * times
            offset += n * length
        bins += times
    return {k: np.array(v, dtype=np.int64) for k, v in ranges.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give each row of `pieces` (with a `length` from 1 to capacity) its sequence_id and offset."""
    pieces = staged(pieces, "pieces")
    lengths = pieces.groupBy("length").count().collect()  # at most `capacity` rows
    total = sum(r["count"] for r in lengths)
    slots = _slots(plan_bins({r["length"]: r["count"] for r in lengths}, capacity))
    buckets = max(16, total // PIECES_PER_BUCKET)
    fields = pieces.columns
    held = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*fields), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = held.groupBy("length", "_bucket").count()
    offsets = sizes.select("length", "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy("length", "_bucket").orderBy(*fields)
    ranked = held.withColumn("_rank", F.row_number().over(own)).join(offsets, ["length", "_bucket"])
    ranked = ranked.select(*fields, (F.col("_rank") + F.col("_before") - 1).alias("_rank"))

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
        sequence, offset = np.empty_like(rank), np.empty_like(rank)
        for value in np.unique(length):
            at = np.flatnonzero(length == value)
            r = slots[int(value)]
            i = np.searchsorted(r[:, 0], rank[at], side="right") - 1
            rel = rank[at] - r[i, 0]
            sequence[at] = r[i, 2] + rel // r[i, 1]
            offset[at] = r[i, 3] + rel % r[i, 1] * value
        kept = [batch.column(f) for f in fields]
        return pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*fields, "sequence_id", "offset"])

    kinds = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes)
    return mapped(ranked, place, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(token_pieces(docs, tokenizer, capacity, end_id), capacity)
