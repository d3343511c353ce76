"""Weak-label quality model: labellers, expectation-maximisation, and a hashed linear scorer.

Overlapping heuristic labellers vote on two aspects of a text, `junk` and
`toxic`: reject, keep, or abstain. The votes of all texts are counted by
pattern, of which there are at most 3^labellers. Expectation-maximisation over
these counts gives the share of texts to reject and how often each labeller
votes what in either class. The posterior of its pattern labels a text. All
texts with these labels train a logistic scorer over hashed words and text
statistics, in shards of about `sample` texts: a task trains on each shard, and
the scorer's weights are the means of the shards' by their texts. It then
scores every text, and so also catches what no labeller knows.

Two toxic labellers learn their words from all labelled texts: words of at
least `min_texts` toxic texts of a language and of a tenth of these, that are
much commoner there than in its other texts. A language has at most ten times
as many as its toxic texts have distinct words on average.

Defined results: a null or empty text has no words, every labeller abstains,
and it is kept; repeated rows are scored alike; without labels the learned
list is empty; without texts to learn from nothing is rejected; other columns
are kept as they are; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tillstar.llm.common import TEXTS, mapped, staged, strings, words_of

#: Texts of a shard, on which one task trains.
SAMPLE = 20_000
BUCKETS = 1 << 18
STATS = 8
MIN_TEXTS = 5
#: Labelled doc_ids (16 bytes each) that are broadcast.
SMALL_IDS = 1_000_000
#: Place of the scorer's constant among its weights.
BIAS = -1
ASPECTS = ("junk", "toxic")
#: A short list of insults in the languages of the corpus.
INSULTS = frozenset(
    b"asshole bastard clown crap disgusting dumb fool garbage idiot imbecile jerk loser moron pathetic scum stupid trash ugly worthless "
    b"arschloch dummkopf abschaum connard imbecile ordure idiota basura escoria".split()
)
CAPITALS = bytes(range(0x41, 0x5B))
EDGES = b".,;:!?\"'()[]{}*#%&$|<>-_"
SIGNS = bytes(sorted(set(range(0x21, 0x7F)) - set(b"abcdefghijklmnopqrstuvwxyz0123456789.,;:!?'\"-()")))


class Facts:
    """What the labellers look at, from one pass over a text."""

    def __init__(self, text: str | None, learned: frozenset[bytes]):
        cased = text.encode("utf-8", "surrogatepass") if text else b""
        raw = cased.lower()
        words = raw.split()
        self.n = len(words)
        bare = [w.strip(EDGES) for w in words]
        kinds = set(bare)
        kinds.discard(b"")
        self.kinds = kinds
        self.insults = sum(1 for w in bare if w in INSULTS) if not kinds.isdisjoint(INSULTS) else 0
        self.learned = sum(1 for w in bare if w in learned) if learned and not kinds.isdisjoint(learned) else 0
        self.bad_kinds = len(kinds & (INSULTS | learned))
        size = max(1, len(raw))
        self.signs = (len(raw) - len(raw.translate(None, SIGNS))) / size
        self.bare_signs = bare.count(b"") / max(1, self.n)
        self.runs = sum(raw.count(x) for x in (b"%%%", b"###", b"$$$", b"&&&", b"***", b"!!", b"??", b"@@@", b"^^^", b"~~~")) / max(1, self.n)
        lines = raw.split(b"\n")
        self.repeats = 1 - len(set(lines)) / len(lines) if len(lines) > 3 else 0.0
        self.width = len(raw) / max(1, self.n)
        self.loops = sum(map(bytes.__eq__, bare, bare[1:])) / max(1, self.n)
        self.shout = (len(cased) - len(cased.translate(None, CAPITALS))) / max(1, len(raw) - len(raw.translate(None, CAPITALS.lower())))


def _band(value: float, keep_under: float, reject_over: float) -> int:
    """1 reject, 0 keep, -1 abstain."""
    return 1 if value > reject_over else 0 if value < keep_under else -1


def votes(f: Facts) -> dict[str, list[int]]:
    """Each labeller's vote, by aspect. Labellers of an aspect overlap; none is trusted alone."""
    if not f.n:
        return {"junk": [-1] * 7, "toxic": [-1] * 4}
    return {
        "junk": [
            _band(f.signs, 0.01, 0.05),
            _band(f.bare_signs, 0.002, 0.05),
            _band(f.runs, 0.002, 0.05),
            _band(f.repeats, 0.1, 0.4),
            _band(f.width, 20.0, 40.0),
            _band(f.loops, 0.03, 0.2),
            _band(f.shout, 0.2, 0.6),
        ],
        "toxic": [
            _band(f.insults, 1, 0.5),
            _band(f.learned, 1.5, 1.5),
            _band(f.bad_kinds, 1.5, 1.5),
            _band((f.insults + f.learned) / f.n, 0.0005, 0.004) if f.insults + f.learned > 1 else 0,
        ],
    }


def fit_em(patterns: dict[tuple[int, ...], int], rounds: int = 100, prior: float = 0.1, false_alarms: float = 0.001) -> tuple[float, np.ndarray]:
    """Share of rejects, and P(vote | class) as [labeller, class, vote + 1]; class 1 is reject.

    Starts from labellers that are mostly right, and smooths every count by one.
    No labeller rejects more than a share `false_alarms` of the texts to keep:
    labellers that know different faults seldom agree, and without this bound
    their votes would pass for noise.
    """
    keys = np.array(list(patterns), dtype=int) + 1
    n = np.array(list(patterns.values()), dtype=float)
    if not len(keys) or not n.sum():
        return prior, np.full((0, 2, 3), 1 / 3)
    labellers = keys.shape[1]
    p = np.empty((labellers, 2, 3))
    p[:, 0], p[:, 1] = [0.3, 0.7 - false_alarms, false_alarms], [0.3, 0.4, 0.3]
    for _ in range(rounds):
        post = posterior(keys - 1, prior, p)
        prior = float((n * post).sum() / n.sum())
        prior = min(max(prior, 1e-6), 0.5)
        for c, w in ((0, n * (1 - post)), (1, n * post)):
            for j in range(labellers):
                counts = np.bincount(keys[:, j], weights=w, minlength=3) + 1.0
                p[j, c] = counts / counts.sum()
        p[:, 0, 2] = np.minimum(p[:, 0, 2], false_alarms)
        p[:, 0] /= p[:, 0].sum(axis=1, keepdims=True)
    return prior, p


def posterior(keys: np.ndarray, prior: float, p: np.ndarray) -> np.ndarray:
    """P(reject | votes) of each row of votes."""
    logs = np.zeros((len(keys), 2)) + np.log([1 - prior, prior])
    for j in range(p.shape[0]):
        logs += np.log(p[j][:, keys[:, j] + 1]).T
    gap = np.clip(logs[:, 0] - logs[:, 1], -500, 500)
    return 1 / (1 + np.exp(gap))


def features(f: Facts) -> np.ndarray:
    """Buckets of the distinct words, and of text statistics by size."""
    words = np.fromiter((xxhash.xxh3_64_intdigest(w) % BUCKETS for w in f.kinds), dtype=np.int64, count=len(f.kinds))
    sizes = (f.signs * 50, f.bare_signs * 50, f.runs * 50, f.repeats * 8, f.width / 6, f.loops * 20, f.shout * 8, f.bad_kinds)
    stats = [BUCKETS + i * STATS + min(STATS - 1, int(x)) for i, x in enumerate(sizes)]
    return np.unique(np.concatenate([words, stats])).astype(np.int32)


WIDTH = BUCKETS + 8 * STATS


def train(rows: list[np.ndarray], targets: np.ndarray, rounds: int = 150, rate: float = 0.05, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, by Adam over all rows; each has a feature at least."""
    weights, bias = np.zeros(WIDTH), 0.0
    if not rows:
        return weights, -10.0
    sizes = np.array([len(r) for r in rows])
    seen, index = np.unique(np.concatenate(rows), return_inverse=True)
    begins = np.cumsum(sizes) - sizes
    by_feature = np.argsort(index, kind="stable")
    of = np.repeat(np.arange(len(rows)), sizes)[by_feature]
    first = np.searchsorted(index[by_feature], np.arange(len(seen)))
    share = min(max(float(targets.mean()), 1e-3), 1 - 1e-3)
    bias = math.log(share / (1 - share))
    own, m, v, mb, vb = np.zeros(len(seen)), np.zeros(len(seen)), np.zeros(len(seen)), 0.0, 0.0
    for t in range(1, rounds + 1):
        z = np.add.reduceat(own[index], begins) + bias
        gap = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - targets
        g = np.add.reduceat(gap[of], first) / len(rows) + decay * own
        gb = float(gap.mean())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        scale = rate * math.sqrt(1 - 0.999**t) / (1 - 0.9**t)
        own -= scale * m / (np.sqrt(v) + 1e-7)
        bias -= scale * mb / (math.sqrt(vb) + 1e-7)
    weights[seen] = own
    return weights, bias


def _sampled(docs: DataFrame, n: int, sample: int) -> DataFrame:
    """About `sample` of n rows, each by itself, so that rows which share or lack an id come in proportion."""
    return docs if n <= sample else docs.filter(F.rand(7) < sample / n)


def learn_words(docs: DataFrame, labels: DataFrame | None, min_texts: int = MIN_TEXTS) -> frozenset[bytes]:
    """Words that toxic texts have far more often than others, from all labelled texts."""
    if labels is None:
        return frozenset()
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = staged(known, "known")
    chosen = docs.join(F.broadcast(known) if known.count() <= SMALL_IDS else known, "doc_id")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen: dict[tuple, Counter] = {}
        for text, lang, toxic in zip(*(strings(batch.column(c)) for c in ("text", "lang", "toxic"))):
            seen.setdefault((lang, toxic == 1), Counter()).update({w.strip(EDGES) for w in words_of(text)} | {b""})
        rows = [(lang, w, n if t else 0, 0 if t else n) for (lang, t), c in seen.items() for w, n in c.items()]
        kinds = (pa.string(), pa.binary(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["lang", "word", "bad", "good"])

    counted = mapped(chosen.select("text", "lang", "toxic"), count, "lang string, word binary, bad long, good long", TEXTS)
    counted = staged(counted.groupBy("lang", "word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")), "words")
    whole = counted.filter(F.col("word") == F.lit(b"")).select("lang", F.col("bad").alias("all_bad"), F.col("good").alias("all_good"))
    share = F.col("bad") / F.col("all_bad")
    ratio = share / ((F.col("good") + 0.5) / F.col("all_good"))
    strong = counted.join(whole, "lang").filter((F.length("word") > 1) & (F.col("bad") >= min_texts) & (F.col("all_good") > 0))
    strong = strong.filter((share >= 0.1) & (ratio >= 20)).select("word").distinct()
    return frozenset(bytes(r["word"]) for r in strong.collect())


class Model:
    def __init__(self, learned: frozenset[bytes], em: dict, scorer: dict):
        self.learned, self.em, self.scorer = learned, em, scorer

    def score(self, f: Facts) -> dict[str, float]:
        if not f.n:
            return dict.fromkeys(ASPECTS, 0.0)
        at, out = features(f), {}
        for aspect in ASPECTS:
            weights, bias = self.scorer[aspect]
            out[aspect] = 1 / (1 + math.exp(-max(-50.0, min(50.0, float(weights[at].sum()) + bias))))
        return out


def trained(described: DataFrame, known: dict[str, dict[str, float]], n: int, sample: int = SAMPLE) -> dict[str, tuple[np.ndarray, float]]:
    """The scorer of each aspect, from all rows (at, and the pattern of each aspect) with words, in shards of about `sample`.

    `known` has the probability that each pattern stands for. A task holds one shard, and a weight goes to the driver once.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[np.ndarray] = []
        targets: dict[str, list[float]] = {a: [] for a in ASPECTS}
        for batch in batches:
            rows += [np.asarray(x.values, dtype=np.int64) for x in batch.column("at")]
            for aspect in ASPECTS:
                targets[aspect] += [known[aspect][p] for p in strings(batch.column(aspect))]
        if not rows:
            return
        # Adam carries the order of sums far, and rows arrive in any
        order = sorted(range(len(rows)), key=lambda i: (rows[i].tobytes(), *(targets[a][i] for a in ASPECTS)))
        rows, seen = [rows[i] for i in order], np.unique(np.concatenate(rows))
        for aspect in ASPECTS:
            weights, bias = train(rows, np.array(targets[aspect])[order])
            at, own = np.append(seen, BIAS), np.append(weights[seen], bias)
            made = [pa.array([aspect] * len(at)), pa.array(at), pa.array(own), pa.array(np.full(len(at), len(rows)))]
            yield pa.RecordBatch.from_arrays(made, ["aspect", "at", "weight", "n"])

    dealt = described.filter(F.size("at") > 0).repartition(max(1, math.ceil(n / sample)))
    shards = dealt.mapInArrow(over, "aspect string, at long, weight double, n long")
    summed = shards.groupBy("aspect", "at").agg(F.sum(F.col("weight") * F.col("n")).alias("weight"), F.sum("n").alias("n")).toArrow()
    out = {}
    for aspect in ASPECTS:
        own = summed.filter(pc.equal(summed.column("aspect"), aspect))
        at, total, texts = (own.column(c).to_numpy() for c in ("at", "weight", "n"))
        if not len(at):
            out[aspect] = train([], np.zeros(0))
            continue
        every = float(texts[at == BIAS][0])  # a shard without a word weighs it 0
        weights = np.zeros(WIDTH)
        weights[at[at != BIAS]] = total[at != BIAS] / every
        out[aspect] = weights, float(total[at == BIAS][0]) / every
    return out


def fit(docs: DataFrame, labels: DataFrame | None, sample: int = SAMPLE) -> Model:
    """Votes of all texts, then both models."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"), lang.alias("lang"))
    learned = learn_words(texts, labels)

    def describe(batch: pa.RecordBatch) -> pa.RecordBatch:
        at, patterns = [], {a: [] for a in ASPECTS}
        for text in strings(batch.column("text")):
            f = Facts(text, learned)
            at.append(features(f) if f.n else np.zeros(0, dtype=np.int32))
            for aspect, v in votes(f).items():
                patterns[aspect].append(",".join(map(str, v)))
        cols = [pa.array(at, pa.list_(pa.int32())), *[pa.array(patterns[a], pa.string()) for a in ASPECTS]]
        return pa.RecordBatch.from_arrays(cols, ["at", *ASPECTS])

    described = staged(mapped(texts.select("text"), describe, "at array<int>, junk string, toxic string", TEXTS), "described")
    known, em, n = {}, {}, 0
    for aspect in ASPECTS:
        counted = {r[0]: r["count"] for r in described.groupBy(aspect).count().collect()}  # at most 3^7 and 3^4 rows
        patterns = {tuple(map(int, p.split(","))): times for p, times in counted.items()}
        em[aspect], n = fit_em(patterns), sum(counted.values())
        keys = np.array(list(patterns), dtype=int)
        known[aspect] = dict(zip(counted, posterior(keys, *em[aspect]).tolist())) if counted else {}
    return Model(learned, em, trained(described, known, n, sample))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` as struct `row`, with junk and toxic scores from 0 to 1."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    # a string text crosses to the workers once, inside the row; a text of another type goes beside it as a string
    apart = not isinstance(docs.schema["text"].dataType, StringType)
    whole = docs.select(row, F.col("text").cast("string").alias("text")) if apart else docs.select(row)

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = shared.value
        texts = batch.column("text") if apart else pc.struct_field(batch.column("row"), "text")
        made = [own.score(Facts(t, own.learned)) for t in strings(texts)]
        cols = [pa.array([m[a] for m in made], pa.float64()) for a in ASPECTS]
        return pa.RecordBatch.from_arrays([batch.column("row"), *cols], ["row", *ASPECTS])

    kind = whole.schema["row"].dataType.simpleString()
    return mapped(whole, over, f"row {kind}, junk double, toxic double", TEXTS)


def classify(docs: DataFrame, labels: DataFrame | None, sample: int = SAMPLE, cut: float = 0.5) -> DataFrame:
    """`row`, both scores, and `rejected`: whether one of them is over the cut."""
    scored = score(docs, fit(docs, labels, sample))
    return scored.withColumn("rejected", (F.col("junk") > cut) | (F.col("toxic") > cut))
