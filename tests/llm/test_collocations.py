"""Collocations against brute force, and what the summaries guarantee."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import compare, database

from tillstar.llm import collocations

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, a long, l string, r int, n long, score string, `rank` int, word string, part int, h long"


def brute(rows, threshold=10, best=2000, within=50):
    counts = defaultdict(Counter)
    for lang, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts["und" if lang is None else lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= threshold}
        scored = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and p in (q[:2], q[1:]) and 100 * b >= within * a for q, b in candidates.items()):
                continue
            score, _, left, right = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for i, (s, a, phrase, left, right) in enumerate(sorted(scored)[:best]):
            out.append((lang, i + 1, phrase.decode(), -a, left, right, n, -s))
    return sorted(out)


def texts(seed, n=150):
    made = random.Random(seed)
    vocabulary = [f"w{int(made.paretovariate(0.8)) % 60}" for _ in range(500)] + ["É", "é", "semi word"]
    rows = []
    for i in range(n):
        words = [w + made.choice(["", "", "", "", ",", ".", "!", "\n", "\t", "\r\n", "\x0b"]) for w in made.choices(vocabulary, k=made.choice([1, 2, 40, 90]))]
        rows.append((made.choice(["en", "en", "de", None, ""]), " ".join(words)))
    fixed = "alpha beta gamma. Alpha Beta gamma! ALPHA beta"
    return rows + [("en", fixed)] * 12 + [("en", None), (None, ""), ("de", " \n.,"), ("fr", "one two"), ("und", "x y x y x y " * 40)]


def frame(spark, rows):
    return spark.createDataFrame([(i % 9, t, lang, 1, "l", 1, 1, "s", 1, "w", 1, 1) for i, (lang, t) in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(collocations, "FLUSH", 700)
    rows = texts(seed)
    got = collocations.collocations(frame(spark, rows).repartition(3), part_mass=500)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for _, t in got.dtypes} == {"string", "bigint"}
    want = brute(rows)
    assert len(want) > 20
    assert sorted(map(tuple, got.collect())) == want
    few = collocations.collocations(frame(spark, rows), threshold=4, best=7, within=80)
    assert sorted(map(tuple, few.collect())) == brute(rows, 4, 7, 80)


def test_no_rows(spark):
    assert collocations.collocations(frame(spark, [("en", None), (None, ".")])).collect() == []
    assert collocations.collocations(frame(spark, [("en", "a b")]).limit(0)).collect() == []


def test_tiny_bit_maps_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "MAP_BITS", 1 << 10)
    rows = texts(5)
    assert sorted(map(tuple, collocations.collocations(frame(spark, rows)).collect())) == brute(rows)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_every_frequent_item_survives_merging(order):
    made = random.Random(order)
    items = [int(made.paretovariate(1.1)) for _ in range(20_000)] + list(range(10**6, 10**6 + 30_000))
    made.shuffle(items)
    exact, threshold = Counter(items), 25
    summary = collocations.Summary(len(items) // threshold + 1)
    for at in range(0, len(items), 777):
        hashes, counts = np.unique(np.array(items[at : at + 777], dtype=np.uint64), return_counts=True)
        summary.add(hashes, counts)
        summary.fold()
        assert len(summary.hashes) <= summary.capacity
    kept = set(summary.at_least(threshold).tolist())
    assert 0 < summary.error < threshold
    assert {x for x, n in exact.items() if n >= threshold} <= kept
    for x, left in zip(summary.hashes.tolist(), summary.counts.tolist()):
        assert left <= exact[x] <= left + summary.error


def test_bits_hold_all_that_was_put_in(spark):
    hashes = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000, dtype=np.int64)
    made = collocations.bit_map(spark.createDataFrame([(int(h),) for h in hashes], "h long"), len(hashes))
    assert made.holds(hashes.view(np.uint64)).all()
    other = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 50_000, dtype=np.int64).view(np.uint64)
    assert made.holds(other).mean() < 0.08


def test_products_over_64_bits(spark):
    big = 3 * 10**12
    candidates = spark.createDataFrame([("en", "a b", big)], "lang string, phrase string, a long")
    words = spark.createDataFrame([("en", "a", big + 1), ("en", "b", 2 * big)], "lang string, word string, n long")
    totals = spark.createDataFrame([("en", 9 * big)], "lang string, n long")
    assert collocations.score(candidates, words, totals).first()["score"] == 1_000_000 * big * big // ((big + 1) * 2 * big)


def test_query_equals_sql(spark):
    good, note = compare(spark, database(FOLDER), "op13_phrase_collocations", FOLDER)
    assert good, note
