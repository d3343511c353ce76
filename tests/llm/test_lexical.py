"""Ranked search against brute force, its bounds, and what they skip."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from compare import compare, database

from tillstar.llm import lexical

FOLDER = "/root/testdata/sf0.001"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
DOCS = "doc_id long, text string, n long, terms string, item int, score string, `rank` int"
ITEMS = "item_id long, text string, doc_id string, weights int"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(WORD, low)


def brute(docs, items, best=20):
    held = [(doc_id, Counter(words(t)), len(words(t))) for doc_id, t in docs]
    held = [d for d in held if d[2]]
    n_docs, total = len(held), sum(d[2] for d in held)
    df = Counter(t for _, terms, _ in held for t in terms)
    out = []
    for item_id, text in dict.fromkeys(items):
        scores = []
        for doc_id, terms, n in held:
            m = 75 + (25 * n * n_docs) // total
            score = 0
            for t in words(text):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * terms[t]) // (1000 * terms[t] + 12 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        scores.sort()
        out += [(item_id, i + 1, d, -s) for i, (s, _, _, d) in enumerate(scores[:best])]
    return sorted(out, key=repr)


def tables(seed, n_docs=300, n_items=25):
    made = random.Random(seed)
    vocabulary = [f"w{int(made.paretovariate(0.6)) % 400}" for _ in range(4000)] + ["É", "é", "Zwölf", "x1"]
    texts = [" ".join(made.choices(vocabulary, k=made.choice([1, 3, 30, 200]))) for _ in range(n_docs)]
    texts += texts[:5] * 12 + [None, "", "  ...", "UPPER w1-w2_w3", "w1 " * 5000]
    docs = [(i if i % 50 != 49 else None, t) for i, t in enumerate(texts)] + [(3, texts[9])]
    items = [(i, " ".join(made.choices(vocabulary, k=made.choice([1, 2, 5, 40])))) for i in range(n_items)]
    return docs, [*items, items[0], (0, "w1 w2 W2"), (90, None), (91, ""), (92, "nowhere else"), (None, "w3, w4")]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(lexical, "BLOCK", 64)
    docs, items = tables(seed)
    d = spark.createDataFrame([(i, t, 1, "t", 2, "s", 3) for i, t in docs], DOCS).repartition(3)
    q = spark.createDataFrame([(i, t, "d", 1) for i, t in items], ITEMS)
    want = brute(docs, items)
    assert sorted(map(tuple, lexical.rank(d, q).collect()), key=repr) == want
    assert sorted(map(tuple, lexical.rank(d, q, item_bytes=300).collect()), key=repr) == want  # several batches of items


def test_empty_tables(spark):
    docs, items = tables(3, 20, 3)
    d, q = spark.createDataFrame([(i, t, 1, "t", 2, "s", 3) for i, t in docs], DOCS), spark.createDataFrame([(i, t, "d", 1) for i, t in items], ITEMS)
    assert lexical.rank(d.limit(0), q).collect() == []
    assert lexical.rank(d, q.limit(0)).collect() == []
    assert lexical.rank(d.limit(0), q.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def blocks(docs, items, size):
    """The index of small documents, without Spark."""
    import pyarrow as pa

    vocabulary = {t: i for i, t in enumerate(sorted({w for _, text in items for w in words(text)}))}
    held = [(i, Counter(words(t)), len(words(t))) for i, t in docs if words(t)]
    total, df = sum(n for _, _, n in held), Counter(t for _, terms, _ in held for t in terms)
    weights = np.array([math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1))) for t in vocabulary] + [0])
    arranged = lexical.arrange([{vocabulary[w]: c for w, c in Counter(words(text)).items()} for _, text in items], weights)
    made = []
    for at in range(0, len(held), size):
        part = held[at : at + size]
        terms = [sorted((vocabulary[t], c) for t, c in own.items() if t in vocabulary) for _, own, _ in part]
        ids, counts = (pa.array([[x[k] for x in row] for row in terms], pa.list_(pa.int32())) for k in (0, 1))
        n = np.array([n for _, _, n in part])
        made.append(lexical.Block(lexical.build_block(pa.array([i for i, _, _ in part], pa.int64()), n, ids, counts, arranged, len(held), total)))
    return arranged, made


def test_pair_bounds_hold_and_are_tighter_than_single_ones():
    docs, items = tables(4, 600, 30)
    items = [x for x in items if x[1]]
    arranged, made = blocks(docs, items, 128)
    tighter = 0
    for block in made:
        bound, _, _ = lexical.pair_bounds(block, arranged)
        for p in range(len(arranged.a)):
            added = np.zeros(len(block.ids), dtype=np.int64)
            single = 0
            for term, times in ((arranged.a[p], arranged.ca[p]), (arranged.b[p], arranged.cb[p])):
                where, impacts = block.postings(term)
                if times and len(where):
                    values = times * arranged.weights[term] * impacts
                    added[where] += values
                    single += int(values.max())
            assert added.max(initial=0) <= bound[p] <= single
            tighter += bound[p] < single
    assert tighter > len(made)


def test_bounds_skip_blocks_and_lookups():
    docs, items = tables(5, 4000, 30)
    items = [x for x in items if x[1]]
    arranged, made = blocks(docs, items, 128)
    counter, top = {}, lexical.Top(len(items), 20)
    for block in made:
        lexical.search_block(block, arranged, top, counter)
    all_pairs = sum(len(block.ids) for block in made) * 2 * len(arranged.a)
    assert counter["searched"] < 0.9 * counter["items"]
    assert counter["looked up"] < 0.05 * all_pairs
    want = Counter(item for item, *_ in brute([d for d in docs if words(d[1])], [(i, t) for i, (_, t) in enumerate(items)]))
    assert [len(scores) for scores, _, _ in top.held] == [want[i] for i in range(len(items))]


def test_query_equals_sql(spark):
    good, note = compare(spark, database(FOLDER), "op12_lexical_search", FOLDER)
    assert good, note
