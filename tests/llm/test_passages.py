"""Repeated passages: against brute force, by recall on planted copies, and with shared, missing and hot ids."""

import random
from collections import defaultdict

import pytest

from tillstar.llm import substring_dedup as op

SCHEMA = "doc_id long, text string, n_chars long, node long, own string, h long, words string, extend int"


def unique(n, *of):
    return [f"{'.'.join(map(str, of))}.{j}" for j in range(n)]


def frame(spark, rows, parts=3):
    made = [(i, t, None if t is None else len(t), 1, "o", 2, "w", 3) for i, t in rows]
    return spark.createDataFrame(made, SCHEMA).repartition(parts)


def spans_of(spark, rows):
    found = defaultdict(list)
    for r in op.passages(frame(spark, rows)).collect():
        found[r.doc_id].append((r.start_word, r.start_word + r.n_words, r.source_doc_ids))
    return {k: sorted(v) for k, v in found.items()}


def brute(rows, least=50):
    """Words of each text that stand in a common run of at least `least` words with an earlier one."""
    texts = sorted((i, t.split()) for i, t in rows)
    out = {}
    for at, (i, own) in enumerate(texts):
        covered = [False] * len(own)
        for _, other in texts[:at]:
            before = [0] * (len(other) + 1)
            for x, word in enumerate(own, 1):
                row = [0] * (len(other) + 1)
                for y, w in enumerate(other, 1):
                    if w == word:
                        row[y] = before[y - 1] + 1
                        if row[y] >= least:
                            covered[x - row[y] : x] = [True] * row[y]
                before = row
        runs, begin = [], None
        for x, c in enumerate([*covered, False]):
            if c and begin is None:
                begin = x
            if not c and begin is not None:
                runs.append((begin, x))
                begin = None
        if runs:
            out[i] = runs
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_passages_equal_brute_force(spark, seed):
    made = random.Random(seed)
    pool = [unique(made.randrange(55, 130), "p", i) for i in range(8)]
    rows = []
    for i in range(40):
        words = unique(made.randrange(5, 60), i, "a")
        for _ in range(made.randrange(3)):
            passage = made.choice(pool)
            begin = made.randrange(0, max(1, len(passage) - 60))
            words += passage[begin:] + unique(made.randrange(5, 40), i, "b", len(words))
        rows.append((i, " ".join(words)))
    rows += [(40, rows[5][1]), (41, rows[5][1].upper())]
    found, want = spans_of(spark, rows), brute([(i, t.lower()) for i, t in rows])
    assert {i: len(v) for i, v in found.items()} == {i: len(v) for i, v in want.items()}
    # words that only a later of many holders has too, beside a passage's end, need a seed of their own
    gaps = [(abs(s[0] - a), abs(s[1] - b)) for i, v in found.items() for s, (a, b) in zip(v, want[i])]
    assert max(max(g) for g in gaps) <= 6 and sum(g == (0, 0) for g in gaps) >= 0.9 * len(gaps)
    assert all(source < i for i, v in found.items() for s in v for source in s[2])


def edited(words, share, picked, *tag):
    """One word in so many replaced, dropped or doubled."""
    out = list(words)
    for at in sorted(picked.sample(range(len(words)), round(share * len(words))), reverse=True):
        kind = picked.choice("rrrrdi")
        out[at : at + 1] = {"r": [f"x{'.'.join(map(str, tag))}.{at}"], "d": [], "i": [words[at], f"y{'.'.join(map(str, tag))}.{at}"]}[kind]
    return out


def recall(spark, share, frequent):
    """Share of planted copies of which most words are found; with `frequent`, ten texts hold each passage, all edited."""
    rows, planted = [], {}
    for p in range(40):
        picked = random.Random(1000 * p + int(100 * share))
        passage = unique(51 + picked.randrange(50), "p", p)
        for c in range(10 if frequent else 2):
            own = passage if c == 0 else edited(passage, share, picked, p, c)
            before = unique(20 + c, p, c, "a")
            if c:
                planted[len(rows)] = (len(before), len(before) + len(own))
            rows.append((len(rows), " ".join(before + own + unique(25, p, c, "z"))))
    found = spans_of(spark, rows)
    good = 0
    for i, (a, b) in planted.items():
        words = sum(max(0, min(b, y) - max(a, x)) for x, y, _ in found.get(i, []))
        outside = sum(max(0, y - b) + max(0, a - x) for x, y, _ in found.get(i, []))
        good += words >= 0.7 * (b - a) and outside <= 6
    return good / len(planted)


@pytest.mark.parametrize("frequent", [False, True])
@pytest.mark.parametrize(("share", "least"), [(0.0, 1.0), (0.05, 0.97), (0.1, 0.95), (0.15, 0.9)])
def test_recall_of_edited_passages(spark, share, least, frequent):
    assert recall(spark, share, frequent) >= least


def test_texts_that_share_an_id_are_told_apart(spark):
    passage, own = unique(60, "p"), unique(300, "q")
    rows = [(1, " ".join(passage)), (2, " ".join(unique(60, "r") + passage)), (2, " ".join(own)), (2, "short text")]
    found = op.passages(frame(spark, rows)).collect()
    assert [(r.doc_id, r.start_word, r.n_words, r.source_doc_ids) for r in found] == [(2, 60, 60, [1])]
    left = sorted((r.doc_id, r.text) for r in op.remove_passages(frame(spark, rows)).collect())
    assert left == sorted([(1, " ".join(passage)), (2, " ".join(unique(60, "r")) + " "), (2, " ".join(own)), (2, "short text")])


def test_copies_of_an_id_stay_linear(spark):
    passage = unique(60, "p")
    rows = [(i, " ".join([f"w{i}", *passage, *unique(30, i)])) for i in (1, 2) for _ in range(500)]
    found = op.passages(frame(spark, rows)).collect()
    assert [(r.doc_id, r.start_word, r.n_words) for r in found] == [(2, 1, 60)]
    assert op.remove_passages(frame(spark, rows)).count() == 1000
    spans = op._passages(frame(spark, rows), 50, op.K, op.SIMILARITY)[0]
    assert spans.count() == 1


def test_large_groups_link_to_their_first(spark, monkeypatch):
    """Hundreds of texts with one passage, whole copies, and several flushes of a task."""
    monkeypatch.setattr(op, "FLUSH", 3000)
    passage, whole = unique(70, "p"), " ".join(unique(120, "whole"))
    rows = [(i, " ".join(unique(20, i, "a") + passage + unique(20, i, "b"))) for i in range(300)] + [(1000 + i, whole) for i in range(200)]
    found = spans_of(spark, rows)
    assert set(found) == set(range(1, 300)) | set(range(1001, 1200))
    assert all(found[i] == [(20, 90, found[i][0][2])] and min(found[i][0][2]) < i for i in range(1, 300))
    assert all(found[i] == [(0, 120, [1000])] for i in range(1001, 1200))
    left = {r.doc_id for r in op.remove_passages(frame(spark, rows)).collect()}
    assert left == set(range(300)) | {1000}


def test_words_that_repeat_without_end_make_few_chains(spark):
    """Texts of one line over and over: no chain per place, and the copies are found."""
    rows = [(i, " ".join(unique(9, "line") * (40 + 10 * i) + unique(5, i))) for i in range(30)]
    chains = op._chains(frame(spark, rows), op.K)
    assert chains.count() <= 20 * 30
    found = spans_of(spark, rows)
    assert set(found) == set(range(1, 30)) and all(v[0][1] - v[0][0] >= 340 for v in found.values())


def test_rows_without_an_id_come_first(spark):
    passage = unique(60, "p")
    rows = [(None, " ".join(passage)), (0, " ".join(unique(10, "a") + passage)), (None, None), (5, ""), (None, " ".join(unique(20, "z")))]
    found = op.passages(frame(spark, rows)).collect()
    assert [(r.doc_id, r.start_word, r.n_words, r.source_doc_ids) for r in found] == [(0, 10, 60, [None])]
    left = op.remove_passages(frame(spark, rows)).collect()
    assert len(left) == 5 and left[0].asDict().keys() == {f.split()[0] for f in SCHEMA.split(", ")}
    assert sorted(len((r.text or "").split()) for r in left) == [0, 0, 10, 20, 60]


def test_clean_texts_and_empty_tables(spark):
    made = random.Random(3)
    common = unique(400, "c")
    rows = [(i, " ".join(made.choices(common, k=200))) for i in range(60)]
    assert op.passages(frame(spark, rows)).count() == 0
    assert op.remove_passages(frame(spark, rows)).count() == 60
    assert op.passages(frame(spark, rows).limit(0)).count() == 0
    assert op.remove_passages(frame(spark, rows).limit(0)).count() == 0


def test_a_far_apart_pair_of_runs_is_two_chains():
    import time

    import numpy as np

    x = np.concatenate([np.arange(0, 2000, 4), np.arange(8000, 10_000, 4)])
    y = np.concatenate([np.arange(0, 2000, 4), np.arange(2000, 4000, 4)])
    started = time.time()
    chains = op.pair_chains(x.astype(np.int32), y.astype(np.int32))
    assert sorted(c[0][0] for c in chains) == [0, 8000] and time.time() - started < 1
    a, b = list(range(3000)), list(range(0, 3000, 2))
    assert op.common_length(a, b) == 1500 and time.time() - started < 2


def test_every_shared_run_of_a_window_of_kmers_gives_both_texts_a_seed():
    import numpy as np

    rng = np.random.default_rng(7)
    run = op.WINDOW + op.K - 1
    for _ in range(300):
        shared = rng.integers(1, 2**63, run, dtype=np.uint64)
        a = np.concatenate([rng.integers(1, 2**63, 30, dtype=np.uint64), shared, rng.integers(1, 2**63, 17, dtype=np.uint64)])
        b = np.concatenate([rng.integers(1, 2**63, 3, dtype=np.uint64), shared])
        seed, text, place = op.sampled([a, b])
        short = place < op.LONG_PLACE
        assert set(seed[short & (text == 0)]) & set(seed[short & (text == 1)])
