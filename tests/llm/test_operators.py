"""Each operator against a brute-force version, on small and awkward tables: nulls, empty and long texts, ties, repeats, clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import compare, database
from pyspark.sql import functions as F

from tillstar.llm import license_scan, lm_scoring, lz_fingerprint, mixing, near_duplicates, packing, quality, substring_dedup, topk, warc
from tillstar.llm import queries as registered

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tokens string, node long, `_row` string, seed string, n long, bucket int"
VOCABULARY = [a + b for a in "ba de ki lo mu ne po ra si tu".split() for b in "ba de ki lo mu ne po ra si tu".split()]


def prose(n, seed):
    picked = random.Random(seed)
    return " ".join(picked.choice(VOCABULARY) for _ in range(n))


def edited(text, every, seed):
    words = text.split()
    picked = random.Random(seed)
    return " ".join(picked.choice(VOCABULARY) if i % every == every - 1 else w for i, w in enumerate(words))


def documents():
    base, passage = prose(200, 1), prose(80, 2)
    texts = [None, "", " \n ", "one", "one two three", base, base, base.upper(), edited(base, 40, 3), edited(base, 9, 4)]
    texts += [prose(30, 5) + " " + passage + " " + prose(30, 6), prose(50, 7) + " " + edited(passage, 20, 8), prose(9000, 9), "é ß 語 " + prose(20, 10)]
    texts += [prose(60, 20 + i) for i in range(12)]
    rows = [(i, t) for i, t in enumerate(texts)]
    return [*rows, rows[5], rows[3]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, len(t or ""), "x", 1, "r", "s", 2, 3) for i, t in documents()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def tokens_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


# --- op1


def test_scores_equal_brute_force(docs):
    train = [t for i, t in documents() if not lm_scoring.is_held_out(i)]
    counts = Counter(w for t in train for w in [*tokens_of(t), None])
    total, distinct = sum(counts.values()), len(counts)
    order = 3
    seen = set()
    for t in train:
        raw = b"\xff" * order + (t or "").encode().lower() + b"\xff"
        for p in range(order, len(raw)):
            seen.add(raw[p - order : p + 1])
    longest = Counter()
    for t in train:
        raw = b"\xff" * order + (t or "").encode().lower() + b"\xff"
        longest.update(raw[p - order : p + 1] for p in range(order, len(raw)))
    table = {order: defaultdict(dict)}
    for gram, n in longest.items():
        table[order][gram[:-1]][gram[-1]] = n
    for level in range(order - 1, -1, -1):
        table[level] = defaultdict(dict)
        for context, symbols in table[level + 1].items():
            for s in symbols:
                table[level][context[1:]][s] = table[level][context[1:]].get(s, 0) + 1

    def score(text):
        raw, out = b"\xff" * order + (text or "").encode().lower() + b"\xff", 0.0
        for p in range(order, len(raw)):
            excluded, s = set(), raw[p]
            for level in range(order, -1, -1):
                symbols = {k: v for k, v in table[level].get(raw[p - level : p], {}).items() if k not in excluded}
                if not symbols:
                    continue
                whole = sum(symbols.values()) + len(symbols)
                if s in symbols:
                    out += math.log10(symbols[s] / whole)
                    break
                out += math.log10(len(symbols) / whole)
                excluded |= set(symbols)
            else:
                out -= math.log10(256 - len(excluded))
        return out

    got = lm_scoring.score_documents(docs, order=order, frequent=20).collect()
    assert len(got) == len(documents())
    texts = dict(documents())
    for r in got:
        words = [*tokens_of(texts[r.doc_id]), None]
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(w in counts for w in words), total)
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(score(texts[r.doc_id]), rel=1e-9)


def test_symbol_probabilities_sum_to_one():
    codes, n = np.unique(lm_scoring._codes([b"abracadabra", b"abc"], 2)[0], return_counts=True)
    level, code, count = [np.full(len(codes), 2)], [codes], [n]
    for j in (1, 0):
        short, back = np.unique(code[-1] & np.uint64((1 << 8 * (j + 1)) - 1), return_inverse=True)
        level.append(np.full(len(short), j))
        code.append(short)
        count.append(np.bincount(back))
    trie = lm_scoring.Trie(2, *map(np.concatenate, (level, code, count)))
    for context in (b"ab", b"zz", b"ra", b"xa"):
        every = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256)], dtype=np.uint64)
        assert (10 ** trie.log10(every)).sum() == pytest.approx(1)


def test_scoring_without_rows(none):
    assert lm_scoring.score_documents(none).count() == 0


def test_scores_keep_every_pair(spark):
    """Text without repeats has over 3 million pairs, most seen once; all of them count, also over several batches and runs."""
    picked = random.Random(6)
    rows = [(i, "".join(picked.choices("abcdefghijklmnopqrstuvwxyz ", k=5000))) for i in range(360)]
    raw = [t.encode() for i, t in rows if not lm_scoring.is_held_out(i)]
    code, n = np.unique(lm_scoring._codes(raw, 5)[0], return_counts=True)
    level, codes, count = [np.full(len(code), 5)], [code], [n]
    for j in range(4, -1, -1):
        short, n = np.unique(codes[-1] & np.uint64((1 << 8 * (j + 1)) - 1), return_counts=True)
        level.append(np.full(len(short), j))
        codes.append(short)
        count.append(n)
    assert sum(map(len, codes)) > 3_000_000
    trie = lm_scoring.Trie(5, *map(np.concatenate, (level, codes, count)))
    got = {r.doc_id: r.score for r in lm_scoring.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        assert got[i] == pytest.approx(trie.log10(lm_scoring._codes([t.encode()], 5)[0]).sum(), rel=1e-9)


# --- op2


def test_revisits_equal_brute_force(spark):
    picked = random.Random(3)
    rows = []
    for i in range(300):
        url = picked.choice([None, "http://www.A.org/x/", "https://a.org/x?utm_source=z#top", "a.org/y?p=1", "http://m.a.org/y?p=1&ref=k"])
        headers = picked.choice([None, {}, {"etag": "1"}, {"etag": "W/1", "date": "d"}, {"etag": "2"}, {"last-modified": "m", "content-length": "5"}])
        rows.append((i, picked.choice(["response", "revisit"]), url, picked.choice([None, 0, 5, 70000, 200000]), headers, "extra"))
    got = {r.record_id: r for r in warc.resolve(spark.createDataFrame(rows, "record_id long, kind string, url string, time long, headers map<string,string>, carried string")).collect()}

    def key(url):
        return None if url is None else {"x": "a.org/x", "y": "a.org/y?p=1"}[re.search(r"/([xy])", url)[1]]

    def when(r):
        return (-(1 << 62) if r[3] is None else r[3], r[0], r[1])

    for r in rows:
        if r[1] != "revisit":
            assert r[0] not in got
            continue
        before = [o for o in rows if o[1] == "response" and key(o[2]) and key(o[2]) == key(r[2]) and when(o) < when(r)]
        last, own = max(before, key=when, default=None), r[4] or {}
        stored = (last[4] or {}) if last else {}
        if last is None:
            outcome = "no-response"
        elif "etag" in own and "etag" in stored:
            outcome = "resolved" if own["etag"].removeprefix("W/") == stored["etag"].removeprefix("W/") else "changed"
        elif "last-modified" in own and "last-modified" in stored:
            outcome = "resolved" if own["last-modified"] == stored["last-modified"] else "changed"
        else:
            outcome = "unverified"
        assert got[r[0]].outcome == outcome
        assert got[r[0]].response_id == (last[0] if outcome == "resolved" else None)
        if outcome == "resolved":
            assert got[r[0]].headers == stored | {k: v for k, v in own.items() if k in warc.PERMITTED}


# --- op3


def test_packing_is_whole_and_gapless(docs, none):
    from tokenizers import Tokenizer

    path = registered.tokenizer_path()
    whole = Tokenizer.from_file(path)
    got = packing.pack_documents(docs, path, capacity=256).collect()
    expected = Counter()
    for i, t in documents():
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        expected.update((i, p, a, len(ids[a : a + 256]), zlib.crc32(ids[a : a + 256].tobytes())) for p, a in enumerate(range(0, len(ids), 256)))
    assert Counter(tuple(r)[:5] for r in got) == expected
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 256
    assert len(bins) <= -(-sum(r.length for r in got) // 256) + 1
    assert packing.pack_documents(none, path).count() == 0


def test_word_ids_equal_the_tokenizer():
    from tokenizers import Tokenizer

    path = registered.tokenizer_path()
    whole = Tokenizer.from_file(path)
    texts = ["It's <|endoftext|> A,b;c  ÀÉß x́y \x1c z ÿ× 12a3 语言 don't!!", None, "", "ﬁ İ ΣΑΣ   a b", "é\te\ń"]
    got = packing.WordIds(path).of([None if t is None else t.encode() for t in texts])
    assert got == [np.array(whole.encode(t or "", add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]


def test_fullest_equals_brute_force():
    picked = random.Random(1)
    for _ in range(50):
        have, room = Counter(picked.randint(1, 30) for _ in range(8)), picked.randint(1, 80)
        sums = {0}
        for x in have.elements():
            sums |= {s + x for s in sums if s + x <= room}
        chosen = packing.fullest(dict(have), room)
        assert sum(k * n for k, n in chosen.items()) == max(sums)
        assert all(have[k] >= n for k, n in chosen.items())


# --- op4


def test_em_finds_labellers_accuracies():
    picked = random.Random(2)
    patterns = Counter()
    for _ in range(20000):
        bad = picked.random() < 0.2
        patterns[tuple((1 if picked.random() < 0.8 else 0) if bad else (1 if picked.random() < 0.001 else 0) for _ in range(4))] += 1
    share, p = quality.fit_em(patterns)
    assert share == pytest.approx(0.2, abs=0.02)
    assert p[:, 1, 2] == pytest.approx(np.full(4, 0.8), abs=0.03)


def test_classifier_rejects_bad_and_keeps_clean(spark, none):
    rows, toxic = [], []
    for i in range(400):
        text = prose(80, 1000 + i)
        if i % 10 == 0:
            text += " you stupid idiot scum"
            toxic.append(i)
        if i % 10 == 1:
            text = text.replace(" ", "%%% ")
        rows.append((i, None if i == 7 else "" if i == 8 else text, "en", "s", 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, row string, junk int")
    labels = spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(0, 400, 2)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.rejected for r in quality.classify(docs, labels).select("row.doc_id", "rejected").collect()}
    assert {i for i, bad in got.items() if bad} == {i for i in range(400) if i % 10 in (0, 1)}
    assert quality.classify(none, None).count() == 0


# --- op5


def test_passages_are_found_and_removed(docs, none):
    got = substring_dedup.passages(docs).collect()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert 10 not in by and 12 not in by and 13 not in by
    assert by[11][0].source_doc_ids == [10] and by[11][0].start_word == 50 and by[11][0].n_words >= 75
    assert by[6][0].n_words == 200 and by[7][0].n_words == 200 and by[8][0].n_words >= 190
    left = {r.doc_id: r for r in substring_dedup.remove_passages(docs).collect()}
    assert 6 not in left and 7 not in left
    assert left[11].text.split() == dict(documents())[11].split()[:50] + dict(documents())[11].split()[by[11][0].start_word + by[11][0].n_words :]
    assert left[12].text == dict(documents())[12] and left[0].text is None and left[11].tokens == "x"
    assert substring_dedup.passages(none).count() == 0


def test_chain_equals_brute_force():
    picked = random.Random(5)
    for _ in range(40):
        points = list({(picked.randint(0, 40), picked.randint(0, 40)) for _ in range(9)})
        x, y = (np.array(v) for v in zip(*points))

        def worth(path):
            return len(path) * 4.0 - sum(0.15 * (x[b] - x[a] + y[b] - y[a]) for a, b in zip(path, path[1:]))

        best, order = 0.0, sorted(range(len(points)), key=lambda i: points[i])
        for mask in range(1, 1 << len(order)):
            path = [i for b, i in enumerate(order) if mask >> b & 1]
            if all(x[a] < x[b] and y[a] < y[b] for a, b in zip(path, path[1:])):
                best = max(best, worth(path))
        assert max(worth(p) for p in substring_dedup.chain(x, y)) == pytest.approx(best)


def planted(texts_of, trials):
    """Documents in which passages stand in two texts, and where in the later one."""
    rows, spans = [], {}
    for i in range(trials):
        passage, change, noise = texts_of(i)
        rows += [(3 * i, noise), (3 * i + 1, f"{unique(40, i, 'a')} {passage} {unique(40, i, 'b')}"), (3 * i + 2, f"{unique(40, i, 'c')} {change} {unique(40, i, 'd')}")]
        spans[3 * i + 2] = (40, len(change.split()))
    return rows, spans


def unique(n, *of):
    return " ".join(f"{'.'.join(map(str, of))}.{j}" for j in range(n))


def covered(spark, rows, spans):
    """Of the planted passages, those of which most words are found."""
    found = defaultdict(list)
    for r in substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        found[r.doc_id].append((r.start_word, r.start_word + r.n_words))
    words = {i: sum(max(0, min(b, start + n) - max(a, start)) for a, b in found[i]) for i, (start, n) in spans.items()}
    return {i for i, (_, n) in spans.items() if words[i] >= 0.8 * n}


def test_edited_passages_are_found(spark):
    """Passages of 60 to 100 words, with up to one word in ten replaced."""

    def texts_of(i):
        picked, words = random.Random(i), unique(60 + i % 41, i, "p").split()
        change = list(words)
        for at in picked.sample(range(3, len(words) - 3), len(words) * (i % 5) // 40):
            change[at] = f"x{i}.{at}"
        return " ".join(words), " ".join(change), ""

    rows, spans = planted(texts_of, 200)
    assert covered(spark, rows, spans) == set(spans)


def test_passages_of_phrases_that_earlier_texts_hold_are_found(spark):
    """Half of each passage's 5-word runs stand in unrelated earlier texts too."""

    def texts_of(i):
        words = unique(60, i, "p").split()
        return " ".join(words), " ".join(words), ""

    rows, spans = planted(texts_of, 60)
    early = []
    for i, t in rows:
        if i % 3 == 1:
            words = t.split()[40:100]
            early += [(-1 - len(early) - j, f"{unique(9, i, j)} {' '.join(words[j : j + 9])} {unique(9, i, j, 'z')}") for j in range(0, 60, 12)]
    assert covered(spark, [*rows, *early], spans) == set(spans)


def test_thinned_runs_keep_their_ends():
    x, y = substring_dedup.thinned(np.array([5, 6, 7, 8, 9, 10, 11, 30]), np.array([1, 2, 3, 4, 5, 6, 7, 9]), 5)
    assert sorted(zip(x.tolist(), y.tolist())) == [(5, 1), (10, 6), (11, 7), (30, 9)]


# --- op6


def test_fingerprints_equal_brute_force(docs, none):
    rows = sorted(documents(), key=lambda r: (r[0], r[1] or ""))
    got = sorted(lz_fingerprint.fingerprint_documents(docs).collect(), key=lambda r: (r.doc_id, r.edited_sha256))
    expected = []
    for k, (i, t) in enumerate(rows):
        t, following = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        change = t[: len(t) - half] + following[:half]
        own, other = lz_fingerprint.fingerprint(t), lz_fingerprint.fingerprint(change)
        near = lz_fingerprint.likeness(own, other), lz_fingerprint.likeness(own, lz_fingerprint.fingerprint(following))
        expected.append((i, len(t), hashlib.sha256(change.encode()).hexdigest(), own, other, *near))
    assert [tuple(r) for r in got] == sorted(expected, key=lambda r: (r[0], r[2]))
    assert lz_fingerprint.fingerprint_documents(none).count() == 0


# --- op7


def test_mix_meets_its_weights(spark, none):
    rows = [(i, prose(50, i), "big" if i % 2 else f"s{i % 20}", "x", 9) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, budget string, full int")
    got = mixing.mix(docs, entropy_share=0.97, places=True)
    share = {r.source: r.t for r in got.groupBy("source").agg(F.sum("tokens").alias("t")).collect()}
    total = sum(share.values())
    shares = [0.5, *[0.05] * 10]
    exponent = mixing.bisect_exponent(shares, 0.97 * math.log(11), 4.0)
    assert 0 < exponent < 1
    assert share["big"] / total == pytest.approx(mixing.weights(shares, exponent)[0], abs=0.005)
    assert got.select("doc_id").distinct().count() == 3000
    assert mixing.mix(docs).columns == docs.columns
    epochs = got.groupBy("doc_id", "epoch").count().filter("count > 1").count()
    assert epochs == 0
    assert mixing.mix(none).count() == 0


def test_repeat_limit_bounds_epochs():
    shares = [0.9, 0.09, 0.01]
    exponent = mixing.bisect_exponent(shares, 0.0001, 3.0)
    assert exponent == pytest.approx(1.0)
    exponent = mixing.bisect_exponent(shares, math.log(3), 3.0)
    assert mixing.epochs(shares, mixing.weights(shares, exponent), None) == pytest.approx(3.0, rel=1e-6)


# --- op8


def test_license_scan_edges(spark):
    notice = "Licensed under the Apache License, Version 2.0"
    texts = [None, "", "All rights  reserved, all rights reserved. CC BY", "cc-by General Public Licenses", f"a\n{notice}!\nb", notice.rsplit(" ", 2)[0], "all. Rights"]
    rows = [(i, t, "x") for i, t in enumerate([*texts, texts[2]])]
    got = sorted(license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string, words string")).collect())
    assert [tuple(r)[:6] for r in got[:4]] == [(0, 0, 0, None, None, ""), (1, 0, 0, None, None, ""), (2, 8, 3, 0, 6, "cc-by,reserved"), (3, 5, 1, 0, 0, "cc-by")]
    assert [r.labels for r in got[4:7]] == ["apache-2.0", "", ""]
    assert len(got) == 8


def test_wrapped_notices_are_found(spark):
    """Notices over several lines, with comment signs, wherever they begin; the same words far apart are none."""
    rows, expected = [], []
    for n, (label, text) in enumerate(license_scan.TEMPLATES):
        words = text.split()
        wrapped = "\n".join(" * " + " ".join(words[i : i + 4]) for i in range(0, len(words), 4))
        apart = "\n".join(w + "\n" + prose(30, 7) for w in words)
        for before in (0, 3, 118, 127, 300):
            rows.append((len(rows), f"{prose(before, 5)}\n{wrapped}\n{prose(40, 6)}"))
            expected.append((label, 1.0))
        rows.append((len(rows), apart))
        expected.append(("", 0.0))
    got = sorted(license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    for r, (label, score) in zip(got, expected):
        assert (label in r.labels.split(",")) if label else r.labels in ("", "gpl")
        assert r.score == score or r.base_labels
    assert len(got) == len(rows)


# --- op9


def test_top_k_edges(spark):
    picked = random.Random(4)
    rows = [(i, [picked.choice([-1.0, -0.26, 0.0, 0.5, 2.0]) for _ in range(6)], "x") for i in range(120)]
    rows += [(200 + i, [0.5] * 6, "x") for i in range(60)]
    rows += [(300, None, "x"), (301, [1.0, None, 1.0, 1.0, 1.0, 1.0], "x"), (302, [float("nan")] * 6, "x"), (303, [], "x"), (304, [1.0], "x"), (None, [1.0] * 6, "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = defaultdict(list)
    for r in topk.top_k(frame, F.col("vec_id") % 20 == 0, k=5).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    sound = {i: [math.floor(64 * x) for x in v] for i, v, _ in rows if i is not None and i < 300}
    for q in [i for i in sound if i % 20 == 0]:
        scores = sorted((-sum(a * b for a, b in zip(sound[q], v)), i) for i, v in sound.items() if i != q)[:5]
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert set(got) == {i for i in sound if i % 20 == 0}


# --- op10


def brute_components(rows, percent):
    sets = {}
    for i, t in rows:
        w = tokens_of(t)
        sets.setdefault(i, frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("small", [64, 4])
def test_components_equal_brute_force(spark, docs, none, monkeypatch, small):
    """With small buckets of 4, most links come from the blocks of large ones."""
    monkeypatch.setattr(near_duplicates, "SMALL_BUCKET", small)
    monkeypatch.setattr(near_duplicates, "BLOCK_ROWS", 16 if small == 4 else 4096)
    got = near_duplicates.near_duplicates(docs, 85).collect()
    expected = brute_components(documents(), 85)
    assert len(got) == len(documents())
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    base = prose(120, 77)
    rows = [(i, base if i == 0 else edited(base, 5 + i % 60, 500 + i)) for i in range(90)]
    many = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in many} == brute_components(rows, 85)
    assert near_duplicates.near_duplicates(none).count() == 0
    once = [r.doc_id for r in near_duplicates.first_of_each(docs, 85).collect()]
    assert sorted(once) == sorted(i for i, (_, c) in expected.items() if i == c)


def test_rows_of_one_doc_id_are_judged_by_their_texts(spark):
    """A doc_id on several rows: clean texts stay, near duplicates go, and links of every text count."""
    base, other = prose(120, 90), prose(120, 91)
    rows = [(1, base), (5, edited(base, 60, 92)), (5, prose(50, 93)), (5, prose(50, 94)), (5, prose(50, 94)), (7, other), (7, prose(90, 95)), (8, edited(other, 60, 96))]
    rows += [(9, prose(30, 100 + i)) for i in range(20)] + [(None, base), (9, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    gone = {rows[1], rows[7]}
    left = sorted(near_duplicates.first_of_each(docs, 80).collect(), key=str)
    assert sorted(map(tuple, left), key=str) == sorted({r for r in rows if r not in gone}, key=str)
    judged = Counter((r.doc_id, r.component_id) for r in near_duplicates.near_duplicates(docs, 80).collect())
    assert judged == Counter({(1, 1): 1, (5, 1): 1, (5, 5): 3, (7, 7): 2, (8, 7): 1, (9, 9): 22, (None, None): 1})


# --- registered queries


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_query_equals_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    good, note = compare(spark, database(folder), name, folder)
    assert good, note
