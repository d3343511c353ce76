"""Cases that earlier versions of the operators got wrong."""

import math
from collections import Counter, defaultdict

import duckdb
from compare import rows_of
from pyspark.sql import functions as F

from tillstar.llm import license_scan, lz_fingerprint, mixing, quality, topk, warc
from tillstar.llm import queries as registered


def test_license_words_far_apart_in_a_line_are_no_notice(spark):
    filler = " ".join(f"w{i}" for i in range(2000))
    texts = [
        "He released the report under pressure. The old license was renewed.",
        f"released {filler} under {filler} the {filler} mit {filler} license",
        "It is Released under the MIT License, as ever.",
        "Released\n * under the\n * MIT License",
        None,
        "",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.labels for r in sorted(license_scan.scan(frame).collect())]
    assert got == ["", "", "mit", "mit", "", ""]


def test_license_scan_equals_sql_on_wrapped_and_long_lines(spark):
    rows = []
    for i, (_, text) in enumerate(license_scan.TEMPLATES):
        words = text.split()
        rows.append((10 * i, "lead " * i + "\n".join(" ".join(words[j : j + 3]) for j in range(0, len(words), 3))))
        rows.append((10 * i + 1, " ".join(w + " x y" for w in words)))
        rows.append((10 * i + 2, " ".join(words[1:]) + " cc by all rights reserved"))
        rows.append((10 * i + 3, " ".join(w if j % 4 else w + " and" for j, w in enumerate(words))))
    rows += [(900, None), (901, ""), (902, "General Public License")]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    result = con.execute(registered.oracle_sql()["op8_license_scan"])
    want = rows_of([d[0] for d in result.description], result.fetchall())
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got.columns, got.collect()) == want
    assert len({r[4] for r in want}) > 4


def test_vectors_whose_scores_leave_64_bits_take_no_part(spark):
    rows = [(0, [3e305, 1.0]), (1, [1.0, 2.0]), (20, [2.0, 1.0]), (40, [1e9, 0.0]), (60, [2.0**24, 0.0])]
    got = sorted(map(tuple, topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=3).collect()))
    big = 64 * 2**24
    assert got == [(20, 1, 60, 128 * big), (20, 2, 1, 64 * 64 * 4), (60, 1, 20, 128 * big), (60, 2, 1, 64 * big)]


def test_texts_without_an_id_are_fingerprinted(spark):
    rows = [(None, "aa bb"), (None, None), (3, "cc dd ee"), (None, "zz")]
    got = lz_fingerprint.fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()
    assert sorted((r.doc_id is None, r.n_chars) for r in got) == [(False, 8), (True, 0), (True, 2), (True, 5)]
    assert {r.fingerprint for r in got} == {lz_fingerprint.fingerprint(t) for _, t in rows}


def test_every_page_is_revisited(spark):
    pages = spark.createDataFrame([(i if i < 30 else None, f"http://h/{i}", "<p>x") for i in range(33)], "page_id long, url string, html string")
    kinds = warc.records_of_pages(pages).groupBy("kind").count().collect()
    assert {r.kind: r["count"] for r in kinds} == {"response": 33, "revisit": 33}
    resolved = warc.resolve(warc.records_of_pages(pages))
    assert resolved.count() == 33


def test_rows_that_share_an_id_are_sampled_in_proportion(spark):
    rows = spark.range(20_000).selectExpr("CASE WHEN id % 2 = 0 THEN 7 END AS doc_id", "'same' AS text")
    taken = quality._sampled(rows, 20_000, 2_000).count()
    assert 1_700 < taken < 2_300
    assert quality._sampled(rows, 20_000, 50_000).count() == 20_000


def test_mix_realises_the_budgets_of_a_brute_force_plan(spark):
    sizes = {"web": 600, "books": 90, "code": 25, None: 10}
    rows = [(100_000 * k + i, " ".join(f"{s}{i}w{j}" for j in range(10)), s) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3), entropy_share=0.8, max_epochs=3.0, places=True)
    got = mixed.collect()
    used, tokens, docs = defaultdict(float), defaultdict(float), defaultdict(Counter)
    for r in got:
        used[r.source] += r.tokens
        docs[r.source][r.doc_id] += 1
    for r in {r.doc_id: r for r in got}.values():
        tokens[r.source] += r.tokens
    assert {s: len(c) for s, c in docs.items()} == sizes  # every document at least once
    shares = {s: t / sum(tokens.values()) for s, t in tokens.items()}

    def weights(a):
        norm = sum(p**a for p in shares.values())
        return {s: p**a / norm for s, p in shares.items()}

    def allowed(a):
        w = weights(a)
        whole = max(tokens[s] / w[s] for s in w)
        entropy = -sum(x * math.log(x) for x in w.values())
        return entropy <= 0.8 * math.log(len(w)) + 1e-12 and max(w[s] * whole / tokens[s] for s in w) <= 3.0 + 1e-9

    exponent = next(a / 20_000 for a in range(20_001) if allowed(a / 20_000))
    w = weights(exponent)
    whole = max(tokens[s] / w[s] for s in w)
    longest = max(r.tokens for r in got)
    for s in sizes:
        assert abs(used[s] - w[s] * whole) <= longest + 1e-3 * whole
        epochs = w[s] * whole / tokens[s]
        assert set(docs[s].values()) <= {math.floor(epochs + 1e-3), math.ceil(epochs - 1e-3)}
    placed = sorted(got, key=lambda r: r.mix_at)
    half = Counter(r.source for r in placed[: len(placed) // 2])
    assert all(abs(half[s] / (len(placed) // 2) - w[s]) < 0.1 for s in sizes)


def test_classifier_on_held_out_labels(spark):
    """Words are learned from one half of the labels; the other half is judged."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    judged = quality.classify(docs, labels.filter("doc_id % 2 = 0")).select("row.doc_id", "junk", F.col("toxic").alias("toxic_score"), "rejected")
    rows = judged.join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    clean = [r for r in rows if r.quality == 1 and r.toxic == 0]
    toxic, junk = [r for r in rows if r.toxic == 1], [r for r in rows if r.quality == 0]
    assert sum(r.rejected for r in clean) <= 0.002 * len(clean)
    assert sum(r.toxic_score > 0.5 for r in toxic) >= 0.85 * len(toxic)
    assert sum(r.junk > 0.5 for r in junk) >= 0.95 * len(junk)


def test_scoring_sends_a_string_text_once_with_the_scores_of_a_cast_one(spark):
    """A string text reaches the workers only inside its row; other types still go beside it as strings, scored alike."""
    folder = "/root/testdata/sf0.01"
    model = quality.fit(*(spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels")))
    texts = [None, "", "Buy now!!! cheap cheap cheap", "The committee met on Tuesday to discuss the budget."]
    docs = spark.createDataFrame([(i, texts[i % 4] and f"{texts[i % 4]} {i}", i % 3) for i in range(2500)], "doc_id long, text string, source int")
    scored = quality.score(docs, model)
    assert " AS text#" not in scored._jdf.queryExecution().analyzed().toString()
    cast = quality.score(docs.withColumn("text", F.col("text").cast("binary")), model)
    got = {r.doc_id: (r.text, r.junk, r.toxic) for r in scored.select("row.*", "junk", "toxic").collect()}
    apart = {r.doc_id: (None if r.text is None else bytes(r.text).decode(), r.junk, r.toxic) for r in cast.select("row.*", "junk", "toxic").collect()}
    assert len(got) == 2500 and got == apart


def test_every_text_trains_the_scorer(spark):
    """Ten times as many texts as a shard has, each with a word of its own: every word has a weight."""
    words = [f"word{i}x" for i in range(200)]
    docs = spark.createDataFrame([(i, "en", f"some common text with {w}") for i, w in enumerate(words)], "doc_id long, lang string, text string")
    model = quality.fit(docs, None, sample=20)
    for aspect in quality.ASPECTS:
        weights, _ = model.scorer[aspect]
        own = [weights[quality.xxhash.xxh3_64_intdigest(w.encode()) % quality.BUCKETS] for w in words]
        assert all(own)


def test_words_are_learned_from_all_labelled_texts(spark):
    """More toxic words than any list of 500, each in all six toxic texts."""
    bad = [f"bad{i}" for i in range(700)]
    rows = [(i, "en", " ".join(bad) if i < 6 else f"a good text about {i}") for i in range(206)]
    docs = spark.createDataFrame([(i, lang, text) for i, lang, text in rows], "doc_id long, lang string, text string")
    labels = spark.createDataFrame([(i, int(i < 6)) for i in range(206)], "doc_id long, toxic int")
    assert quality.learn_words(docs, labels) == {w.encode() for w in bad}
