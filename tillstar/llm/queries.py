"""The registered queries of this subpackage, and SQL where it can express them."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import (
    collocations,
    html_text,
    lexical,
    license_scan,
    lm_scoring,
    lz_fingerprint,
    mixing,
    near_duplicates,
    packing,
    quality,
    substring_dedup,
    topk,
    warc,
)
from tillstar.llm.common import table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


TOP_K_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 20 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


NEAR_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[CAST(i AS BIGINT) : CAST(i + 4 AS BIGINT)], ' ') AS s
  FROM w, unnest(range(1, greatest(2, len(w) - 3))) AS t(i) WHERE len(w) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id, d.doc_id = min(r.b) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id
"""


SEARCH_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), s AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS total FROM d WHERE len(w) > 0),
t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term),
x AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS weight FROM t, s GROUP BY term, n_docs),
q AS (
  SELECT i, item_id, term, count(*) AS times
  FROM (
    SELECT row_number() OVER () AS i, item_id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)
  ) GROUP BY i, item_id, term
), m AS (SELECT r, doc_id, 100 - 25 + (25 * CAST(len(w) AS BIGINT) * n_docs) // total AS m FROM d, s WHERE len(w) > 0),
f AS (
  SELECT i, item_id, r, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM q JOIN x USING (term) JOIN t USING (term) JOIN m USING (r) GROUP BY i, item_id, r, doc_id
), k AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM f WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 20
"""


PHRASES_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (
  SELECT lang, k, array_to_string(w[CAST(i AS BIGINT) : CAST(i + k - 1 AS BIGINT)], ' ') AS phrase
  FROM w, unnest(range(1, len(w) + 1)) AS t(i), (VALUES (1), (2), (3)) AS s(k) WHERE i + k - 1 <= len(w)
), f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= 10),
u AS (
  SELECT c.lang, c.k, c.phrase, c.a, cut, x.f AS l, y.f AS r, CAST((c.a::HUGEINT * c.a * 1000000) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM (SELECT c.*, unnest(range(1, k)) AS cut FROM c) AS c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : CAST(cut AS BIGINT)], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[CAST(cut + 1 AS BIGINT) :], ' ')
), b AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
h AS (
  SELECT lang, array_to_string(w[CAST(i AS BIGINT) : CAST(i + 1 AS BIGINT)], ' ') AS phrase, max(a) AS longer
  FROM c, (VALUES (1), (2)) AS t(i) WHERE k = 3 GROUP BY ALL
), o AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, score
  FROM b LEFT JOIN h ON h.lang = b.lang AND h.phrase = b.phrase WHERE longer IS NULL OR 100 * longer < 50 * a
)
SELECT o.lang, rank, phrase, a, l, r, n, score FROM o JOIN n ON n.lang = o.lang WHERE rank <= 2000
"""


def _license_sql() -> str:
    """Phrases by place, and templates by containment in every window of words, without the join's filters."""
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    word = "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'"
    places = []
    for label, phrase in license_scan.PHRASES:
        parts = phrase.split(" ")
        here = " AND ".join(f"w[i + {k + 1}] = '{p}'" for k, p in enumerate(parts))
        places.append(f"SELECT doc_id, '{label}' AS label, i FROM w, unnest(range(0, len(w))) AS t(i) WHERE {here}")
    listed = []
    for label, text in license_scan.TEMPLATES:
        words = license_scan.template_words(text)
        need = math.ceil(license_scan.THRESHOLD * len(words) - 1e-9)
        width = license_scan.window_width(text, license_scan.THRESHOLD)
        listed.append(f"('{label}', {words}, {need}, {width})")
    return f"""
WITH w AS (SELECT doc_id, regexp_extract_all({lowered}, {word}) AS w FROM documents),
p AS ({" UNION ALL ".join(places)}),
t(label, words, need, width) AS (VALUES {", ".join(listed)}),
m AS (
  SELECT doc_id, label, common / size AS share FROM (
    SELECT doc_id, label, need, CAST(len(t.words) AS DOUBLE) AS size,
           len(list_intersect(list_distinct(w.w[CAST(i + 1 AS BIGINT) : CAST(i + width AS BIGINT)]), t.words)) AS common
    FROM w, unnest(range(0, len(w.w))) AS r(i), t WHERE list_contains(t.words, w.w[CAST(i + 1 AS BIGINT)])
  ) WHERE common >= need
),
b AS (SELECT doc_id, count(*) AS n, min(i) AS lo, max(i) AS hi, list_distinct(list(label)) AS labels FROM p GROUP BY doc_id),
f AS (SELECT doc_id, max(share) AS best, list_distinct(list(label)) AS labels FROM m GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(b.n, 0) AS n_base, b.lo AS first_word, b.hi AS last_word,
       coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(f.labels, [])))), ','), '') AS labels,
       greatest(CASE WHEN b.n > 0 THEN 1.0 ELSE 0.0 END, coalesce(f.best, 0.0))::DOUBLE AS score
FROM w LEFT JOIN b ON b.doc_id = w.doc_id LEFT JOIN f ON f.doc_id = w.doc_id
"""


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"))


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = warc.resolve(warc.records_of_pages(table(spark, sf_dir, "pages")))
    return resolved.withColumn("headers", warc.header_lines(F.col("headers")))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("row.doc_id", "junk", "toxic", "rejected")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.passages(table(spark, sf_dir, "documents"))


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz_fingerprint.fingerprint_documents(table(spark, sf_dir, "documents"))


def op7_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), places=True)
    return mixed.select("doc_id", "source", "epoch", "block", "tokens", "mix_at")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_lm_scoring": op1_lm_scoring,
        "op2_warc_revisits": op2_warc_revisits,
        "op3_best_fit_packing": op3_best_fit_packing,
        "op4_quality_classifier": op4_quality_classifier,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_document_fingerprints": op6_document_fingerprints,
        "op7_temperature_mixing": op7_temperature_mixing,
        "op8_license_scan": op8_license_scan,
        "op9_exact_topk": op9_exact_topk,
        "op10_minhash_near_dedup": op10_minhash_near_dedup,
        "op11_html_extraction": op11_html_extraction,
        "op12_lexical_search": op12_lexical_search,
        "op13_phrase_collocations": op13_phrase_collocations,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op8_license_scan": _license_sql(),
        "op9_exact_topk": TOP_K_SQL,
        "op10_minhash_near_dedup": NEAR_SQL,
        "op12_lexical_search": SEARCH_SQL,
        "op13_phrase_collocations": PHRASES_SQL,
    }
