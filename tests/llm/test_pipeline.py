"""The whole pipeline on the smallest tables: every stage's decisions reach the next."""

import corpus_pipeline
from tillstar.llm.common import staged, table

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, FOLDER, "documents")
    columns, counts = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, FOLDER), "stage")
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[1] <= counts[0] and counts[2] <= counts[1] and counts[3] <= counts[2] and counts[4] >= counts[3]
    labels = table(spark, FOLDER, "labels").filter("toxic = 1")
    assert docs.join(labels, "doc_id").count() <= 0.2 * labels.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert packed.groupBy("sequence_id").sum("length").filter("`sum(length)` > 2048").count() == 0
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_awkward_rows_pass_all_stages(spark, tmp_path):
    """Nulls in every column, shared ids, copies, a passage that two texts of one id hold differently, and clashing names."""
    passage, prose = " ".join(f"p{i}" for i in range(60)), " ".join(f"q{i}" for i in range(300))
    rows = [
        (1, passage + " one", "en", "a", 10, "x"),
        (2, " ".join(f"r{i}" for i in range(60)) + " " + passage, "en", "a", 20, "x"),
        (2, prose, "en", None, 30, None),
        (3, prose, None, "b", None, "x"),
        (None, " ".join(f"n{i}" for i in range(80)), "de", "b", 5, "x"),
        (4, None, "en", "a", None, "x"),
        (5, "", None, None, 0, None),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, `_row` string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = table(spark, str(tmp_path), "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, str(tmp_path)), "stage")
        assert docs.columns == [f.split()[0].strip("`") for f in schema.split(", ")], name
    left = {(r.doc_id, (r.text or "").split()[:1][0] if (r.text or "").split() else "") for r in docs.collect()}
    assert {(1, "p0"), (2, "r0"), (None, "n0"), (4, ""), (5, "")} <= left
    assert len([x for x in left if x[1] == "q0"]) == 1  # one of the two equal texts stays, whole
    whole = [r.text for r in docs.collect() if r.text and r.text.startswith("q0")]
    assert all(len(t.split()) == 300 for t in whole)
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert packed.count() >= 6 and packed.agg({"length": "max"}).first()[0] <= 2048


def test_an_empty_table(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").coalesce(1).write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
