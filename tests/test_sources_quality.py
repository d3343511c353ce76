import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tillstar.operators import quality
from tillstar.sources import generator, schemas, tables


def test_versions_are_immutable_and_only_finished_ones_count(spark, rows, tmp_path):
    base = str(tmp_path / "dim")
    assert tables.read_snapshot(spark, base) is None
    assert tables.write_version(spark.range(2), base) == 1
    grown = tables.read_snapshot(spark, base).union(spark.range(2, 3))
    assert tables.write_version(grown, base) == 2
    assert (tables.read_snapshot(spark, base).count(), tables.read_snapshot(spark, base, 1).count()) == (3, 2)
    (tmp_path / "dim" / "version=3").mkdir()
    assert tables.versions(spark, base) == [1, 2]
    assert tables.write_version(spark.range(5), base) == 3
    with pytest.raises(ValueError):
        tables.read_snapshot(spark, base, 9)


def test_replaced_slices_leave_the_others(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    data = spark.createDataFrame([("a", 1, 1), ("b", 1, 2), ("c", 2, 2)], "k string, v int, m int")
    tables.write_table(data, path, ("m",))
    tables.rebuild_slice(data, lambda df: df.filter("k = 'c'").withColumn("v", F.lit(9)), path, F.col("m") == 2, ("m",))
    assert rows(tables.read_table(spark, path)) == [("a", 1, 1), ("c", 9, 2)]


def test_overwrite_clears_partitions_that_are_gone(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    data = spark.createDataFrame([("a", 1), ("b", 2)], "k string, m int")
    tables.write_table(data, path, ("m",))
    tables.write_table(data.filter("m = 2"), path, ("m",))
    assert rows(tables.read_table(spark, path)) == [("b", 2)]


def test_compaction_gives_disjoint_ranges(spark, tmp_path):
    source, target = str(tmp_path / "many"), str(tmp_path / "few")
    spark.range(1000).select(((F.col("id") * 37) % 1000).alias("k")).repartition(20).write.parquet(source)
    tables.compact(spark, source, target, ("k",), 4)
    spans = (
        tables.read_table(spark, target)
        .groupBy(F.col("_metadata.file_name").alias("f"))
        .agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
        .orderBy("lo")
        .collect()
    )
    assert 1 < len(spans) <= 4
    assert all(a.hi < b.lo for a, b in zip(spans, spans[1:]))


def test_compaction_splits_a_hot_key(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    hot = F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id"))
    spark.range(6000).select(hot.alias("k"), F.col("id").alias("v")).write.parquet(source)
    tables.compact(spark, source, target, ("k",), 6)
    sizes = tables.read_table(spark, target).groupBy(F.col("_metadata.file_name").alias("f")).count().collect()
    assert sum(r["count"] for r in sizes) == 6000
    assert max(r["count"] for r in sizes) < 2000


def test_conform_reports_lost_and_missing_fields(spark, rows):
    feed = spark.createDataFrame(
        [("1", "2024-02-30", "Cafe", "12.345"), ("2", "2024-02-29", None, "x")],
        "transaction_id string, transaction_date string, merchant_name string, amount string",
    ).withColumn("created_at", F.lit(datetime(2024, 1, 1)))
    out = schemas.conform(feed, schemas.CARD_TRANSACTION, "lost")
    assert out.columns == [*schemas.CARD_TRANSACTION.fieldNames(), "lost"]
    found = {r.transaction_id: r for r in out.collect()}
    assert found["1"].lost == ["transaction_date"] and str(found["1"].amount) == "12.35"
    assert found["2"].lost == ["merchant_name", "amount"] and found["2"].transaction_date == date(2024, 2, 29)
    assert schemas.type_mismatches(feed, schemas.CARD_TRANSACTION) == ["transaction_date", "amount"]


def test_align_fills_defaults_and_keeps_extras(spark, rows):
    target = spark.createDataFrame([], "a int, b string").schema
    df = spark.createDataFrame([(1, 5), (None, 6)], "a int, extra int")
    out = schemas.align_schema(df, target, {"a": 0, "b": "none"})
    assert out.columns == ["a", "b", "extra"]
    assert rows(out) == [(0, "none", 6), (1, "none", 5)]


def test_generated_rows_depend_on_seed_and_id_only(spark, rows):
    ids = spark.range(500)
    def make(df, seed):
        return rows(generator.generate_transactions(spark, df, seed=seed).drop("created_at"))

    first = make(ids.repartition(1), 42)
    assert first == make(ids.repartition(9), 42)
    assert first != make(ids, 43)


def test_generated_values_stay_in_their_ranges(spark):
    catalog = generator.merchant_catalog(spark)
    start, end = date(2023, 1, 1), date(2023, 1, 31)
    df = generator.generate_transactions(spark, 3000, start, end)
    checked = df.join(catalog, F.col("merchant_name") == F.col("name"))
    assert checked.count() == 3000
    assert checked.filter("amount < min_amount OR amount > max_amount").count() == 0
    low, high, merchants, days, ids = df.agg(
        F.min("transaction_date"), F.max("transaction_date"), F.count_distinct("merchant_name"),
        F.count_distinct("transaction_date"), F.count_distinct("transaction_id"),
    ).first()
    assert (low, high, days, ids, merchants) == (start, end, 31, 3000, catalog.count())
    assert df.filter("NOT card_number RLIKE '^[*]{4}[0-9]{4}$'").count() == 0


# --- quality ----------------------------------------------------------------------------------

BRONZE = "transaction_id string, transaction_date date, merchant_name string, amount int, card_number string"


def _results(df):
    return {(r.check_name, r.column_name): (r.failed_rows, r.passed) for r in df.collect()}


def test_bronze_rules_count_failing_rows(spark):
    day = date(2024, 1, 1)
    df = spark.createDataFrame(
        [("a", day, "m", 1, "c"), ("a", day, None, 0, "c"), (None, day, "m", 20_000_000, "c"), (None, None, "m", None, "c")], BRONZE
    )
    found = _results(quality.run_checks(df, "bronze", quality.bronze_checks()))
    assert found[("unique", "transaction_id")] == (2, False)  # NULL counts as one value
    assert found[("not_null", "transaction_id")] == (2, False)
    assert found[("not_null", "merchant_name")] == (1, False)
    assert found[("in_range", "amount")] == (2, False)  # NULL is not a range failure
    assert found[("not_null", "amount")] == (1, False)
    assert found[("required_column", "card_number")] == (0, True)
    assert len(found) == 11


def test_a_missing_column_fails_once_and_skips_its_rules(spark):
    df = spark.createDataFrame([("a", "m", 1)], "transaction_id string, normalized_merchant string, amount int")
    found = _results(quality.run_checks(df, "silver", quality.silver_checks()))
    assert found[("required_column", "transaction_type")] == (1, False)
    assert ("allowed_values", "transaction_type") not in found


def test_empty_layers_pass(spark):
    found = _results(quality.run_checks(spark.createDataFrame([], BRONZE), "bronze", quality.bronze_checks()))
    assert all(passed for _, passed in found.values())
    found = _results(quality.run_checks(spark.createDataFrame([], "amount int"), "bronze", quality.bronze_checks()))
    assert found[("required_column", "transaction_id")] == (1, False)


def test_allowed_values_count_null_as_bad(spark):
    df = spark.createDataFrame([("INCOME",), ("other",), (None,)], "transaction_type string")
    found = _results(quality.run_checks(df, "silver", quality.allowed("transaction_type", quality.TRANSACTION_TYPES)))
    assert found[("allowed_values", "transaction_type")] == (2, False)


def test_report_and_summary(spark, tmp_path):
    df = spark.createDataFrame([("a", None, "m", 0, "c")], BRONZE)
    results = quality.run_checks(df, "bronze", quality.bronze_checks())
    quality.write_report(results, str(tmp_path / "report"))
    lines = [json.loads(x) for f in (tmp_path / "report").glob("*.json") for x in f.read_text().splitlines()]
    assert len(lines) == 11 and all("checked_at" in x for x in lines)
    summary = quality.summarize(results).first()
    assert (summary.success, summary.checks, summary.passed_checks) == (False, 11, 9)
    assert summary.failed_checks == "in_range:amount, not_null:transaction_date"
    assert quality.all_passed(results).first().success_percent == 81.82


def test_layers_follow_their_inputs(spark, tmp_path):
    import shutil

    import pyarrow.parquet as pq

    from tillstar.plans.prepared import Prepared

    folder = tmp_path / "sf"
    shutil.copytree("/root/testdata/sf0.001", folder)
    before = Prepared.of(spark, str(folder)).raw.count()
    assert Prepared.of(spark, str(folder)) is Prepared.of(spark, str(folder))
    lines = folder / "lineitem.parquet"
    lines.chmod(0o644)
    pq.write_table(pq.read_table(lines).slice(0, 100), lines)
    assert Prepared.of(spark, str(folder)).raw.count() == 100 < before
