from datetime import date

import pytest
from pyspark.sql import functions as F

from tillstar.operators import dedup, keys
from tillstar.plans.layers import build_silver

D1, D2 = date(2024, 1, 1), date(2024, 1, 2)
SCHEMA = (
    "transaction_id string, transaction_date date, merchant_name string, merchant_category string, "
    "amount decimal(15,2), card_number string, card_type string, card_company string, created_at timestamp_ntz"
)


def _feed(spark, *rows):
    full = [(i, d, m, "Food-Cafe", a, "****0001", "Credit", "X", None) for i, d, m, a in rows]
    return spark.createDataFrame(full, SCHEMA.replace("decimal(15,2)", "int")).withColumn(
        "amount", F.col("amount").cast("decimal(15,2)")
    )


def test_window_and_hash_keep_the_same_whole_rows(spark, rows):
    df = spark.createDataFrame(
        [("a", 2, "x", None), ("a", 1, None, "p"), ("a", 1, "z", None), ("b", None, "y", "q"), ("b", 5, "y", "q"), (None, 1, "n", "n")],
        "k string, o int, v string, w string",
    )
    expected = [("a", 1, None, "p"), ("b", None, "y", "q"), (None, 1, "n", "n")]
    assert rows(dedup.dedup_window(df, ["k"], ["o"])) == expected
    assert rows(dedup.dedup_hash(df, ["k"], ["o"])) == expected
    assert len(rows(dedup.dedup_any(df, ["k"]))) == 3
    assert rows(dedup.dedup_stats(df, ["k"])) == [(6, 3, 3, 3)]


def test_stats_of_nothing(spark, rows):
    assert rows(dedup.dedup_stats(spark.createDataFrame([], "k string"), ["k"])) == [(0, 0, 0, 0)]


def test_an_invalid_copy_loses_the_transaction_only_when_deduplicated_first(spark, rows):
    feed = _feed(spark, ("t", D1, "Cafe", -5), ("t", D2, "Cafe", 7))
    assert [r[0] for r in rows(build_silver(feed), "transaction_id")] == ["t"]
    assert rows(build_silver(feed, filter_first=False), "transaction_id") == []


def test_silver_is_the_same_under_any_partitioning(spark, rows):
    feed = _feed(spark, *[(f"t{i % 40}", D1 if i % 3 else D2, f"Cafe {i % 7} 강남점", i - 20) for i in range(400)])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for n in (1, 7):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(rows(build_silver(feed.repartition(n)).drop("processed_at")))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] and len(found[0]) == 40


def test_a_hot_key_travels_once_per_task(spark, rows):
    """A third of all rows are copies of one transaction; the group limit sits before the shuffle."""
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    kept = dedup.dedup_window(df, ["k"])
    assert kept.count() == 20001
    assert rows(kept.filter("k = -1")) == [(-1, 0)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("partitions", [1, 5, None])
def test_dense_keys_are_the_global_row_number(spark, partitions):
    df = spark.range(2000).select(((F.col("id") * 7919) % 2000).alias("v"), (F.col("id") % 3).alias("hot"))
    keyed = keys.dense_key(df, "k", ["hot", "v"], start=10, partitions=partitions)
    got = [(r.hot, r.v) for r in keyed.orderBy("k").collect()]
    assert got == sorted(got)
    assert [r.k for r in keyed.orderBy("k").collect()] == list(range(11, 2011))
    assert keyed.schema["k"].dataType.typeName() == "long"


def test_extended_keys_follow_the_largest(spark, rows):
    dim = spark.createDataFrame([(7, "x"), (3, "y")], "k bigint, n string")
    new = spark.createDataFrame([("b",), ("a",)], "n string")
    assert rows(keys.extend_keys(dim, new, "k", ["n"])) == [(8, "a"), (9, "b")]
    assert rows(keys.extend_keys(dim.limit(0), new, "k", ["n"])) == [(1, "a"), (2, "b")]


def test_offset_keys_are_unique_above_start(spark):
    keyed = keys.offset_key(spark.range(1000).repartition(6), "k", start=100)
    found = [r.k for r in keyed.collect()]
    assert len(set(found)) == 1000 and min(found) == 101


def test_duplicate_keys_are_refused(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    with pytest.raises(ValueError, match="not unique"):
        keys.assert_unique(df, ["k"], "table")
    keys.assert_unique(df.distinct(), ["k"], "table")


def test_hash_form_equals_window_form_without_sorting_rows(spark, rows):
    import random
    from datetime import date, timedelta

    made = random.Random(3)
    copies = [
        (
            made.choice([None, *[f"t{i}" for i in range(200)]]) if i % 4 else f"u{i}",
            made.choice([None, date(2024, 1, 1) + timedelta(made.randrange(3))]),
            made.choice([None, "a", "b"]),
            made.randrange(3),
        )
        for i in range(2000)
    ] + [("hot", date(2024, 1, 1 + i % 20), "x", i) for i in range(3000)]
    df = spark.createDataFrame(copies + copies[:50], "transaction_id string, transaction_date date, name string, amount int").repartition(4)
    for order in (["transaction_date"], ["amount", "name"], ["name"], []):
        want = rows(dedup.dedup_window(df, ["transaction_id"], order))
        assert rows(dedup.dedup_hash(df, ["transaction_id"], order)) == want
    assert rows(dedup.dedup_hash(df, ["transaction_id", "name"], ["amount"])) == rows(dedup.dedup_window(df, ["transaction_id", "name"], ["amount"]))
    assert rows(dedup.dedup_hash(df.limit(0), ["transaction_id"], ["amount"])) == []


def test_hash_form_has_no_sort_aggregate(spark, monkeypatch):
    plans = []
    real = dedup.materialize
    monkeypatch.setattr(dedup, "materialize", lambda df, label: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df, label))
    df = spark.range(100).selectExpr("cast(id % 50 as string) AS k", "date'2024-01-01' + cast(id % 7 as int) AS d", "cast(id as string) AS v")
    dedup.dedup_hash(df, ["k"], ["d"]).collect()
    assert "SortAggregate" not in plans[0] and "SortMergeJoin" not in plans[0]
    assert "ShuffledHashJoin" in plans[0] and "HashAggregate" in plans[0]
