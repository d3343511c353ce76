from datetime import date

import pytest
from pyspark.sql import functions as F

from tillstar.operators import lookup, merge, quality
from tillstar.plans import dimensions
from tillstar.sources import tables

A, B, C = date(2020, 1, 1), date(2021, 1, 1), date(2022, 1, 1)
END = date(9999, 12, 31)
CARD = "card_number string, card_type string, card_company string"


# --- lookups ----------------------------------------------------------------------------------


def test_shared_card_numbers_do_not_multiply_rows(spark, rows):
    cards = spark.createDataFrame(
        [(1, "****1", "Credit", "X"), (2, "****1", "Debit", "X"), (3, "****1", None, "X"), (4, "****2", None, None)],
        f"card_key bigint, {CARD}",
    )
    facts = spark.createDataFrame(
        [("a", "****1", "Debit", "X"), ("b", "****1", None, "X"), ("c", None, "Credit", "X"), ("d", "****9", "Debit", "X")],
        f"transaction_id string, {CARD}",
    )
    assert rows(lookup.join_card(facts, cards), "transaction_id", "card_key") == [
        ("a", 2), ("b", 3), ("c", None), ("d", None)
    ]


def test_asof_picks_the_version_of_the_day(spark, rows):
    dim = spark.createDataFrame(
        [(1, "m", "old", A, B), (2, "m", "new", B, END)],
        "merchant_key bigint, merchant_name string, merchant_category string, effective_date date, expiration_date date",
    )
    facts = spark.createDataFrame(
        [("before", "m", date(2019, 12, 31)), ("first", "m", A), ("last", "m", date(2020, 12, 31)), ("turn", "m", B), ("other", "x", B)],
        "transaction_id string, normalized_merchant string, transaction_date date",
    )
    assert rows(lookup.join_merchant_asof(facts, dim), "transaction_id", "merchant_key") == [
        ("before", None), ("first", 1), ("last", 1), ("other", None), ("turn", 2)
    ]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_shuffled_lookup_of_a_hot_key_equals_the_broadcast_one(spark, rows, how):
    """A third of the rows share one key and some have none."""
    facts = spark.range(6000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 != 1, F.col("id")).alias("k")
    )
    dim = spark.range(0, 4000).select(F.col("id").alias("dk"), (F.col("id") * 2).alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    small = lookup.lookup(facts, dim, {"k": "dk"}, ["v"], how, small=True)
    expected = rows(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = lookup.lookup(facts, dim, {"k": "dk"}, ["v"], how, small=False)
        assert "BroadcastHashJoin" not in large._jdf.queryExecution().executedPlan().toString()
        assert rows(large) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_a_hot_key_is_split_when_the_dimension_is_too_large_to_broadcast(spark):
    """Thresholds scaled down to the test's size; the cluster's own apply there."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
        facts = spark.range(0, 200_000, 1, 16).select(F.md5(F.col("id").cast("string")).alias("t"), hot.alias("k"))
        dim = spark.range(200_000).select(F.col("id").alias("dk"), (F.col("id") * 2).alias("v"))
        joined = lookup.lookup(facts, dim, {"k": "dk"}, ["v"], small=False)
        assert len(joined.collect()) == 200_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_broadcast_is_measured(spark):
    wide = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("s"))
    frames = {"wide": wide, "empty": wide.limit(0)}
    assert lookup.small_enough(frames) == {"wide", "empty"}
    assert lookup.small_enough(frames, max_rows=99) == {"empty"}
    assert lookup.small_enough(frames, max_bytes=99_999) == {"empty"}


def test_changes_and_orphans(spark, rows):
    old = spark.createDataFrame([("a", "x"), ("b", None), ("c", "z"), ("d", "w")], "n string, c string")
    new = spark.createDataFrame([("a", "y"), ("b", "x"), ("c", None), ("d", "w"), ("e", "q")], "n string, c string")
    assert rows(lookup.detect_changes(new, old, "n", ["c"]), "n") == [("a",), ("b",), ("c",)]
    fact = spark.createDataFrame([(1,), (9,), (None,)], "fk int")
    dim = spark.createDataFrame([(1,), (2,)], "pk int")
    assert rows(lookup.orphans(fact, "fk", dim, "pk")) == [(9,), (None,)]


# --- upserts ----------------------------------------------------------------------------------

TXN = "transaction_id string, amount int, year int, month int"


def test_upsert_twice_is_upsert_once(spark, rows):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    source = spark.createDataFrame([("b", 9), ("c", 3)], "k string, v int")
    once = merge.upsert(target, source, ["k"])
    assert rows(once) == [("a", 1), ("b", 9), ("c", 3)]
    assert rows(merge.upsert(once, source, ["k"])) == rows(once)
    with pytest.raises(ValueError, match="not unique"):
        merge.upsert(target, source.union(source), ["k"])


def _stored(spark, tmp_path, data):
    path = str(tmp_path / "fact")
    tables.write_table(spark.createDataFrame(data, TXN), path, ("year", "month"))
    return path


def test_slices_follow_a_row_that_moves_to_another_month(spark, rows, tmp_path):
    path = _stored(spark, tmp_path, [("a", 1, 2024, 1), ("b", 2, 2024, 1), ("c", 3, 2024, 2), ("d", 4, 2024, 3)])
    untouched = {f.name for f in (tmp_path / "fact" / "year=2024" / "month=3").glob("*.parquet")}
    delta = spark.createDataFrame([("a", 10, 2024, 2), ("e", 5, 2023, 12)], TXN)
    merge.upsert_slices(spark, path, delta, ["transaction_id"], ("year", "month"))
    assert rows(tables.read_table(spark, path)) == [
        ("a", 10, 2024, 2), ("b", 2, 2024, 1), ("c", 3, 2024, 2), ("d", 4, 2024, 3), ("e", 5, 2023, 12)
    ]
    assert untouched == {f.name for f in (tmp_path / "fact" / "year=2024" / "month=3").glob("*.parquet")}


def test_a_slice_that_becomes_empty_is_removed(spark, rows, tmp_path):
    path = _stored(spark, tmp_path, [("a", 1, 2024, 1), ("b", 2, 2024, 2)])
    delta = spark.createDataFrame([("a", 10, 2024, 2)], TXN)
    merge.upsert_slices(spark, path, delta, ["transaction_id"], ("year", "month"))
    assert rows(tables.read_table(spark, path)) == [("a", 10, 2024, 2), ("b", 2, 2024, 2)]
    assert not (tmp_path / "fact" / "year=2024" / "month=1").exists()


def test_an_empty_delta_changes_nothing(spark, rows, tmp_path):
    path = _stored(spark, tmp_path, [("a", 1, 2024, 1)])
    merge.upsert_slices(spark, path, spark.createDataFrame([], TXN), ["transaction_id"], ("year", "month"))
    assert rows(tables.read_table(spark, path)) == [("a", 1, 2024, 1)]


def test_watermark_of_an_empty_target_lets_everything_through(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, w int")
    assert len(rows(merge.newer_than(df, df.limit(0), "w"))) == 2
    assert rows(merge.newer_than(df, df.filter("w = 1"), "w")) == [("b", 2)]


def test_scd1_adds_absent_members_only(spark, rows):
    target = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "k bigint, n string, t string")
    source = spark.createDataFrame([("a", None), ("b", "y"), ("c", "z")], "n string, t string")
    merged = merge.scd1_insert(target, source, ["n", "t"], lambda new: new.select(F.lit(9).cast("bigint").alias("k"), "n", "t"))
    assert rows(merged) == [(1, "a", None), (2, "b", "x"), (9, "b", "y"), (9, "c", "z")]


# --- type 2 -----------------------------------------------------------------------------------


def _members(spark, *pairs):
    return spark.createDataFrame(list(pairs), "merchant_name string, merchant_category string")


def _merge(dim, source, day):
    return merge.scd2_merge(dim, source, "merchant_name", ["merchant_category"], day)


def _first(spark):
    source = _members(spark, ("same", "x"), ("moved", "x"), ("to null", "x"), ("from null", None), ("absent", "x"))
    dim = merge.scd2_init(source, A)
    return merge.with_version_key(dim, "merchant_name", ["merchant_category"], "merchant_key")


def test_scd2_versions(spark, rows):
    batch = _members(spark, ("same", "x"), ("moved", "y"), ("to null", None), ("from null", "x"), ("new", "z"))
    dim = _merge(_first(spark), batch, B)
    cols = ("merchant_name", "merchant_category", "effective_date", "expiration_date", "is_current")
    assert rows(dim, *cols) == sorted(
        [
            ("same", "x", A, END, True),
            ("absent", "x", A, END, True),
            ("moved", "x", A, B, False),
            ("moved", "y", B, END, True),
            ("to null", "x", A, B, False),
            ("to null", None, B, END, True),
            ("from null", None, A, B, False),
            ("from null", "x", B, END, True),
            ("new", "z", B, END, True),
        ],
        key=repr,
    )
    assert dim.filter("merchant_key IS NULL").count() == 0
    assert dim.select("merchant_key").distinct().count() == 9
    assert rows(_merge(dim, batch, C)) == rows(dim)
    assert rows(quality.scd2_violations(dim)) == []


def test_scd2_return_to_an_old_category_is_a_new_version(spark, rows):
    dim = _merge(_merge(_first(spark), _members(spark, ("moved", "y")), B), _members(spark, ("moved", "x")), C)
    moved = dim.filter("merchant_name = 'moved'")
    assert rows(moved, "merchant_category", "effective_date", "expiration_date") == [("x", A, B), ("x", C, END), ("y", B, C)]
    assert moved.select("merchant_key").distinct().count() == 3


def test_scd2_refuses_two_categories_for_one_member(spark):
    with pytest.raises(ValueError, match="not unique"):
        _merge(_first(spark), _members(spark, ("moved", "y"), ("moved", "z")), B)


def test_bootstrap_adds_only_what_is_missing(spark, rows):
    old = spark.createDataFrame([("m", False)], "merchant_name string, is_current boolean")
    out = merge.scd2_bootstrap(old)
    assert rows(out, "merchant_name", "is_current", "effective_date", "expiration_date") == [
        ("m", False, date(2000, 1, 1), END)
    ]


def test_violations_are_found(spark, rows):
    dim = spark.createDataFrame(
        [("none open", A, B, False), ("overlap", A, C, False), ("overlap", B, END, True), ("empty", A, A, True), ("fine", A, END, True)],
        "merchant_name string, effective_date date, expiration_date date, is_current boolean",
    )
    assert rows(quality.scd2_violations(dim)) == [("empty", 1, 0, 1), ("none open", 0, 0, 0), ("overlap", 1, 1, 0)]


def test_merchants_take_their_latest_category(spark, rows):
    silver = spark.createDataFrame(
        [("m", "x", A), ("m", "y", B), ("m", "x", A), ("n", None, A), (None, "x", A)],
        "normalized_merchant string, merchant_category string, transaction_date date",
    )
    assert rows(dimensions.merchant_members(silver)) == [("m", "y"), ("n", None)]


def test_changes_on_one_day_amend_and_older_ones_fail(spark, rows):
    from datetime import date

    from tillstar.operators.merge import scd2_init, scd2_merge, with_version_key

    def batch(value):
        return spark.createDataFrame([("m", value)], "merchant_name string, category string")

    day = date(2024, 1, 1)
    first = with_version_key(scd2_init(batch("A"), day), "merchant_name", ["category"], "merchant_key")
    second = scd2_merge(first, batch("B"), "merchant_name", ["category"], day)
    third = scd2_merge(second, batch("A"), "merchant_name", ["category"], day)
    assert rows(second, "category", "is_current") == [("B", True)]
    assert rows(third) == rows(first.select(*third.columns))
    with pytest.raises(Exception, match="dated before"):
        scd2_merge(first, batch("B"), "merchant_name", ["category"], date(2023, 1, 1)).collect()
