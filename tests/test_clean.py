from datetime import date

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillstar.functions.calendar import calendar_columns
from tillstar.functions.keys import content_key, if_known, row_key
from tillstar.functions.money import mean, percent
from tillstar.functions.text import BRANCH_TOKENS, normalize_merchant
from tillstar.operators import clean

FEED = "transaction_id string, transaction_date date, merchant_name string, amount decimal(15,2)"
DAY = date(2024, 2, 29)


def test_valid_and_rejects_split_the_feed(spark, rows):
    feed = spark.createDataFrame(
        [
            ("good", DAY, "Cafe", 1),
            ("zero", DAY, "Cafe", 0),
            ("negative", DAY, "Cafe", -1),
            ("no amount", DAY, "Cafe", None),
            ("no merchant", DAY, None, 1),
            ("no date", None, "Cafe", 1),
        ],
        "transaction_id string, transaction_date date, merchant_name string, amount int",
    )
    assert rows(clean.filter_valid(feed), "transaction_id") == [("good",)]
    assert rows(clean.rejects(feed), "transaction_id", "reject_reason") == [
        ("negative", "amount not positive"),
        ("no amount", "amount is null"),
        ("no date", "transaction_date is null"),
        ("no merchant", "merchant_name is null"),
        ("zero", "amount not positive"),
    ]


def _by_hand(name):
    for token in BRANCH_TOKENS:
        name = name.replace(token, "").strip()
    return name


PIECES = st.lists(st.sampled_from([*BRANCH_TOKENS, " ", "\t", "　", "\xa0", "A", "b b", "점", "강남", "월계점강"]), max_size=7)


@settings(max_examples=5, deadline=None)
@given(st.lists(PIECES.map("".join), min_size=50, max_size=200))
def test_normalize_equals_stepwise_deletion(spark, names):
    names = [*names, "강남점", "Shop 강남점 역삼점", "강남강남점점", " a ", ""]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = df.select("name", normalize_merchant(F.col("name")).alias("out")).collect()
    assert all(r.out == _by_hand(r.name) for r in got)


def test_normalize_with_blanks_in_a_token(spark, rows):
    df = spark.createDataFrame([("x East Branch",), (" East Branchy",)], "name string")
    out = df.select(normalize_merchant(F.col("name"), ("East Branch", "y")))
    assert rows(out) == [("",), ("x",)]


def test_category_levels(spark, rows):
    df = spark.createDataFrame([("Food",), ("Food-Cafe",), ("a-b-c",), (None,)], "merchant_category string")
    assert rows(clean.split_category(df)) == [
        ("Food", "Food", None),
        ("Food-Cafe", "Food", "Cafe"),
        ("a-b-c", "a", "b"),
        (None, None, None),
    ]


def test_calendar_of_special_days(spark):
    days = [date(2024, 2, 29), date(2024, 12, 31), date(2024, 3, 2), date(2024, 3, 3), date(2024, 3, 4)]
    df = spark.createDataFrame([(d,) for d in days], "day date").select(*calendar_columns(F.col("day")))
    found = {r.full_date: r for r in df.collect()}
    for d in days:
        r = found[d]
        assert r.date_key == int(d.strftime("%Y%m%d"))
        assert (r.day_of_week, r.day_name, r.month_name) == (d.weekday(), d.strftime("%A"), d.strftime("%B"))
        assert r.is_weekend == (d.weekday() >= 5)
        assert r.quarter == (d.month - 1) // 3 + 1


def test_holidays_keep_every_day(spark, rows):
    dim = spark.createDataFrame([(1, date(2024, 1, 1), False), (2, DAY, False)], "date_key int, full_date date, is_holiday boolean")
    holidays = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 1),), (date(1999, 1, 1),)], "holiday_date date")
    assert rows(clean.with_holidays(dim, holidays), "date_key", "is_holiday") == [(1, True), (2, False)]


def test_keys_tell_members_apart(spark):
    values = [("a", "b"), ("ab", ""), ("", "ab"), (None, "a"), ("a", None), ("~", "a"), ("1:a", None), (None, None)]
    df = spark.createDataFrame(values, "x string, y string")
    for key in (content_key, row_key):
        keys = [r.k for r in df.select(key(F.col("x"), F.col("y")).alias("k")).collect()]
        assert len(set(keys)) == len(values) and None not in keys
    known = df.select(if_known(row_key, F.col("x"), F.col("y")).alias("k")).collect()
    assert sum(r.k is None for r in known) == 4


def test_averages_round_half_up_from_exact_sums(spark):
    df = spark.createDataFrame([(1,)], "i int")
    value = df.select(
        mean(F.lit("0.25").cast("decimal(15,2)"), F.lit(2)).alias("half"),
        mean(F.lit("2.00").cast("decimal(15,2)"), F.lit(3)).alias("third"),
        percent(F.lit(1), F.lit(0)).alias("empty"),
        percent(F.lit(1), F.lit(8)).alias("eighth"),
    ).first()
    assert [str(v) for v in value] == ["0.13", "0.67", "None", "12.50"]


def test_sample_does_not_depend_on_partitions(spark, rows):
    df = spark.range(5000).select(F.col("id").cast("string").alias("transaction_id"))
    one = rows(clean.sample_for_checks(df.repartition(1), 0.1))
    assert one == rows(clean.sample_for_checks(df.repartition(7), 0.1))
    assert 350 < len(one) < 650
