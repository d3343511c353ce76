"""Whole runs on a generated feed: invariants across layers, second runs, incremental runs."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tillstar.functions.money import total
from tillstar.operators import quality
from tillstar.plans import medallion, reports
from tillstar.plans.dimensions import dim_date
from tillstar.sources import generator, tables

START, END = date(2023, 11, 1), date(2024, 2, 15)


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    """3,000 transactions, a third of them further copies of one."""
    path = str(tmp_path_factory.mktemp("feed") / "raw")
    ids = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("id"))
    tables.write_table(generator.generate_transactions(spark, ids, START, END), path)
    return path


@pytest.fixture(scope="module")
def star(spark, feed, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("run") / "out")
    return out, medallion.run_full(spark, feed, out, START)


def _sum(df):
    return df.agg(total(F.col("amount"))).first()[0]


def test_rows_and_amounts_survive_every_layer(star):
    _, t = star
    assert t["bronze"].count() == 3000
    assert t["silver"].count() == t["fact_transactions"].count() == 2001
    assert _sum(t["silver"]) == _sum(t["fact_transactions"])
    keys = ["date_key", "category_key", "merchant_key", "card_key", "transaction_key"]
    assert t["fact_transactions"].filter(" OR ".join(f"{k} IS NULL" for k in keys)).count() == 0
    assert t["fact_transactions"].select("transaction_key").distinct().count() == 2001


def test_all_checks_pass_but_bronze_copies(star):
    _, t = star
    results = quality.validate_layers(quality.standard_layers(t))
    failed = {(r.layer, r.check_name) for r in results.filter("NOT passed").collect()}
    assert failed == {("bronze", "unique")}


def test_report_totals_add_up(star):
    _, t = star
    s = reports.Star.of(t)
    whole = reports.overall_statistics(s).first()
    for report in (
        reports.monthly_detail(s), reports.subcategory_summary(s), reports.category_share(s), reports.weekend_summary(s),
        reports.card_summary(s), reports.daily_trend(s), reports.weekday_pattern(s), reports.monthly_category(s),
        reports.merchant_share(s),
    ):
        assert report.agg(F.sum("total_amount")).first()[0] == whole.total_spent
        if "txn_count" in report.columns:
            assert report.agg(F.sum("txn_count")).first()[0] == whole.total_transactions
    assert reports.top_merchants(s, 10_000).agg(F.sum("total_spent")).first()[0] == whole.total_spent


def test_second_run_adds_and_keeps(spark, feed, tmp_path):
    out, early = str(tmp_path / "out"), str(tmp_path / "early")
    cut = date(2024, 1, 1)
    tables.write_table(tables.read_table(spark, feed).filter(F.col("transaction_date") < cut), early)
    first = medallion.run_full(spark, early, out, START)
    old_cards = {r.card_key: r.card_number for r in first["dim_card"].collect()}
    second = medallion.run_full(spark, feed, out, cut)
    assert second["fact_transactions"].count() == 2001
    assert second["fact_transactions"].select("transaction_key").distinct().count() == 2001
    new_cards = {r.card_key: r.card_number for r in second["dim_card"].collect()}
    assert old_cards.items() <= new_cards.items() and len(new_cards) == second["dim_card"].count()
    assert quality.scd2_violations(second["dim_merchant"]).count() == 0
    assert tables.versions(spark, f"{out}/fact_transactions") == [1, 2]


def test_incremental_run_brings_in_new_silver_rows(spark, feed, tmp_path):
    out = str(tmp_path / "out")
    cut = date(2024, 1, 10)
    calendar = dim_date(spark, date(2023, 1, 1), date(2024, 12, 31))
    early = str(tmp_path / "early")
    tables.write_table(tables.read_table(spark, feed).filter(F.col("transaction_date") < cut), early)
    before = medallion.run_full(spark, early, out, START, calendar)["fact_transactions"].count()
    full = str(tmp_path / "full")
    medallion.run_full(spark, feed, full, START, calendar)
    late = tables.read_table(spark, f"{full}/silver").filter(F.col("transaction_date") >= cut)
    tables.write_table(tables.materialize(late), f"{out}/silver", ("year", "month"), mode="append")
    medallion.run_incremental(spark, out, cut)
    fact = medallion.load_star(spark, out)["fact_transactions"]
    assert before < 2001 == fact.count() == fact.select("transaction_id").distinct().count()
    assert fact.filter("date_key IS NULL OR card_key IS NULL OR merchant_key IS NULL").count() == 0


def test_reduced_runs_agree_with_the_full_one(spark, feed, star):
    _, t = star
    raw = tables.read_table(spark, feed)
    one_pass = medallion.run_one_pass(raw, t["dim_date"])
    mart, flat = medallion.run_hash_mart(raw), medallion.run_window_mart(raw)
    assert {_sum(one_pass), _sum(mart), _sum(flat)} == {_sum(t["fact_transactions"])}
    assert [r[0] for r in flat.select("transaction_key").orderBy("transaction_key").collect()] == list(range(1, 2002))
    members = raw.select("merchant_name", "merchant_category").distinct().count()
    assert one_pass.select("merchant_key").distinct().count() == mart.select("merchant_key").distinct().count() == members


def test_moving_average_waits_for_seven_rows(spark, star):
    _, t = star
    s = reports.Star.of(t)
    daily = reports.moving_average(s).orderBy("full_date").collect()
    assert [r.moving_avg for r in daily[:6]] == [None] * 6
    exact = sum(r.total_amount for r in daily[:7]) / 7
    assert abs(daily[6].moving_avg - exact) <= exact.__class__("0.005")
    six = reports.Star(s.fact.filter(F.col("date_key") <= 20231106), s.dim_date, s.dim_category, s.dim_merchant, s.dim_card)
    assert reports.moving_average(six).filter("moving_avg IS NOT NULL").count() == 0


def test_dates_outside_the_calendar_keep_year_and_month(spark, feed, tmp_path):
    short = dim_date(spark, date(2024, 1, 1), date(2024, 1, 31))
    t = medallion.run_full(spark, feed, str(tmp_path / "out"), START, short)
    outside = t["fact_transactions"].filter("date_key IS NULL")
    assert t["fact_transactions"].count() == 2001
    assert 0 < outside.count() == outside.filter("year IS NOT NULL AND month IS NOT NULL").count()


def test_a_second_year_leaves_the_first_in_reports(spark, tmp_path):
    """The calendar grows with each run, so feeds of different years add up."""
    from tillstar.plans import medallion, reports

    out = str(tmp_path / "out")
    ids = spark.range(200)
    for year, seed in ((2023, 1), (2024, 2)):
        feed = str(tmp_path / f"raw{year}")
        tables.write_table(generator.generate_transactions(spark, ids, date(year, 1, 1), date(year, 12, 31), seed=seed), feed)
        star = medallion.run_full(spark, feed, out, date(year, 12, 31))
    months = reports.monthly_summary(reports.Star.of(star)).collect()
    assert {r.year for r in months} == {2023, 2024}
    assert sum(r.txn_count for r in months) == 400


def test_a_further_feed_adds_a_version_in_a_new_year_and_moves_a_corrected_date(spark, tmp_path):
    out, feeds = str(tmp_path / "out"), [str(tmp_path / f"raw{i}") for i in range(2)]
    first = generator.generate_transactions(spark, spark.range(100), date(2023, 1, 1), date(2023, 1, 31), seed=1)
    tables.write_table(first, feeds[0])
    medallion.run_full(spark, feeds[0], out, date(2023, 1, 31))
    before = sorted(map(tuple, tables.read_snapshot(spark, f"{out}/fact_transactions", 1).collect()))
    moved = tables.read_table(spark, feeds[0]).limit(10).withColumn("transaction_date", F.lit(date(2024, 3, 1)).cast(first.schema["transaction_date"].dataType))
    tables.write_table(moved, feeds[1])
    star = medallion.run_incremental(spark, out, date(2024, 3, 1), feeds[1])
    fact = star["fact_transactions"]
    assert fact.count() == fact.select("transaction_id").distinct().count() == 100
    assert fact.filter("date_key = 20240301").count() == 10
    assert star["silver"].count() == 100 and star["bronze"].count() == 110
    assert before == sorted(map(tuple, tables.read_snapshot(spark, f"{out}/fact_transactions", 1).collect()))
    again = medallion.run_incremental(spark, out, date(2024, 3, 1))
    assert again["fact_transactions"].count() == 100
