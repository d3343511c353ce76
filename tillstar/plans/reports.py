"""Spending reports over the star schema.

Facts are first summed per foreign key and only then joined to a dimension:
counts, sums, minima and maxima add up again, a hot merchant shrinks to one row
per task before anything is shuffled, and the join sees aggregates only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tillstar.functions.calendar import time_of_day, year_month_label
from tillstar.functions.money import AMOUNT, TOTAL, in_units, mean, percent, total
from tillstar.functions.text import day_type


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    dim_date: DataFrame
    dim_category: DataFrame
    dim_merchant: DataFrame
    dim_card: DataFrame

    @classmethod
    def of(cls, tables: dict[str, DataFrame]) -> Star:
        names = ("dim_date", "dim_category", "dim_merchant", "dim_card")
        return cls(tables["fact_transactions"], *[tables[n] for n in names])


def _per_key(fact: DataFrame, *keys: str) -> DataFrame:
    return fact.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"),
        total(F.col("amount")).alias("_sum"),
        F.min("amount").alias("_min"),
        F.max("amount").alias("_max"),
    )


def _count() -> Column:
    return F.sum("_rows").alias("txn_count")


def _total() -> Column:
    return total(F.col("_sum")).alias("total_amount")


def _avg(scale: int = 2) -> Column:
    return mean(F.sum("_sum"), F.sum("_rows"), scale).alias("avg_amount")


def _min() -> Column:
    return F.min("_min").cast(AMOUNT).alias("min_amount")


def _max() -> Column:
    return F.max("_max").cast(AMOUNT).alias("max_amount")


def _by_day(star: Star) -> DataFrame:
    return _per_key(star.fact, "date_key").join(star.dim_date, "date_key")


def _by_category(star: Star) -> DataFrame:
    return _per_key(star.fact, "category_key").join(star.dim_category, "category_key")


def _by_merchant(star: Star) -> DataFrame:
    current = star.dim_merchant.filter("is_current").select("merchant_key", "merchant_name")
    return (
        _per_key(star.fact, "merchant_key", "category_key")
        .join(current, "merchant_key")
        .join(star.dim_category, "category_key")
    )


def _rounded_total() -> Column:
    return F.round(F.sum("_sum"), 0).cast("decimal(25,0)").alias("total_amount")


# --- months -----------------------------------------------------------------------------------


def monthly_summary(star: Star) -> DataFrame:
    return (
        _by_day(star)
        .groupBy("year", "month", "month_name")
        .agg(_count(), _rounded_total(), _avg(0))
        .orderBy("year", "month")
    )


def monthly_detail(star: Star) -> DataFrame:
    return (
        _by_day(star)
        .groupBy("year", "month", "month_name")
        .agg(_count(), _total(), _avg(), _min(), _max())
        .orderBy("year", "month")
    )


def monthly_chart(star: Star) -> DataFrame:
    """Monthly detail labelled `yyyy-mm`, in millions."""
    return monthly_detail(star).select(
        year_month_label(F.col("year"), F.col("month")).alias("year_month"),
        "txn_count",
        in_units(F.col("total_amount"), 1_000_000).alias("total_millions"),
    )


def monthly_category(star: Star, year: int | None = None) -> DataFrame:
    """Spend per month and main category; a year also prunes the fact's partitions."""
    fact = star.fact if year is None else star.fact.filter(F.col("year") == year)
    days = star.dim_date.select("date_key", "year", "month", "month_name")
    days = days if year is None else days.filter(F.col("year") == year)
    return (
        _per_key(fact, "date_key", "category_key")
        .join(days, "date_key")
        .join(star.dim_category, "category_key")
        .groupBy("year", "month", "month_name", F.col("level_1").alias("category"))
        .agg(_count(), _total())
        .orderBy("year", "month", F.desc("total_amount"), "category")
    )


def month_report(star: Star, year_month: str) -> DataFrame:
    """One month (`YYYY-MM`) by category and subcategory."""
    year, month = (int(part) for part in year_month.split("-"))
    # Tested on the fact too, so that only the month's partition is read.
    in_month = (F.col("year") == year) & (F.col("month") == month)
    return (
        _per_key(star.fact.filter(in_month), "date_key", "category_key")
        .join(star.dim_date.filter(in_month), "date_key")
        .join(star.dim_category, "category_key")
        .groupBy("month_name", F.col("level_1").alias("category"), F.col("level_2").alias("subcategory"))
        .agg(_count(), _total(), _avg(), _max())
        .orderBy(F.desc("total_amount"), "category", "subcategory")
    )


def year_on_year(star: Star) -> DataFrame:
    """Each month beside the same month a year before, also across gaps."""
    months = _by_day(star).groupBy("year", "month").agg(_total())
    before = months.select(
        (F.col("year") + 1).alias("year"), "month", F.col("total_amount").alias("previous_amount")
    )
    change = F.col("total_amount") - F.col("previous_amount")
    return (
        months.join(before, ["year", "month"], "left")
        .withColumn("change_percent", percent(change, F.col("previous_amount")))
        .orderBy("year", "month")
    )


def spending_trend(star: Star, ahead: int = 3, by_category: bool = False) -> DataFrame:
    """Monthly spend with its straight-line trend, and the trend's next months, of all spend or of each main category.

    The line is least squares over the months since the first one, two regression aggregates on one row per month. Months
    without spend have no row and no part in it; a single month has no trend. Forecast rows have no amount.
    """
    keys = ["category"] if by_category else []
    if by_category:
        days = star.dim_date.select("date_key", "year", "month")
        sums = _per_key(star.fact, "date_key", "category_key").join(days, "date_key").join(star.dim_category, "category_key")
        months = sums.groupBy(F.col("level_1").alias("category"), "year", "month").agg(_total())
    else:
        months = _by_day(star).groupBy("year", "month").agg(_total())
    months = months.withColumn("_at", F.col("year") * 12 + F.col("month") - 1)
    x, y = F.col("_at").cast("double"), F.col("total_amount").cast("double")
    x = x - F.lit(24000)  # months since 2000, so that the intercept is no far extrapolation
    line = months.groupBy(*keys).agg(
        F.regr_slope(y, x).alias("_slope"), F.regr_intercept(y, x).alias("_start"), F.max("_at").alias("_last")
    )
    coming = line.select(*keys, F.explode(F.sequence(F.col("_last") + 1, F.col("_last") + ahead)).alias("_at"))
    coming = coming.select(
        *keys,
        F.floor(F.col("_at") / 12).cast("int").alias("year"),
        (F.col("_at") % 12 + 1).cast("int").alias("month"),
        F.lit(None).cast(months.schema["total_amount"].dataType).alias("total_amount"),
        "_at",
    )
    every = months.select(*coming.columns).unionByName(coming)
    if by_category:
        every, start, slope = every.join(line, keys), F.col("_start"), F.col("_slope")
    else:
        start, slope = line.select("_start").scalar(), line.select("_slope").scalar()
    trend = F.round(start + slope * (F.col("_at") - 24000), 2)
    return every.select(
        *keys, "year", "month", "total_amount", trend.alias("trend"), F.col("total_amount").isNull().alias("is_forecast")
    ).orderBy(*keys, "year", "month")


def peak_months(star: Star) -> DataFrame:
    """Best and worst month per year and the ratio between them; ties go to the earlier month."""
    months = _by_day(star).groupBy("year", "month").agg(_total())
    high = F.max(F.struct("total_amount", (-F.col("month")).alias("m")))
    low = F.min(F.struct("total_amount", F.col("month").alias("m")))
    return (
        months.groupBy("year")
        .agg(high.alias("high"), low.alias("low"))
        .select(
            "year",
            (-F.col("high.m")).alias("peak_month"),
            F.col("high.total_amount").alias("peak_amount"),
            F.col("low.m").alias("trough_month"),
            F.col("low.total_amount").alias("trough_amount"),
            F.round(F.col("high.total_amount") / F.col("low.total_amount"), 2).cast("decimal(15,2)").alias("peak_ratio"),
        )
        .orderBy("year")
    )


# --- categories -------------------------------------------------------------------------------


def category_summary(star: Star) -> DataFrame:
    return (
        _by_category(star)
        .groupBy(F.col("level_1").alias("category"))
        .agg(_count(), _rounded_total(), _avg(0))
        .orderBy(F.desc("total_amount"), "category")
    )


def subcategory_summary(star: Star) -> DataFrame:
    return (
        _by_category(star)
        .groupBy(F.col("level_1").alias("category"), F.col("level_2").alias("subcategory"))
        .agg(_count(), _total(), _avg())
        .orderBy(F.desc("total_amount"), "category", "subcategory")
    )


def category_share(star: Star) -> DataFrame:
    """Main categories with their share of all spend; the window sees one row per main category."""
    rolled = subcategory_summary(star).groupBy("category").agg(F.sum("total_amount").cast(TOTAL).alias("total_amount"))
    whole = F.sum("total_amount").over(Window.partitionBy())
    return rolled.withColumn("share_percent", percent(F.col("total_amount"), whole)).orderBy(
        F.desc("total_amount"), "category"
    )


def category_rollup(star: Star) -> DataFrame:
    """All spend, main categories and subcategories as levels of one table, from one scan of the facts.

    The fact is summed per category once; the levels are grouping sets of these sums. `level` is 0 for the whole, 1 for main
    categories and 2 for subcategories, told apart by the grouping and not by NULL, which a category without a subcategory has.
    The share is of the level above.
    """
    levels = _by_category(star).rollup("level_1", "level_2")
    summed = levels.agg(F.grouping_id().alias("_set"), _count(), _total(), _avg(), _min(), _max())
    level = F.when(F.col("_set") == 3, 0).when(F.col("_set") == 1, 1).otherwise(2)
    names = [F.col("level_1").alias("category"), F.col("level_2").alias("subcategory")]
    named = summed.select(level.alias("level"), *names, *[c for c in summed.columns if c not in ("level_1", "level_2", "_set")])

    def of_level(n: int, within: WindowSpec) -> Column:
        return F.max(F.when(F.col("level") == n, F.col("total_amount"))).over(within)

    # windows over sums: a row per category at most
    main = of_level(1, Window.partitionBy("category", F.col("level") == 0))
    above = F.when(F.col("level") == 2, main).otherwise(of_level(0, Window.partitionBy()))
    return named.withColumn("share_percent", percent(F.col("total_amount"), above)).orderBy(
        "level", F.desc("total_amount"), "category", "subcategory"
    )


def top_subcategories(star: Star, n: int = 15) -> DataFrame:
    return subcategory_summary(star).limit(n)


# --- merchants --------------------------------------------------------------------------------


def top_merchants(star: Star, n: int = 15) -> DataFrame:
    return (
        _by_merchant(star)
        .groupBy("merchant_name", F.col("level_1").alias("category"))
        .agg(F.sum("_rows").alias("visits"), total(F.col("_sum")).alias("total_spent"), _avg())
        .orderBy(F.desc("total_spent"), "merchant_name", "category")
        .limit(n)
    )


def top_merchants_by_category_name(star: Star, n: int = 10) -> DataFrame:
    return (
        _by_merchant(star)
        .groupBy("merchant_name", "category_name")
        .agg(total(F.col("_sum")).alias("total_spent"), F.sum("_rows").alias("visits"))
        .orderBy(F.desc("total_spent"), "merchant_name", "category_name")
        .limit(n)
    )


def merchant_share(star: Star) -> DataFrame:
    """Every merchant, over all versions of it, with its share of all spend in the fact.

    Merchants can be many, so the whole is a one-row scalar subquery, not a window in one task.
    """
    every = star.dim_merchant.select("merchant_key", "merchant_name")
    spend = _per_key(star.fact, "merchant_key").join(every, "merchant_key").groupBy("merchant_name").agg(_total())
    whole = star.fact.agg(total(F.col("amount")).alias("whole")).scalar()
    return spend.withColumn("share_percent", percent(F.col("total_amount"), whole)).orderBy(
        F.desc("total_amount"), "merchant_name"
    )


# --- days -------------------------------------------------------------------------------------


def weekend_summary(star: Star) -> DataFrame:
    return (
        _by_day(star)
        .groupBy("is_weekend", day_type(F.col("is_weekend")).alias("day_type"))
        .agg(_count(), _total(), _avg())
        .orderBy("is_weekend")
    )


def weekend_category(star: Star) -> DataFrame:
    return (
        _per_key(star.fact, "date_key", "category_key")
        .join(star.dim_date, "date_key")
        .join(star.dim_category, "category_key")
        .groupBy("is_weekend", "category_name")
        .agg(_avg(), _count())
        .orderBy(F.desc("avg_amount"), "category_name", "is_weekend")
    )


def weekend_gap(star: Star) -> DataFrame:
    """Share of rows on either kind of day, and how far the weekend average lies from the weekday one."""

    def on(weekend: bool, col: str) -> Column:
        return F.sum(F.when(F.col("is_weekend") == weekend, F.col(col)))

    totals = _by_day(star).agg(
        *[
            on(weekend, col).alias(f"{name}{col}")
            for weekend, name in ((True, "end"), (False, "day"))
            for col in ("_rows", "_sum")
        ],
        F.sum("_rows").alias("_all"),
    )
    # avg_end / avg_day - 1, brought over one denominator so that it stays exact.
    ends = F.col("end_sum") * F.col("day_rows")
    days = F.col("day_sum") * F.col("end_rows")
    gap = F.round((ends - days).cast("decimal(38,2)") * 100 / days.cast("decimal(38,2)"), 2)
    return totals.select(
        percent(F.col("day_rows"), F.col("_all")).alias("weekday_percent"),
        percent(F.col("end_rows"), F.col("_all")).alias("weekend_percent"),
        mean(F.col("day_sum"), F.col("day_rows")).alias("weekday_avg"),
        mean(F.col("end_sum"), F.col("end_rows")).alias("weekend_avg"),
        gap.cast("decimal(30,2)").alias("avg_gap_percent"),
    )


def daily_trend(star: Star) -> DataFrame:
    return _by_day(star).groupBy("full_date", "day_name").agg(_count(), _total()).orderBy("full_date")


def moving_average(star: Star, rows: int = 7) -> DataFrame:
    """Daily trend with the mean of the last `rows` rows, NULL until there are that many.

    The one-task window sees one row per calendar day.
    """
    window = Window.orderBy("full_date").rowsBetween(1 - rows, 0)
    full = F.count(F.lit(1)).over(window) == rows
    average = mean(F.sum("total_amount").over(window), F.lit(rows))
    return daily_trend(star).withColumn("moving_avg", F.when(full, average))


def weekday_pattern(star: Star) -> DataFrame:
    return (
        _by_day(star).groupBy("day_of_week", "day_name").agg(_count(), _total(), _avg()).orderBy("day_of_week")
    )


def time_of_day_pattern(df: DataFrame, ts: str, amount: str) -> DataFrame:
    """Any table with a time column: morning, noon, evening."""
    return (
        df.groupBy(time_of_day(F.col(ts)).alias("time_of_day"))
        .agg(F.count(F.lit(1)).alias("txn_count"), total(F.col(amount)).alias("total_amount"))
        .orderBy("time_of_day")
    )


# --- cards and totals -------------------------------------------------------------------------


def card_summary(star: Star) -> DataFrame:
    return (
        _per_key(star.fact, "card_key")
        .join(star.dim_card, "card_key")
        .groupBy("card_company", "card_type")
        .agg(_count(), _total(), _avg())
        .orderBy(F.desc("total_amount"), "card_company", "card_type")
    )


def overall_statistics(star: Star) -> DataFrame:
    amount = F.col("amount")
    return star.fact.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        total(amount).alias("total_spent"),
        mean(F.sum(amount), F.count(amount)).alias("avg_transaction"),
        F.min(amount).alias("min_transaction"),
        F.max(amount).alias("max_transaction"),
        F.round(F.stddev_samp(amount), 2).alias("std_transaction"),
    )
