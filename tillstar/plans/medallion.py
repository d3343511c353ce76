"""Whole runs: raw feed to fact table, in full and in reduced forms."""

from __future__ import annotations

import hashlib
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.functions.keys import if_known, row_key
from tillstar.operators import quality
from tillstar.operators.clean import filter_valid, members, split_category
from tillstar.operators.dedup import dedup_hash, dedup_window
from tillstar.operators.keys import assert_unique, dense_key, max_key
from tillstar.operators.lookup import join_category, join_date, join_merchant_composite, small_enough
from tillstar.operators.merge import newer_than, not_among, touched_slices, upsert, upsert_slices
from tillstar.plans.dimensions import dim_card, dim_category, dim_date_covering, dim_merchant, grown_calendar
from tillstar.plans.fact import LOOKUPS, fact_transactions, small_dimensions
from tillstar.plans.layers import KEY, build_bronze, build_silver
from tillstar.sources.tables import (
    finished_folders,
    is_complete,
    materialize,
    publish_slices,
    publish_table,
    publish_version,
    read_snapshot,
    read_table,
    run_scratch,
    small_table,
    with_year_month,
    within_slices,
    write_slices,
    write_table,
    write_version,
)

MONTHS = ("year", "month")
DIMENSIONS = ("dim_date", "dim_category", "dim_merchant", "dim_card")


#: Checks whose failure keeps a layer from being published; the others are recorded.
GATE = ("required_column", "unique")


def load_dimensions(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    found = {name: read_snapshot(spark, f"{out}/{name}") for name in DIMENSIONS}
    return {name: df for name, df in found.items() if df is not None}


def build_dimensions(
    silver: DataFrame, out: str, as_of: date, calendar: DataFrame | None = None, found: list[tuple] | None = None
) -> dict[str, DataFrame]:
    """Write the next version of all four dimensions, merged with the newest earlier one.

    Each is written once, watched by its checks, and becomes visible when all four have passed; their results are added to
    `found`.
    """
    spark = silver.sparkSession
    old = load_dimensions(spark, out)
    built = {
        "dim_date": grown_calendar(silver, old.get("dim_date")) if calendar is None else calendar,
        "dim_category": dim_category(silver, old.get("dim_category")),
        "dim_merchant": dim_merchant(silver, as_of, old.get("dim_merchant")),
        "dim_card": dim_card(silver, old.get("dim_card")),
    }
    watched, written = {}, {}
    for name, df in built.items():
        watch = quality.Watch(name, quality.dimension_checks(name.removeprefix("dim_")))
        written[name] = write_version(df, f"{out}/{name}", publish=False, over=watch.over)
        watched[name] = watch, read_table(spark, f"{out}/{name}/version={written[name]}")
    results = quality.watched_results(watched)
    quality.refuse(results, GATE)
    for name, version in written.items():
        publish_version(spark, f"{out}/{name}", version)
    if found is not None:
        found += results
    return load_dimensions(spark, out)


def run_full(
    spark: SparkSession,
    raw_path: str,
    out: str,
    as_of: date,
    calendar: DataFrame | None = None,
    history: bool = False,
    date_keys: tuple[int, int] = quality.DATE_KEY_RANGE,
) -> dict[str, DataFrame]:
    """Raw feed to bronze, silver, dimensions and fact under `out`; a further run adds its feed to all of them.

    The fact's `created_at` is silver's processing time, so its maximum tells
    an incremental run exactly which silver rows the fact has seen. With
    `history`, facts point to the merchant version of their own date instead of
    the current one. Checks run while the layers are written: a layer that
    fails one of `GATE` is not published, and `load_checks` has all results.
    """
    return _run(spark, raw_path, out, as_of, calendar, history, date_keys)


def run_incremental(
    spark: SparkSession,
    out: str,
    as_of: date,
    feed: str | None = None,
    history: bool = False,
    date_keys: tuple[int, int] = quality.DATE_KEY_RANGE,
) -> dict[str, DataFrame]:
    """The next fact version: the newest one with the silver rows processed since, after merging `feed` if one is given.

    Only months that the new rows lie in, or that their transactions lay in
    before, are read and written; the new version takes all others from the
    earlier ones, which stay as they are.
    """
    return _run(spark, feed, out, as_of, None, history, date_keys)


def _run(spark, feed, out, as_of, calendar, history, date_keys) -> dict[str, DataFrame]:
    found: list[tuple] = []
    with run_scratch(spark):
        if feed is not None:
            merge_feed(spark, feed, out, found=found)
        _update_fact(spark, out, as_of, calendar, history, date_keys, found)
    return load_star(spark, out)


def _update_fact(spark, out, as_of, calendar, history, date_keys, found) -> None:
    base = f"{out}/fact_transactions"
    if not is_complete(spark, f"{out}/silver"):
        return  # no valid row has come yet
    silver, fact = read_table(spark, f"{out}/silver"), read_snapshot(spark, base)
    watch = quality.Watch("fact_transactions", [c for c in quality.fact_checks(date_keys) if c.name != "unique"])
    if fact is None:
        dims = build_dimensions(silver, out, as_of, calendar, found)
        small = small_dimensions(dims)
        rows = fact_transactions(silver, dims, as_of=history, created_at="processed_at", small=small)
        # Without a shuffled lookup, the rows keep the monthly layout of silver.
        version = write_version(rows, base, MONTHS, small.issuperset(LOOKUPS), publish=False, over=watch.over)
        found += watch.results()
        quality.refuse(found, GATE)
        publish_version(spark, base, version)
    else:
        fresh = newer_than(silver, fact.select(F.col("created_at").alias("processed_at")), "processed_at")
        places = {tuple(row) for row in fresh.select(*MONTHS).distinct().collect()}
        if not places:
            return
        fresh = within_slices(fresh, MONTHS, places)  # silver stays as it is, so its new rows are read where they lie
        assert_unique(fresh, KEY, "new silver rows")
        dims = build_dimensions(fresh, out, as_of, calendar, found)
        start, small = max_key(fact, "transaction_key"), small_dimensions(dims)
        rows = fact_transactions(fresh, dims, start=start, as_of=history, created_at="processed_at", small=small)
        # As in the first run, rows without a shuffled lookup keep the monthly layout; others are staged in it.
        rows = rows if small.issuperset(LOOKUPS) else materialize(rows, "new_facts", MONTHS)
        merged, touched, clustered = update_slices(fact, rows, fresh.select(*KEY, *MONTHS))
        version = write_slices(merged, base, MONTHS, clustered=clustered, over=watch.over)
        found += watch.results()
        quality.refuse(found, GATE)
        publish_slices(spark, base, version, MONTHS, touched)
    write_table(small_table(spark, found, quality.RESULT).coalesce(1), f"{out}/checks/version={version}")


def update_slices(fact: DataFrame, rows: DataFrame, laid: DataFrame | None = None) -> tuple[DataFrame, set[tuple], bool]:
    """The months that new facts touch, with the new facts in them; and whether all rows are laid out by month.

    `laid` has the keys and months of new facts that lie by month already, from a cheaper plan; they go to the write as they
    lie. While the new keys are few enough to broadcast, so do kept rows; otherwise kept rows alone are shuffled again.
    """
    known = rows if laid is None else laid
    touched = touched_slices(fact, known, KEY, MONTHS)
    few = bool(small_enough({"keys": known.select(*KEY)}))
    there = within_slices(fact, MONTHS, touched)
    if few:
        source = rows if laid is not None else rows.hint("rebalance", *MONTHS)
        return upsert(there, source, KEY, check=False, small=True), touched, True
    if laid is None:
        return upsert(there, rows, KEY, check=False, small=False), touched, False
    kept = not_among(there, known.select(*KEY), KEY, False).hint("rebalance", *MONTHS)
    return kept.unionByName(rows), touched, True


def load_star(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """All tables of the finished runs; none of silver and the star before a valid row has come."""
    if not is_complete(spark, f"{out}/silver"):
        return {}
    found = {"bronze": read_bronze(spark, out), "silver": read_table(spark, f"{out}/silver"), **load_dimensions(spark, out)}
    fact = read_snapshot(spark, f"{out}/fact_transactions")
    return found if fact is None else {**found, "fact_transactions": fact}


def load_checks(spark: SparkSession, out: str, version: int | None = None) -> DataFrame | None:
    """The results of the checks that ran while a fact version and its layers were written, by default the newest."""
    return read_snapshot(spark, f"{out}/checks", version)


# --- bronze loads and silver ------------------------------------------------------------------
#
# Bronze holds one folder per load, `load=<digest of its files>`. A load counts once its list of files stands in `_files`, which
# is written last, after silver has its rows: until then the same feed writes the same folder again, and afterwards its files
# are known and left out. Raw files are not rewritten under the same name.


def _known_loads(spark: SparkSession, out: str) -> list[str]:
    return [f"{out}/bronze/_files/{name}" for name in finished_folders(spark, f"{out}/bronze/_files", "load=")]


def read_bronze(spark: SparkSession, out: str) -> DataFrame | None:
    """All finished loads; the column `load` names them."""
    loads = [f"{out}/bronze/{name}" for name in finished_folders(spark, f"{out}/bronze/_files", "load=")]
    return spark.read.option("basePath", f"{out}/bronze").parquet(*loads) if loads else None


def _new_files(spark: SparkSession, feed: str, out: str) -> list[str]:
    """Files of the feed that no finished load has."""
    files = read_table(spark, feed).inputFiles()
    known = _known_loads(spark, out)
    if known and files:
        listed = small_table(spark, [(f,) for f in files], "source_file string")
        files = [r["source_file"] for r in listed.join(spark.read.parquet(*known), "source_file", "left_anti").collect()]
    return sorted(files)


def merge_feed(spark: SparkSession, feed: str, out: str, found: list[tuple] | None = None) -> int:
    """Add the files of a feed that bronze does not have yet to bronze, and their transactions to silver; the number of files.

    A transaction that silver has already is replaced, also when its date has
    moved it to another month; only the months concerned are rewritten. The
    same feed again adds nothing, and a feed whose merge died is taken up anew.
    """
    files = _new_files(spark, feed, out)
    if not files:
        return 0
    load = f"load={hashlib.md5(chr(10).join(files).encode()).hexdigest()[:16]}"
    raw = spark.read.option("basePath", feed).parquet(*files)
    merge_rows(spark, build_bronze(raw), out, load, found)
    write_table(small_table(spark, [(f,) for f in files], "source_file string").coalesce(1), f"{out}/bronze/_files/{load}")
    return len(files)


def merge_rows(spark: SparkSession, rows: DataFrame, out: str, load: str, found: list[tuple] | None = None) -> None:
    """Write bronze rows as the load of that name, and upsert their transactions into silver. Repeating it changes nothing.

    Without rows silver stays as it is, also where there is none yet.
    """
    path, silver = f"{out}/bronze/{load}", f"{out}/silver"
    watched = [c for c in quality.bronze_checks() if c.name != "unique"]  # copies are silver's business
    watch = quality.Watch("bronze", watched)
    write_table(rows, path, MONTHS, over=watch.over)
    written = spark.read.schema(rows.schema).parquet(path)
    results = watch.results()
    new = build_silver(written)
    watch = quality.Watch("silver", [c for c in quality.silver_checks() if c.name != "unique"])  # one row per transaction
    if not is_complete(spark, silver):
        write_table(new, silver, MONTHS, publish=False, over=watch.over)
        results += watch.results()
        quality.refuse(results, GATE)
        if watch.rows:
            publish_table(spark, silver)
    else:
        staged = materialize(new, "new_silver", MONTHS, over=watch.over)
        results += watch.results()
        quality.refuse(results, GATE)
        upsert_slices(spark, silver, staged, KEY, MONTHS, staged=True)
    if found is not None:
        found += results


def run_one_pass(raw: DataFrame, dim_date: DataFrame, key=row_key) -> DataFrame:
    """Raw feed to fact in one lineage with a single shuffle.

    Category and merchant keys come from the row's own content, so no
    dimension has to be built first or joined. Merchants keep their raw names.
    """
    columns = ["transaction_id", "transaction_date", "merchant_name", "merchant_category", "amount"]
    rows = dedup_window(filter_valid(raw.select(*columns), ("transaction_date",)), KEY, ["transaction_date"])
    return join_date(with_year_month(rows), dim_date).select(
        F.monotonically_increasing_id().alias("transaction_key"),
        "date_key",
        "year",
        "month",
        if_known(key, F.col("merchant_category")).alias("category_key"),
        if_known(key, F.col("merchant_name"), F.col("merchant_category")).alias("merchant_key"),
        "transaction_id",
        "amount",
        F.lit(1).alias("quantity"),
        F.current_timestamp().alias("created_at"),
    )


def one_pass_dimensions(raw: DataFrame, key=row_key) -> dict[str, DataFrame]:
    """The tables that the keys of `run_one_pass` resolve in: the same content keys, over the members of the raw feed.

    A member is a row per task before anything moves.
    """
    rows = filter_valid(raw.select("transaction_date", "merchant_name", "merchant_category", "amount"), ("transaction_date",))
    category, pair = F.col("merchant_category"), (F.col("merchant_name"), F.col("merchant_category"))
    categories = split_category(members(rows.filter(category.isNotNull()), ["merchant_category"]))
    merchants = members(rows.filter("merchant_name IS NOT NULL AND merchant_category IS NOT NULL"), ["merchant_name", "merchant_category"])
    return {
        "dim_category": categories.select(
            if_known(key, category).alias("category_key"), category.alias("category_name"), "level_1", "level_2"
        ),
        "dim_merchant": merchants.select(if_known(key, *pair).alias("merchant_key"), *pair),
    }


def write_one_pass(spark: SparkSession, raw_path: str, out: str, codec: str | None = None, key=row_key) -> dict[str, DataFrame]:
    """The one-pass mart with the dimensions of its keys, whose uniqueness is checked."""
    raw = read_table(spark, raw_path)
    dims = {"dim_date": dim_date_covering(raw), **one_pass_dimensions(raw, key)}
    for name, df in dims.items():
        write_table(df, f"{out}/{name}", codec=codec)
        assert_unique(read_table(spark, f"{out}/{name}"), [df.columns[0]], name)
    fact = run_one_pass(raw, read_table(spark, f"{out}/dim_date"), key)
    write_table(fact, f"{out}/fact_transactions", MONTHS, codec=codec)
    return {name: read_table(spark, f"{out}/{name}") for name in (*dims, "fact_transactions")}


def write_hash_mart(spark: SparkSession, raw_path: str, out: str, codec: str | None = None) -> dict[str, DataFrame]:
    """The reduced mart with the dimensions of its keys."""
    with run_scratch(spark):
        made = hash_mart(read_table(spark, raw_path))
        for name, df in made.items():
            write_table(df, f"{out}/{name}", codec=codec)
    return {name: read_table(spark, f"{out}/{name}") for name in made}


def run_hash_mart(raw: DataFrame) -> DataFrame:
    """Facts of the reduced mart."""
    return hash_mart(raw)["fact_transactions"]


def hash_mart(raw: DataFrame) -> dict[str, DataFrame]:
    """Reduced mart: hash deduplication, dense keys, rows without a merchant or category dropped.

    Both dimensions come from one pass that leaves the pairs of merchant and category.
    """
    columns = ["transaction_id", "transaction_date", "merchant_name", "merchant_category", "amount"]
    silver = with_year_month(dedup_hash(filter_valid(raw.select(*columns), ()), KEY, ["transaction_date"]))
    pairs = materialize(members(silver.filter("merchant_category IS NOT NULL"), ["merchant_name", "merchant_category"]), "mart_members")
    small = bool(small_enough({"pairs": pairs}))  # then each dimension is too, and one range of keys will do
    ranges = 1 if small else None
    categories = members(pairs, [F.col("merchant_category").alias("category_name")])
    dim_cat = dense_key(categories, "category_key", ["category_name"], partitions=ranges)
    merchants = pairs.filter("merchant_name IS NOT NULL")
    dim_mer = dense_key(merchants, "merchant_key", ["merchant_name", "merchant_category"], partitions=ranges)
    rows = join_category(silver, dim_cat, "inner", small=small)
    rows = join_merchant_composite(rows, dim_mer, "inner", small=small)
    fact = rows.select("transaction_id", "year", "month", "category_key", "merchant_key", "amount")
    return {"dim_category": dim_cat, "dim_merchant": dim_mer, "fact_transactions": fact}


def run_window_mart(raw: DataFrame) -> DataFrame:
    """Flat fact: window deduplication, then the amount filter, then dense transaction keys."""
    columns = ["transaction_id", "transaction_date", "amount", "merchant_name", "merchant_category"]
    rows = filter_valid(dedup_window(raw.select(*columns), KEY, ["transaction_date"]), ())
    return dense_key(with_year_month(rows), "transaction_key", ["transaction_id"])
