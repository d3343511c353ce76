"""The registered queries, one or more per operator id, all over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from tillstar.functions.calendar import calendar_columns, date_key, year_month_label
from tillstar.functions.keys import content_key
from tillstar.functions.money import in_units, total
from tillstar.functions.text import day_type, normalize_merchant, transaction_type
from tillstar.operators import clean, dedup, keys, lookup, merge, quality
from tillstar.plans import dimensions, fact, layers, medallion, reports
from tillstar.plans.prepared import FIRST_LOAD, MONTHS, Prepared
from tillstar.sources import bucketed, card_feed, generator, schemas, tables
from tillstar.streaming import ingest

CUT = date(2001, 1, 1)
OVERLAP = date(2000, 10, 1)
SNAPSHOT_A, SNAPSHOT_B = date(2000, 1, 1), date(2001, 1, 1)

_QUERIES: dict[str, Callable[[Prepared], DataFrame]] = {}


def query(fn: Callable[[Prepared], DataFrame]) -> Callable[[Prepared], DataFrame]:
    _QUERIES[fn.__name__] = fn
    return fn


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and times as text: types that every engine's client renders alike."""
    cols = []
    for f in df.schema.fields:
        col = F.col(f.name)
        if isinstance(f.dataType, DecimalType):
            col = col.cast("double")
        elif isinstance(f.dataType, DateType):
            col = col.cast("string")
        elif isinstance(f.dataType, (TimestampNTZType, TimestampType)):
            col = col.cast("string").substr(1, 19)
        cols.append(col.alias(f.name))
    return df.select(*cols)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(Prepared.of(spark, sf_dir)))

        run.__name__ = fn.__name__
        return run

    return {name: bind(fn) for name, fn in _QUERIES.items()}


def _scratch(p: Prepared, label: str) -> str:
    return tables.scratch_path(p.spark, label)


# --- sources, sinks, layout -------------------------------------------------------------------


@query
def src_1_scan_raw(p):
    return tables.read_table(p.spark, p.path("raw"))


@query
def src_1_derive_feed(p):
    """The feed itself, straight from the order tables in one lazy plan."""
    return card_feed.card_feed(p.spark, p.folder)


@query
def src_2_lineage(p):
    return tables.with_lineage(p.raw).select(
        "transaction_id",
        "amount",
        F.col("ingestion_timestamp").isNotNull().alias("has_time"),
        F.col("source_file").endswith(".parquet").alias("has_source"),
    )


@query
def src_3_year_month(p):
    return tables.with_year_month(p.raw).select("transaction_id", "transaction_date", "year", "month")


@query
def src_4_partitioned_write(p):
    path = _scratch(p, "by_month")
    for _ in range(2):  # the second run replaces the first
        tables.write_table(tables.with_year_month(p.raw), path, MONTHS)
    return tables.read_table(p.spark, path).drop("created_at")


@query
def src_5_rerun_modes(p):
    feed, found = p.raw.select("transaction_id", "amount"), []
    for mode in ("overwrite", "append"):
        path = _scratch(p, mode)
        for _ in range(2):
            tables.write_table(feed, path, mode=mode)
        found.append(
            tables.read_table(p.spark, path).agg(
                F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("row_count"), total(F.col("amount")).alias("amount")
            )
        )
    return found[0].unionByName(found[1])


@query
def src_6_read_by_path(p):
    path = p.path("silver")
    return p.spark.sql(
        f"SELECT year, month, count(*) AS row_count, CAST(sum(amount) AS DECIMAL(25,2)) AS amount "
        f"FROM parquet.`{path}` GROUP BY year, month"
    )


@query
def src_7_sql_views(p):
    tables.register_views(p.tables)
    return p.spark.sql(
        """
        WITH spend AS (
          SELECT date_key, category_key, sum(amount) AS day_amount
          FROM fact_transactions
          GROUP BY date_key, category_key
        )
        SELECT year, month_name, level_1 AS category, CAST(sum(day_amount) AS DECIMAL(25,2)) AS total_amount
        FROM spend JOIN dim_date USING (date_key) JOIN dim_category USING (category_key)
        GROUP BY year, month, month_name, level_1
        ORDER BY year, month, total_amount DESC, category
        """
    )


@query
def src_8_schema_evolution(p):
    """Rows before the cut were written without two columns; the read merges both file schemas."""
    path = _scratch(p, "evolved")
    feed = p.raw.select("transaction_id", "transaction_date", "amount", "card_type", "card_company")
    old, new = feed.filter(F.col("transaction_date") < CUT), feed.filter(F.col("transaction_date") >= CUT)
    tables.write_table(old.drop("card_type", "card_company"), path)
    tables.write_table(new, path, mode="append")
    merged = tables.read_table(p.spark, path, merge_schema=True)
    return schemas.align_schema(merged, feed.schema, {"card_company": "UNKNOWN"})


@query
def src_8_union_by_name(p):
    feed = p.raw.select("transaction_id", "transaction_date", "amount", "card_company")
    old, new = feed.filter(F.col("transaction_date") < CUT), feed.filter(F.col("transaction_date") >= CUT)
    return schemas.merge_all(old.drop("card_company"), new)


@query
def src_9_conform_card(p):
    """Text input with unreadable amounts in it."""
    text = p.raw.select(
        "transaction_id",
        F.col("transaction_date").cast("string").alias("transaction_date"),
        "merchant_name",
        "merchant_category",
        F.when(F.col("transaction_id").endswith("-3"), "n/a").otherwise(F.col("amount").cast("string")).alias("amount"),
        "card_number",
        "card_type",
        "card_company",
        F.col("created_at").cast("string").alias("created_at"),
    )
    fitted = schemas.conform(text, schemas.CARD_TRANSACTION, "lost_fields")
    return fitted.withColumn("lost_fields", F.array_join("lost_fields", ","))


@query
def src_9_conform_bank(p):
    feed = (
        card_feed.table(p.spark, p.folder, "orders")
        .join(card_feed.table(p.spark, p.folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("transaction_id"),
            F.col("o_orderdate").alias("transaction_date"),
            F.col("o_orderpriority").alias("description"),
            F.col("o_totalprice").alias("amount"),
            F.col("c_acctbal").alias("balance"),
            F.col("c_custkey").alias("account_number"),
            F.col("o_orderdate").alias("created_at"),
        )
    )
    return schemas.conform(feed, schemas.BANK_TRANSACTION)


@query
def src_9_conform_stock(p):
    feed = (
        card_feed.table(p.spark, p.folder, "lineitem")
        .join(card_feed.table(p.spark, p.folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
            F.col("l_shipdate").alias("transaction_date"),
            F.col("p_brand").alias("stock_code"),
            F.col("p_name").alias("stock_name"),
            F.col("l_returnflag").alias("transaction_type"),
            F.col("l_quantity").alias("quantity"),
            F.col("p_retailprice").alias("price"),
            F.col("l_extendedprice").alias("total_amount"),
            F.col("l_shipdate").alias("created_at"),
        )
    )
    return schemas.conform(feed, schemas.STOCK_TRANSACTION)


@query
def src_10_export_codecs(p):
    found = []
    for codec in ("snappy", "uncompressed"):
        path = _scratch(p, codec)
        tables.export(p.silver.select("transaction_id", "year", "month", "amount"), path, codec)
        found.append(tables.read_table(p.spark, path).withColumn("codec", F.lit(codec)))
    return found[0].unionByName(found[1])


@query
def src_11_copy_floor(p):
    path = _scratch(p, "copy")
    tables.copy_table(p.spark, p.path("raw"), path)
    return tables.read_table(p.spark, path)


@query
def src_12_report_json(p):
    path = _scratch(p, "report")
    quality.write_report(quality.run_checks(p.raw, "bronze", quality.bronze_checks()), path)
    return p.spark.read.json(path).select("layer", "check_name", "column_name", "failed_rows", "passed")


def _catalog(p: Prepared) -> DataFrame:
    """A merchant catalogue made from the suppliers."""
    low = F.col("s_suppkey") % 50 * 100 + 1000
    return card_feed.merchants(p.spark, p.folder).select(
        F.col("s_name").alias("name"),
        F.col("r_name").alias("category"),
        F.col("n_name").alias("subcategory"),
        low.alias("min_amount"),
        (low * 10).alias("max_amount"),
    )


@query
def src_14_generate(p):
    """One generated transaction per order id."""
    ids = card_feed.table(p.spark, p.folder, "orders").select(F.col("o_orderkey").alias("id"))
    return generator.generate_transactions(p.spark, ids, catalog=_catalog(p)).drop("created_at")


@query
def src_15_catalog_filter(p):
    return generator.merchants_by_category(_catalog(p), "ASIA")


@query
def src_16_compact(p):
    path = _scratch(p, "clustered")
    tables.compact(p.spark, p.path("raw"), path, ("transaction_date", "transaction_id"))
    return tables.read_table(p.spark, path)


@query
def src_16_zorder(p):
    """Clustered by two keys at once; the rows stay what they are."""
    path = _scratch(p, "zorder")
    tables.zorder(p.spark, p.path("raw"), path, ("transaction_date", "amount"))
    return tables.read_table(p.spark, path)


@query
def src_17_snapshot(p):
    base = _scratch(p, "versions")
    first = p.silver.select("transaction_id", "transaction_date", "amount")
    tables.write_version(first.filter(F.col("transaction_date") < CUT), base)
    tables.write_version(first, base)
    found = [
        tables.read_snapshot(p.spark, base, version).agg(
            F.lit(label).alias("snapshot"), F.count(F.lit(1)).alias("row_count"), total(F.col("amount")).alias("amount")
        )
        for label, version in (("earlier", 1), ("latest", None))
    ]
    return found[0].unionByName(found[1])


@query
def src_18_rebuild_slice(p):
    path = _scratch(p, "slices")
    rows = p.silver.select("transaction_id", "amount", "year", "month")
    tables.write_table(rows, path, MONTHS)
    march = (F.col("year") == 1998) & (F.col("month") == 3)
    tables.rebuild_slice(rows, lambda df: df.withColumn("amount", F.col("amount") + 1), path, march)
    return tables.read_table(p.spark, path)


@query
def str_1_stream_ingest(p):
    """The raw files taken in by a stream, twice; the second call finds nothing new."""
    bronze, checkpoint = _scratch(p, "stream_bronze"), _scratch(p, "stream_checkpoint")
    for _ in range(2):
        ingest.ingest_new_files(p.spark, p.path("raw"), p.raw.schema, bronze, checkpoint)
    taken = tables.read_table(p.spark, bronze)
    return taken.select(
        "transaction_id", "transaction_date", "amount", "year", "month", F.col("source_file").isNotNull().alias("has_source")
    )


def _feed_parts(p: Prepared) -> list[DataFrame]:
    """The feed up to the cut; later rows and some before it, corrected; and the oldest rows once more."""
    early = p.raw.filter(F.col("transaction_date") < CUT)
    corrected = p.raw.filter(F.col("transaction_date") >= OVERLAP)
    corrected = corrected.withColumn("amount", (F.col("amount") + 1).cast("decimal(15,2)"))
    return [early, corrected, p.raw.filter(F.col("transaction_date") < date(1996, 1, 1))]


@query
def str_1_stream_merge(p):
    """Files that arrive one after the other, with corrections and repeats, through bronze and silver to the fact."""
    feed, out, checkpoint = (_scratch(p, f"stream_{part}") for part in ("feed", "out", "checkpoint"))
    for part in _feed_parts(p):
        tables.write_table(part, feed, mode="append")
        ingest.merge_new_files(p.spark, feed, p.raw.schema, out, checkpoint, FIRST_LOAD)
    ingest.merge_new_files(p.spark, feed, p.raw.schema, out, checkpoint, FIRST_LOAD)  # nothing new
    star = medallion.load_star(p.spark, out)
    return star["fact_transactions"].select("transaction_id", "year", "month", "date_key", "category_key", "merchant_key", "amount")


# --- projections, filters, scalars ------------------------------------------------------------


@query
def prj_1_valid(p):
    return clean.filter_valid(p.raw).drop("created_at")


@query
def prj_1_valid_without_merchant(p):
    return clean.filter_valid(p.raw, ("transaction_date",)).select("transaction_id", "merchant_name", "amount")


@query
def prj_1_valid_amount_only(p):
    return clean.filter_valid(p.raw, ()).select("transaction_id", "transaction_date", "amount")


@query
def prj_2_rejects(p):
    return clean.rejects(p.raw).drop("created_at")


@query
def prj_3_normalize_merchant(p):
    name = F.col("merchant_name")
    return p.raw.select("transaction_id", name, normalize_merchant(name).alias("normalized_merchant"))


@query
def prj_4_transaction_type(p):
    return p.raw.select("transaction_id", "amount", transaction_type(F.col("amount")).alias("transaction_type"))


@query
def prj_5_select_silver(p):
    return clean.select_silver(clean.with_silver_columns(p.raw))


@query
def prj_6_split_category(p):
    return clean.split_category(p.raw.select("transaction_id", "merchant_category"))


@query
def prj_7_constant_columns(p):
    stamped = clean.with_audit_time(p.silver.select("transaction_id", "amount"), "loaded_at")
    return stamped.select(
        "transaction_id", "amount", F.lit(1).alias("quantity"), F.col("loaded_at").isNotNull().alias("has_loaded_at")
    )


@query
def prj_8_members(p):
    return clean.members(p.silver, ["merchant_category", "card_company", "card_type"])


@query
def prj_9_calendar_columns(p):
    return p.raw.select("transaction_id", *calendar_columns(F.col("transaction_date")))


def _holidays(p: Prepared) -> DataFrame:
    """1 January and 25 December of every year in the calendar."""
    day = F.col("full_date")
    fixed = ((F.month(day) == 1) & (F.dayofmonth(day) == 1)) | ((F.month(day) == 12) & (F.dayofmonth(day) == 25))
    return p.table("dim_date").filter(fixed).select(day.alias("holiday_date"))


@query
def prj_10_holidays(p):
    return clean.with_holidays(p.table("dim_date"), _holidays(p))


@query
def prj_11_rounding_units(p):
    amount = F.col("amount")
    return p.silver.select(
        "transaction_id",
        F.round(amount, 0).cast("decimal(15,0)").alias("rounded"),
        in_units(amount, 1000).alias("thousands"),
        in_units(amount, 1_000_000).alias("millions"),
        year_month_label(F.col("year"), F.col("month")).alias("year_month"),
    )


@query
def prj_12_day_type(p):
    weekend = F.weekday("transaction_date") >= 5
    return p.raw.select("transaction_id", "transaction_date", day_type(weekend).alias("day_type"))


@query
def prj_13_sample(p):
    return clean.sample_for_checks(p.silver.select("transaction_id", "amount"), 0.01, digest=content_key)


# --- deduplication ----------------------------------------------------------------------------


@query
def ded_1_any(p):
    """Which copy stays is open, so only the key is reported."""
    return dedup.dedup_any(clean.filter_valid(p.raw), layers.KEY).select("transaction_id")


@query
def ded_2_hash(p):
    return dedup.dedup_hash(clean.filter_valid(p.raw), layers.KEY, ["transaction_date"])


@query
def ded_3_window(p):
    return dedup.dedup_window(clean.filter_valid(p.raw), layers.KEY, ["transaction_date"])


@query
def ded_3_dedup_first(p):
    return clean.filter_valid(dedup.dedup_window(p.raw, layers.KEY, ["transaction_date"]))


@query
def ded_4_stats(p):
    return dedup.dedup_stats(p.raw, layers.KEY)


# --- joins ------------------------------------------------------------------------------------


@query
def jon_1_date(p):
    """A calendar that ends early leaves later rows with a NULL key."""
    calendar = p.table("dim_date").filter(F.col("full_date") <= date(2001, 6, 30))
    return lookup.join_date(p.silver.select("transaction_id", "transaction_date"), calendar)


@query
def jon_2_category(p):
    return lookup.join_category(p.silver.select("transaction_id", "merchant_category"), p.table("dim_category"))


@query
def jon_3_merchant_current(p):
    return lookup.join_merchant_current(p.silver.select("transaction_id", "normalized_merchant"), _snapshot_b(p))


@query
def jon_4_merchant_composite(p):
    rows = p.silver.select("transaction_id", "normalized_merchant", "merchant_category")
    return lookup.join_merchant_composite(rows, p.table("dim_merchant"), name="normalized_merchant")


@query
def jon_5_card(p):
    rows = p.silver.select("transaction_id", "card_number", "card_type", "card_company")
    return lookup.join_card(rows, p.table("dim_card"))


@query
def jon_6_inner(p):
    calendar = p.table("dim_date").filter(F.col("full_date") <= date(2001, 6, 30))
    rows = p.silver.select("transaction_id", "transaction_date", "merchant_category")
    return lookup.join_category(lookup.join_date(rows, calendar, "inner"), p.table("dim_category"), "inner")


@query
def jon_7_star(p):
    s = p.star
    return (
        s.fact.join(s.dim_category, "category_key")
        .join(s.dim_merchant.filter("is_current"), "merchant_key")
        .select("transaction_id", "merchant_name", "level_1", "level_2", "amount")
    )


@query
def jon_8_changes(p):
    return lookup.detect_changes(_merchants_b(p), _merchants_a(p), "merchant_name", ["merchant_category"])


@query
def jon_9_asof(p):
    rows = p.silver.select("transaction_id", "transaction_date", "normalized_merchant")
    return lookup.join_merchant_asof(rows, _snapshot_b(p))


@query
def jon_9_asof_merged(p):
    """The same, with versions too many to broadcast: rows and versions in one ordered pass."""
    rows = p.silver.select("transaction_id", "transaction_date", "normalized_merchant")
    return lookup.join_merchant_asof(rows, _snapshot_b(p), small=False)


@query
def jon_10_orphans(p):
    calendar = p.table("dim_date").filter(F.col("full_date") <= date(2001, 6, 30))
    rows = p.table("fact_transactions").select("date_key", "transaction_id")
    return lookup.orphans(rows, "date_key", calendar)


# --- merges -----------------------------------------------------------------------------------


def _merchants_a(p: Prepared) -> DataFrame:
    feed = card_feed.merchants(p.spark, p.folder).filter(F.col("s_suppkey") % 10 != 9)
    return feed.select(F.col("s_name").alias("merchant_name"), card_feed.category_of().alias("merchant_category"))


def _merchants_b(p: Prepared) -> DataFrame:
    moved = F.concat(F.lit("RECLASS-"), "n_name")
    feed = card_feed.merchants(p.spark, p.folder).filter(F.col("s_suppkey") % 10 != 8)
    category = F.when(F.col("s_suppkey") % 10 == 0, moved).otherwise(card_feed.category_of())
    return feed.select(F.col("s_name").alias("merchant_name"), category.alias("merchant_category"))


def _snapshot_a(p: Prepared) -> DataFrame:
    first = merge.scd2_init(_merchants_a(p), SNAPSHOT_A)
    return merge.with_version_key(first, "merchant_name", ["merchant_category"], "merchant_key")


def _snapshot_b(p: Prepared) -> DataFrame:
    merged = merge.scd2_merge(_snapshot_a(p), _merchants_b(p), "merchant_name", ["merchant_category"], SNAPSHOT_B)
    return tables.materialize(merged, "dim_merchant_b")


@query
def mrg_1_scd1_category(p):
    """Categories seen before the cut, then those of the whole feed and a reclassified set."""
    moved = F.concat(F.lit("RECLASS-"), F.col("merchant_category"))
    early = p.silver.filter(F.col("transaction_date") < CUT)
    late = p.silver.select(
        F.when(F.col("card_type") == "Debit", moved).otherwise(F.col("merchant_category")).alias("merchant_category")
    )
    first = tables.materialize(dimensions.dim_category(early), "dim_category")
    return dimensions.dim_category(late, first)


@query
def mrg_1_scd1_card(p):
    early = p.silver.filter(F.col("transaction_date") < date(1996, 1, 1))
    return dimensions.dim_card(p.silver, dimensions.dim_card(early))


def _delta(p: Prepared, rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("transaction_date") >= OVERLAP).withColumn(
        "amount", (F.col("amount") + 1).cast("decimal(15,2)")
    )


@query
def mrg_2_upsert(p):
    rows = p.silver.select("transaction_id", "transaction_date", "year", "month", "amount")
    base = rows.filter(F.col("transaction_date") < CUT)
    return merge.upsert(base, _delta(p, rows), layers.KEY)


@query
def mrg_2_large_source(p):
    """The same, with keys too many to broadcast: a Bloom filter parts the target."""
    rows = p.silver.select("transaction_id", "transaction_date", "year", "month", "amount")
    base = rows.filter(F.col("transaction_date") < CUT)
    return merge.upsert(base, _delta(p, rows), layers.KEY, small=False)


@query
def mrg_2_bucketed(p):
    """The same, with the target in buckets of its key: the source alone is shuffled, and the result is bucketed again."""
    rows = p.silver.select("transaction_id", "transaction_date", "year", "month", "amount")
    old, new = _scratch(p, "bucketed"), _scratch(p, "bucketed")
    buckets = int(p.spark.conf.get("spark.sql.shuffle.partitions"))
    bucketed.write_bucketed(rows.filter(F.col("transaction_date") < CUT), old, layers.KEY, buckets)
    target = bucketed.read_bucketed(p.spark, old, layers.KEY, buckets)
    bucketed.write_bucketed(merge.upsert_bucketed(target, _delta(p, rows), layers.KEY), new, layers.KEY, buckets, dealt=True)
    return bucketed.read_bucketed(p.spark, new, layers.KEY, buckets)


@query
def mrg_3_scd2(p):
    return _snapshot_b(p)


@query
def mrg_3_scd2_repeated(p):
    """The same batch a second time changes nothing."""
    return merge.scd2_merge(_snapshot_b(p), _merchants_b(p), "merchant_name", ["merchant_category"], SNAPSHOT_B)


@query
def mrg_4_scd2_init(p):
    return _snapshot_a(p)


@query
def mrg_5_scd2_bootstrap(p):
    return merge.scd2_bootstrap(_merchants_a(p))


@query
def mrg_6_incremental(p):
    """Rows past the stored watermark, upserted into their months in place."""
    path = _scratch(p, "incremental")
    rows = p.silver.select("transaction_id", "amount", "processed_at", "year", "month")
    tables.write_table(rows.filter(F.col("processed_at") < F.lit(CUT)), path, MONTHS)
    fresh = merge.newer_than(rows, tables.read_table(p.spark, path), "processed_at")
    fresh = fresh.withColumn("amount", (F.col("amount") + 1).cast("decimal(15,2)"))
    merge.upsert_slices(p.spark, path, fresh, layers.KEY, MONTHS)
    return tables.read_table(p.spark, path)


def _in_two_loads(p: Prepared, label: str) -> str:
    """The feed up to the cut in a full run, then the rest as an increment."""
    out, early, late = (_scratch(p, f"{label}_{part}") for part in ("out", "early", "late"))
    tables.write_table(p.raw.filter(F.col("transaction_date") < CUT), early)
    tables.write_table(p.raw.filter(F.col("transaction_date") >= CUT), late)
    medallion.run_full(p.spark, early, out, FIRST_LOAD)
    medallion.run_incremental(p.spark, out, CUT, late)
    return out


@query
def mrg_6_run_incremental(p):
    """A further feed through bronze and silver to the fact; the calendar grows with it."""
    star = medallion.load_star(p.spark, _in_two_loads(p, "increment"))
    cards = star["dim_card"].withColumnRenamed("card_number", "_number")
    return (
        star["fact_transactions"]
        .join(cards, "card_key")
        .select("transaction_id", "year", "month", "date_key", "category_key", "merchant_key",
                F.col("_number").alias("card_number"), "card_type", "card_company", "amount")
    )


@query
def src_17_snapshot_after_incremental(p):
    """The first fact version, read after an increment has made the second."""
    first = tables.read_snapshot(p.spark, f"{_in_two_loads(p, 'snapshots')}/fact_transactions", 1)
    return first.select("transaction_id", "year", "month", "date_key", "amount")


@query
def mrg_6_upsert_slices(p):
    """Changed and new rows; only the months they lie in are rewritten."""
    path = _scratch(p, "slices")
    rows = p.silver.select("transaction_id", "transaction_date", "amount", "year", "month")
    tables.write_table(rows.filter(F.col("transaction_date") < CUT), path, MONTHS)
    merge.upsert_slices(p.spark, path, _delta(p, rows), layers.KEY, MONTHS)
    return tables.read_table(p.spark, path)


@query
def mrg_7_staged_union(p):
    expiring = _merchants_b(p).join(_merchants_a(p), ["merchant_name", "merchant_category"], "left_anti")
    return schemas.merge_all(expiring.select("merchant_name"), _merchants_b(p))


@query
def mrg_8_materialize(p):
    return tables.materialize(clean.members(p.silver, ["card_number", "card_type", "card_company"]), "members")


# --- keys -------------------------------------------------------------------------------------


@query
def key_1_offset(p):
    """Which row gets which key is open; count and uniqueness are not."""
    keyed = keys.offset_key(p.silver.select("transaction_id"), "transaction_key")
    return keyed.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("transaction_key").alias("key_count"),
        (F.min("transaction_key") > 0).alias("positive"),
    )


@query
def key_3_content(p):
    cards = clean.members(p.silver, ["card_number", "card_type", "card_company"])
    return cards.withColumn("card_key", content_key(*[F.col(c) for c in cards.columns]))


@query
def key_4_dense(p):
    orders = card_feed.table(p.spark, p.folder, "orders").select("o_orderkey", "o_custkey")
    return keys.dense_key(orders, "order_key", ["o_custkey", "o_orderkey"])


@query
def key_5_extend(p):
    """Merchants new in the second snapshot, numbered after the first."""
    first = keys.dense_key(_merchants_a(p), "merchant_no", ["merchant_name"])
    new = _merchants_b(p).join(first, "merchant_name", "left_anti")
    return first.unionByName(keys.extend_keys(first, new, "merchant_no", ["merchant_name"]))


@query
def key_6_date_key(p):
    return p.raw.select("transaction_id", date_key(F.col("transaction_date")).alias("date_key"))


# --- builders ---------------------------------------------------------------------------------


@query
def bld_1_bronze(p):
    bronze = p.table("bronze")
    return bronze.select(
        "transaction_id", "transaction_date", "merchant_name", "merchant_category", "amount", "card_number",
        "card_type", "card_company", "year", "month",
        F.col("ingestion_timestamp").isNotNull().alias("has_time"), F.col("source_file").isNotNull().alias("has_source"),
    )


@query
def bld_2_silver(p):
    return layers.build_silver(p.raw).drop("processed_at")


@query
def bld_2_silver_hash(p):
    return layers.build_silver(p.raw, dedup=dedup.dedup_hash).drop("processed_at")


@query
def bld_3_dim_date(p):
    return dimensions.dim_date_covering(p.raw)


@query
def bld_4_dim_category(p):
    return dimensions.dim_category(p.silver)


@query
def bld_4_dim_category_dense(p):
    return dimensions.dim_category(p.silver, keys="dense")


@query
def bld_5_dim_merchant(p):
    return dimensions.dim_merchant(p.silver, FIRST_LOAD)


@query
def bld_6_dim_card(p):
    return dimensions.dim_card(p.silver)


@query
def bld_7_fact(p):
    return fact.fact_transactions(p.silver, p.dims, transaction_key="dense").drop("created_at")


@query
def bld_7_fact_asof(p):
    dims = {**p.dims, "dim_merchant": _snapshot_b(p)}
    return fact.fact_transactions(p.silver, dims, as_of=True).drop("created_at", "transaction_key")


@query
def bld_8_full_run(p):
    """All layers written, then the final fact."""
    star = medallion.run_full(p.spark, p.path("raw"), _scratch(p, "full_run"), FIRST_LOAD)
    return star["fact_transactions"].drop("created_at", "transaction_key")


@query
def bld_8_second_run(p):
    """The feed up to the cut, then the whole feed into the same tables."""
    out, early = _scratch(p, "two_runs"), _scratch(p, "early_feed")
    tables.write_table(p.raw.filter(F.col("transaction_date") < CUT), early)
    medallion.run_full(p.spark, early, out, FIRST_LOAD)
    star = medallion.run_full(p.spark, p.path("raw"), out, CUT)
    cards = star["dim_card"].withColumnRenamed("card_number", "_number")
    return (
        star["fact_transactions"]
        .join(cards, "card_key")
        .select("transaction_id", "year", "month", "date_key", "category_key", "merchant_key",
                F.col("_number").alias("card_number"), "card_type", "card_company", "amount")
    )


@query
def bld_8_disjoint_years(p):
    """The feed in two runs, split by the year in which a transaction first occurs: every layer is as after a single run."""
    out, feeds = _scratch(p, "years"), (_scratch(p, "years_early"), _scratch(p, "years_late"))
    first = p.raw.groupBy("transaction_id").agg(F.min("transaction_date").alias("_first"))
    known = p.raw.join(first, "transaction_id").withColumn("_early", F.coalesce(F.col("_first") < CUT, F.lit(True)))
    for path, early in zip(feeds, (True, False)):
        tables.write_table(known.filter(F.col("_early") == early).select(*p.raw.columns), path)
        medallion.run_full(p.spark, path, out, FIRST_LOAD)
    medallion.run_full(p.spark, feeds[0], out, FIRST_LOAD)  # a feed that is there already
    star = medallion.load_star(p.spark, out)
    found = [
        star[name].groupBy("year", "month").agg(F.count(F.lit(1)).alias("row_count"), total(F.col("amount")).alias("amount")).withColumn("layer", F.lit(name))
        for name in ("bronze", "silver", "fact_transactions")
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query
def bld_8_asof_run(p):
    """Two runs with history; the second has corrections of rows from before it and moves some merchants to another category."""
    out, feeds = _scratch(p, "history"), (_scratch(p, "history_early"), _scratch(p, "history_late"))
    moved = F.when(F.col("merchant_category").startswith("ASIA"), F.concat(F.lit("RECLASS-"), "merchant_category"))
    late = p.raw.filter(F.col("transaction_date") >= OVERLAP)
    late = late.withColumn("merchant_category", moved.otherwise(F.col("merchant_category")))
    tables.write_table(p.raw.filter(F.col("transaction_date") < CUT), feeds[0])
    tables.write_table(late, feeds[1])
    medallion.run_full(p.spark, feeds[0], out, FIRST_LOAD, history=True)
    star = medallion.run_full(p.spark, feeds[1], out, CUT, history=True)
    return star["fact_transactions"].select("transaction_id", "year", "month", "date_key", "category_key", "merchant_key", "amount")


@query
def bld_9_one_pass(p):
    fact_rows = medallion.run_one_pass(p.raw, p.table("dim_date"), key=content_key)
    return fact_rows.drop("created_at", "transaction_key")


@query
def bld_9_one_pass_row_keys(p):
    """With the default keys, whose values only Spark computes; which rows have one is compared."""
    known = F.col("merchant_key").isNotNull().alias("has_merchant_key")
    fact_rows = medallion.run_one_pass(p.raw, p.table("dim_date"))
    return fact_rows.select("date_key", "year", "month", "transaction_id", "amount", "quantity", known)


@query
def bld_10_hash_mart(p):
    return medallion.run_hash_mart(p.raw)


@query
def bld_9_one_pass_star(p):
    """The one-pass mart written with its dimensions, and its keys resolved in them."""
    star = medallion.write_one_pass(p.spark, p.path("raw"), _scratch(p, "one_pass"), key=content_key)
    merchants = star["dim_merchant"].select("merchant_key", "merchant_name", "merchant_category")
    return (
        star["fact_transactions"]
        .join(star["dim_category"], "category_key", "left")
        .join(merchants, "merchant_key", "left")
        .select("transaction_id", "date_key", "category_name", "level_1", "level_2", "merchant_name", "merchant_category", "amount")
    )


@query
def bld_10_mart_star(p):
    """The reduced mart written with its dimensions, and its keys resolved in them."""
    star = medallion.write_hash_mart(p.spark, p.path("raw"), _scratch(p, "mart"))
    merchants = star["dim_merchant"].select("merchant_key", "merchant_name", "merchant_category")
    return (
        star["fact_transactions"]
        .join(star["dim_category"], "category_key")
        .join(merchants, "merchant_key")
        .select("transaction_id", "year", "month", "category_name", "merchant_name", "merchant_category", "amount")
    )


@query
def bld_11_window_mart(p):
    return medallion.run_window_mart(p.raw)


@query
def bld_12_all_dimensions(p):
    dims = medallion.build_dimensions(p.silver, _scratch(p, "dims"), FIRST_LOAD)
    return quality.reconcile(dims)


# --- reports ----------------------------------------------------------------------------------


@query
def rpt_1_monthly_summary(p):
    return reports.monthly_summary(p.star)


@query
def rpt_2_monthly_detail(p):
    return reports.monthly_detail(p.star)


@query
def rpt_2_monthly_chart(p):
    return reports.monthly_chart(p.star)


@query
def rpt_3_category_summary(p):
    return reports.category_summary(p.star)


@query
def rpt_4_subcategory_summary(p):
    return reports.subcategory_summary(p.star)


@query
def rpt_5_category_share(p):
    return reports.category_share(p.star)


@query
def rpt_5_rollup(p):
    return reports.category_rollup(p.star)


@query
def rpt_6_top_subcategories(p):
    return reports.top_subcategories(p.star)


@query
def rpt_7_top_merchants_15(p):
    return reports.top_merchants(p.star, 15).drop("avg_amount")


@query
def rpt_7_top_merchants_20(p):
    return reports.top_merchants(p.star, 20)


@query
def rpt_7_top_merchants_10(p):
    return reports.top_merchants_by_category_name(p.star)


@query
def rpt_8_weekend(p):
    return reports.weekend_summary(p.star)


@query
def rpt_9_weekend_category(p):
    return reports.weekend_category(p.star)


@query
def rpt_10_card(p):
    return reports.card_summary(p.star)


@query
def rpt_11_overall(p):
    return reports.overall_statistics(p.star)


@query
def rpt_12_daily_trend(p):
    return reports.daily_trend(p.star)


@query
def rpt_13_moving_average(p):
    return reports.moving_average(p.star)


@query
def rpt_14_monthly_category(p):
    return reports.monthly_category(p.star)


@query
def rpt_14_one_year(p):
    return reports.monthly_category(p.star, 1998)


@query
def rpt_15_month_report(p):
    return reports.month_report(p.star, "1998-03")


@query
def rpt_16_year_on_year(p):
    return reports.year_on_year(p.star)


@query
def rpt_17_weekday(p):
    return reports.weekday_pattern(p.star)


@query
def rpt_18_time_of_day(p):
    events = card_feed.table(p.spark, p.folder, "events")
    return reports.time_of_day_pattern(
        events.select("ts", F.col("value").cast("decimal(15,2)").alias("amount")), "ts", "amount"
    )


@query
def rpt_19_peak_months(p):
    return reports.peak_months(p.star)


@query
def rpt_20_merchant_share(p):
    return reports.merchant_share(p.star)


@query
def rpt_21_weekend_gap(p):
    return reports.weekend_gap(p.star)


# --- ideas the reports lead to -----------------------------------------------------------------


@query
def fct_1_trend(p):
    return reports.spending_trend(p.star, ahead=3)


@query
def fct_1_trend_by_category(p):
    return reports.spending_trend(p.star, ahead=2, by_category=True)


@query
def cat_1_map(p):
    """Merchants of nine suppliers in ten have a category of their own in the map."""
    feed = card_feed.merchants(p.spark, p.folder).filter(F.col("s_suppkey") % 10 != 9)
    mapping = feed.select(F.col("s_name").alias("merchant_name"), F.concat_ws(" ", "n_name", "r_name").alias("category"))
    return lookup.categorize(p.silver.select("transaction_id", "normalized_merchant"), mapping)


# --- data quality -----------------------------------------------------------------------------

DATE_KEYS = (19950101, 20010630)


@query
def dq_1_required(p):
    """`card_number` is missing on purpose."""
    return quality.run_checks(
        p.raw.drop("card_number"), "bronze", quality.required("transaction_id", "amount", "card_number")
    )


@query
def dq_2_not_null(p):
    cols = ("transaction_id", "transaction_date", "merchant_name", "amount")
    return quality.run_checks(p.raw, "bronze", quality.not_null(*cols))


@query
def dq_3_unique(p):
    return quality.run_checks(p.raw, "bronze", quality.unique("transaction_id", "merchant_name"))


@query
def dq_4_range(p):
    return quality.run_checks(p.raw, "bronze", quality.in_range("amount", 1, 100_000))


@query
def dq_5_allowed(p):
    typed = p.raw.select(
        F.when(F.col("merchant_name").isNotNull(), transaction_type(F.col("amount"))).alias("transaction_type"),
        "card_type",
    )
    checks = [*quality.allowed("transaction_type", quality.TRANSACTION_TYPES), *quality.allowed("card_type", ("Debit",))]
    return quality.run_checks(typed, "silver", checks)


@query
def dq_6_foreign_keys(p):
    calendar = p.table("dim_date").filter(F.col("full_date") <= date(2001, 6, 30))
    keyed = fact.fact_transactions(p.silver, {**p.dims, "dim_date": calendar})
    return quality.run_checks(keyed, "gold_fact", quality.foreign_keys("date_key", "merchant_key", "category_key"))


@query
def dq_6_referential(p):
    """A calendar that ends early and a merchant dimension without some of its members leave keys that point nowhere."""
    calendar = p.table("dim_date").filter(F.col("full_date") <= date(2001, 6, 30))
    merchants = p.table("dim_merchant").filter(~F.col("merchant_category").startswith("ASIA"))
    dims = {**p.dims, "dim_date": calendar, "dim_merchant": merchants}
    members = {fk: (dims[name], pk) for fk, (name, pk) in quality.REFERENCES.items()}
    return quality.referential(p.table("fact_transactions"), "fact_transactions", members)


@query
def dq_6_dangling_keys(p):
    """Each key that points nowhere, with its rows."""
    merchants = p.table("dim_merchant").filter(~F.col("merchant_category").startswith("ASIA"))
    return quality.dangling_keys(p.table("fact_transactions"), {"merchant_key": (merchants, "merchant_key")})


@query
def dq_7_date_key_range(p):
    return quality.run_checks(p.table("fact_transactions"), "gold_fact", quality.in_range("date_key", *DATE_KEYS))


@query
def dq_8_dimension_keys(p):
    names = ("date", "category", "merchant", "card")
    return quality.validate_layers(
        {f"dim_{n}": (p.table(f"dim_{n}"), quality.dimension_checks(n)[-1:]) for n in names}
    )


@query
def dq_9_merchant_columns(p):
    return quality.run_checks(p.table("dim_merchant"), "dim_merchant", quality.dimension_checks("merchant"))


@query
def dq_10_column_types(p):
    """`created_at` is zone-free here and `amount` is read as double on purpose."""
    feed = p.raw.withColumn("amount", F.col("amount").cast("double"))
    return quality.run_checks(feed, "bronze", quality.card_feed_types(feed))


@query
def dq_11_reconcile(p):
    counts = {"raw": p.raw, "valid": clean.filter_valid(p.raw), "silver": p.silver, "fact": p.table("fact_transactions")}
    return quality.reconcile(counts, {"valid": "raw", "silver": "valid", "fact": "silver"})


def _all_layers(p: Prepared) -> DataFrame:
    found = {"bronze": p.raw, "silver": p.silver, **p.tables}
    return quality.validate_layers(quality.standard_layers(found, DATE_KEYS))


@query
def dq_12_report(p):
    return quality.summarize(_all_layers(p))


@query
def dq_13_all_layers(p):
    return _all_layers(p)


@query
def dq_13_during_write(p):
    """The results that a run's checks gave while its layers were written."""
    out = _scratch(p, "watched")
    medallion.run_full(p.spark, p.path("raw"), out, FIRST_LOAD, date_keys=DATE_KEYS)
    return medallion.load_checks(p.spark, out)


@query
def dq_13_whole_star(p):
    """All layers, all references of the facts, and the merchants' history."""
    return quality.validate_star({"bronze": p.raw, "silver": p.silver, **p.tables}, DATE_KEYS)


@query
def dq_14_success_percent(p):
    return quality.all_passed(_all_layers(p))


@query
def dq_15_scd2_integrity(p):
    """A second open version is planted for every merchant that the batch changed."""
    dim = _snapshot_b(p)
    broken = dim.unionByName(dim.filter("NOT is_current").withColumn("is_current", F.lit(True)))
    return quality.scd2_violations(broken)


@query
def dq_15_scd2_clean(p):
    return quality.scd2_violations(_snapshot_b(p))
