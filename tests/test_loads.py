"""Loads that touch only what changed: slices, sketches, buckets, repeated feeds and batches, checks while writing."""

import pathlib
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tillstar.operators import bloom, lookup, merge, quality
from tillstar.plans import medallion
from tillstar.plans.layers import KEY
from tillstar.sources import bucketed, generator, tables
from tillstar.streaming import ingest

MONTHS = ("year", "month")
ROWS = "transaction_id string, amount int, year int, month int"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files_of(path, pattern="*.parquet"):
    return {str(f.relative_to(path)) for f in path.rglob(pattern)}


def random_rows(spark, n, seed, months=6):
    made = random.Random(seed)
    return spark.createDataFrame([(f"t{i}" if i % 97 else None, made.randrange(1000), 2024, made.randrange(months) + 1) for i in range(n)], ROWS)


# --- versions by slices


def test_a_version_by_slices_shares_untouched_months(spark, rows, tmp_path):
    base = str(tmp_path / "t")
    tables.write_version(spark.createDataFrame([("a", 1, 2024, 1), ("b", 2, 2024, 2), ("c", 3, 2024, 3), ("n", 0, None, None)], ROWS), base, MONTHS)
    before = files_of(tmp_path / "t")
    changed = spark.createDataFrame([("b", 20, 2024, 2), ("d", 4, 2024, 4)], ROWS)
    version = tables.write_slices(changed, base, MONTHS)
    assert tables.versions(spark, base) == [1] and len(rows(tables.read_snapshot(spark, base))) == 4  # not published yet
    tables.publish_slices(spark, base, version, MONTHS, {(2024, 2), (2024, 3), (2024, 4)})
    assert rows(tables.read_snapshot(spark, base)) == sorted([("a", 1, 2024, 1), ("b", 20, 2024, 2), ("d", 4, 2024, 4), ("n", 0, None, None)], key=repr)
    assert len(rows(tables.read_snapshot(spark, base, 1))) == 4 and before <= files_of(tmp_path / "t")
    assert tables.slices_of(spark, base, 2, MONTHS) == {
        "year=2024/month=1": 1, "year=2024/month=2": 2, "year=2024/month=4": 2, tables.slice_folder({"year": None, "month": None}): 1
    }
    one = tables.read_snapshot(spark, base).filter("year = 2024 AND month = 4")
    assert "PartitionFilters: [isnotnull(year" in plan_of(one) and len(one.inputFiles()) >= 1
    assert rows(one) == [("d", 4, 2024, 4)]


def test_a_write_that_died_leaves_the_last_version_in_force(spark, rows, tmp_path):
    base = str(tmp_path / "t")
    tables.write_version(spark.createDataFrame([("a", 1, 2024, 1)], ROWS), base, MONTHS)
    tables.write_slices(spark.createDataFrame([("x", 9, 2024, 1)], ROWS), base, MONTHS)  # and no publish
    tables.write_version(spark.createDataFrame([("y", 9, 2024, 1)], ROWS), base, MONTHS, publish=False)
    assert rows(tables.read_snapshot(spark, base)) == [("a", 1, 2024, 1)]
    version = tables.write_slices(spark.createDataFrame([("b", 2, 2024, 2)], ROWS), base, MONTHS)
    tables.publish_slices(spark, base, version, MONTHS, {(2024, 2)})
    assert rows(tables.read_snapshot(spark, base)) == [("a", 1, 2024, 1), ("b", 2, 2024, 2)]


def test_all_slices_may_go(spark, rows, tmp_path):
    base = str(tmp_path / "t")
    tables.write_version(spark.createDataFrame([("a", 1, 2024, 1)], ROWS), base, MONTHS)
    version = tables.write_slices(spark.createDataFrame([], ROWS), base, MONTHS)
    tables.publish_slices(spark, base, version, MONTHS, {(2024, 1)})
    empty = tables.read_snapshot(spark, base)
    assert rows(empty) == [] and empty.columns == ["transaction_id", "amount", "year", "month"]


# --- sketches and upserts


def test_bloom_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(0, 3000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).alias("j"))
    among = bloom.may_be_among(keys, ["k", "j"], 3000)
    asked = spark.range(0, 30_000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).alias("j"), "id")
    held = asked.select("id", among.alias("m")).filter("m")
    assert held.filter("id < 3000").count() == 3000
    assert held.filter("id >= 3000").count() < 0.01 * 27_000
    assert "Exchange" not in plan_of(asked.filter(among)).split("Subquery")[0]


def test_bloom_filter_is_bounded():
    assert bloom.filter_bits(1) == 1 << 12
    assert bloom.filter_bits(1 << 20) == 1 << 24
    assert bloom.filter_bits(1 << 24) == bloom.MAX_BITS
    assert bloom.filter_bits(1 << 25) is None
    assert bloom.may_be_among(None, ["k"], 1 << 30) is None


@pytest.mark.parametrize("limit", [None, 1 << 8])
def test_upserts_of_any_size_agree(spark, rows, monkeypatch, limit):
    if limit:
        monkeypatch.setattr(bloom, "MAX_BITS", limit)  # too small for any filter: both sides shuffle
    target, source = random_rows(spark, 2000, 1), random_rows(spark, 2600, 2).filter("transaction_id > 't1'")
    few = merge.upsert(target, source, KEY, small=True)
    assert rows(few) == rows(merge.upsert(target, source, KEY, small=False))
    assert target.count() < few.count() < target.count() + source.count()


def test_touched_slices(spark, tmp_path):
    target = spark.createDataFrame([("a", 1, 2024, 1), ("b", 2, 2024, 2), ("c", 3, 2024, 3), ("d", 3, None, None)], ROWS)
    source = spark.createDataFrame([("b", 1, 2024, 5), ("x", 2, 2024, 6), ("d", 1, 2024, 5)], ROWS)
    assert merge.touched_slices(target, source, KEY, MONTHS) == {(2024, 2), (2024, 5), (2024, 6), (None, None)}
    assert merge.touched_slices(target, source.limit(0), KEY, MONTHS) == set()


def test_a_bucketed_target_is_not_shuffled(spark, rows, tmp_path):
    path, new = str(tmp_path / "b"), str(tmp_path / "n")
    target, source = random_rows(spark, 3000, 1).filter("transaction_id IS NOT NULL"), random_rows(spark, 4000, 2).filter("transaction_id > 't2'")
    bucketed.write_bucketed(target, path, KEY, 4)
    stored = bucketed.read_bucketed(spark, path, KEY, 4)
    merged = merge.upsert_bucketed(stored, source, KEY)
    plan = plan_of(merged)
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    target_side = plan.split("_new_amount")[0]
    assert rows(merged) == rows(merge.upsert(target, source, KEY, small=True))
    bucketed.write_bucketed(merged, new, KEY, 4, dealt=True)
    assert len(files_of(tmp_path / "n")) <= 4 and target_side
    assert rows(bucketed.read_bucketed(spark, new, KEY, 4)) == rows(merged)
    with pytest.raises(ValueError, match="not unique"):
        merge.upsert_bucketed(stored, source.unionByName(source), KEY)


# --- as-of by merging


def asof_tables(spark, seed, merchants=30, rows=3000):
    made = random.Random(seed)
    versions, day = [], date(2020, 1, 1)
    for m in range(merchants):
        at = day + timedelta(made.randrange(400))
        for _ in range(made.randrange(5)):
            end = at + timedelta(made.randrange(1, 500))
            versions.append((f"m{m}", len(versions), f"c{made.randrange(5)}", at, end))
            at = end + timedelta(made.choice([0, 0, 40]))  # some gaps
        versions.append((f"m{m}", len(versions), None, at, date(9999, 12, 31)))
    facts = []
    for i in range(rows):
        m = 0 if i % 3 == 0 else made.randrange(merchants + 3)  # a hot member, and some unknown ones
        facts.append((i, f"m{m}" if i % 50 else None, day + timedelta(made.randrange(-100, 2500)) if i % 41 else None))
    return (
        spark.createDataFrame(facts, "transaction_id int, normalized_merchant string, transaction_date date"),
        spark.createDataFrame(versions, "merchant_name string, merchant_key int, merchant_category string, effective_date date, expiration_date date"),
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_merged_asof_equals_the_range_join(spark, rows, seed):
    facts, dim = asof_tables(spark, seed)
    joined = lookup.join_merchant_asof(facts, dim, small=True)
    merged = lookup.join_merchant_asof(facts, dim, small=False)
    assert merged.columns == joined.columns and rows(merged) == rows(joined)
    assert "Join" not in plan_of(merged)
    assert joined.filter("merchant_key IS NOT NULL").count() > 500
    assert rows(lookup.join_merchant_asof(facts.limit(0), dim, small=False)) == []
    assert lookup.join_merchant_asof(facts, dim.limit(0), small=False).filter("merchant_key IS NULL").count() == facts.count()


def test_a_hot_member_is_many_groups_and_versions_make_no_pairs(spark):
    facts, dim = asof_tables(spark, 3, merchants=1, rows=5000)
    merged = lookup.join_merchant_asof(facts, dim, small=False)
    plan = plan_of(merged)
    assert "_stretch" in plan.split("Window")[1]
    stretches = facts.select(F.trunc("transaction_date", "quarter")).distinct().count()
    assert stretches > 20


# --- clustering by several keys


def matching_files(spark, path, key, low, high):
    """Files whose least and greatest value of the key meet the range."""
    spans = tables.read_table(spark, path).groupBy(F.input_file_name().alias("f")).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    return spans.filter((F.col("low") <= high) & (F.col("high") >= low)).count()


def test_zorder_serves_filters_on_either_key(spark, rows, tmp_path):
    made = random.Random(5)
    data = [(i, made.randrange(1000), f"{made.randrange(1000):04d}", None if i % 100 == 0 else 1.5 * i) for i in range(20_000)]
    source, linear, z = (str(tmp_path / n) for n in ("source", "linear", "z"))
    tables.write_table(spark.createDataFrame(data, "id int, a int, b string, c double"), source)
    tables.compact(spark, source, linear, ("a", "b"), 16)
    tables.zorder(spark, source, z, ("a", "b"), 16)
    assert rows(tables.read_table(spark, z)) == rows(tables.read_table(spark, source))
    found = {n: (matching_files(spark, p, "a", 300, 310), matching_files(spark, p, "b", "0300", "0310")) for n, p in (("linear", linear), ("z", z))}
    assert found["linear"][0] <= 2 and found["linear"][1] == 16
    assert found["z"][0] <= 8 and found["z"][1] <= 8
    tables.zorder(spark, source, z, ("c", "a"))
    assert tables.read_table(spark, z).count() == 20_000


def test_zorder_of_an_empty_and_of_a_constant_table(spark, rows, tmp_path):
    source, z = str(tmp_path / "s"), str(tmp_path / "z")
    for data in ([], [(1, "x")] * 50):
        tables.write_table(spark.createDataFrame(data, "a int, b string"), source)
        tables.zorder(spark, source, z, ("a", "b"), 2)
        assert rows(tables.read_table(spark, z)) == data


def test_ranges_stay_within_a_task_s_memory_whatever_the_files_pack(spark, rows, tmp_path, monkeypatch):
    """Texts that pack small on disk still fill memory when sorted: the ranges follow their size as held."""
    data = [(i, i % 7, "x" * 5000) for i in range(2000)]
    source = str(tmp_path / "s")
    tables.write_table(spark.createDataFrame(data, "id int, a int, t string").repartition(1), source)
    monkeypatch.setattr(tables, "FILE_BYTES", 1 << 40)
    monkeypatch.setattr(tables, "TASK_BYTES", 1 << 20, raising=False)
    for rewrite, target in ((tables.compact, "c"), (tables.zorder, "z")):
        rewrite(spark, source, str(tmp_path / target), ("a", "id"))
        out = tables.read_table(spark, str(tmp_path / target))
        per_file = [r["count"] for r in out.groupBy(F.col("_metadata.file_name")).count().collect()]
        assert rows(out) == rows(tables.read_table(spark, source))
        assert len(per_file) >= 8 and max(per_file) <= 2 * (1 << 20) // 5000


# --- feeds and batches


def feed_of(spark, path, ids, first, last, seed):
    tables.write_table(generator.generate_transactions(spark, ids, first, last, seed=seed), path)
    return path


def test_feeds_add_up_and_a_repeated_one_adds_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    feeds = [feed_of(spark, str(tmp_path / f"raw{y}"), spark.range(200), date(y, 1, 1), date(y, 12, 31), y) for y in (2023, 2024)]
    for feed in (*feeds, feeds[0]):
        star = medallion.run_full(spark, feed, out, date(2024, 12, 31))
    assert [star[t].count() for t in ("bronze", "silver", "fact_transactions")] == [400, 400, 400]
    assert tables.versions(spark, f"{out}/fact_transactions") == [1, 2]
    untouched = {n for n, v in tables.slices_of(spark, f"{out}/fact_transactions", 2, MONTHS).items() if v == 1}
    assert untouched == {f"year=2023/month={m}" for m in range(1, 13)}
    more = generator.generate_transactions(spark, spark.range(50), date(2024, 1, 1), date(2024, 1, 31), seed=9)
    tables.write_table(more, feeds[1], mode="append")  # further files in a known folder
    star = medallion.run_incremental(spark, out, date(2024, 12, 31), feeds[1])
    assert [star[t].count() for t in ("bronze", "silver", "fact_transactions")] == [450, 450, 450]
    touched = {n for n, v in tables.slices_of(spark, f"{out}/fact_transactions", 3, MONTHS).items() if v == 3}
    assert touched == {"year=2024/month=1"}


def test_only_touched_months_are_read(spark, tmp_path):
    out = str(tmp_path / "out")
    feed = feed_of(spark, str(tmp_path / "raw"), spark.range(300), date(2023, 1, 1), date(2023, 12, 31), 1)
    star = medallion.run_full(spark, feed, out, date(2023, 1, 1))
    rows_of_may = star["fact_transactions"].filter("month = 5")
    merged, touched, few = medallion.update_slices(star["fact_transactions"], rows_of_may)
    assert touched == {(2023, 5)} and few
    plan = plan_of(merged)
    assert "PartitionFilters: [" in plan and "(month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert merged.count() == rows_of_may.count()


def test_a_merge_that_died_is_taken_up_again(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    feed = feed_of(spark, str(tmp_path / "raw"), spark.range(100), date(2023, 1, 1), date(2023, 3, 31), 1)
    medallion.run_full(spark, feed, out, date(2023, 1, 1))
    late = feed_of(spark, str(tmp_path / "late"), spark.range(60), date(2023, 3, 1), date(2023, 4, 30), 2)

    def dies(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(medallion, "upsert_slices", dies)
        with pytest.raises(RuntimeError, match="lost"):
            medallion.run_full(spark, late, out, date(2023, 4, 30))
    assert [medallion.load_star(spark, out)[t].count() for t in ("bronze", "silver", "fact_transactions")] == [100, 100, 100]
    with monkeypatch.context() as broken:
        broken.setattr(medallion, "publish_slices", dies)
        with pytest.raises(RuntimeError, match="lost"):
            medallion.run_full(spark, late, out, date(2023, 4, 30))
    assert medallion.load_star(spark, out)["fact_transactions"].count() == 100
    star = medallion.run_full(spark, late, out, date(2023, 4, 30))
    assert [star[t].count() for t in ("bronze", "silver", "fact_transactions")] == [160, 160, 160]
    assert star["fact_transactions"].select("transaction_key").distinct().count() == 160


def test_a_batch_may_come_twice(spark, tmp_path):
    out = str(tmp_path / "out")
    merge_batch = ingest.batch_merger(out, "s", date(2023, 1, 1))
    first = tables.read_table(spark, feed_of(spark, str(tmp_path / "a"), spark.range(80), date(2023, 1, 1), date(2023, 3, 31), 1))
    second = first.limit(20).withColumn("amount", (F.col("amount") + 1).cast("decimal(15,2)"))
    tables.write_table(second, str(tmp_path / "b"))
    second = tables.read_table(spark, str(tmp_path / "b"))
    from tillstar.plans.layers import build_bronze

    for batch, rows in ((0, first), (0, first), (1, second), (1, second)):
        merge_batch(build_bronze(rows), batch)
    star = medallion.load_star(spark, out)
    assert [star[t].count() for t in ("bronze", "silver", "fact_transactions")] == [100, 80, 80]
    assert tables.versions(spark, f"{out}/fact_transactions") == [1, 2]
    total = first.agg(F.sum("amount")).first()[0]
    assert star["fact_transactions"].agg(F.sum("amount")).first()[0] == total + 20


def test_a_batch_that_died_half_way_is_repeated(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    merge_batch = ingest.batch_merger(out, "s", date(2023, 1, 1))
    rows = tables.with_year_month(tables.with_lineage(tables.read_table(spark, feed_of(spark, str(tmp_path / "a"), spark.range(50), date(2023, 1, 1), date(2023, 1, 31), 1))))

    def dies(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(ingest, "write_table", dies)  # after silver, before the load is listed
        with pytest.raises(RuntimeError):
            merge_batch(rows, 0)
    merge_batch(rows, 0)
    star = medallion.load_star(spark, out)
    assert [star[t].count() for t in ("bronze", "silver", "fact_transactions")] == [50, 50, 50]


def test_a_stream_takes_files_as_they_come(spark, tmp_path):
    feed, out, checkpoint = (str(tmp_path / n) for n in ("feed", "out", "checkpoint"))
    for seed in (1, 2):
        made = generator.generate_transactions(spark, spark.range(40), date(2023, 1, 1), date(2023, 2, 28), seed=seed)
        tables.write_table(made, feed, mode="append")
        ingest.merge_new_files(spark, feed, made.schema, out, checkpoint, date(2023, 1, 1))
    ingest.merge_new_files(spark, feed, made.schema, out, checkpoint, date(2023, 1, 1))
    star = medallion.load_star(spark, out)
    assert [star[t].count() for t in ("bronze", "silver", "fact_transactions")] == [80, 80, 80]
    assert star["bronze"].select("load").distinct().count() == 2


# --- checks while writing


def test_a_watch_gives_what_a_scan_gives(spark, rows, tmp_path):
    df = spark.createDataFrame([("a", 1, "x"), ("a", -5, None), (None, None, "y")], "transaction_id string, amount int, transaction_type string")
    checks = [*quality.silver_checks(), *quality.column_types(df.schema)]
    watch = quality.Watch("silver", checks)
    path = str(tmp_path / "t")
    tables.write_table(df, path, over=watch.over)
    found = quality.watched_results({"silver": (watch, tables.read_table(spark, path))})
    assert sorted(found, key=repr) == rows(quality.run_checks(df, "silver", checks))


def test_what_fails_its_checks_is_not_published(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    feed = feed_of(spark, str(tmp_path / "raw"), spark.range(100), date(2023, 1, 1), date(2023, 3, 31), 1)
    real = medallion.dim_card
    with monkeypatch.context() as broken:
        broken.setattr(medallion, "dim_card", lambda *a: real(*a).unionByName(real(*a)))
        with pytest.raises(quality.Refused, match="dim_card.card_key: unique"):
            medallion.run_full(spark, feed, out, date(2023, 1, 1))
    assert medallion.load_dimensions(spark, out) == {}
    assert tables.versions(spark, f"{out}/fact_transactions") == []
    star = medallion.run_full(spark, feed, out, date(2023, 1, 1))
    assert star["fact_transactions"].count() == 100
    found = medallion.load_checks(spark, out)
    layers = {r.layer for r in found.collect()}  # bronze and silver stood already
    assert layers == {"dim_date", "dim_category", "dim_merchant", "dim_card", "fact_transactions"}
    assert found.filter("NOT passed").count() == 0


def test_references_and_history_are_validated(spark, tmp_path):
    out = str(tmp_path / "out")
    feed = feed_of(spark, str(tmp_path / "raw"), spark.range(100), date(2023, 1, 1), date(2023, 3, 31), 1)
    star = medallion.run_full(spark, feed, out, date(2023, 1, 1))
    assert quality.validate_star(star).filter("NOT passed").count() == 0

    def failed(tables_, **kwargs):
        return {(r.layer, r.check_name, r.column_name, r.failed_rows) for r in quality.validate_star(tables_, **kwargs).filter("NOT passed").collect()}

    fact = star["fact_transactions"]
    wrong = fact.withColumn("merchant_key", F.lit(999).cast("bigint"))
    assert failed({**star, "fact_transactions": wrong}) == {("fact_transactions", "referential", "merchant_key", 100)}
    assert quality.dangling_keys(wrong, {"merchant_key": (star["dim_merchant"], "merchant_key")}).collect()[0].rows == 100
    dim = star["dim_merchant"]
    twice = dim.unionByName(dim.limit(1).withColumn("merchant_key", F.lit(-1).cast("bigint")))
    assert failed({**star, "dim_merchant": twice}) == {("dim_merchant", "scd2_integrity", "merchant_name", 1)}
    assert failed(star, date_keys=(20230101, 20230131)) == {
        ("fact_transactions", "in_range", "date_key", fact.filter("date_key > 20230131").count())
    }


def test_validate_exits_with_1(spark, tmp_path, monkeypatch):
    import sys

    from tillstar import __main__

    out = str(tmp_path / "out")
    feed = feed_of(spark, str(tmp_path / "raw"), spark.range(60), date(2023, 1, 1), date(2023, 3, 31), 1)

    def run(*args):
        monkeypatch.setattr(sys, "argv", ["tillstar", *args])
        return __main__.main()

    assert run("run", feed, out, "--as-of", "2023-01-01") == 0
    assert run("validate", out) == 0
    assert run("validate", out, "--last-day", "20230131") == 1
    base = f"{out}/fact_transactions"
    fact = tables.read_snapshot(spark, base)
    tables.write_version(fact.withColumn("card_key", F.lit(0).cast("bigint")), base, MONTHS)
    assert run("validate", out) == 1


# --- scratch


def test_scratch_goes_with_its_run(spark, tmp_path, monkeypatch):
    made = []
    real = tables.scratch_path
    monkeypatch.setattr(tables, "scratch_path", lambda *a: made.append(real(*a)) or made[-1])
    feed = feed_of(spark, str(tmp_path / "raw"), spark.range(50), date(2023, 1, 1), date(2023, 1, 31), 1)
    made.clear()
    medallion.run_full(spark, feed, str(tmp_path / "out"), date(2023, 1, 1))
    assert made
    with pytest.raises(RuntimeError), tables.run_scratch(spark):
        tables.materialize(spark.range(3))
        raise RuntimeError("lost")
    for path in made:
        fs, folder = tables._path_handle(spark, path)
        assert not fs.exists(folder)
    kept = tables.materialize(spark.range(3))
    assert kept.count() == 3


def test_widths_of_all_kinds_count(spark):
    wide = spark.range(10).select(F.array(*[F.lit("x" * 100)] * 10).alias("a"), F.lit(b"y" * 500).alias("b"), F.lit(None).cast("decimal(38,2)").alias("d"))
    assert lookup.small_enough({"w": wide}, max_bytes=10 * 1500) == set()
    assert lookup.small_enough({"w": wide}, max_bytes=10 * 1700) == {"w"}


# --- disk of runs


def shuffles_left(folder):
    return sum(f.stat().st_size for f in folder.rglob("shuffle_*.data"))


def test_a_run_leaves_no_shuffle_files(spark, tmp_path):
    """A write's shuffles go when it ends, not when the driver collects its garbage."""
    local = [pathlib.Path(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()[0].getAbsolutePath())]
    feed = feed_of(spark, str(tmp_path / "raw"), spark.range(3000), date(2023, 1, 1), date(2023, 12, 31), 1)
    before = sum(map(shuffles_left, local))
    medallion.run_full(spark, feed, str(tmp_path / "out"), date(2023, 1, 1))
    tables.materialize(spark.range(100_000).repartition(7), "dealt")
    assert sum(map(shuffles_left, local)) - before < 200_000
    assert spark.conf.get(tables.CLEANUP, None) in (None, "false")


def stages_of_write(spark, monkeypatch):
    """Labels of what a run stages."""
    made, real = [], tables.materialize

    def noted(df, label="stage", *args, **kwargs):
        made.append(label)
        return real(df, label, *args, **kwargs)

    for module in (medallion, merge):
        monkeypatch.setattr(module, "materialize", noted)
    return made


@pytest.mark.parametrize("few", [True, False])
def test_an_increment_stages_and_shuffles_new_rows_once(spark, rows, tmp_path, monkeypatch, few):
    """With keys too many to broadcast or for a Bloom filter, too; the tables are as after one run."""
    if not few:
        for module in (medallion, merge):
            monkeypatch.setattr(module, "small_enough", lambda frames, **kw: set(frames) - {"keys"})
        monkeypatch.setattr(bloom, "MAX_BITS", 1 << 6)
    feeds = [feed_of(spark, str(tmp_path / f"raw{i}"), spark.range(n), date(2023, 1, 1), date(2023, 4, 30), 5) for i, n in enumerate((200, 300))]
    changed = tables.read_table(spark, feeds[1]).withColumn("transaction_date", F.add_months("transaction_date", 2)).withColumn("amount", F.col("amount") + 1)
    tables.write_table(changed, str(tmp_path / "late"))
    both, alone = str(tmp_path / "both"), str(tmp_path / "alone")
    medallion.run_full(spark, feeds[0], both, date(2023, 1, 1))
    made = stages_of_write(spark, monkeypatch)
    star = medallion.run_full(spark, str(tmp_path / "late"), both, date(2023, 1, 1))
    assert not {"fresh", "new_facts"} & set(made) and ("merged" in made) == few
    only = medallion.run_full(spark, str(tmp_path / "late"), alone, date(2023, 1, 1))
    kept = tables.read_table(spark, feeds[0]).join(changed, KEY, "left_anti").count()
    for name, columns in (("silver", ["transaction_id", "transaction_date", "amount", "year", "month"]), ("fact_transactions", ["transaction_id", "amount", "year", "month", "category_key"])):
        new = only[name].select(*columns)
        got = star[name].select(*columns)
        assert got.exceptAll(new).count() == kept and new.exceptAll(got).isEmpty()
    assert star["fact_transactions"].select("transaction_key").distinct().count() == star["fact_transactions"].count()
