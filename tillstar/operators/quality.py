"""Data-quality checks over every row.

All row rules of a layer share one aggregate pass, which can be the write of
the layer itself (`Watch`); each uniqueness rule is one further grouped count.
All foreign keys of a fact table share one pass. Only one small row per check
leaves the executors.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from tillstar.sources.schemas import CARD_TRANSACTION
from tillstar.sources.tables import small_table

# Accepted ranges and sets.
AMOUNT_RANGE = (1, 10_000_000)
DATE_KEY_RANGE = (20230101, 20251231)
TRANSACTION_TYPES = ("INCOME", "EXPENSE")


@dataclass(frozen=True)
class Check:
    """A rule on one column. `bad` marks a failing row; uniqueness has none."""

    name: str
    column: str
    bad: Column | None = field(default=None, compare=False)
    dtype: DataType | None = None


def required(*cols: str) -> list[Check]:
    return [Check("required_column", c) for c in cols]


def column_types(schema: StructType) -> list[Check]:
    return [Check("column_type", f.name, dtype=f.dataType) for f in schema.fields]


def not_null(*cols: str) -> list[Check]:
    return [Check("not_null", c, F.col(c).isNull()) for c in cols]


def foreign_keys(*cols: str) -> list[Check]:
    return [Check("foreign_key", c, F.col(c).isNull()) for c in cols]


def unique(*cols: str) -> list[Check]:
    return [Check("unique", c) for c in cols]


def in_range(col: str, low, high) -> list[Check]:
    """NULL is not a range failure."""
    return [Check("in_range", col, ~F.col(col).between(low, high))]


def allowed(col: str, values: tuple[str, ...]) -> list[Check]:
    """NULL is not an allowed value."""
    return [Check("allowed_values", col, ~F.coalesce(F.col(col).isin(*values), F.lit(False)))]


def bronze_checks() -> list[Check]:
    critical = ("transaction_id", "transaction_date", "merchant_name", "amount")
    return [
        *required(*critical, "card_number"),
        *not_null(*critical),
        *unique("transaction_id"),
        *in_range("amount", *AMOUNT_RANGE),
    ]


def silver_checks() -> list[Check]:
    return [
        *required("transaction_id", "normalized_merchant", "transaction_type", "processed_at"),
        *allowed("transaction_type", TRANSACTION_TYPES),
        *not_null("transaction_id", "normalized_merchant", "amount"),
        *unique("transaction_id"),
        *in_range("amount", *AMOUNT_RANGE),
    ]


def fact_checks(date_keys: tuple[int, int] = DATE_KEY_RANGE) -> list[Check]:
    return [
        *required("transaction_key", "date_key", "merchant_key", "category_key", "amount"),
        *foreign_keys("date_key", "merchant_key", "category_key"),
        *unique("transaction_key"),
        *in_range("date_key", *date_keys),
    ]


def dimension_checks(name: str) -> list[Check]:
    columns = {
        "date": ("date_key", "full_date", "year", "month"),
        "category": ("category_key", "category_name", "level_1"),
        "merchant": ("merchant_key", "merchant_name"),
        "card": ("card_key", "card_number"),
    }[name]
    return [*required(*columns), *unique(columns[0])]


RESULT = "layer string, check_name string, column_name string, failed_rows bigint, passed boolean"


def _scanned(df: DataFrame, checks: list[Check]) -> list[Check]:
    """The row and schema rules that apply to `df`: a rule on a column that does not exist is left out."""
    return [c for c in checks if c.name != "unique" and (c.bad is None or c.column in df.columns)]


def _in_schema(df: DataFrame, check: Check) -> int:
    """Failures of a rule on the schema alone."""
    types = {f.name: f.dataType for f in df.schema.fields}
    if check.name == "column_type":
        return int(types.get(check.column) != check.dtype)
    return int(check.column not in types)


def run_checks(df: DataFrame, layer: str, checks: list[Check]) -> DataFrame:
    """One row per check: layer, check_name, column_name, failed_rows, passed.

    A rule on a column that does not exist is left out; `required` reports the column.
    """
    frames = []
    scanned = _scanned(df, checks)
    if scanned:
        counts = [F.count_if(c.bad).alias(f"_{i}") for i, c in enumerate(scanned) if c.bad is not None]
        # The row count keeps one row when all rules concern the schema only.
        totals = df.agg(F.count(F.lit(1)).alias("_rows"), *counts)
        rows = []
        for i, check in enumerate(scanned):
            failed = F.lit(_in_schema(df, check)) if check.bad is None else F.col(f"_{i}")
            rows.append(
                F.struct(
                    F.lit(check.name).alias("check_name"),
                    F.lit(check.column).alias("column_name"),
                    failed.cast("bigint").alias("failed_rows"),
                )
            )
        frames.append(totals.select(F.inline(F.array(*rows))))

    for check in checks:
        if check.name == "unique" and check.column in df.columns:
            frames.append(_beyond_first(df, check.column))

    found = reduce(DataFrame.unionByName, frames)
    return found.select(
        F.lit(layer).alias("layer"),
        "check_name",
        "column_name",
        "failed_rows",
        (F.col("failed_rows") == 0).alias("passed"),
    )


class Watch:
    """The checks of a layer, counted while the layer is written: `over` the frame that the write takes, `results` after it.

    Row rules are metrics of the write's own pass. Put it last, after any shuffle, so that a task that is run again counts
    once. Uniqueness, which no single pass can tell, is left to `watched_results`, which reads the one column of what was written.
    """

    def __init__(self, layer: str, checks: list[Check]):
        self.layer, self.checks = layer, checks
        self.observation = Observation()
        self.scanned: list[Check] = []
        self.in_schema: dict[int, int] = {}

    def over(self, df: DataFrame) -> DataFrame:
        self.scanned = _scanned(df, self.checks)
        self.in_schema = {i: _in_schema(df, c) for i, c in enumerate(self.scanned) if c.bad is None}
        counts = [F.count_if(c.bad).alias(f"_{i}") for i, c in enumerate(self.scanned) if c.bad is not None]
        return df.observe(self.observation, F.count(F.lit(1)).alias("_rows"), *counts)

    @property
    def rows(self) -> int:
        """Rows of the write that has ended."""
        return self.observation.get["_rows"]

    def results(self) -> list[tuple]:
        """The rows that `run_checks` gives for row and schema rules, a few dozen."""
        found = self.observation.get
        failed = [self.in_schema[i] if c.bad is None else found[f"_{i}"] for i, c in enumerate(self.scanned)]
        return [(self.layer, c.name, c.column, n, n == 0) for c, n in zip(self.scanned, failed)]


def watched_results(written: dict[str, tuple[Watch, DataFrame]]) -> list[tuple]:
    """All checks of layers that were written under watch; the uniqueness rules of all layers are one job."""
    rows = [row for watch, _ in written.values() for row in watch.results()]
    keys = {name: (df, [c for c in watch.checks if c.name == "unique"]) for name, (watch, df) in written.items()}
    keys = {name: (df, checks) for name, (df, checks) in keys.items() if checks}
    return rows + ([tuple(r) for r in validate_layers(keys).collect()] if keys else [])


class Refused(ValueError):
    """A layer that failed its checks and was not published."""


def refuse(results: list[tuple], rules: tuple[str, ...]) -> None:
    """Raise when a check by one of these names has failed."""
    failed = [f"{layer}.{column}: {check} ({n} rows)" for layer, check, column, n, passed in results if not passed and check in rules]
    if failed:
        raise Refused(f"not published: {', '.join(failed)}")


def _beyond_first(df: DataFrame, col: str) -> DataFrame:
    """Rows beyond the first of each value; NULL counts as one value."""
    copies = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("failed_rows")).select(
        F.lit("unique").alias("check_name"), F.lit(col).alias("column_name"), "failed_rows"
    )


#: Foreign keys of the facts: dimension and key there.
REFERENCES = {
    "date_key": ("dim_date", "date_key"),
    "category_key": ("dim_category", "category_key"),
    "merchant_key": ("dim_merchant", "merchant_key"),
    "card_key": ("dim_card", "card_key"),
}


def dangling_keys(fact: DataFrame, members: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Keys of the facts that name no member, with the rows that have them: column_name, member, rows.

    `members` names the dimension and its key for each foreign key. One scan of the facts counts every key first, so that a
    hot key is a row per task before anything moves; the join sees distinct keys only. A NULL key names nothing and is left
    to `foreign_keys`.
    """
    kinds = {fact.schema[fk].dataType.typeName() for fk in members}
    kind = "bigint" if kinds <= {"byte", "short", "integer", "long"} else "string"
    pairs = [F.struct(F.lit(fk).alias("column_name"), F.col(fk).cast(kind).alias("member")) for fk in members]
    used = fact.select(F.inline(F.array(*pairs))).filter("member IS NOT NULL")
    used = used.groupBy("column_name", "member").agg(F.count(F.lit(1)).alias("rows"))
    known = reduce(
        DataFrame.unionAll,
        [dim.select(F.lit(fk).alias("column_name"), F.col(pk).cast(kind).alias("member")) for fk, (dim, pk) in members.items()],
    )
    return used.join(known, ["column_name", "member"], "left_anti")


def referential(fact: DataFrame, layer: str, members: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One check per foreign key: fact rows whose key has no member."""
    every = small_table(fact.sparkSession, [(fk,) for fk in members], "column_name string")
    failed = dangling_keys(fact, members).groupBy("column_name").agg(F.sum("rows").alias("_n"))
    n = F.coalesce("_n", F.lit(0)).cast("bigint")
    return every.join(failed, "column_name", "left").select(
        F.lit(layer).alias("layer"), F.lit("referential").alias("check_name"), "column_name", n.alias("failed_rows"), (n == 0).alias("passed")
    )


def scd2_check(dim: DataFrame, layer: str, key: str = "merchant_name") -> DataFrame:
    """One check: members whose versions overlap, are empty, or are not open exactly once."""
    n = F.count(F.lit(1)).cast("bigint")
    return scd2_violations(dim, key).agg(n.alias("failed_rows")).select(
        F.lit(layer).alias("layer"),
        F.lit("scd2_integrity").alias("check_name"),
        F.lit(key).alias("column_name"),
        "failed_rows",
        (F.col("failed_rows") == 0).alias("passed"),
    )


def validate_star(tables: dict[str, DataFrame], date_keys: tuple[int, int] = DATE_KEY_RANGE) -> DataFrame:
    """Every check of the pipeline's tables: those of each layer, all references of the facts, and the merchants' history."""
    found = validate_layers(standard_layers(tables, date_keys))
    members = {fk: (tables[dim], pk) for fk, (dim, pk) in REFERENCES.items() if dim in tables}
    if "fact_transactions" in tables and members:
        found = found.unionByName(referential(tables["fact_transactions"], "fact_transactions", members))
    if "dim_merchant" in tables:
        found = found.unionByName(scd2_check(tables["dim_merchant"], "dim_merchant"))
    return found


def validate_layers(layers: dict[str, tuple[DataFrame, list[Check]]]) -> DataFrame:
    """The checks of several layers as one table."""
    return reduce(DataFrame.unionByName, [run_checks(df, name, checks) for name, (df, checks) in layers.items()])


def standard_layers(tables: dict[str, DataFrame], date_keys: tuple[int, int] = DATE_KEY_RANGE) -> dict:
    """The usual checks for whichever of the pipeline's tables are given."""
    checks = {
        "bronze": bronze_checks(),
        "silver": silver_checks(),
        "dim_date": dimension_checks("date"),
        "dim_category": dimension_checks("category"),
        "dim_merchant": dimension_checks("merchant"),
        "dim_card": dimension_checks("card"),
        "fact_transactions": fact_checks(date_keys),
    }
    return {name: (df, checks[name]) for name, df in tables.items() if name in checks}


def summarize(results: DataFrame) -> DataFrame:
    """Per layer: success flag, counts, percent passed and the failed checks."""
    label = F.concat_ws(":", "check_name", "column_name")
    n = F.count(F.lit(1))
    good = F.count_if("passed")
    return results.groupBy("layer").agg(
        F.every("passed").alias("success"),
        n.alias("checks"),
        good.alias("passed_checks"),
        F.round(good * 100 / n, 2).alias("success_percent"),
        F.array_join(F.array_sort(F.collect_list(F.when(~F.col("passed"), label))), ", ").alias("failed_checks"),
    )


def all_passed(results: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    good = F.count_if("passed")
    return results.agg(
        F.coalesce(F.every("passed"), F.lit(True)).alias("all_passed"),
        n.alias("checks"),
        F.round(good * 100 / n, 2).alias("success_percent"),
    )


def write_report(results: DataFrame, path: str) -> None:
    """The check table (a few dozen rows) as JSON lines, stamped with the run time."""
    results.withColumn("checked_at", F.current_timestamp()).coalesce(1).write.mode("overwrite").json(path)


def reconcile(counts: dict[str, DataFrame], expected: dict[str, str] | None = None) -> DataFrame:
    """Row count per layer; `expected` names the layer that each one should match."""
    frames = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
        for name, df in counts.items()
    ]
    found = reduce(DataFrame.unionByName, frames)
    if not expected:
        return found
    # One row per layer on both sides.
    pairs = F.create_map(*[F.lit(x) for pair in expected.items() for x in pair])
    other = found.select(F.col("layer").alias("expected_layer"), F.col("row_count").alias("expected_count"))
    return (
        found.withColumn("expected_layer", pairs[F.col("layer")])
        .join(other, "expected_layer", "left")
        .select(
            "layer",
            "row_count",
            "expected_layer",
            "expected_count",
            (F.col("row_count") - F.col("expected_count")).alias("difference"),
        )
    )


def card_feed_types(df: DataFrame) -> list[Check]:
    """Declared types for the columns that `df` shares with the card feed."""
    return column_types(StructType([f for f in CARD_TRANSACTION.fields if f.name in df.columns]))


def scd2_violations(dim: DataFrame, key: str = "merchant_name") -> DataFrame:
    """Members without exactly one open version, or with overlapping or empty intervals.

    Versions are few per member: one per change, not per transaction. The window
    shares the one shuffle of the grouping.
    """
    later = Window.partitionBy(key).orderBy("effective_date", "expiration_date")
    marked = dim.select(
        key,
        "is_current",
        (F.lead("effective_date").over(later) < F.col("expiration_date")).alias("_overlap"),
        (F.col("effective_date") >= F.col("expiration_date")).alias("_empty"),
    )
    return (
        marked.groupBy(key)
        .agg(
            F.count_if("is_current").alias("open_versions"),
            F.count_if("_overlap").alias("overlaps"),
            F.count_if("_empty").alias("empty_intervals"),
        )
        .filter("open_versions <> 1 OR overlaps > 0 OR empty_intervals > 0")
    )
