"""Command line: generate a feed, run it to the star schema, print reports, validate the layers.

    python -m tillstar generate data/raw --records 100000
    python -m tillstar run data/raw data/out --mode full
    python -m tillstar report data/out
    python -m tillstar validate data/out --reports data/quality
"""

from __future__ import annotations

import argparse
import sys
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tillstar.operators import quality
from tillstar.plans import medallion, reports
from tillstar.sources import generator, tables
from tillstar.streaming import ingest


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tillstar")
    commands = parser.add_subparsers(dest="command", required=True)

    generate = commands.add_parser("generate", help="write a synthetic card feed")
    generate.add_argument("output")
    generate.add_argument("--records", type=int, default=100_000)
    generate.add_argument("--start", type=date.fromisoformat, default=date(2023, 1, 1))
    generate.add_argument("--end", type=date.fromisoformat, default=date(2024, 12, 31))
    generate.add_argument("--seed", type=int, default=42)

    run = commands.add_parser("run", help="feed to fact table")
    run.add_argument("feed")
    run.add_argument("output")
    run.add_argument("--mode", choices=["full", "incremental", "one-pass", "hash", "window"], default="full")
    run.add_argument("--as-of", type=date.fromisoformat, default=date.today())
    run.add_argument("--history", action="store_true", help="facts point to the merchant version of their own date")
    run.add_argument("--codec", default="snappy")

    report = commands.add_parser("report", help="print the spending reports of a full run")
    report.add_argument("output")
    report.add_argument("--month", help="also the report of one month, YYYY-MM")

    validate = commands.add_parser("validate", help="check every layer of a full run; exit code 1 on failure")
    validate.add_argument("output")
    validate.add_argument("--reports", help="folder for the JSON report")
    low, high = quality.DATE_KEY_RANGE
    validate.add_argument("--first-day", type=int, default=low, help=f"least date key, yyyymmdd (default {low})")
    validate.add_argument("--last-day", type=int, default=high, help=f"greatest date key, yyyymmdd (default {high})")

    stream = commands.add_parser("stream", help="bring new files of a folder into the star schema, each once")
    stream.add_argument("feed")
    stream.add_argument("output")
    stream.add_argument("--checkpoint", required=True, help="folder that remembers the files taken")
    stream.add_argument("--as-of", type=date.fromisoformat, default=date.today())
    stream.add_argument("--history", action="store_true")
    return parser.parse_args()


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.mode == "full":
        medallion.run_full(spark, args.feed, args.output, args.as_of, history=args.history)
    elif args.mode == "incremental":
        medallion.run_incremental(spark, args.output, args.as_of, args.feed, history=args.history)
    elif args.mode == "one-pass":
        medallion.write_one_pass(spark, args.feed, args.output, args.codec)
    elif args.mode == "hash":
        medallion.write_hash_mart(spark, args.feed, args.output, args.codec)
    else:
        tables.export(medallion.run_window_mart(tables.read_table(spark, args.feed)), args.output, args.codec)


def _print(df: DataFrame) -> None:
    """Every row of a report, a line each; reports have a row per month, category, card or check at most."""
    print(*df.columns, sep="\t")
    for row in df.toLocalIterator():
        print(*row, sep="\t")


def _report(spark: SparkSession, args: argparse.Namespace) -> None:
    star = reports.Star.of(medallion.load_star(spark, args.output))
    shown = {
        "Monthly spending": reports.monthly_summary(star),
        "Categories": reports.category_summary(star),
        "Top merchants": reports.top_merchants(star),
        "Weekend and weekday": reports.weekend_summary(star),
        "Cards": reports.card_summary(star),
        "Overall": reports.overall_statistics(star),
    }
    if args.month:
        shown[f"Month {args.month}"] = reports.month_report(star, args.month)
    for title, df in shown.items():
        print(title)
        _print(df)


def _validate(spark: SparkSession, args: argparse.Namespace) -> bool:
    found = medallion.load_star(spark, args.output)
    results = tables.materialize(quality.validate_star(found, (args.first_day, args.last_day)), "quality")
    if args.reports:
        quality.write_report(results, args.reports)
    _print(quality.summarize(results))
    return quality.all_passed(results).first().all_passed


def main() -> int:
    args = _arguments()
    spark = SparkSession.builder.appName(f"tillstar {args.command}").getOrCreate()
    if args.command == "generate":
        feed = generator.generate_transactions(spark, args.records, args.start, args.end, args.seed)
        tables.write_table(feed, args.output)
    elif args.command == "run":
        _run(spark, args)
    elif args.command == "stream":
        schema = tables.read_table(spark, args.feed).schema
        ingest.merge_new_files(spark, args.feed, schema, args.output, args.checkpoint, args.as_of, args.history)
    elif args.command == "report":
        _report(spark, args)
    else:
        return 0 if _validate(spark, args) else 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
