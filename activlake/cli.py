"""Command line: one command per stage, for ``spark-submit`` or ``python -m activlake``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activlake.operators import quality
from activlake.plans import medallion
from activlake.plans.medallion import LakePaths
from activlake.session import get_session, shuffle_partitions
from activlake.sources.cdc import read_cdc_files, read_cdc_kafka
from activlake.sinks.lots import lot_counts
from activlake.streaming import start_bronze, start_bronze_lots, start_notifications


def _messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.kafka:
        return read_cdc_kafka(spark, args.kafka, args.topic, max_per_trigger=args.max_per_trigger)
    return read_cdc_files(spark, args.source, args.source_format, args.max_per_trigger)


def _show(frames: dict[str, DataFrame]) -> None:
    for title, frame in frames.items():
        print(f"--- {title}")
        frame.printSchema()
        frame.show(truncate=False)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="activlake")
    parser.add_argument("--lake", required=True, help="root folder of the lake (shared storage)")
    parser.add_argument("--master", help="Spark master; leave out under spark-submit")
    parser.add_argument("--delta", action="store_true", help="use Delta tables (needs its jar)")
    parser.add_argument(
        "--input-gb", type=float, required=True, help="input size, which sizes the shuffles"
    )
    commands = parser.add_subparsers(dest="command", required=True)

    reference = commands.add_parser("reference", help="build the employee reference")
    reference.add_argument("--hr", required=True)
    reference.add_argument("--sport", required=True)
    reference.add_argument("--format", default="csv")
    reference.add_argument(
        "--multiline", action="store_true", help="quoted line breaks in CSV; one task per file"
    )
    reference.add_argument("--responses", help="Parquet of stored distance responses")

    commands.add_parser("create", help="create the operational tables")
    ingest = commands.add_parser("ingest", help="validate posted bodies and store them")
    ingest.add_argument("--bodies", required=True, help="Parquet of id and body")
    ingest.add_argument("--lot", help="name of these bodies; sent again, they replace themselves")
    requests = commands.add_parser("requests", help="list the distances that have to be asked for")
    requests.add_argument("--hr", required=True)
    requests.add_argument("--format", default="csv")
    daily = commands.add_parser("daily", help="build the daily partials")
    daily.add_argument("--days", nargs="*", type=date.fromisoformat, help="replace these only")
    compact = commands.add_parser("compact", help="merge the small files of Bronze")
    compact.add_argument("--files", type=int, required=True, help="files, or files per day")
    clean = commands.add_parser("clean", help="delete runs that are no longer current")
    clean.add_argument("--keep", type=int, default=1, help="older runs to keep per table")

    for name, text in (("bronze", "stream changes to Bronze"), ("notify", "stream messages")):
        stream = commands.add_parser(name, help=text)
        stream.add_argument("--kafka", help="bootstrap servers")
        stream.add_argument("--topic", help="topic of change envelopes")
        stream.add_argument("--source", help="folder of envelopes when there is no Kafka")
        stream.add_argument("--source-format", default="parquet", choices=["parquet", "text"])
        stream.add_argument("--trigger", help='interval such as "1 minute", or "available"')
        stream.add_argument("--max-per-trigger", type=int, help="messages or files per batch")
    commands.choices["bronze"].add_argument("--by-day", action="store_true")
    commands.choices["bronze"].add_argument(
        "--by-lot", action="store_true", help="a folder per batch, with quality counts"
    )

    silver = commands.add_parser("silver", help="rebuild Silver")
    silver.add_argument("--by-day", action="store_true")
    silver.add_argument("--days", nargs="*", type=date.fromisoformat, help="refresh these only")

    gold = commands.add_parser("gold", help="rebuild Gold and its CSV export")
    run = commands.add_parser("run", help="Silver, then Gold and the distances")
    run.add_argument("--by-day", action="store_true")
    for stage in (gold, run):
        stage.add_argument("--as-of", type=date.fromisoformat, help="keep the twelve months before")
        stage.add_argument("--columns", nargs="*", help="columns of the CSV export")
        stage.add_argument("--export-files", type=int, help="CSV files; one per task by default")
    gold.add_argument("--from-bronze", action="store_true", help="count without a Silver table")
    gold.add_argument("--from-daily", action="store_true", help="add up the daily partials")

    for layer in ("bronze", "silver", "gold"):
        commands.add_parser(f"check-{layer}", help=f"quality report of {layer}")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    partitions = shuffle_partitions(int(args.input_gb * 1024**3))
    conf = {"spark.sql.shuffle.partitions": str(partitions)}
    spark = get_session(f"activlake-{args.command}", args.master, conf, args.delta)
    paths = LakePaths(args.lake)
    match args.command:
        case "reference":
            responses = spark.read.parquet(args.responses) if args.responses else None
            medallion.run_reference(
                spark,
                paths,
                args.hr,
                args.sport,
                args.format,
                responses,
                multiline=args.multiline,
            )
        case "create":
            medallion.create_tables(spark, paths)
        case "ingest":
            medallion.run_ingest(spark, paths, spark.read.parquet(args.bodies), args.lot)
        case "requests":
            medallion.run_requests(spark, paths, args.hr, args.format)
        case "daily":
            medallion.run_daily(spark, paths, args.days or None)
        case "compact":
            medallion.compact_bronze(spark, paths, args.files)
        case "clean":
            medallion.clean_up(spark, paths, args.keep)
        case "bronze" if args.by_lot:
            rules = quality.generator_rules()
            start_bronze_lots(
                _messages(spark, args),
                paths.lots,
                paths.checkpoint("bronze_lots"),
                args.trigger,
                args.by_day,
                counts={name: F.count_if(bad) for name, bad in rules.items()},
                counted=lot_counts(paths.counts("bronze")),
            ).awaitTermination()
        case "bronze":
            start_bronze(
                _messages(spark, args),
                paths.bronze,
                paths.checkpoint("bronze"),
                args.trigger,
                args.by_day,
            ).awaitTermination()
        case "notify":
            start_notifications(
                _messages(spark, args),
                paths.notifications,
                paths.checkpoint("notifications"),
                args.trigger,
            ).awaitTermination()
        case "silver" if args.days:
            medallion.refresh_silver(spark, paths, args.days)
        case "silver":
            medallion.run_silver(spark, paths, args.by_day)
        case "gold":
            medallion.run_gold(
                spark,
                paths,
                args.as_of,
                export_columns=args.columns,
                export_files=args.export_files,
                from_bronze=args.from_bronze,
                from_daily=args.from_daily,
            )
        case "check-bronze":
            _show(medallion.check_bronze(spark, paths))
        case "check-silver":
            _show(medallion.check_silver(spark, paths))
        case "check-gold":
            _show(medallion.check_gold(spark, paths))
        case "run":
            medallion.run_silver(spark, paths, args.by_day)
            medallion.run_gold(
                spark,
                paths,
                args.as_of,
                export_columns=args.columns,
                export_files=args.export_files,
            )
            medallion.run_distances(spark, paths)
