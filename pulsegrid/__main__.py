"""Command line: python -m pulsegrid {summarise,filter,blend,features} ... (or through spark-submit)."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from pulsegrid.functions.ids import NOISE, SIGNAL
from pulsegrid.operators import select
from pulsegrid.operators.summary import PULSE_ORDER
from pulsegrid.plans import jobs
from pulsegrid.schema import SummaryMode
from pulsegrid.sources import files


def numbers(text: str) -> list[int]:
    return [int(part) for part in text.split(",")]


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="pulsegrid")
    commands = parser.add_subparsers(dest="command", required=True)
    one = commands.add_parser("summarise", help="SQLite parts to sensor rows and truth")
    one.add_argument("source", choices=[SIGNAL, NOISE])
    one.add_argument("subdir")
    one.add_argument("folder")
    one.add_argument("target")
    one.add_argument("--events-per-shard", type=int, default=20_000)
    one.add_argument("--summary-mode", type=int, default=0, choices=[m.value for m in SummaryMode])
    one.add_argument("--stored-order", action="store_true", help="take pulses in the order of the file instead of by time")
    one.add_argument("--geometry", help="CSV of string, dom_number, dom_x, dom_y, dom_z")
    one.add_argument("--parts", type=numbers, help="only these parts, comma-separated; the others stay as they are")
    two = commands.add_parser("filter", help="keep selected events")
    two.add_argument("source", choices=[SIGNAL, NOISE])
    two.add_argument("subdir")
    two.add_argument("root")
    two.add_argument("target")
    two.add_argument("--clean-ids", help="CSV files of RunID, EventID")
    two.add_argument("--charged-current", action="store_true")
    two.add_argument("--muon-like", action="store_true")
    two.add_argument("--contained", action="store_true")
    two.add_argument("--min-travel-distance", type=int)
    two.add_argument("--parts", type=numbers, help="only these parts, comma-separated; the others stay as they are")
    three = commands.add_parser("blend", help="balance and interleave two datasets")
    three.add_argument("source", choices=[SIGNAL, NOISE])
    three.add_argument("low")
    three.add_argument("high")
    three.add_argument("blended")
    three.add_argument("root")
    four = commands.add_parser("features", help="shape features of datasets of several flavours, with statistics and histograms")
    four.add_argument("source", choices=[SIGNAL, NOISE])
    four.add_argument("root")
    four.add_argument("target")
    four.add_argument("geometry", help="CSV of string, dom_number, dom_x, dom_y, dom_z")
    four.add_argument("subdirs", nargs="+")
    four.add_argument("--compact", action="store_true", help="the nine features instead of the seventeen")
    four.add_argument("--unbalanced", action="store_true", help="use all events of every flavour")
    return parser


def selection(spark: SparkSession, args: argparse.Namespace) -> select.Selection:
    chosen: dict[str, select.EventFilter] = {}
    if args.clean_ids:
        chosen["CRclean"] = select.Clean(files.read_clean_ids(spark, args.clean_ids))
    if args.charged_current:
        chosen["CC"] = select.ChargedCurrent()
    if args.muon_like:
        chosen["MuonLike"] = select.MuonLike()
    if args.contained:
        chosen["Contained"] = select.Contained()
    if args.min_travel_distance is not None:
        chosen["IntraTravelDistance"] = select.TravelDistance(args.min_travel_distance)
    return select.Selection(chosen)


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = SparkSession.builder.appName(f"pulsegrid {args.command}").getOrCreate()
    if args.command == "summarise":
        geometry = files.read_geometry(spark, args.geometry) if args.geometry else None
        jobs.summarise(spark, args.folder, args.target, args.source, args.subdir, args.events_per_shard,
                       SummaryMode(args.summary_mode), geometry, ("pulse_id",) if args.stored_order else PULSE_ORDER, args.parts)
    elif args.command == "filter":
        jobs.filter_dataset(spark, args.root, args.target, args.source, args.subdir, selection(spark, args), args.parts)
    elif args.command == "features":
        geometry = files.read_geometry(spark, args.geometry)
        jobs.feature_datasets(spark, args.root, args.target, args.source, args.subdirs, geometry, args.compact, not args.unbalanced)
    else:
        jobs.blend_datasets(spark, args.root, args.source, args.low, args.high, args.blended)


if __name__ == "__main__":
    main()
