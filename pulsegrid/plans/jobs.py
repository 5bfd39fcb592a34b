"""The batch jobs from files to files: summarise, filter, blend, features.

Datasets lie at <root>/<source>/<subdir>/{doms,truth}/part_no=..  All parts of a
dataset are one job; Spark spreads them.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions import ids
from pulsegrid.operators import blend as blending
from pulsegrid.operators import quality, select, shape, stats
from pulsegrid.operators import truth as labels
from pulsegrid.operators.detector import assign_sensor
from pulsegrid.operators.summary import PULSE_ORDER, dom_summary
from pulsegrid.runtime import pin, released_pins
from pulsegrid.schema import SIDE_TABLES, SummaryMode, summary_columns
from pulsegrid.sources import files
from pulsegrid.sources.sqlite import read_sqlite, resolve_table, source_files, table_names

PULSE_TABLES = ("SRTInIcePulses", "SplitInIcePulses")
TRUTH_TABLES = ("truth", "Truth")
_MEASURED = ("event_no", "dom_x", "dom_y", "dom_z", "Qtotal")
SIDE_SOURCES = {"inice": "GNHighestEInIceParticle", "daughter": "GNHighestEDaughter", "weights": "MCWeightDict"}


def _table(spark: SparkSession, folder: str, table: str, source: str, subdir: str, parts: Sequence[int] | None = None) -> DataFrame:
    """Rows of all parts, or of those given; event numbers made unique over parts before anything is grouped."""
    chosen = {} if parts is None else {"parts": ",".join(map(str, parts))}
    rows = read_sqlite(spark, folder, table, row_ids=True, **chosen)
    number = ids.enhanced_event_no(
        ids.source_tag(source), ids.dataset_tag(F.lit(subdir), source), F.col("part_no"), F.col("event_no")
    )
    return rows.withColumns({"original_event_no": F.col("event_no").cast("int"), "event_no": number})


def _suffixed(rows: DataFrame, columns: dict) -> DataFrame:
    """Side columns may come without the suffix of their table."""
    short = {name.rsplit("_", 1)[0]: name for name in columns}
    return rows.withColumnsRenamed({s: n for s, n in short.items() if s in rows.columns and n not in rows.columns})


def summarise(
    spark: SparkSession,
    folder: str,
    target: str,
    source: str,
    subdir: str,
    events_per_shard: int,
    mode: SummaryMode = SummaryMode.CLASSIC,
    geometry: DataFrame | None = None,
    order_by: Sequence[str] = PULSE_ORDER,
    parts: Sequence[int] | None = None,
) -> None:
    """SQLite parts of a dataset -> sensor rows and truth.

    Events are numbered and cut into shards once, by their pulses; offsets count the
    sensor rows of all of them, also of events without labels.  Order pulses by
    `pulse_id` alone to take them as they were stored.  With `parts` only these are
    read and replaced; nothing is replaced if their events do not all come out.
    """
    with released_pins(spark):
        _summarise(spark, folder, target, source, subdir, events_per_shard, mode, geometry, order_by, parts)


def _events_missing(placed: DataFrame):
    """Check of written rows: all placed events, and no others."""

    def check(written: DataFrame) -> str | None:
        wanted, found = placed.count(), written.select("event_no").distinct().count()
        return None if wanted == found else f"{found} events instead of {wanted}"

    return check


def _summarise(spark, folder, target, source, subdir, events_per_shard, mode, geometry, order_by, parts) -> None:
    pulses = _table(spark, folder, resolve_table(folder, PULSE_TABLES), source, subdir, parts).withColumnRenamed("row_id", "pulse_id")
    if not {"string", "dom_number"} <= set(pulses.columns):
        if geometry is None:
            raise ValueError("pulses carry no string and dom_number: a geometry table is needed")
        pulses = assign_sensor(pulses, geometry)
    # The files are read once, whole rows at a time; what follows reads columns.
    pulses = pin(pulses)
    placed = pin(labels.place_events(pulses, events_per_shard))
    shards = placed.select("event_no", "original_event_no", "part_no", "shard_no")
    names = ["event_no", "original_event_no"] + [n for n, _ in summary_columns(mode)[1:]]
    kinds = dict(summary_columns(mode))
    rows = (
        dom_summary(pulses, mode, order_by)
        .join(shards, "event_no")
        .select(*[F.col(n).cast(kinds[n]) if n in kinds and n != "event_no" else F.col(n) for n in names], "part_no", "shard_no")
    )
    files.write_summary(rows, target, source, subdir, parts, _events_missing(placed))
    doms = files.read_dataset(spark, target, source, subdir, "doms")
    if parts is not None:
        doms = doms.where(F.col("part_no").isin(*parts))

    truth = _table(spark, folder, resolve_table(folder, TRUTH_TABLES), source, subdir, parts)
    present = set(table_names(source_files(folder)[0]))
    sides = {"labels": truth if set(truth.columns) & set(SIDE_TABLES["labels"]) else None}
    for side, table in SIDE_SOURCES.items():
        if table in present:
            sides[side] = _suffixed(_table(spark, folder, table, source, subdir, parts), SIDE_TABLES[side])
    tag = ids.dataset_tag_number(subdir, source)
    full = labels.assemble_truth(truth, pulses, doms, sides, tag, events_per_shard, placed=placed.drop("original_event_no"))
    originals = truth.select("event_no", "original_event_no")
    whole = full.join(originals, "event_no").select("event_no", "original_event_no", *full.columns[1:])
    files.write_truth(whole, target, source, subdir, parts)
    numbers = truth.join(placed.select("event_no"), "event_no", "left_semi").withColumnRenamed("file_name", "source_file")
    files.write_numbers(labels.number_receipt(numbers, F.col("source_file"), ["part_no"]), target, source, subdir, parts)


def filter_dataset(
    spark: SparkSession, root: str, target: str, source: str, subdir: str, selection: select.Selection, parts: Sequence[int] | None = None
) -> str:
    """Keep selected events of a dataset, or of some of its parts, which alone are replaced; returns the folder named after the filters."""
    truth, doms = (files.read_dataset(spark, root, source, subdir, t) for t in ("truth", "doms"))
    if parts is not None:
        truth, doms = (t.where(F.col("part_no").isin(*parts)) for t in (truth, doms))
    out = f"{target}/{selection.keyword()}"
    files.write_truth(selection.truth(truth), out, source, subdir, parts)
    files.write_summary(selection.doms(truth, doms), out, source, subdir, parts)
    files.write_receipt(selection.receipt(truth), f"{out}/{source}/{subdir}/receipt", parts)
    return out


def feature_datasets(
    spark: SparkSession,
    root: str,
    target: str,
    source: str,
    subdirs: Sequence[str],
    geometry: DataFrame,
    compact: bool = False,
    balance: bool = True,
    receipt: DataFrame | None = None,
    bins: int = 50,
) -> None:
    """Written datasets of several flavours -> shape features per event, and their statistics and histograms per flavour.

    Writes <target>/features, <target>/statistics and <target>/histograms.  `receipt`
    lists the events that may be used; with `balance` every flavour gives as many events.
    """
    with released_pins(spark):
        truths = [
            files.read_dataset(spark, root, source, s, "truth").select("event_no", ids.flavour(F.lit(s)).alias("flavour")) for s in subdirs
        ]
        events = reduce(DataFrame.unionByName, truths)
        if receipt is not None:
            events = labels.only_listed(events, receipt)
        if balance:
            events = blending.balance_classes(events)
        doms = reduce(DataFrame.unionByName, [files.read_dataset(spark, root, source, s, "doms").select(*_MEASURED) for s in subdirs])
        rows = shape.labelled_features(doms, pin(events), geometry, compact)
        rows.write.mode("overwrite").parquet(f"{target}/features")
        rows = spark.read.parquet(f"{target}/features")
        names = [c for c in rows.columns if c not in ("event_no", "flavour")]
        stats.describe_columns(rows, names, ["flavour"]).write.mode("overwrite").parquet(f"{target}/statistics")
        stats.histograms(rows, {n: stats.Bins(bins=bins) for n in names}, ["flavour"]).write.mode("overwrite").parquet(f"{target}/histograms")


def blend_datasets(
    spark: SparkSession,
    root: str,
    source: str,
    low: str,
    high: str,
    blended: str,
    energy_cutoff: float | None = blending.ENERGY_CUTOFF,
    events_per_part: int = blending.EVENTS_PER_PART,
    events_per_shard: int = blending.EVENTS_PER_SHARD,
) -> None:
    """Two datasets -> one, written beside them; raises if the sensor rows of a blended event are incomplete."""
    with released_pins(spark):
        _blend_datasets(spark, root, source, low, high, blended, energy_cutoff, events_per_part, events_per_shard)


def _blend_datasets(spark, root, source, low, high, blended, energy_cutoff, events_per_part, events_per_shard) -> None:
    truths = [files.read_dataset(spark, root, source, s, "truth") for s in (low, high)]
    mixed = blending.blend_truth(*truths, int(blended), energy_cutoff, events_per_part, events_per_shard)
    files.write_truth(mixed, root, source, blended)
    placed = files.read_dataset(spark, root, source, blended, "truth")
    doms = [files.read_dataset(spark, root, source, s, "doms") for s in (low, high)]
    odd = quality.unexpected_columns(doms[1], doms[0].columns)
    if any(odd.values()):
        raise ValueError(f"{high} was summarised in another mode than {low}: {odd}")
    both = doms[0].unionByName(doms[1])
    short = blending.missing_doms(placed, both).limit(5).collect()
    if short:
        raise ValueError(f"sensor rows are missing, for example {[tuple(r) for r in short]} (event, wanted, found)")
    rows = blending.blend_doms(placed, both)
    files.write_summary(rows, root, source, blended)
    receipt = blending.blend_receipt(*truths, int(blended), energy_cutoff)
    files.write_receipt(receipt, os.path.join(root, source, blended, "receipt"))
