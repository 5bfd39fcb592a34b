"""Per-event labels: assembly from source tables, derived labels, shards and offsets."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions import geometry, ids
from pulsegrid.operators.scan import number_by_key, number_rows, running_totals
from pulsegrid.operators.shape import max_pair_distance
from pulsegrid.schema import DERIVED_TRUTH, SIDE_TABLES, TRUTH_COLUMNS, cast_to, filled

# Adds a label computed from other columns of the same row.
TruthFeature = Callable[[DataFrame], DataFrame]
# Label of an event from its sensor rows: DataFrame -> DataFrame keyed by event_no.
SummaryFeature = Callable[[DataFrame], DataFrame]
_DAUGHTER = "_GNHighestEDaughter"


def count_doms(pulses: DataFrame) -> DataFrame:
    """Distinct sensors per event; a sensor without string or number does not count."""
    return pulses.groupBy("event_no").agg(F.count_distinct("string", "dom_number").cast("int").alias("N_doms"))


def _shard(events_per_shard: int) -> Column:
    return (F.floor((F.col("_n") - 1) / events_per_shard) + 1).cast("int").alias("shard_no")


def assign_shards(events: DataFrame, events_per_shard: int, within: Sequence[str] = ("part_no",), **scale) -> DataFrame:
    """Distinct events of each part, numbered in order and cut into shards from 1 on."""
    distinct = events.select(*within, "event_no").distinct()
    numbered = number_rows(distinct, ["event_no"], within, "_n", **scale)
    return numbered.select(*within, "event_no", _shard(events_per_shard))


def with_shards(truth: DataFrame, events_per_shard: int, within: Sequence[str] = ("part_no",), **scale) -> DataFrame:
    """Add shard_no to a table with one row per event."""
    numbered = number_by_key(truth, ["event_no"], within, "_n", **scale)
    return numbered.select(*truth.columns, _shard(events_per_shard))


def shard_offsets(
    truth: DataFrame, within: Sequence[str] = ("part_no", "shard_no"), order_by: Sequence[str] = ("event_no",), exclusive: bool = False
) -> DataFrame:
    """Running sum of N_doms per shard: where the rows of an event end (or begin) in it.

    A shard holds at most `events_per_shard` events, so the window is bounded.
    """
    spec = Window.partitionBy(*within).orderBy(*order_by)
    upto = spec.rowsBetween(Window.unboundedPreceding, -1 if exclusive else Window.currentRow)
    total = F.coalesce(F.sum("N_doms").over(upto), F.lit(0)).cast("int")
    return truth.withColumn("offset", total)


def place_events(pulses: DataFrame, events_per_shard: int, **scale) -> DataFrame:
    """Part, shard, N_doms and offset of every event with pulses; other columns that are constant in an event are kept."""
    kept = [c for c in ("original_event_no",) if c in pulses.columns]
    counted = pulses.groupBy("part_no", "event_no", *kept).agg(F.count_distinct("string", "dom_number").cast("int").alias("N_doms"))
    return shard_offsets(with_shards(counted, events_per_shard, **scale))


def running_dom_count(truth: DataFrame, order_by: Sequence[str] = ("event_no",), **scale) -> DataFrame:
    """Running sum of N_doms over a whole dataset."""
    return running_totals(truth, order_by, {"doms_so_far": F.col("N_doms").cast("long")}, **scale)


def attach_side(truth: DataFrame, side: DataFrame | None, columns: Mapping[str, tuple[str, float]]) -> DataFrame:
    """Left join by event number; absent tables, columns, events and NaN become defaults."""
    if side is None:
        joined, present = truth, set()
    else:
        present = set(side.columns) & set(columns)
        joined = truth.join(side.select("event_no", *sorted(present)), "event_no", "left")
    values = [filled(n if n in present else "NULL", kind, default, n) for n, (kind, default) in columns.items()]
    return joined.selectExpr(*[f"`{c}`" for c in truth.columns], *values)


def _daughter(kind: str) -> tuple[str, str, str]:
    return tuple(f"double({kind}_{axis}{_DAUGHTER})" for axis in "xyz")


def is_within_detector(truth: DataFrame) -> DataFrame:
    return truth.withColumn("isWithinIceCube", geometry.within_detector(*_daughter("pos")))


def segment_in_detector(truth: DataFrame) -> DataFrame:
    direction = _daughter("dir")
    span = geometry.line_span(_daughter("pos"), direction)
    return truth.withColumn("post_vertex_intraIceCube_segment", geometry.segment_after_vertex(span, direction))


TRUTH_FEATURES: tuple[TruthFeature, ...] = (is_within_detector, segment_in_detector)
SUMMARY_FEATURES: tuple[SummaryFeature, ...] = (max_pair_distance,)


def only_listed(table: DataFrame, receipt: DataFrame, keys: Sequence[str] = ("event_no",)) -> DataFrame:
    """Rows of events on the receipt; `keys` may name shard and event."""
    return table.join(receipt.select(*keys), list(keys), "left_semi").select(*table.columns)


def build_truth(truth: DataFrame, pulses: DataFrame, doms: DataFrame, sides: Mapping[str, DataFrame | None],
                subdirectory_no: int, source: str, events_per_shard: int, **features) -> DataFrame:
    """The complete truth table, with enhanced event numbers."""
    tag = ids.dataset_tag_number(str(subdirectory_no), source)
    rows = assemble_truth(truth, pulses, doms, sides, tag, events_per_shard, **features)
    return with_enhanced_id(rows, subdirectory_no, source)


def assemble_truth(
    truth: DataFrame,
    pulses: DataFrame,
    doms: DataFrame,
    sides: Mapping[str, DataFrame | None],
    subdirectory_no: int,
    events_per_shard: int,
    truth_features: Sequence[TruthFeature] = TRUTH_FEATURES,
    summary_features: Sequence[SummaryFeature] = SUMMARY_FEATURES,
    placed: DataFrame | None = None,
) -> DataFrame:
    """Truth, side tables and derived labels; declared types and order.

    Pulses are reduced to one row per event before they meet the labels.  Events
    without pulses have no sensor rows and are left out.  `placed` (`place_events`)
    gives parts, shards and offsets that sensor rows were written by; else the
    labelled events are numbered here.
    """
    base = truth.drop("shard_no", "N_doms", "offset", "subdirectory_no")
    if placed is None:
        rows = shard_offsets(with_shards(base.join(count_doms(pulses), "event_no", "inner"), events_per_shard))
    else:
        rows = base.drop("part_no").join(placed, "event_no", "inner")
    rows = rows.withColumn("subdirectory_no", F.lit(subdirectory_no))
    present = set(rows.columns)
    rows = rows.selectExpr(
        *[f"`{name}`" if name in present else f"CAST(NULL AS {kind}) AS `{name}`" for name, kind in TRUTH_COLUMNS.items()]
    )
    for name, columns in SIDE_TABLES.items():
        rows = attach_side(rows, sides.get(name), columns)
    for feature in summary_features:
        rows = rows.join(feature(doms), "event_no", "inner")
    for feature in truth_features:
        rows = feature(rows)
    return _typed(rows)


def _typed(rows: DataFrame) -> DataFrame:
    kinds = [(n, rows.schema[n].dataType.simpleString() if n == "event_no" else k) for n, k in TRUTH_COLUMNS.items()]
    for columns in SIDE_TABLES.values():
        kinds += [(name, kind) for name, (kind, _) in columns.items()]
    kinds += [(n, DERIVED_TRUTH.get(n, "double")) for n in rows.columns if n not in dict(kinds)]
    return cast_to(rows, kinds)


def with_enhanced_id(rows: DataFrame, subdirectory_no: int | str, source: str, part_no: str = "part_no") -> DataFrame:
    """Replace event_no by (enhanced event_no, original_event_no) at the front."""
    tag = ids.dataset_tag(F.lit(str(subdirectory_no)), source)
    enhanced = ids.enhanced_event_no(ids.source_tag(source), tag, F.col(part_no), F.col("event_no"))
    rest = [c for c in rows.columns if c != "event_no"]
    return rows.select(enhanced.alias("event_no"), F.col("event_no").alias("original_event_no"), *rest)


def number_receipt(rows: DataFrame, source_file: Column, keep: Sequence[str] = ()) -> DataFrame:
    """original_event_no, event_no and source_file of each event, to trace new numbers back."""
    return rows.select("original_event_no", "event_no", source_file.alias("source_file"), *keep)


def doms_by_slice(doms: DataFrame, truth: DataFrame, place: str = "row_in_shard") -> DataFrame:
    """Sensor rows of each event found by their place in the shard, [offset - N_doms, offset).

    Every place of an event is listed once and joined by equality.
    """
    places = truth.select(
        "part_no", "shard_no", F.col("event_no").alias("owner"),
        F.explode(F.sequence(F.col("offset") - F.col("N_doms"), F.col("offset") - 1)).alias(place),
    )
    return doms.join(places, ["part_no", "shard_no", place], "inner")
