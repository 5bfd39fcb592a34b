"""Blend two datasets into one of equal shares, interleaved and cut into new parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.operators.scan import number_by_key, number_rows
from pulsegrid.operators.truth import shard_offsets
from pulsegrid.runtime import pin

ENERGY_CUTOFF = 1e5
EVENTS_PER_PART = 30_000
EVENTS_PER_SHARD = 3_000
ORDER = ("part_no", "event_no")


def interleave(low: DataFrame, high: DataFrame, order_by: Sequence[str] = ORDER, **scale) -> DataFrame:
    """low[0], high[0], low[1], high[1], ... as far as both reach; adds 0-based `position`."""
    low, high = (side if getattr(side, "_is_pinned", False) else pin(side) for side in (low, high))
    shorter = min(low.count(), high.count())
    sides = [
        number_by_key(side, order_by, name="_n", **scale)
        .where(F.col("_n") <= shorter)
        .withColumn("position", ((F.col("_n") - 1) * 2 + rank).cast("long"))
        .drop("_n")
        for rank, side in enumerate((low, high))
    ]
    return sides[0].unionByName(sides[1])


def blend_truth(
    low: DataFrame,
    high: DataFrame,
    subdirectory_no: int,
    energy_cutoff: float | None = ENERGY_CUTOFF,
    events_per_part: int = EVENTS_PER_PART,
    events_per_shard: int = EVENTS_PER_SHARD,
    order_by: Sequence[str] = ORDER,
    **scale,
) -> DataFrame:
    """Blended truth: the energy cut holds for `low` only; parts and shards are renumbered."""
    if energy_cutoff is not None:
        low = low.where(F.col("energy") > energy_cutoff)
    rows = interleave(low, high, order_by, **scale)
    in_part = F.col("position") % events_per_part
    rows = (
        rows.withColumn("subdirectory_no", F.lit(subdirectory_no % 100))
        .withColumn("source_part_no", F.col("part_no"))
        .withColumn("part_no", (F.floor(F.col("position") / events_per_part) + 1).cast("int"))
        .withColumn("shard_no", (F.floor(in_part / events_per_shard) + 1).cast("int"))
    )
    return shard_offsets(rows, ("part_no", "shard_no"), ("position",))


def blend_doms(truth: DataFrame, doms: DataFrame) -> DataFrame:
    """Sensor rows of the blended events with their new part, shard and event position."""
    places = truth.select("event_no", "part_no", "shard_no", "position")
    return doms.drop("part_no", "shard_no").join(places, "event_no", "inner")


def blend_receipt(low: DataFrame, high: DataFrame, subdirectory_no: int, energy_cutoff: float | None = ENERGY_CUTOFF) -> DataFrame:
    if energy_cutoff is not None:
        low = low.where(F.col("energy") > energy_cutoff)
    counts = (
        low.select(F.lit(1).alias("l"), F.lit(0).alias("h"))
        .unionByName(high.select(F.lit(0).alias("l"), F.lit(1).alias("h")))
        .agg(F.coalesce(F.sum("l"), F.lit(0)).alias("l"), F.coalesce(F.sum("h"), F.lit(0)).alias("h"))
    )
    return counts.select(
        F.lit(subdirectory_no).alias("subdir_no"),
        F.col("l").alias("events_from_low_energy"),
        F.col("h").alias("events_from_high_energy"),
        (F.least("l", "h") * 2).alias("total_events_combined"),
    )


def missing_doms(truth: DataFrame, doms: DataFrame) -> DataFrame:
    """Blended events whose sensor rows are incomplete."""
    found = doms.groupBy("event_no").agg(F.count(F.lit(1)).alias("found"))
    return truth.join(found, "event_no", "left").where(
        F.coalesce("found", F.lit(0)) != F.col("N_doms")
    ).select("event_no", "N_doms", F.coalesce("found", F.lit(0)).alias("found"))


def balance_classes(events: DataFrame, label: str = "flavour", order_by: Sequence[str] = ("event_no",), **scale) -> DataFrame:
    """The first events of each class, as many as the smallest class has."""
    smallest = events.groupBy(label).count().agg(F.min("count")).scalar()
    numbered = number_rows(events, order_by, [label], "_n", **scale)
    return numbered.where(F.col("_n") <= smallest).drop("_n")
