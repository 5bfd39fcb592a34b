"""Event selection: single filters, their composition, application and receipt.

A filter is either a condition on truth columns or a table of keys to keep, so
that conditions are pushed into the scan and keys become semi joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.operators.truth import shard_offsets


class EventFilter:
    """Subclass and override `apply` (and `settings` if it has parameters)."""

    def apply(self, truth: DataFrame) -> DataFrame:
        raise NotImplementedError

    def mark(self, truth: DataFrame, name: str) -> DataFrame:
        """All rows, with a flag that says which ones `apply` keeps."""
        kept = self.apply(truth).select("event_no", F.lit(True).alias(name))
        return truth.join(kept, "event_no", "left").withColumn(name, F.coalesce(name, F.lit(False)))

    def settings(self) -> list:
        return []


class ConditionFilter(EventFilter):
    def condition(self) -> Column:
        raise NotImplementedError

    def apply(self, truth: DataFrame) -> DataFrame:
        return truth.where(self.condition())

    def mark(self, truth: DataFrame, name: str) -> DataFrame:
        return truth.withColumn(name, F.coalesce(self.condition(), F.lit(False)))


class ChargedCurrent(ConditionFilter):
    def condition(self) -> Column:
        return F.col("InteractionType") == 1


class MuonLike(ConditionFilter):
    def condition(self) -> Column:
        return F.col("MuonFilter_13") == 1


class Contained(ConditionFilter):
    def condition(self) -> Column:
        return F.col("isWithinIceCube") != 0


@dataclass
class TravelDistance(ConditionFilter):
    min_travel_distance: float = 300

    def condition(self) -> Column:
        return F.col("post_vertex_intraIceCube_segment") > self.min_travel_distance

    def settings(self) -> list:
        return [self.min_travel_distance]


@dataclass
class Clean(EventFilter):
    """Events listed as clean by (RunID, EventID)."""

    listing: DataFrame

    def apply(self, truth: DataFrame) -> DataFrame:
        return truth.join(self.listing.select("RunID", "EventID"), ["RunID", "EventID"], "left_semi").select(
            *truth.columns
        )

    def mark(self, truth: DataFrame, name: str) -> DataFrame:
        listed = self.listing.select("RunID", "EventID").distinct().withColumn(name, F.lit(True))
        return truth.join(listed, ["RunID", "EventID"], "left").withColumn(name, F.coalesce(name, F.lit(False)))


@dataclass
class Selection:
    """AND of named filters."""

    filters: Mapping[str, EventFilter] = field(default_factory=dict)

    def keyword(self) -> str:
        names = []
        for alias in sorted(self.filters):
            names.append("_".join([alias, *map(str, self.filters[alias].settings())]))
        return "_".join(names) or "None"

    def keep(self, truth: DataFrame) -> DataFrame:
        """Selected truth rows, offsets as before; no filters select nothing."""
        if not self.filters:
            return truth.where(F.lit(False))
        for alias in sorted(self.filters):
            truth = self.filters[alias].apply(truth)
        return truth

    def truth(self, truth: DataFrame, within: Sequence[str] = ("part_no", "shard_no")) -> DataFrame:
        return shard_offsets(self.keep(truth), within).select(*truth.columns)

    def doms(self, truth: DataFrame, doms: DataFrame) -> DataFrame:
        return doms.join(self.keep(truth).select("event_no"), "event_no", "left_semi")

    def receipt(self, truth: DataFrame, by: Sequence[str] = ("subdirectory_no", "part_no")) -> DataFrame:
        """Events before and after, and their ratios, per part."""
        keys, chosen = list(by), F.lit(bool(self.filters))
        rows = truth
        for alias in sorted(self.filters):
            rows = self.filters[alias].mark(rows, f"_{alias}")
            chosen = chosen & F.col(f"_{alias}")
        counted = rows.select(*keys, chosen.alias("chosen")).groupBy(*keys).agg(
            F.expr("count(*) AS initial_events"), F.expr("count_if(chosen) AS selected_events")
        )
        survival = F.coalesce(F.try_divide(F.col("selected_events"), F.col("initial_events")), F.lit(0.0))
        return counted.select(
            *keys,
            F.lit(self.keyword()).alias("filter_applied"),
            "initial_events",
            "selected_events",
            F.round(survival, 4).alias("survival_ratio"),
            F.round(1 - survival, 4).alias("reduction_ratio"),
        )


def busy_events(truth: DataFrame, n_doms_cut: int = 1250) -> DataFrame:
    return truth.where(F.col("N_doms") > n_doms_cut)
