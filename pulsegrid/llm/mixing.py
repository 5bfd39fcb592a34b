"""Mixing sources to target weights by Pareto order sampling.

Every source has a share of all words; a target never exceeds `MOST_COPIES` times
the source's own words, and what is cut off goes to the other sources by weight.
A source whose target is r times its size gives each document floor(r) whole
copies for certain.  For the rest, longer documents get better odds: the
inclusion probability grows with the length class (bits of the size) and is 1 at
most.  Documents are then ranked by random odds divided by inclusion odds, and
the lowest ranks are taken until the target is met as nearly as possible.

Ranks are cut without sorting a source: sums per rank bucket find the bucket in
which the target falls, and only that bucket's rows are ordered.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import unit, whole_rows
from pulsegrid.operators.scan import broadcast_checked, running_totals
from pulsegrid.runtime import pin

# Word pattern, weights in turn, and most copies of a document.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
_KEY_BITS, _BUCKET_BITS = 44, 14
_NUMBERS = 1 << 12  # equal rows that one row of a frame stands for when they are numbered
_NAMES = ("size", "source_size", "target", "taken", "copies")


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def length_class(size: Column) -> Column:
    """Number of binary digits of the size; 0 for an empty document."""
    return F.when(size > 0, F.length(F.bin(size))).otherwise(0).cast("int")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size) with `target`; sources in code point order, null last, take the weights in turn.

    The sources are ordered in one task: one row each.
    """
    everywhere = Window.partitionBy()
    named = Window.orderBy(F.asc_nulls_last("source"))
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(named) - 1, F.lit(len(weights))) + 1)
    weighed = sizes.withColumn("_w", pick).withColumn("_most", F.col("source_size") * float(most))
    # Filled up in order of most / weight: a source is full if the level of those not yet full lies above it.
    order = [F.col("_most") / F.col("_w"), F.asc_nulls_last("source")]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everywhere) - F.coalesce(F.sum("_most").over(before), F.lit(0.0))) / F.sum("_w").over(onward)
    levels = weighed.withColumn("_level", level).withColumn("_place", F.row_number().over(Window.orderBy(*order)))
    open_ = F.min(F.when(F.col("_level") * F.col("_w") <= F.col("_most"), F.struct("_place", "_level"))).over(everywhere)
    return levels.withColumn("_open", open_["_level"]).select(
        "source", "source_size", F.least(F.col("_most"), F.coalesce(F.col("_open") * F.col("_w"), F.col("_most"))).alias("target")
    )


@dataclass(frozen=True)
class Mix:
    """Small tables that decide a mix: `classes` has a row for each source and length class with the source's target,
    whole copies, inclusion probability and the last rank taken."""

    classes: DataFrame
    rows: int


def _ranked(measured: DataFrame, classes: DataFrame, rows: int) -> DataFrame:
    """Adds the class's columns and `_key`, the rank by random odds over inclusion odds on a scale from 0 to 2^44."""
    theirs = broadcast_checked(classes.withColumnsRenamed({"source": "_s", "_class": "_c"}), rows)
    joined = measured.join(theirs, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_class") == F.col("_c"))).drop("_s", "_c")
    u, p = F.col("_u"), F.col("_p")
    scale = (u * (1 - p)) / (u * (1 - p) + (1 - u) * p)  # q / (1 + q) of the odds ratio q
    return joined.withColumn("_key", F.least(F.floor(scale * float(1 << _KEY_BITS)), F.lit((1 << _KEY_BITS) - 1)).cast("long"))


def measured(docs: DataFrame, keep: Sequence[str], doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The columns `keep` with source, size, length class and `_h`, a hash of id and text, of each document."""
    size = words_of(F.col(text))
    kept = [F.col(f"`{c}`") for c in keep if c not in (*_NAMES, "source")]
    return docs.select(
        *kept, F.col(source).alias("source"), size.alias("size"), length_class(size).alias("_class"),
        F.xxhash64(F.col(doc_id), F.col(text)).alias("_h"),
    )


def _counted(rows: DataFrame) -> DataFrame:
    """Equal rows once, with their number `_m`."""
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_m"))


def numbered(counted: DataFrame, first: Column | None = None) -> DataFrame:
    """Every row as often as it was counted, with its random number `_u`: equal rows have numbers of their own from
    `first` (0) on, so that each is drawn for itself.  Many equal rows are dealt out in parts before they are written out."""
    names = [c for c in counted.columns if c != "_m"]
    begin = F.lit(0) if first is None else first
    few = counted.withColumn("_no", F.when(F.col("_m") == 1, begin))
    parts = few.where("_m > 1").select(*names, "_m", begin.alias("_b"), F.explode(F.expr(f"sequence(0L, (_m - 1) div {_NUMBERS})")).alias("_part"))
    places = F.sequence(F.col("_part") * _NUMBERS, F.least(F.col("_m"), (F.col("_part") + 1) * _NUMBERS) - 1)
    many = parts.repartition("_h", "_part").select(*names, F.col("_b"), F.explode(places).alias("_no"))
    every = few.where("_m = 1").select(*names, "_no").unionByName(many.select(*names, (F.col("_b") + F.col("_no")).alias("_no")))
    return every.withColumn("_u", unit(F.col("_h"), F.col("_no").cast("long"), seed=3)).drop("_no")


def plan_mix(rows: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_COPIES) -> Mix:
    """Decide a mix from `numbered` rows."""
    per_class = pin(rows.groupBy("source", "_class").agg(F.sum("size").alias("_words")))
    n = per_class.count()
    sizes = per_class.groupBy("source").agg(F.sum("_words").alias("source_size"))
    targets = source_targets(sizes, weights, most).withColumnRenamed("source", "_s")
    whole = F.floor(F.try_divide(F.col("target"), F.col("source_size").cast("double")))
    shared = per_class.join(targets, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    shared = shared.withColumn("_whole", F.coalesce(F.least(whole, F.lit(most)), F.lit(0)).cast("long"))
    shared = shared.withColumn("_rest", F.col("target") - F.col("_whole") * F.col("source_size"))
    # Inclusion probability in proportion to the class, 1 at most: classes are filled from the longest down.
    down = Window.partitionBy("source").orderBy(F.desc("_class"))
    before = down.rowsBetween(Window.unboundedPreceding, -1)
    onward = down.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weight = F.col("_class") * F.col("_words")
    rate = F.try_divide(F.col("_rest") - F.coalesce(F.sum("_words").over(before), F.lit(0)), F.sum(weight).over(onward).cast("double"))
    rated = shared.withColumn("_rate", rate)
    fits = F.min(F.when(F.col("_rate") * F.col("_class") <= 1, F.struct((-F.col("_class")).alias("o"), "_rate"))).over(Window.partitionBy("source"))
    rated = rated.withColumn("_fit", fits["_rate"])
    p = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.col("_fit") * F.col("_class"), F.lit(1.0))))
    classes = pin(rated.select("source", "_class", "source_size", "target", "_whole", "_rest", p.alias("_p")))

    # Where in the ranks the target falls: first by bucket, then by row within that bucket.
    ranked = _ranked(rows.where("size > 0").select("source", "size", "_class", "_u"), classes, n)
    shift = _KEY_BITS - _BUCKET_BITS
    buckets = ranked.groupBy("source", F.shiftright("_key", shift).alias("_bucket")).agg(F.sum("size").alias("_words"), F.first("_rest").alias("_rest"))
    upto = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = buckets.withColumn("_upto", F.sum("_words").over(upto)).where((F.col("_upto") >= F.col("_rest")) & (F.col("_rest") > 0))
    edge = summed.groupBy(F.col("source").alias("_s")).agg(F.min(F.struct("_bucket", (F.col("_upto") - F.col("_words")).alias("_below"))).alias("_edge"))
    edge = pin(edge.select("_s", F.col("_edge._bucket").alias("_b"), F.col("_edge._below").alias("_below")))
    inside = ranked.join(
        broadcast_checked(edge, n), F.col("source").eqNullSafe(F.col("_s")) & (F.shiftright("_key", shift) == F.col("_b"))
    ).select("source", "size", "_key", "_u", "_rest", "_below")
    within = Window.partitionBy("source").orderBy("_key", "_u").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tried = inside.withColumn("_upto", F.col("_below") + F.sum("size").over(within))
    taken = tried.where(2 * F.col("_upto") - F.col("size") <= 2 * F.col("_rest"))
    last = taken.groupBy(F.col("source").alias("_s")).agg(F.max(F.struct("_key", "_u")).alias("_last"))
    first_open = F.shiftleft(F.col("_b"), shift)
    cut = edge.select(F.col("_s").alias("_e"), "_b").join(last, F.col("_e").eqNullSafe(F.col("_s")), "left")
    cut = cut.select("_e", F.coalesce(F.col("_last._key"), first_open - 1).alias("_cut"), F.coalesce(F.col("_last._u"), F.lit(2.0)).alias("_cut_u"))
    decided = classes.join(cut, F.col("source").eqNullSafe(F.col("_e")), "left").drop("_e", "_rest")
    return Mix(pin(decided), n)


def apply_mix(rows: DataFrame, mix: Mix) -> DataFrame:
    """`numbered` rows with source_size, target, copies and taken (copies times size)."""
    ranked = _ranked(rows, mix.classes, mix.rows)
    before = (F.col("_key") < F.col("_cut")) | ((F.col("_key") == F.col("_cut")) & (F.col("_u") <= F.col("_cut_u")))
    extra = F.when(F.coalesce(before, F.lit(False)) & (F.col("size") > 0), 1).otherwise(0)
    copies = (F.col("_whole") + extra).cast("int")
    return ranked.withColumn("copies", copies).withColumn("taken", F.col("size") * F.col("copies")).drop(
        "_class", "_h", "_u", "_key", "_whole", "_p", "_cut", "_cut_u"
    )


def mix_report(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """What a mix takes of each document: doc_id, source, size, source_size, target, copies, taken.

    A null text has size 0; a document of size 0 is taken as often as its source
    gives whole copies, which is no word.  Equal rows (id, text, source) are each drawn
    for themselves.  Null sources form a source of their own.
    Targets add up to all words; without words all are 0.
    """
    rows = numbered(pin(_counted(measured(docs, ["doc_id"]))))
    return apply_mix(rows, plan_mix(rows, weights, most))


def mix_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """The mix itself: the rows of `docs`, each as often as it is taken.

    Texts stay where they are, but for rows of one id, text and source: these meet to be numbered in order of all columns.
    """
    counted = pin(_counted(measured(docs, [])))
    mix = plan_mix(numbered(counted), weights, most)
    rows = measured(whole_rows(docs, "doc_id", "text", "source"), ["_doc"])
    repeated = pin(counted.where("_m > 1").select(F.col("_h").alias("_r"), F.col("source").alias("_s")))
    if repeated.isEmpty():
        drawn = rows.withColumn("_u", unit(F.col("_h"), F.lit(0).cast("long"), seed=3))
    else:
        known = repeated.select("_r").distinct()
        once = rows.join(known, F.col("_h") == F.col("_r"), "left_anti").withColumn("_u", unit(F.col("_h"), F.lit(0).cast("long"), seed=3))
        several = _counted(rows.join(known, F.col("_h") == F.col("_r"), "left_semi"))
        upto = running_totals(several, ["_doc"], {"_upto": F.col("_m")}, ["_h", "source"])
        drawn = once.unionByName(numbered(upto.withColumn("_from", F.col("_upto") - F.col("_m")).drop("_upto"), F.col("_from")).drop("_from"))
    chosen = apply_mix(drawn, mix)
    return chosen.where("copies > 0").select("_doc", F.explode(F.sequence(F.lit(1), "copies"))).select("_doc.*")
