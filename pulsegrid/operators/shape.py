"""Shape of events: extent, principal axes, stretch and clustering.

Per event only distinct string positions matter for everything horizontal, so
rows are first reduced to those by hash aggregation (at most one row per string
of the detector), and outlines are computed on the reduced rows.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.geometry import OUTLINE_AREA
from pulsegrid.functions.scaling import adjusted_charge, adjusted_charge_sql, repeat_weight
from pulsegrid.operators import kernels
from pulsegrid.operators.segments import borders, map_groups, to_arrays
from pulsegrid.schema import NOT_ENOUGH_PULSES

_BOUNDARY_SCHEMA = (
    "n_points long, n_border long, extent double, end1_x double, end1_y double, end2_x double, end2_y double, "
    "major double, minor double, axis_x double, axis_y double, area double"
)
# An event of more points than FOLD_ROWS is reduced to its outline while it streams by; parts below PRUNE_FROM stay whole.
PRUNE_FROM, FOLD_ROWS = 256, 100_000


def _nan_to_null(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[F.nanvl(F.col(c), F.lit(None)).alias(c) if c in names else F.col(c) for c in df.columns])


def _outline_only(table: pa.Table) -> pa.Table:
    """Drop points inside the hull of their event; small or collinear sets stay whole.

    hull(A and B) = hull(hull(A) and hull(B)), so this may run on any share of an
    event.  `held` says how many points a row stands for.
    """
    table = table.sort_by([("event_no", "ascending"), ("x", "ascending"), ("y", "ascending")])
    columns = to_arrays(table)
    keys, x, y = columns["event_no"], columns["x"], columns["y"]
    starts, sizes = borders(keys)
    large = sizes >= PRUNE_FROM
    if not large.any():
        return table
    keep, held = ~np.repeat(large, sizes), columns["held"].copy()
    for at, size in zip(starts[large], sizes[large]):
        rows, count = kernels.hull_rows(x[at : at + size], y[at : at + size], np.array([0]), np.array([size]))
        if count[0] < 3:
            keep[at : at + size] = True
            continue
        keep[at + rows] = True
        # The first kept point stands for those left out.
        inside = held[at : at + size].sum() - held[at + rows].sum()
        held[at + rows[0]] += inside
    table = table.set_column(table.schema.get_field_index("held"), "held", pa.array(held))
    return table.filter(pa.array(keep))


def boundary(points: DataFrame) -> DataFrame:
    """Outline features per event of its distinct (x, y) points.

    Columns: n_points, n_border, extent with its end points, major and minor axis
    lengths, direction of the major axis, area of the outline.  The outline is the
    convex hull, or all points if they are collinear.
    """
    distinct = points.where(F.col("x").isNotNull() & F.col("y").isNotNull()).select(
        "event_no", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")
    ).distinct()
    distinct = distinct.withColumn("held", F.lit(1).cast("long"))

    def kernel(columns, starts, sizes):
        return kernels.boundary_features(columns, starts, sizes) | {"n_points": np.add.reduceat(columns["held"], starts)}

    out = map_groups(distinct, kernel, _BOUNDARY_SCHEMA, sort=("x", "y"), fold=_outline_only, fold_rows=FOLD_ROWS)
    return _nan_to_null(out, ["major", "minor", "area"])


def max_pair_distance(doms: DataFrame, name: str = "max_interPMT_distance") -> DataFrame:
    """Largest 3-D distance between two sensors of an event, 0 with fewer than two.

    For a fixed (x, y) only the lowest and highest sensor can be an end of the
    longest line, so rows are reduced to those two before any pairing.
    """
    columns = doms.groupBy("event_no", "dom_x", "dom_y").agg(
        F.min("dom_z").alias("z_low"), F.max("dom_z").alias("z_high")
    )
    ends = columns.select(
        "event_no",
        F.col("dom_x").cast("double").alias("x"),
        F.col("dom_y").cast("double").alias("y"),
        F.explode(F.array_distinct(F.array(F.col("z_low").cast("double"), F.col("z_high").cast("double")))).alias("z"),
    )

    def kernel(columns, starts, sizes):
        points = np.column_stack([columns["x"], columns["y"], columns["z"]])
        return {name: kernels.farthest_pairs(points, starts, sizes)[0]}

    return map_groups(ends, kernel, f"{name} double")


def string_stretch(doms: DataFrame) -> DataFrame:
    """Vertical range of each string of each event."""
    return doms.where(F.col("string").isNotNull()).groupBy("event_no", "string").agg(
        F.min("dom_z").alias("z_low"),
        F.max("dom_z").alias("z_high"),
        (F.max("dom_z") - F.min("dom_z")).alias("stretch"),
    )


def z_stretch(doms: DataFrame) -> DataFrame:
    """Mean, maximum and half the central range of the string stretches of an event."""
    strings = string_stretch(doms)
    longest = F.min(F.struct((-F.col("stretch")).alias("s"), "string", "z_low", "z_high"))
    # At most one row per string here, so the exact percentiles hold few values.
    out = strings.groupBy("event_no").agg(
        F.avg("stretch").alias("stretch_mean"),
        F.max("stretch").alias("stretch_max"),
        ((F.percentile("stretch", 0.843) - F.percentile("stretch", 0.157)) / 2).alias("stretch_hiqr"),
        longest.alias("_top"),
    )
    return out.select(
        "event_no", "stretch_mean", "stretch_max", "stretch_hiqr",
        F.col("_top.string").alias("stretch_string"),
        F.col("_top.z_low").alias("stretch_z_low"),
        F.col("_top.z_high").alias("stretch_z_high"),
    )


def string_nearest_mean(doms: DataFrame) -> DataFrame:
    """String whose stretch is closest to the mean stretch of its event."""
    strings = string_stretch(doms)
    mean = F.avg("stretch").over(Window.partitionBy("event_no"))  # one row per string
    return (
        strings.withColumn("_gap", F.abs(F.col("stretch") - mean))
        .groupBy("event_no")
        .agg(
            F.min_by("string", F.struct("_gap", "string")).alias("string"),
            F.min_by("stretch", F.struct("_gap", "string")).alias("stretch"),
        )
    )


def string_table(doms: DataFrame) -> DataFrame:
    """Mean position and summed adjusted charge of each string of an event."""
    return doms.where(F.col("string").isNotNull()).groupBy("event_no", "string").agg(
        F.avg("dom_x").alias("x"), F.avg("dom_y").alias("y"), F.sum("Qtotal").alias("w")
    )


def _distances(strings: DataFrame) -> DataFrame:
    event = Window.partitionBy("event_no")  # one row per string
    total = F.sum("w").over(event)
    cx = F.try_divide(F.sum(F.col("x") * F.col("w")).over(event), total)
    cy = F.try_divide(F.sum(F.col("y") * F.col("w")).over(event), total)
    measured = strings.select(
        "event_no", "w", F.sqrt((F.col("x") - cx) ** 2 + (F.col("y") - cy) ** 2).alias("d")
    )
    return measured.withColumn("d_max", F.max("d").over(event))


def charge_spread(strings: DataFrame, bins: int = 10) -> DataFrame:
    """Charge-weighted mean distance to the centroid, and the charge share in its outer half."""
    place = F.least(F.lit(bins - 1), F.floor(F.try_divide(F.col("d") * bins, F.col("d_max"))))
    outer = F.sum(F.when(place >= bins // 2, F.col("w")).otherwise(0.0))
    enough = F.count(F.lit(1)) >= 3
    total = F.sum("w")
    return (
        _distances(strings)
        .groupBy("event_no")
        .agg(
            F.when(enough & (F.max("d") > 0) & (total != 0), outer / (total + 1e-8)).alias("outer_mass_fraction"),
            F.when(enough, F.try_divide(F.sum(F.col("d") * F.col("w")), total)).alias("normalised_weighted_distance"),
        )
    )


def cluster_scores(strings: DataFrame, mean_shift: bool = True) -> DataFrame:
    """Separation scores of two-component mixtures and mean shift; null with one string."""
    names = ["gmm_score", "kmeans_score", *(["meanshift_score"] if mean_shift else [])]
    rows = strings.select("event_no", "string", "x", "y", "w")
    kernel = partial(kernels.cluster_scores, mean_shift=mean_shift)
    scored = map_groups(rows, kernel, ", ".join(f"{n} double" for n in names), sort=("x", "y", "string"))
    return _nan_to_null(scored, names)


def repeated_points(strings: DataFrame) -> DataFrame:
    """String positions repeated 1..10 times according to their charge."""
    top = F.max("w").over(Window.partitionBy("event_no"))  # one row per string
    return strings.withColumn("copies", repeat_weight(F.col("w"), top)).select(
        "event_no", "string", "x", "y", F.explode(F.array_repeat(F.lit(1), F.col("copies"))).alias("one")
    ).drop("one")


def eccentricity(guarded: bool) -> Column:
    major, minor = F.col("major"), F.col("minor")
    value = F.sqrt(F.lit(1.0) - F.pow(F.try_divide(minor, major), 2))
    return F.when((major > 0) & (minor > 0), value).otherwise(NOT_ENOUGH_PULSES) if guarded else value


def aspect_contrast(guarded: bool) -> Column:
    major, minor = F.col("major"), F.col("minor")
    value = F.try_divide(major - minor, major + minor)
    return F.when((major > 0) & (minor > 0), value).otherwise(NOT_ENOUGH_PULSES) if guarded else value


def _extent_cosines() -> tuple[Column, Column]:
    """Cosines between the extent and the major and minor axis; null if undefined."""
    ex = F.try_divide(F.col("end2_x") - F.col("end1_x"), F.col("extent"))
    ey = F.try_divide(F.col("end2_y") - F.col("end1_y"), F.col("extent"))
    valid = F.col("major") > 0
    major = F.when(valid, ex * F.col("axis_x") + ey * F.col("axis_y"))
    minor = F.when(valid, ey * F.col("axis_x") - ex * F.col("axis_y"))
    return major, minor


def extent_axis_cosine(power: int) -> Column:
    major, _ = _extent_cosines()
    clipped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.pow(major, power)))
    return F.when(major.isNotNull(), clipped)


def composite_cosines(power: int) -> dict[str, Column]:
    major, minor = _extent_cosines()
    defined = F.col("minor") > 0
    a = F.when(defined, F.pow(F.least(F.lit(1.0), F.abs(major)), power))
    b = F.when(defined, F.pow(F.least(F.lit(1.0), F.abs(minor)), power))
    return {
        "abs_diff": F.abs(a - b),
        "gaussian_sum": F.exp(-a) + F.exp(-b),
        "quadratic_diff_sum": F.pow(a - 0.5, 2) + F.pow(b - 0.5, 2),
    }


def adjusted(doms: DataFrame, q_cut: float | None = -1.0) -> DataFrame:
    """Positions with adjusted charge, keeping sensors above the cut."""
    rows = doms.withColumn("Qtotal", adjusted_charge(F.col("Qtotal")))
    return rows if q_cut is None else rows.where(F.col("Qtotal") > q_cut)


EVENT_STATISTICS = [
    f"{name}_{rule}"
    for name, rules in (
        ("raw_Qtotal", ("max", "mean", "median")), ("raw_t1", ("max", "min", "mean", "median")),
        ("adjusted_Qtotal", ("max", "mean", "median")), ("kept_t1", ("max", "min", "mean", "median")),
    )
    for rule in rules
]


def event_statistics(doms: DataFrame, q_cut: float = -1.0) -> DataFrame:
    """Per event: sensors, those whose adjusted charge is above the cut, and statistics of charge and first time, of all
    sensors as measured and of the kept ones adjusted.  One aggregation; an event has at most as many values as sensors."""
    adjusted_q = adjusted_charge(F.col("Qtotal"))
    kept = adjusted_q > q_cut
    cells = {
        "raw_Qtotal": F.col("Qtotal").cast("double"), "raw_t1": F.col("t1").cast("double"),
        "adjusted_Qtotal": F.when(kept, adjusted_q), "kept_t1": F.when(kept, F.col("t1").cast("double")),
    }
    rules = {"max": F.max, "min": F.min, "mean": F.avg, "median": lambda c: F.percentile(c, 0.5)}
    split = [name.rsplit("_", 1) for name in EVENT_STATISTICS]
    return doms.groupBy("event_no").agg(
        F.count(F.lit(1)).alias("n_doms"), F.count_if(kept).alias("n_kept"), *[rules[rule](cells[name]).alias(f"{name}_{rule}") for name, rule in split]
    )


def event_shapes(doms: DataFrame, q_cut: float | None, outline_of_cut: bool = False, clusters: bool = True) -> DataFrame:
    """Raw shape columns per event in one pass over the sensor rows.

    Sensors are folded into rows per (event, string, x, y) before the shuffle;
    one array kernel then sees all strings of an event.
    """
    cut = "true" if q_cut is None else f"{adjusted_charge_sql('Qtotal')} > {float(q_cut)}D"
    strings = doms.groupBy(
        "event_no", F.expr("coalesce(string, -1) AS string"), F.expr("double(dom_x) AS x"), F.expr("double(dom_y) AS y")
    ).agg(
        F.expr(f"count_if({cut}) AS n"),
        F.expr(f"coalesce(sum(CASE WHEN {cut} THEN {adjusted_charge_sql('Qtotal')} END), 0D) AS w"),
        F.expr(f"double(min(CASE WHEN {cut} THEN dom_z END)) AS z_low"),
        F.expr(f"double(max(CASE WHEN {cut} THEN dom_z END)) AS z_high"),
    )
    names = [*kernels.BOUNDARY, *kernels.STRETCH, *kernels.SPREAD, *(kernels.CLUSTERS if clusters else ())]
    kernel = partial(kernels.event_shape, outline_of_cut=outline_of_cut, clusters=clusters)
    return _nan_to_null(map_groups(strings, kernel, ", ".join(f"{n} double" for n in names)), names)


def shape_features(doms: DataFrame, q_cut: float | None = -1.0) -> DataFrame:
    """Seventeen features per event: outline from all sensors, the rest from those above the cut.

    Undefined values are null.
    """
    extent, stretch = F.col("extent"), F.col("stretch_max")
    return event_shapes(doms, q_cut).select(
        "event_no",
        extent.alias("extent_max"),
        "stretch_max",
        "stretch_mean",
        "stretch_hiqr",
        F.greatest(extent, stretch).alias("max_extent_stretch"),
        F.sqrt(extent * stretch).alias("product"),
        F.sqrt(extent * extent + stretch * stretch).alias("hypotenuse"),
        F.col("major").alias("major_PCA"),
        F.col("minor").alias("minor_PCA"),
        eccentricity(False).alias("eccentricity_PCA"),
        aspect_contrast(False).alias("aspect_contrast_PCA"),
        extent_axis_cosine(2).alias("cos_sq_extent_PCA_major"),
        "gmm_score",
        "kmeans_score",
        (F.col("area") / OUTLINE_AREA).alias("area_ratio"),
        "outer_mass_fraction",
        "normalised_weighted_distance",
    )


def compact_shape_features(doms: DataFrame, q_cut: float | None = -1.0, power: int = 6) -> DataFrame:
    """Nine features per event from sensors above the cut; null without three outline points."""
    rows = event_shapes(doms, q_cut, outline_of_cut=True, clusters=False)
    extent, stretch = F.col("extent"), F.col("stretch_max")
    values = {
        "hypotenuse": F.sqrt(extent * extent + stretch * stretch),
        "major_PCA": F.col("major"),
        "minor_PCA": F.col("minor"),
        "eccentricity_PCA": eccentricity(False),
        "aspect_contrast_PCA": aspect_contrast(False),
        "cos_power_extent_PCA_major": extent_axis_cosine(power),
        **composite_cosines(power),
    }
    enough = F.col("n_border") >= 3
    return rows.select("event_no", *[F.when(enough, v).alias(k) for k, v in values.items()])


def labelled_features(
    doms: DataFrame, events: DataFrame, geometry: DataFrame, compact: bool = False, q_cut: float | None = -1.0, label: str = "flavour"
) -> DataFrame:
    """Shape features of the listed events with their label, from sensor rows that carry no string.

    `events` has event_no and the label; strings are those of the nearest reference
    sensors, and sensors far from all of them count as having none.
    """
    from pulsegrid.operators.detector import assign_string

    rows = doms.join(events.select("event_no"), "event_no", "left_semi")
    rows = assign_string(rows, geometry)
    features = compact_shape_features(rows, q_cut) if compact else shape_features(rows, q_cut)
    return features.join(events.select("event_no", label), "event_no")


def second_round_features(features: DataFrame, q_cut: float = 0.0) -> DataFrame:
    """Shape of the sensors with a charge of at least 10^(cut + 2); -1 if undefined."""
    bright = features.where(F.col("Qtotal") >= F.lit(10.0 ** (q_cut + 2)))
    strings = bright.groupBy("event_no", "string").agg(
        F.min_by(F.struct(F.col("dom_x").alias("x"), F.col("dom_y").alias("y")), "dom_number").alias("_p"),
        (F.max("dom_z") - F.min("dom_z")).alias("stretch"),
    )
    outline = boundary(strings.select("event_no", "_p.*"))
    stretch = strings.groupBy("event_no").agg(F.max("stretch").alias("stretch_max"))
    rows = (
        features.select("event_no")
        .distinct()
        .join(outline, "event_no", "left")
        .join(stretch, "event_no", "left")
    )
    extent = F.when(F.col("n_points") >= 2, F.col("extent")).otherwise(NOT_ENOUGH_PULSES)
    tall = F.coalesce("stretch_max", F.lit(NOT_ENOUGH_PULSES))
    hypotenuse = (
        F.when((extent > 0) & (tall > 0), F.sqrt(extent * extent + tall * tall))
        .when(extent > 0, extent)
        .when(tall > 0, tall)
        .otherwise(NOT_ENOUGH_PULSES)
    )
    return rows.select(
        "event_no",
        eccentricity(True).alias("eccentricity_PCA"),
        aspect_contrast(True).alias("aspect_contrast_PCA"),
        hypotenuse.alias("hypotenuse"),
    )
