"""The registered queries: each is one operator applied to the driver's tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.functions import geometry as geo
from pulsegrid.functions import ids, scaling
from pulsegrid.operators import blend, crossings, detector, quality, select, shape, stats, summary
from pulsegrid.operators import truth as labels
from pulsegrid.plans import fixtures as fx
from pulsegrid.runtime import pin
from pulsegrid.schema import SIDE_TABLES, SummaryMode
from pulsegrid.sources import files, footers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _round(names: Iterable[str], digits: int = 6) -> list[str]:
    return [f"round(double({n}), {digits}) AS {n}" for n in names]


def _rounded(names: Iterable[str], digits: int = 6) -> list[Column]:
    return [F.expr(text) for text in _round(names, digits)]


_KEYS = ["event_no", "string", "dom_number"]
_PLACE = ["dom_x", "dom_y", "dom_z", "dom_x_rel", "dom_y_rel", "dom_z_rel"]
_STATUS = ["pmt_area", "rde", "saturation_status", "bad_dom_status", "bright_dom_status"]
_Q = [f"q{j}" for j in range(1, 6)] + ["Q25", "Q75", "Qtotal"]
_T = [f"t{j}" for j in range(1, 6)] + ["T10", "T50", "sigmaT"]
_SHAPE3 = ["eccentricity_PCA", "aspect_contrast_PCA", "hypotenuse"]
_HLC = [f"hlc{j}" for j in range(1, 6)]


def _summary_view(rows: DataFrame) -> DataFrame:
    return rows.selectExpr(*_KEYS, *_round(_PLACE), *_STATUS, *_HLC, *_round(_Q + _T))


# ---------------------------------------------------------------- sensor summary
@query
def dom_summary_classic(spark, sf_dir):
    return _summary_view(summary.dom_summary(fx.pulses(spark, sf_dir)))


@query
def dom_summary_hits(spark, sf_dir):
    order = ("dom_time", "order_key", "part_key", "price", "discount", "tax")
    return _summary_view(summary.dom_summary(fx.hits(spark, sf_dir, "l_suppkey"), order_by=order))


@query
def dom_summary_equinox(spark, sf_dir):
    rows = summary.dom_summary(fx.pulses(spark, sf_dir), SummaryMode.EQUINOX)
    late = ["t_qmax", "t_qmax_secondhalf", "Q_halftime", "T70", "T90"]
    return rows.selectExpr(*_KEYS, *_round(_Q + _T + late + _SHAPE3))


@query
def dom_summary_second(spark, sf_dir):
    rows = summary.dom_summary(fx.pulses(spark, sf_dir), SummaryMode.SECOND, q_cut=0.4)
    return rows.selectExpr(*_KEYS, *_round(["Qtotal", *_SHAPE3]))


@query
def late_peak_corrected(spark, sf_dir):
    rows = summary.sensor_features(fx.pulses(spark, sf_dir), late=True, compat=False)
    return rows.selectExpr(*_KEYS, *_round(["t_qmax", "t_qmax_secondhalf"]))


@query
def dom_summary_legacy(spark, sf_dir):
    rows = summary.legacy_summary(fx.pulses(spark, sf_dir))
    plain = ["q1", "q2", "q3", "Q25", "Q75", "Qtotal", "t1", "t2", "t3", "T10", "T50", "sigmaT"]
    return rows.selectExpr(*_KEYS, "hlc1", "hlc2", "hlc3", *_round([*plain, "dom_x_rel", "dom_y_rel", "dom_z_rel"]))


@query
def summary_list_variant(spark, sf_dir):
    """The older variant, in which a charge fraction that is never exceeded takes no time; sensors of one string are dark."""
    dark = fx.pulses(spark, sf_dir).withColumn("charge", F.expr("IF(string = 3, CAST(0 AS DECIMAL(12, 2)), charge)"))
    return summary.sensor_features(dark, unreached=0.0).selectExpr(*_KEYS, *_round(["Qtotal", "T10", "T50"]))


@query
def busy_sensor_summary(spark, sf_dir):
    rows = stats.busy_sensor_summary(fx.pulses(spark, sf_dir), 6)
    return rows.selectExpr(*_KEYS, "n_pulses", *_round([c for c in rows.columns if c not in (*_KEYS, "n_pulses")]))


@query
def hist_pulses_per_dom_of_event(spark, sf_dir):
    """One event, sensors above a number of pulses."""
    return _bins(stats.histogram(stats.sensor_pulse_counts(fx.pulses(spark, sf_dir), 42, 2), "n_pulses", width=1))


@query
def hist_busy_pulses_per_dom(spark, sf_dir):
    return _bins(stats.histogram(stats.sensor_pulse_counts(fx.pulses(spark, sf_dir), more_than=4), "n_pulses", width=5))


@query
def event_number_receipt(spark, sf_dir):
    """Old and new number of every event, with the file it came from."""
    rows = labels.with_enhanced_id(fx.truth(spark, sf_dir), "22012", ids.SIGNAL)
    return labels.number_receipt(rows, F.concat(F.lit("merged_part_"), F.col("part_no").cast("string"), F.lit(".db")))


@query
def charge_and_time_statistics(spark, sf_dir):
    """Per event: charges and first times of all sensors, and the adjusted ones of those above the cut."""
    rows = _sensors(spark, sf_dir).select("event_no", "Qtotal", "t1")
    return shape.event_statistics(rows, q_cut=-0.5).selectExpr("event_no", "n_doms", "n_kept", *_round(shape.EVENT_STATISTICS, 5))


@query
def first_hlc_times(spark, sf_dir):
    return summary.first_hlc_times(fx.pulses(spark, sf_dir)).selectExpr(*_KEYS, *_round(["t1", "t2", "t3"]))


@query
def event_charge_centroid(spark, sf_dir):
    rows = summary.charge_centroid(fx.pulses(spark, sf_dir))
    return rows.selectExpr("event_no", *_round(["mean_x", "mean_y", "mean_z"]))


# ------------------------------------------------------------- shards, identities
@query
def event_n_doms_offset(spark, sf_dir):
    rows = fx.placed(spark, sf_dir)
    rows = labels.shard_offsets(rows.withColumnRenamed("offset", "offset_end"), exclusive=True)
    return rows.select("event_no", "part_no", "shard_no", "N_doms", "offset_end", F.col("offset").alias("offset_start"))


@query
def running_dom_count(spark, sf_dir):
    return labels.running_dom_count(fx.placed(spark, sf_dir)).select("event_no", "N_doms", "doms_so_far")


@query
def enhanced_event_no(spark, sf_dir):
    rows = fx.truth(spark, sf_dir)
    signal = labels.with_enhanced_id(rows, "22012", ids.SIGNAL)
    noise = labels.with_enhanced_id(rows, "0002000-0002999", ids.NOISE)
    both = signal.select("event_no", "original_event_no").unionByName(noise.select("event_no", "original_event_no"))
    return both


@query
def decoded_event_no(spark, sf_dir):
    rows = fx.truth(spark, sf_dir).withColumn("name", (F.col("event_no") % 9 + 22010).cast("string"))
    tag = ids.dataset_tag(F.col("name"), ids.SIGNAL)
    number = ids.enhanced_event_no(1, tag, F.col("part_no"), F.col("event_no"))
    decoded = rows.select(number.alias("event_no"), *[c.alias(k) for k, c in ids.decoded_event_no(number).items()])
    return decoded.withColumns(
        {
            "energy_range": ids.energy_range(F.col("subdir")),
            "flavour": ids.flavour(F.col("subdir")),
            "pdg": ids.particle_code(ids.flavour(F.col("subdir"))),
            "dataset": ids.dataset_of(ids.energy_range(F.col("subdir")), ids.flavour(F.col("subdir"))),
        }
    )


@query
def shifted_event_no(spark, sf_dir):
    rows = fx.truth(spark, sf_dir)
    return rows.select("event_no", ids.shifted_event_no(F.col("part_no"), F.col("event_no")).alias("shifted"))


# --------------------------------------------------------------------- truth table
@query
def truth_assembled(spark, sf_dir):
    rows = labels.attach_side(fx.truth(spark, sf_dir), fx.daughter(spark, sf_dir), SIDE_TABLES["daughter"])
    rows = labels.attach_side(rows, None, {"GNLabelEnergyPrimary": SIDE_TABLES["labels"]["GNLabelEnergyPrimary"]})
    names = [f"{n}_GNHighestEDaughter" for n in ("pos_x", "pos_y", "pos_z", "dir_x", "dir_y", "dir_z", "energy", "zenith")]
    return rows.selectExpr("event_no", "part_no", "RunID", *_round([*names, "GNLabelEnergyPrimary"], 2))


@query
def truth_complete(spark, sf_dir):
    """All 130 columns with all four side tables; columns without a source of their own enter through sums and counts."""
    hits, base = fx.hits(spark, sf_dir), fx.truth(spark, sf_dir)
    sides = {
        "labels": base.where("event_no % 3 <> 0").selectExpr(
            "event_no", "event_no % 2 AS GNLabelHighestEInIceParticleIsChild",
            "IF(event_no % 7 = 0, double('NaN'), double(energy)) AS GNLabelEnergyPrimary",
        ),
        "inice": base.where("event_no % 5 <> 0").selectExpr(
            "event_no", "double(event_no % 100) AS pos_x_GNHighestEInIceParticle", "double(energy) AS energy_GNHighestEInIceParticle"
        ),
        "daughter": fx.daughter(spark, sf_dir),
        "weights": base.where("event_no % 11 <> 0").select("event_no", "InteractionType"),
    }
    full = labels.build_truth(base.drop("InteractionType"), hits, fx.doms(spark, sf_dir), sides, 22012, ids.SIGNAL, 500)
    sums = [
        F.round(sum((F.col(f"`{c}`").cast("double") for c in columns), F.lit(0.0)), 1).alias(f"sum_{side}")
        for side, columns in SIDE_TABLES.items()
    ]
    present = sum((F.col(f"`{c}`").isNotNull().cast("int") for c in full.columns), F.lit(0)).alias("n_filled")
    return full.select(
        "event_no", "original_event_no", "subdirectory_no", "part_no", "shard_no", "N_doms", "offset",
        "InteractionType", "isWithinIceCube", *_rounded(["max_interPMT_distance", "post_vertex_intraIceCube_segment"], 2),
        *sums, present, F.lit(len(full.columns)).alias("n_columns"),
    )


@query
def truth_max_interpmt_distance(spark, sf_dir):
    return shape.max_pair_distance(fx.doms(spark, sf_dir)).selectExpr("event_no", *_round(["max_interPMT_distance"]))


@query
def truth_is_within(spark, sf_dir):
    return fx.labelled(spark, sf_dir).select("event_no", "isWithinIceCube")


def _daughter_vectors():
    return [tuple(F.col(f"{kind}_{axis}_GNHighestEDaughter").cast("double") for axis in "xyz") for kind in ("pos", "dir")]


@query
def truth_prism_segment(spark, sf_dir):
    pos, direction = (tuple(f"{k}_{axis}_GNHighestEDaughter" for axis in "xyz") for k in ("pos", "dir"))
    span = geo.line_span(pos, direction)
    rows = fx.daughter(spark, sf_dir).select(
        "event_no",
        F.expr(geo.bound("s", span, "s.t_in")).alias("t_in"),
        F.expr(geo.bound("s", span, "s.t_out")).alias("t_out"),
        geo.vertex_place(span).alias("vertex_place"),
        geo.segment_after_vertex(span, direction).alias("segment"),
    )
    return rows.selectExpr("event_no", "vertex_place", *_round(["t_in", "t_out", "segment"], 5))


@query
def prism_crossings(spark, sf_dir):
    pos, direction = (tuple(f"{k}_{axis}_GNHighestEDaughter" for axis in "xyz") for k in ("pos", "dir"))
    points = geo.crossing_points(geo.line_span(pos, direction), pos, direction)
    rows = fx.daughter(spark, sf_dir).select("event_no", *[c.alias(n) for n, c in points.items()])
    return rows.selectExpr("event_no", "n_intersections", *_round([n for n in points if n != "n_intersections"], 4))


def _lines(spark, sf_dir):
    """Vertices and directions; every 17th event stands on a corner of the prism and looks along no face, so its line only touches."""
    suffix = "_GNHighestEDaughter"
    rows = fx.daughter(spark, sf_dir)
    (ax, ay), (bx, by), (cx, cy) = (geo.PRISM_XY[i] for i in (5, 0, 1))
    touching = {"pos_x": f"{bx}D", "pos_y": f"{by}D", "pos_z": "double(event_no % 400)", "dir_x": f"{cx - ax!r}D", "dir_y": f"{cy - ay!r}D", "dir_z": "0D"}
    return rows.selectExpr("event_no", *[f"IF(event_no % 17 = 0, {value}, {name}{suffix}) AS {name}" for name, value in touching.items()])


@query
def prism_face_crossings(spark, sf_dir):
    """One row per crossed face, with the case of its line."""
    axes = [tuple(f"{kind}_{a}" for a in "xyz") for kind in ("pos", "dir")]
    rows = crossings.prism_face_crossings(_lines(spark, sf_dir), *axes)
    return rows.selectExpr("event_no", "place", "face", *_round(["t", "x", "y", "z"], 4), "n_crossings", "crossing_case", "behind_vertex")


@query
def crossing_case_counts(spark, sf_dir):
    axes = [tuple(f"{kind}_{a}" for a in "xyz") for kind in ("pos", "dir")]
    rows = crossings.prism_face_crossings(_lines(spark, sf_dir), *axes)
    return rows.where("place IS NULL OR place = 1").groupBy("crossing_case").agg(F.count(F.lit(1)).alias("n_events"))


@query
def opening_angle(spark, sf_dir):
    pos, direction = _daughter_vectors()
    norm = F.sqrt(sum((c * c for c in direction), F.lit(0.0)))
    first = tuple(F.try_divide(c, norm) for c in direction)
    zenith, azimuth = F.col("zenith"), F.col("azimuth")
    second = (F.sin(zenith) * F.cos(azimuth), F.sin(zenith) * F.sin(azimuth), F.cos(zenith))
    rows = fx.truth(spark, sf_dir).join(fx.daughter(spark, sf_dir), "event_no")
    # An event without direction has no angle.
    return rows.select("event_no", F.when(norm > 0, F.round(geo.opening_angle(first, second), 4)).alias("angle"))


@query
def interior_vertices(spark, sf_dir):
    x, y, z = _daughter_vectors()[0]
    rows = fx.daughter(spark, sf_dir)
    return rows.select(
        "event_no",
        F.round(geo.horizontal_radius(x, y), 6).alias("radius"),
        geo.interior_flag(x, y, z, 400.0, 300.0).cast("int").alias("interior"),
        F.round(F.cos(F.col("event_no") % 4), 6).alias("cos_zenith"),
    )


@query
def coordinate_fractions(spark, sf_dir):
    axes = {a: F.avg((F.abs(c) < 400).cast("double")) for a, c in zip("xyz", _daughter_vectors()[0])}
    return fx.daughter(spark, sf_dir).agg(*[F.round(c, 6).alias(f"within_{a}") for a, c in axes.items()])


# ----------------------------------------------------------------------- selection
def _filter_query(name: str, make: Callable) -> None:
    def run(spark, sf_dir):
        return make(spark, sf_dir).apply(fx.labelled(spark, sf_dir)).select("event_no", "RunID", "part_no")

    run.__name__ = name
    QUERIES[name] = run


_filter_query("filter_cc", lambda spark, sf_dir: select.ChargedCurrent())
_filter_query("filter_muon", lambda spark, sf_dir: select.MuonLike())
_filter_query("filter_contained", lambda spark, sf_dir: select.Contained())
_filter_query("filter_travel", lambda spark, sf_dir: select.TravelDistance(300))
_filter_query("filter_clean_ids", lambda spark, sf_dir: select.Clean(fx.clean_ids(spark, sf_dir)))


def _selection(spark, sf_dir):
    return select.Selection(
        {
            "CRclean": select.Clean(fx.clean_ids(spark, sf_dir)),
            "CC": select.ChargedCurrent(),
            "IntraTravelDistance": select.TravelDistance(300),
        }
    )


def _labelled_and_placed(spark, sf_dir):
    place = fx.placed(spark, sf_dir).select("event_no", "shard_no", "N_doms", "offset")
    return fx.labelled(spark, sf_dir).join(place, "event_no", "inner")


@query
def filter_composite(spark, sf_dir):
    chosen = _selection(spark, sf_dir).keep(fx.labelled(spark, sf_dir))
    return chosen.select("event_no", "part_no")


@query
def filter_composite_doms(spark, sf_dir):
    rows = _selection(spark, sf_dir).doms(fx.labelled(spark, sf_dir), fx.doms(spark, sf_dir))
    return rows.select(*_KEYS, "Qtotal")


@query
def offset_recomputed(spark, sf_dir):
    rows = _selection(spark, sf_dir).truth(_labelled_and_placed(spark, sf_dir))
    return rows.select("event_no", "part_no", "shard_no", "N_doms", "offset")


@query
def filter_receipt(spark, sf_dir):
    return _selection(spark, sf_dir).receipt(fx.labelled(spark, sf_dir))


@query
def busy_events(spark, sf_dir):
    return select.busy_events(fx.placed(spark, sf_dir), 6).select("event_no", "N_doms")


# ----------------------------------------------------------------------- blending
def _blended(spark, sf_dir):
    rows = pin(fx.placed(spark, sf_dir))
    low, high = rows.where(F.col("flavour") == "nu_mu"), rows.where(F.col("flavour") == "nu_e")
    return blend.blend_truth(low, high, 22031, events_per_part=3000, events_per_shard=300)


@query
def blend_truth_interleaved(spark, sf_dir):
    return _blended(spark, sf_dir).select(
        "event_no", "position", "subdirectory_no", "source_part_no", "part_no", "shard_no", "N_doms", "offset"
    )


@query
def blend_shards(spark, sf_dir):
    rows = blend.blend_doms(_blended(spark, sf_dir), fx.doms(spark, sf_dir))
    return rows.select(*_KEYS, "part_no", "shard_no", "position", "Qtotal")


@query
def blend_receipt(spark, sf_dir):
    rows = fx.truth(spark, sf_dir)
    low, high = rows.where(F.col("flavour") == "nu_mu"), rows.where(F.col("flavour") == "nu_e")
    return blend.blend_receipt(low, high, 22031)


@query
def blend_incomplete(spark, sf_dir):
    """Blended events compared with unreduced hits: those with several hits on a sensor differ."""
    return blend.missing_doms(_blended(spark, sf_dir), fx.hits(spark, sf_dir))


@query
def slice_lookup(spark, sf_dir):
    """Sensor rows found by place in their shard, and the owner that place belongs to."""
    placed = fx.placed(spark, sf_dir)
    spec = Window.partitionBy("part_no", "shard_no").orderBy(*_KEYS)  # one shard
    rows = fx.doms(spark, sf_dir).join(placed.select("event_no", "part_no", "shard_no"), "event_no")
    rows = rows.withColumn("row_in_shard", F.row_number().over(spec) - 1)
    found = labels.doms_by_slice(rows, placed)
    return found.select(*_KEYS, "owner", "row_in_shard")


@query
def class_balanced(spark, sf_dir):
    return blend.balance_classes(fx.truth(spark, sf_dir).select("event_no", "flavour"))


@query
def events_in_chunks(spark, sf_dir):
    rows = fx.truth(spark, sf_dir).select("event_no", "RunID")
    return stats.numbered_bins(rows, ["RunID", "event_no"], 1000)


# -------------------------------------------------------------------- detector
@query
def string_assign_box(spark, sf_dir):
    rows = detector.assign_sensor(fx.displaced(spark, sf_dir), fx.geometry(spark, sf_dir))
    return rows.select("l_orderkey", "l_linenumber", "dom_x", "dom_z", "string", "dom_number")


@query
def string_assign_nearest(spark, sf_dir):
    rows = detector.assign_string(fx.displaced(spark, sf_dir), fx.geometry(spark, sf_dir))
    return rows.select("l_orderkey", "l_linenumber", "dom_x", "dom_y", "string")


@query
def unique_sensors(spark, sf_dir):
    return detector.unique_sensors(fx.pulses(spark, sf_dir))


@query
def missing_doms(spark, sf_dir):
    return detector.missing_sensors(fx.geometry(spark, sf_dir))


@query
def geometry_diff(spark, sf_dir):
    seen = fx.geometry(spark, sf_dir).select("string", "dom_number")
    other = fx.table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 86 + 1).cast("int").alias("string"), (F.col("l_partkey") % 60 + 1).cast("int").alias("dom_number")
    ).distinct()
    return detector.table_differences(seen, other)


@query
def geometry_filled(spark, sf_dir):
    rows = detector.completed_geometry(fx.geometry(spark, sf_dir))
    return rows.selectExpr("string", "dom_number", "dom_x", "dom_y", *_round(["dom_z"], 2))


def _grid_pulses(spark, sf_dir):
    return fx.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("int").alias("event_no"),
        (F.col("user_id") % 90 + 1).cast("int").alias("string"),
        (F.col("event_id") % 60 + 1).cast("int").alias("dom_number"),
    )


@query
def dom_activation_grid(spark, sf_dir):
    return detector.activation_grid(_grid_pulses(spark, sf_dir))


@query
def event_activation(spark, sf_dir):
    return detector.event_activation(_grid_pulses(spark, sf_dir))


@query
def sensor_counts(spark, sf_dir):
    rows = detector.sensor_counts(fx.pulses(spark, sf_dir))
    return rows.selectExpr("string", "dom_number", "n_pulses", "dom_x", "dom_y", "dom_z", *_round(["share"]))


# ----------------------------------------------------------------------- shapes
@query
def z_stretch(spark, sf_dir):
    rows = shape.z_stretch(fx.doms(spark, sf_dir))
    return rows.selectExpr("event_no", "stretch_string", *_round(["stretch_mean", "stretch_max", "stretch_hiqr", "stretch_z_low", "stretch_z_high"]))


@query
def string_nearest_mean(spark, sf_dir):
    return shape.string_nearest_mean(fx.doms(spark, sf_dir)).select("event_no", "string", "stretch")


_OUTLINE = ["extent", "major", "minor", "area"]


@query
def xy_extent(spark, sf_dir):
    points = fx.doms(spark, sf_dir).select("event_no", F.col("dom_x").alias("x"), F.col("dom_y").alias("y"))
    rows = shape.boundary(points)
    return rows.selectExpr("event_no", "n_points", *_round(["extent", "end1_x", "end1_y", "end2_x", "end2_y"]))


@query
def pca_axes(spark, sf_dir):
    points = fx.doms(spark, sf_dir).select("event_no", F.col("dom_x").alias("x"), F.col("dom_y").alias("y"))
    return shape.boundary(points).selectExpr("event_no", "n_points", "n_border", *_round(_OUTLINE))


@query
def string_table(spark, sf_dir):
    return shape.string_table(shape.adjusted(fx.doms(spark, sf_dir), None)).selectExpr("event_no", "string", *_round(["x", "y", "w"]))


@query
def charge_spread(spark, sf_dir):
    rows = shape.charge_spread(_string_charges(spark, sf_dir))
    return rows.selectExpr("event_no", *_round(["outer_mass_fraction", "normalised_weighted_distance"]))


def _string_charges(spark, sf_dir):
    return shape.string_table(fx.doms(spark, sf_dir))


@query
def repeated_points(spark, sf_dir):
    rows = shape.repeated_points(_string_charges(spark, sf_dir))
    return rows.select("event_no", "string", "x", "y")


_SHAPE17 = [
    "extent_max", "stretch_max", "stretch_mean", "stretch_hiqr", "max_extent_stretch", "product", "hypotenuse",
    "major_PCA", "minor_PCA", "eccentricity_PCA", "aspect_contrast_PCA", "cos_sq_extent_PCA_major",
    "area_ratio", "outer_mass_fraction", "normalised_weighted_distance",
]


@query
def shape_features(spark, sf_dir):
    rows = shape.shape_features(fx.doms(spark, sf_dir), q_cut=-1.0)
    return rows.selectExpr("event_no", *_round([*_SHAPE17, "gmm_score", "kmeans_score"], 5))


@query
def shape_features_geometry(spark, sf_dir):
    """The features above that have one right answer, for the oracle."""
    rows = shape.shape_features(fx.doms(spark, sf_dir), q_cut=-1.0)
    steady = [c for c in _SHAPE17 if c not in ("outer_mass_fraction", "normalised_weighted_distance")]
    return rows.selectExpr("event_no", *_round(steady, 5))


@query
def shape_features_compact(spark, sf_dir):
    rows = shape.compact_shape_features(fx.doms(spark, sf_dir), q_cut=-1.0)
    return rows.selectExpr("event_no", *_round([c for c in rows.columns if c != "event_no"], 5))


def _by_flavour(spark, sf_dir):
    """Features of sensor rows without strings, which come from reference positions again."""
    doms = fx.doms(spark, sf_dir)
    geometry = doms.select("string", "dom_number", "dom_x", "dom_y", "dom_z").distinct()
    rows = shape.labelled_features(doms.drop("string"), fx.truth(spark, sf_dir), geometry)
    steady = [c for c in _SHAPE17 if c not in ("outer_mass_fraction", "normalised_weighted_distance")]
    return rows.selectExpr("event_no", "flavour", *_round(steady, 5))


@query
def features_by_flavour(spark, sf_dir):
    """Statistics of shape features per class, from sensor rows that carry no string."""
    rows = _by_flavour(spark, sf_dir)
    names = ["extent_max", "stretch_max", "hypotenuse", "major_PCA", "area_ratio"]
    out = stats.describe_columns(rows, names, ["flavour"])
    return out.selectExpr("flavour", "feature", "n", "n_missing", *_round(["max", "min", "mean", "median", "std"], 3))


@query
def feature_histograms_by_flavour(spark, sf_dir):
    return _bins(stats.histogram(_by_flavour(spark, sf_dir), "hypotenuse", width=50, by=["flavour"]))


SHAPE_GRIDS = {c: stats.Bins(bins=50) for c in _SHAPE17 if c not in ("outer_mass_fraction", "normalised_weighted_distance")}


@query
def shape_histograms_by_flavour(spark, sf_dir):
    """Every shape feature with one right answer, per class, in one pass."""
    return _bins(stats.histograms(pin(_by_flavour(spark, sf_dir)), SHAPE_GRIDS, ["flavour"]))


@query
def cluster_scores(spark, sf_dir):
    return shape.cluster_scores(_string_charges(spark, sf_dir))


# ----------------------------------------------------------------------- scaling
def _plain_summary(spark, sf_dir):
    rows = summary.dom_summary(fx.pulses(spark, sf_dir))
    return rows.select(*_KEYS, *_PLACE, "q1", "q2", "q3", "Q25", "Q75", "Qtotal", "t1", "t2", "t3", "T10", "T50", "sigmaT")


def _all_but_keys(rows: DataFrame) -> DataFrame:
    """Keys and rounded values; what rounds to zero keeps its sign."""
    names = [c for c in rows.columns if c not in _KEYS]
    return rows.selectExpr(*_KEYS, *[f"IF({n} < 0 AND round(double({n}), 6) = 0, -0.0D, round(double({n}), 6)) AS {n}" for n in names])


@query
def pseudo_normalised(spark, sf_dir):
    return _all_but_keys(scaling.pseudo_normalised(_plain_summary(spark, sf_dir)))


@query
def lazy_normalised(spark, sf_dir):
    return _all_but_keys(scaling.lazily_normalised(_plain_summary(spark, sf_dir)))


@query
def former_normalised(spark, sf_dir):
    return _all_but_keys(scaling.formerly_normalised(_plain_summary(spark, sf_dir)))


@query
def adjusted_charge_cut(spark, sf_dir):
    rows = shape.adjusted(fx.doms(spark, sf_dir), -0.5)
    return rows.selectExpr(*_KEYS, "dom_x", "dom_y", "dom_z", *_round(["Qtotal"]))


# ------------------------------------------------------------------- statistics
def _bins(rows: DataFrame) -> DataFrame:
    return rows.withColumn("left_edge", F.round("left_edge", 4))


@query
def hist_doms_per_event(spark, sf_dir):
    return _bins(stats.histogram(labels.count_doms(fx.hits(spark, sf_dir)), "N_doms", width=2))


@query
def hist_pulses_per_event(spark, sf_dir):
    counts = fx.pulses(spark, sf_dir).groupBy("event_no").count()
    return _bins(stats.histogram(counts, "count", width=10))


@query
def hist_pulses_per_dom(spark, sf_dir):
    counts = fx.hits(spark, sf_dir, "l_suppkey").groupBy(*_KEYS).count()
    return _bins(stats.histogram(counts, "count", width=3))


@query
def hist_pulses_per_dom_by_direction(spark, sf_dir):
    counts = fx.hits(spark, sf_dir).groupBy(*_KEYS).count()
    upward = F.when(F.col("zenith") < 1.5707963267948966, "down").otherwise("up")
    rows = counts.join(fx.truth(spark, sf_dir).select("event_no", upward.alias("direction")), "event_no")
    return _bins(stats.histogram(rows, "count", width=1, by=["direction"]))


@query
def hist_pulses_per_dom_by_interaction(spark, sf_dir):
    counts = fx.hits(spark, sf_dir).groupBy(*_KEYS).count()
    kind = F.when(F.col("InteractionType") == 1, "CC").when(F.col("InteractionType") == 2, "NC").otherwise("other")
    rows = counts.join(fx.truth(spark, sf_dir).select("event_no", kind.alias("interaction")), "event_no")
    return _bins(stats.histogram(rows, "count", width=1, by=["interaction"]))


@query
def hist_charge_log(spark, sf_dir):
    return _bins(stats.histogram(fx.pulses(spark, sf_dir), "charge", bins=49, log=True))


@query
def hist_charge_per_dom(spark, sf_dir):
    total = fx.pulses(spark, sf_dir).groupBy("string", "dom_number").agg(F.sum("charge").alias("charge"))
    return _bins(stats.histogram(total, "charge", bins=49, log=True))


@query
def hist_charge_per_event(spark, sf_dir):
    total = fx.pulses(spark, sf_dir).groupBy("event_no").agg(F.sum("charge").alias("charge"))
    return _bins(stats.histogram(total, "charge", bins=49, log=True))


@query
def hist_position_z(spark, sf_dir):
    return _bins(stats.histogram(fx.doms(spark, sf_dir), "dom_z", width=50))


@query
def hist_position_x(spark, sf_dir):
    return _bins(stats.histogram(fx.doms(spark, sf_dir), "dom_x", width=50))


@query
def hist_position_y(spark, sf_dir):
    return _bins(stats.histogram(fx.doms(spark, sf_dir), "dom_y", width=50))


def _sensors(spark, sf_dir):
    return summary.sensor_features(fx.pulses(spark, sf_dir))


@query
def hist_first_charge(spark, sf_dir):
    return _bins(stats.histogram(_sensors(spark, sf_dir), "q1", bins=49))


@query
def hist_first_time(spark, sf_dir):
    return _bins(stats.histogram(_sensors(spark, sf_dir), "t1", width=12))


@query
def hist_total_charge_log(spark, sf_dir):
    return _bins(stats.histogram(_sensors(spark, sf_dir), "Qtotal", bins=49, log=True))


@query
def hist_total_charge_adjusted(spark, sf_dir):
    rows = _sensors(spark, sf_dir).select(scaling.adjusted_charge(F.col("Qtotal")).alias("q"))
    return _bins(stats.histogram(rows, "q", bins=49))


@query
def hist_early_charge(spark, sf_dir):
    return _bins(stats.histogram(_sensors(spark, sf_dir), "Q25", width=20))


@query
def hist_time_spread(spark, sf_dir):
    return _bins(stats.histogram(_sensors(spark, sf_dir), "sigmaT", width=10))


# Widths of the bins of measured and of normalised features.
MEASURED_WIDTHS = {"xy": 50, "z": 50, "q": 5, "Q": 100, "t": 100, "T": 100}
NORMALISED_WIDTH = 0.1
# End of fixed values.
MEASURED_GRIDS = {
    **{c: stats.Bins(MEASURED_WIDTHS["z" if "_z" in c else "xy"]) for c in _PLACE},
    **{c: stats.Bins(MEASURED_WIDTHS[c[0]]) for c in _Q + _T[:-1]},
    "sigmaT": stats.Bins(MEASURED_WIDTHS["T"]),
}
NORMALISED_GRIDS = {c: stats.Bins(NORMALISED_WIDTH) for c in MEASURED_GRIDS if c not in ("q4", "q5", "t4", "t5")}


@query
def all_feature_histograms(spark, sf_dir):
    """Positions, charges and times of the sensor summary: 22 histograms in two reads."""
    rows = _summary_view(summary.dom_summary(fx.pulses(spark, sf_dir))).select(*MEASURED_GRIDS)
    return _bins(stats.histograms(pin(rows), MEASURED_GRIDS))


@query
def all_normalised_histograms(spark, sf_dir):
    rows = _all_but_keys(scaling.pseudo_normalised(_plain_summary(spark, sf_dir)))
    return _bins(stats.histograms(pin(rows), NORMALISED_GRIDS))


@query
def hist_zenith(spark, sf_dir):
    return _bins(stats.histogram(fx.truth(spark, sf_dir), "zenith", bins=50))


@query
def hist_azimuth(spark, sf_dir):
    return _bins(stats.histogram(fx.truth(spark, sf_dir), "azimuth", bins=50))


@query
def charge_raw_and_adjusted(spark, sf_dir):
    """Per event: its charges as measured and as adjusted, and how many sensors the cut would keep."""
    rows = fx.doms(spark, sf_dir).withColumn("adjusted", scaling.adjusted_charge(F.col("Qtotal")))
    return rows.groupBy("event_no").agg(
        F.count(F.lit(1)).alias("n_doms"), F.round(F.sum("Qtotal"), 4).alias("raw_sum"), F.round(F.max("Qtotal"), 4).alias("raw_max"),
        F.round(F.avg("adjusted"), 6).alias("adjusted_mean"), F.round(F.max("adjusted"), 6).alias("adjusted_max"),
        F.count_if(F.col("adjusted") > -1).alias("n_above_cut"),
    )


@query
def hist_energy_log(spark, sf_dir):
    return _bins(stats.histogram(fx.truth(spark, sf_dir), "energy", bins=49, log=True))


@query
def hist_cos_zenith(spark, sf_dir):
    rows = fx.truth(spark, sf_dir).select(F.cos("zenith").alias("cos_zenith"))
    return _bins(stats.histogram(rows, "cos_zenith", bins=50))


@query
def feature_stats_by_class(spark, sf_dir):
    rows = fx.truth(spark, sf_dir).join(shape.z_stretch(fx.doms(spark, sf_dir)), "event_no", "left")
    out = stats.describe_columns(rows, ["stretch_mean", "stretch_max", "energy"], ["flavour"])
    return out.selectExpr("flavour", "feature", "n", "n_missing", *_round(["max", "min", "mean", "median", "std"], 3))


@query
def summary_feature_stats(spark, sf_dir):
    rows = summary.sensor_features(fx.pulses(spark, sf_dir))
    out = stats.describe_columns(rows, ["q1", "Qtotal", "t1", "T50", "sigmaT"], sample_std=True)
    return out.selectExpr("feature", "n", "n_missing", *_round(["max", "min", "mean", "median", "std"], 4))


@query
def energy_five_numbers(spark, sf_dir):
    out = stats.five_numbers(fx.truth(spark, sf_dir), "energy")
    return out.selectExpr("count", *_round(["mean", "std", "min", "p25", "p50", "p75", "max"], 3))


@query
def energy_stats_by_part(spark, sf_dir):
    out = stats.describe_columns(fx.placed(spark, sf_dir), ["energy", "N_doms"], ["part_no"])
    return out.selectExpr("part_no", "feature", "n", *_round(["max", "min", "mean", "median"], 3))


@query
def energy_powerlaw_fit(spark, sf_dir):
    out = stats.power_law_fit(fx.truth(spark, sf_dir), "energy")
    return out.select(*_rounded(["slope", "intercept", "chi2"], 5), F.col("dof").cast("long").alias("dof"))


@query
def energy_powerlaw_p_value(spark, sf_dir):
    out = stats.with_p_value(stats.power_law_fit(fx.truth(spark, sf_dir), "energy"))
    return out.select(*_rounded(["slope", "intercept", "chi2"], 5), F.col("dof").cast("long").alias("dof"), *_rounded(["p_value"], 8))


@query
def doms_below_limits(spark, sf_dir):
    out = stats.class_fractions(labels.count_doms(fx.hits(spark, sf_dir)), "N_doms", [3, 5])
    return out.selectExpr(*_round(out.columns))


@query
def largest_event(spark, sf_dir):
    return stats.largest_events(fx.pulses(spark, sf_dir))


@query
def busiest_events(spark, sf_dir):
    return stats.largest_events(fx.pulses(spark, sf_dir), 10)


@query
def run_value_counts(spark, sf_dir):
    return stats.value_counts(fx.truth(spark, sf_dir), "RunID")


@query
def row_and_event_counts(spark, sf_dir):
    return fx.pulses(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("event_no").alias("n_events")
    )


@query
def nth_event(spark, sf_dir):
    rows = stats.nth_event(fx.pulses(spark, sf_dir), 42)
    return rows.select("event_no", "pulse_id", "charge").withColumn("charge", F.col("charge").cast("double"))


@query
def first_rows(spark, sf_dir):
    """The first rows of the pulse table in stored order."""
    return fx.pulses(spark, sf_dir).orderBy("pulse_id").limit(1000).select("pulse_id", *_KEYS, F.col("charge").cast("double").alias("charge"), "hlc")


@query
def first_events(spark, sf_dir):
    rows = stats.first_events(fx.pulses(spark, sf_dir), 20)
    return rows.select("event_no", "pulse_id", "string", "dom_number")


@query
def busy_sensor_series(spark, sf_dir):
    rows = stats.busy_sensor_series(fx.pulses(spark, sf_dir), 7)
    return rows.selectExpr(*_KEYS, "n_pulses", "pulse_id", *_round(["dom_time", "charge"]))


@query
def busy_sensors_per_event(spark, sf_dir):
    return stats.busy_sensors_per_event(fx.pulses(spark, sf_dir), 6)


@query
def shard_allow_list(spark, sf_dir):
    placed = fx.placed(spark, sf_dir).select("event_no", "shard_no", "N_doms")
    rows = fx.doms(spark, sf_dir).join(placed.select("event_no", "shard_no"), "event_no")
    return labels.only_listed(rows, placed.where("N_doms >= 5"), ["shard_no", "event_no"]).select(*_KEYS, "shard_no")


@query
def marker_scale(spark, sf_dir):
    rows = stats.marker_scale(fx.doms(spark, sf_dir), "Qtotal")
    return rows.select(*_KEYS, *_rounded(["marker"]), F.col("bright").cast("int").alias("bright"))


# ---------------------------------------------------------------------- quality
@query
def nan_audit(spark, sf_dir):
    rows = fx.daughter(spark, sf_dir).withColumn("part_no", F.col("event_no") % 3 + 1).select(
        "part_no", F.col("pos_x_GNHighestEDaughter").alias("pos_x"), F.col("energy_GNHighestEDaughter").alias("energy")
    )
    return quality.undefined_counts(rows, ["part_no"]).withColumn("is_clean", F.col("is_clean").cast("int"))


@query
def event_range_overlap(spark, sf_dir):
    rows = fx.truth(spark, sf_dir).select("event_no", (F.col("RunID") % 50).alias("file_name"))
    return quality.range_overlaps(quality.event_ranges(rows))


@query
def event_range_conflicts(spark, sf_dir):
    """Ranges against all earlier ones; one of them reaches over all the others."""
    rows = fx.truth(spark, sf_dir).select("event_no", F.expr("IF(event_no % 13 = 0, 'long', concat('run ', event_no div 300))").alias("file_name"))
    return quality.range_conflicts(quality.event_ranges(rows.where("event_no % 300 < 250")))


@query
def table_comparison(spark, sf_dir):
    """Orders against orders changed in some parts: a row left out, one repeated, one altered, one emptied."""
    rows = fx.table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey", "o_orderstatus", "o_orderkey % 16 AS part")
    change = """CASE WHEN part = 3 AND o_orderkey % 480 = 3 THEN array() WHEN part = 5 AND o_orderkey % 480 = 5 THEN array(0, 0)
        ELSE array(0) END"""
    altered = "IF(part = 7 AND o_orderkey % 480 = 7, o_custkey + 1, o_custkey) AS o_custkey"
    emptied = "IF(part = 9 AND o_orderkey % 480 = 9, NULL, o_orderstatus) AS o_orderstatus"
    other = rows.selectExpr("part", emptied, altered, "o_orderkey", f"explode({change}) AS one").drop("one")
    return quality.compare_tables(rows, other, ["part"])


@query
def offset_edges(spark, sf_dir):
    rows = quality.offset_drops(fx.placed(spark, sf_dir))
    return rows.select(
        "part_no", "event_no", "shard_no", "offset", F.col("offset_fell").cast("int").alias("offset_fell"),
        F.col("shard_edge").cast("int").alias("shard_edge"),
    )


@query
def slice_audit(spark, sf_dir):
    placed = fx.placed(spark, sf_dir)
    rows = fx.doms(spark, sf_dir).join(placed.select("event_no", "part_no", "shard_no"), "event_no")
    return quality.slice_audit(placed, rows).withColumn("consistent", F.col("consistent").cast("int"))


@query
def synopsis(spark, sf_dir):
    rows = quality.file_rows(spark, f"{sf_dir}/events.parquet").withColumnRenamed("user_id", "event_no")
    return quality.synopsis(rows, "row_id")


@query
def missing_runs(spark, sf_dir):
    return quality.missing_runs(fx.truth(spark, sf_dir), 2201200000, 2201201999)


@query
def negative_charge_audit(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("event_no"), F.col("c_acctbal").alias("charge"))
    return quality.negative_charges(rows, "charge")


@query
def constant_per_sensor(spark, sf_dir):
    """Strings seen with more than one sensor position."""
    return quality.inconsistent_values(fx.pulses(spark, sf_dir), "string", "dom_z")


# ----------------------------------------------------------------------- listings
def _listing_lines(spark, sf_dir):
    """Raw listing lines from orders: some lack fields, two of three are repeated."""
    rows = fx.table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "P", F.concat_ws(",", F.col("o_custkey") + 2201000000, "o_orderkey"))
        .otherwise(F.concat_ws(",", F.col("o_custkey") + 2201000000, F.lit(0), F.col("o_orderkey") % 5, F.lit(0)))
        .alias("value")
    )
    return rows


@query
def clean_ids_dedup(spark, sf_dir):
    return files.reduced_listing(_listing_lines(spark, sf_dir))


@query
def clean_ids_bucketed(spark, sf_dir):
    rows = files.bucketed_listing(files.reduced_listing(_listing_lines(spark, sf_dir)))
    return rows.groupBy("bucket", "file_name").agg(F.count(F.lit(1)).alias("n"))


@query
def listing_validity(spark, sf_dir):
    rows = files.listing_fields(_listing_lines(spark, sf_dir), 2)
    third = F.get("fields", F.lit(2))
    return rows.select("line", files.is_number(F.get("fields", F.lit(0))).cast("int").alias("run_ok"),
                       files.is_stripped(F.col("line")).cast("int").alias("stripped"),
                       third.alias("third"))


@query
def job_log_table(spark, sf_dir):
    """Log lines composed from orders, one log per customer, read back into a table: of repeated lines the last, cells of the first table."""
    price = F.col("o_totalprice")
    border = F.lit("+-----+-----+")
    rows = fx.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("log"),
        "o_orderkey",
        F.posexplode(
            F.array(
                F.concat(F.lit("Source part file size: "), F.round(price / 1000, 2).cast("string"), F.lit(" GB")),
                F.concat(F.lit("Elapsed time: "), (F.col("o_orderkey") % 48).cast("string"), F.lit("h 5m 7s")),
                F.lit("Elapsed time for shard 3: 99h 1m 1s"),
                F.lit("| Truth File Size | 99999 GB |"),
                border,
                F.lit("| Truth Head Size | 77777 GB |"),
                border,
                F.concat(F.lit("| Truth File Size | "), F.round(price / 100, 1).cast("string"), F.lit(" MB |")),
                border,
                F.lit("Memory: 251.00 GB total, 245.71 GB available"),
            )
        ).alias("line", "value"),
    )
    out = files.parse_log_lines(rows, order=("o_orderkey", "line"))
    return out.select(
        "log", *_rounded(["source_file_size_GB", "truth_file_size_MB", "memory_total_GB", "memory_available_GB"], 4),
        "elapsed_time_sec", scaling.duration_text(F.col("elapsed_time_sec")).alias("elapsed_time"),
    )


# Tables whose footers are audited: key, columns that a dataset should have.
AUDITED = {
    "orders": ("o_orderkey", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]),
    "customer": ("c_custkey", ["c_custkey", "c_name", "c_acctbal", "c_missing"]),
    "events": ("user_id", ["event_id", "user_id", "ts", "value"]),
    "documents": ("doc_id", ["doc_id", "text"]),
}


@query
def footer_audit(spark, sf_dir):
    """Rows, key range and columns of tables from the footers of their files alone."""
    found = None
    for name, (key, expected) in AUDITED.items():
        rows = footers.footer_audit(spark, f"{sf_dir}/{name}.parquet", key, expected).groupBy(F.lit(name).alias("table_name")).agg(
            F.sum("n_rows").alias("n_rows"), F.min("first_event").alias("first_event"), F.max("last_event").alias("last_event"),
            F.max("n_columns").cast("long").alias("n_columns"), F.concat_ws(",", F.max("missing")).alias("missing"), F.max(F.size("surplus")).cast("long").alias("n_surplus"),
        )
        found = rows if found is None else found.unionByName(rows)
    return found
