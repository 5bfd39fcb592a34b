"""Outlines, distances and cluster scores against brute force."""

import itertools
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pulsegrid.functions import geometry as geo
from pulsegrid.operators import kernels, shape
from pulsegrid.operators.segments import complete_groups


def groups_of(points_per_group):
    sizes = np.array([len(p) for p in points_per_group])
    starts = np.cumsum(sizes) - sizes
    return np.concatenate(points_per_group), starts, sizes


def random_groups(seed, count, dims, high=40):
    rng = np.random.default_rng(seed)
    return [np.unique(rng.integers(0, 30, (rng.integers(1, high), dims)).astype(float), axis=0) for _ in range(count)]


def hull_by_definition(points):
    """Vertices: points not in the convex hull of the others (directions through pairs)."""
    keep = set()
    for i, p in enumerate(points):
        for j, q in enumerate(points):
            if i == j:
                continue
            side = (q[0] - p[0]) * (points[:, 1] - p[1]) - (q[1] - p[1]) * (points[:, 0] - p[0])
            if (side >= 0).all():
                line = points[side == 0]
                ends = line[np.lexsort((line[:, 1], line[:, 0]))][[0, -1]]
                keep |= {tuple(ends[0]), tuple(ends[1])}
    return keep


def test_hull_matches_definition():
    groups = [g for g in random_groups(1, 60, 2) if len(g) > 1]
    flat, starts, sizes = groups_of(groups)
    rows, counts = kernels.hull_rows(flat[:, 0], flat[:, 1], starts, sizes)
    at = np.cumsum(counts) - counts
    for g, points in enumerate(groups):
        found = flat[rows[at[g] : at[g] + counts[g]]]
        if np.linalg.matrix_rank(points - points[0]) == 2:
            assert {tuple(p) for p in found} == hull_by_definition(points)
            area = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(found, np.roll(found, -1, axis=0))) / 2
            assert area > 0  # counter-clockwise


@pytest.mark.parametrize("dims", [2, 3])
def test_farthest_pairs_match_all_pairs(dims, monkeypatch):
    groups = random_groups(2, 50, dims)
    flat, starts, sizes = groups_of(groups)
    for budget in (2_000_000, 50):  # also the way for large groups
        monkeypatch.setattr(kernels, "PAIR_BLOCK", budget)
        best, a, b = kernels.farthest_pairs(flat, starts, sizes)
        for g, points in enumerate(groups):
            want = max((math.dist(p, q) for p, q in itertools.product(points, points)))
            assert best[g] == pytest.approx(want)
            assert math.dist(flat[a[g]], flat[b[g]]) == pytest.approx(want)


@pytest.mark.parametrize("points, major, minor, border", [
    ([(0, 0), (4, 0), (4, 4), (0, 4), (2, 2)], 2.3094011, 2.3094011, 4),
    ([(0, 0), (3, 4)], 3.5355339, 0.0, 2),
    ([(0, 0), (1, 1), (2, 2)], 1.4142136, 0.0, 3),
])
def test_boundary_of_known_shapes(points, major, minor, border):
    xy = np.array(sorted(points), dtype=float)
    out = kernels.boundary_features({"x": xy[:, 0], "y": xy[:, 1]}, np.array([0]), np.array([len(xy)]))
    assert out["n_border"][0] == border
    assert out["major"][0] == pytest.approx(major, abs=1e-6) and out["minor"][0] == pytest.approx(minor, abs=1e-6)


def test_folding_large_events_changes_nothing(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(int(e), float(x), float(y)) for e in range(6) for x, y in rng.integers(0, 60, (900 if e == 0 else 30, 2))]
    rows += [(9, float(i), float(2 * i)) for i in range(600)]  # collinear
    rows += [(10, float(i % 20), float(i // 20)) for i in range(400)]
    df = spark.createDataFrame(rows, "event_no int, x double, y double").repartition(5)
    plain = {r.event_no: r for r in shape.boundary(df).collect()}
    monkeypatch.setattr(shape, "PRUNE_FROM", 16)
    monkeypatch.setattr(shape, "FOLD_ROWS", 50)
    folded = {r.event_no: r for r in shape.boundary(df).collect()}
    assert plain.keys() == folded.keys()
    for event, row in plain.items():
        for name, value in row.asDict().items():
            assert folded[event][name] == (pytest.approx(value) if value is not None else None), (event, name)
    assert plain[9].area is None and plain[9].n_border == 600 and plain[10].n_points == 400


def test_streaming_groups_are_whole_and_folded():
    keys = np.repeat([1, 2, 3], [5, 95, 3])
    table = pa.table({"k": keys, "v": np.arange(len(keys))})
    batches = table.to_batches(max_chunksize=10)
    out = list(complete_groups(iter(batches), "k"))
    seen = [k for t in out for k in dict.fromkeys(t["k"].to_pylist())]
    assert seen == [1, 2, 3] and sum(t.num_rows for t in out) == len(keys)
    folded = list(complete_groups(iter(batches), "k", fold=lambda t: t.slice(t.num_rows - 1), fold_rows=20))
    assert {k: sum(t["k"].to_pylist().count(k) for t in folded) for k in (1, 3)} == {1: 5, 3: 3}
    assert sum(t.num_rows for t in folded) < 60


def test_max_pair_distance(spark):
    rng = np.random.default_rng(6)
    rows = [(e, float(x), float(y), float(z)) for e in range(5) for x, y, z in rng.integers(0, 9, (1 if e == 4 else 40, 3))]
    df = spark.createDataFrame(rows, "event_no int, dom_x double, dom_y double, dom_z double")
    got = {r.event_no: r[1] for r in shape.max_pair_distance(df).collect()}
    for e in range(5):
        own = [r[1:] for r in rows if r[0] == e]
        assert got[e] == pytest.approx(max(math.dist(p, q) for p in own for q in own))


def test_one_pass_features_equal_their_parts(spark):
    """The fused kernel against the separate native aggregations."""
    rng = np.random.default_rng(8)
    rows = []
    for e in range(40):
        for s in rng.choice(12, rng.integers(1, 9), replace=False):
            for d in range(rng.integers(1, 4)):
                rows.append((e, int(s), d, float(s * 37 % 11 * 20), float(s * 53 % 13 * 20), float(-17 * d - s), float(rng.random() * 300)))
    df = spark.createDataFrame(rows, "event_no int, string int, dom_number int, dom_x double, dom_y double, dom_z double, Qtotal double")
    cut = shape.adjusted(df, -0.5)
    fused = {r.event_no: r.asDict() for r in shape.shape_features(df, -0.5).collect()}
    parts = [shape.z_stretch(cut), shape.charge_spread(shape.string_table(cut)), shape.boundary(df.selectExpr("event_no", "dom_x x", "dom_y y"))]
    same = {"stretch_mean": "stretch_mean", "stretch_max": "stretch_max", "stretch_hiqr": "stretch_hiqr",
            "outer_mass_fraction": "outer_mass_fraction", "normalised_weighted_distance": "normalised_weighted_distance",
            "extent": "extent_max", "major": "major_PCA", "minor": "minor_PCA"}
    for part in parts:
        for row in part.collect():
            for name in set(same) & set(row.asDict()):
                want, got = row[name], fused[row.event_no][same[name]]
                assert got == (pytest.approx(want, abs=1e-9) if want is not None else None), (row.event_no, name)
    assert len(fused) == 40


def test_cluster_scores_find_two_clouds(spark):
    rng = np.random.default_rng(9)
    rows = [(1, i, float(x), float(y), 10.0) for i, (x, y) in enumerate(rng.normal(0, 10, (20, 2)))]
    rows += [(1, 20 + i, float(x), float(y), 10.0) for i, (x, y) in enumerate(rng.normal(0, 10, (20, 2)) + [400, 300])]
    rows += [(2, 1, 0.0, 0.0, 1.0)]
    df = spark.createDataFrame(rows, "event_no int, string int, x double, y double, w double")
    got = {r.event_no: r for r in shape.cluster_scores(df).collect()}
    points = np.array([r[2:4] for r in rows[:40]])
    want = np.linalg.norm(points[:20].mean(axis=0) - points[20:].mean(axis=0)) / points.std(axis=0).mean()
    for name in ("kmeans_score", "gmm_score", "meanshift_score"):
        assert got[1][name] == pytest.approx(want, rel=0.02)
        assert got[2][name] is None


def test_repeat_counts():
    w = np.array([0.0, 5.0, 10.0, 3.0])
    got = kernels.repeat_counts(w, np.array([0, 3]), np.array([3, 1]))
    assert got.tolist() == [1, 4, 9, 9]  # the largest falls just short of 10


# ------------------------------------------------------------------ the detector volume
def face_segment(p, d):
    """Path inside the prism by intersecting every face, as stated in the definition."""
    p, d = np.array(p, float), np.array(d, float)
    if not d.any():
        return 0.0
    hits = []
    corners = np.array(geo.PRISM_XY)
    for z in geo.Z_RANGE:
        if abs(d[2]) > 1e-12:
            t = (z - p[2]) / d[2]
            q = p + t * d
            side = [(b[0] - a[0]) * (q[1] - a[1]) - (b[1] - a[1]) * (q[0] - a[0]) for a, b in zip(corners, np.roll(corners, -1, axis=0))]
            if max(side) <= 1e-9:
                hits.append(t)
    for a, b in zip(corners, np.roll(corners, -1, axis=0)):
        n = np.array([-(b - a)[1], (b - a)[0]])
        speed = n @ d[:2]
        if abs(speed) > 1e-9:
            t = n @ (a - p[:2]) / speed
            q = p + t * d
            along = (q[:2] - a) @ (b - a) / ((b - a) @ (b - a))
            if -1e-12 <= along <= 1 + 1e-12 and geo.Z_RANGE[0] - 1e-9 <= q[2] <= geo.Z_RANGE[1] + 1e-9:
                hits.append(t)
    hits = sorted(hits)
    hits = [t for i, t in enumerate(hits) if i == 0 or t - hits[i - 1] > 1e-9]
    if len(hits) < 2:
        return 0.0
    norm = np.linalg.norm(d)
    if hits[0] >= 0:
        return (hits[1] - hits[0]) * norm
    return hits[1] * norm if hits[1] > 0 else 0.0


def test_clipping_equals_face_intersection(spark):
    rng = np.random.default_rng(10)
    rows = [(*map(float, p), *map(float, d)) for p, d in zip(rng.uniform(-900, 900, (400, 3)), rng.normal(size=(400, 3)))]
    rows += [(0.0, 0.0, 0.0, 0.0, 0.0, 0.0), (0.0, 0.0, -2000.0, 0.0, 0.0, 1.0), (0.0, 0.0, 2000.0, 0.0, 0.0, 1.0)]
    df = spark.createDataFrame(rows, "px double, py double, pz double, dx double, dy double, dz double")
    pos, direction = [tuple(f"{k}{a}" for a in "xyz") for k in "pd"]
    got = df.select("*", geo.segment_after_vertex(geo.line_span(pos, direction), direction).alias("s")).collect()
    for row in got:
        assert row.s == pytest.approx(face_segment(row[:3], row[3:6]), abs=1e-6)


def test_prism_is_convex_and_flat():
    corners = geo.PRISM_XY
    turns = []
    for i in range(6):
        (ax, ay), (bx, by), (cx, cy) = corners[i], corners[(i + 1) % 6], corners[(i + 2) % 6]
        turns.append((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))
    assert max(turns) < -1e-9  # strictly clockwise, so no three corners are collinear
    for nx, ny, nz, _ in geo.prism_planes():
        assert nx * nx + ny * ny + nz * nz == pytest.approx(1)


def test_missing_prism_corner_is_where_two_sides_meet():
    o = geo.OUTLINE_XY
    corner = geo.corner_of_lines(o[10], o[13], o[19], o[16])
    assert corner is not None and geo.corner_of_lines((0, 0), (1, 0), (0, 1), (1, 1)) is None
    assert geo.OUTLINE_AREA > geo.polygon_area(geo.OUTLINE_XY)


def test_opening_angle_clamps(spark):
    one = (F.lit(1.0000001), F.lit(0.0), F.lit(0.0))
    assert spark.range(1).select(geo.opening_angle(one, one).alias("a")).collect()[0].a == 0


def test_cluster_scores_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(8)
    rows = [(e, s, float(x), float(y), float(w)) for e in range(60) for s, (x, y, w) in enumerate(rng.integers(1, 400, (int(rng.integers(2, 30)), 3)))]
    df = spark.createDataFrame(rows, "event_no int, string int, x double, y double, w double")
    found = []
    for parts in ("1", "4", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        found.append(sorted(map(tuple, shape.cluster_scores(df).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found[0] == found[1] == found[2] and len(found[0]) == 60


def test_mean_shift_of_a_large_event(monkeypatch):
    rng = np.random.default_rng(9)
    x, y = rng.random(500) * 900, rng.random(500) * 900
    one = (np.array([0]), np.array([500]))
    whole = kernels.shifted_means(x, y, np.ones(500), *one)
    monkeypatch.setattr(kernels, "PAIR_BLOCK", 5_000)
    assert kernels.shifted_means(x, y, np.ones(500), *one) == pytest.approx(whole)


def test_event_above_the_fold_of_production(spark):
    """More points than `FOLD_ROWS`, in several batches, beside a small event that follows in the stream."""
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) < shape.FOLD_ROWS
    large = spark.range(250_000).select(F.lit(1).alias("event_no"), (F.col("id") % 500).alias("x"), F.expr("id div 500").alias("y"))
    small = spark.createDataFrame([(e, x, y) for e in (0, 2, 3) for x, y in ((0, 0), (3, 0), (0, 4))], "event_no int, x long, y long")
    rows = {r.event_no: r for r in shape.boundary(large.union(small)).collect()}
    assert rows[1].n_points == 250_000 and rows[1].n_border == 4
    assert rows[1].extent == pytest.approx(math.hypot(499, 499)) and rows[1].area == pytest.approx(499 * 499)
    assert all(rows[e].extent == pytest.approx(5) and rows[e].n_points == 3 for e in (0, 2, 3))


@pytest.mark.parametrize("rows", [7, 64])
def test_folded_tables_keep_the_schema_of_the_stream(rows):
    schema = pa.schema([pa.field("k", pa.int64(), nullable=False), pa.field("held", pa.int64(), nullable=False)])
    keys = [1] * 100 + [2] * 3 + [3] * 90
    whole = pa.record_batch([pa.array(keys), pa.array([1] * len(keys))], schema=schema)

    def fold(table):
        return pa.table({"k": table["k"][:1].combine_chunks(), "held": pa.array([sum(table["held"].to_pylist())])})

    batches = [whole.slice(i, rows) for i in range(0, len(keys), rows)]
    out = list(complete_groups(iter(batches), "k", fold=fold, fold_rows=10))
    assert all(t.schema == schema for t in out)
    held = {k: sum(n for t in out for key, n in zip(t["k"].to_pylist(), t["held"].to_pylist()) if key == k) for k in (1, 2, 3)}
    assert held == {1: 100, 2: 3, 3: 90}


def test_tasks_grow_with_the_input_files(spark, tmp_path, monkeypatch):
    from pulsegrid import runtime
    from pulsegrid.plans import fixtures as fx

    width = runtime.shuffle_width(spark)
    sf = "/root/testdata/sf0.001"
    assert runtime.spread(fx.hits(spark, sf)) == runtime.spread(spark.range(3)) == width
    few = shape.string_table(fx.doms(spark, sf))
    monkeypatch.setattr(runtime, "TASK_BYTES", 10_000)
    odd = str(tmp_path / "a b%20c")
    fx.hits(spark, sf).repartition(5).write.parquet(odd)
    many = runtime.spread(spark.read.parquet(odd))
    assert many > width
    monkeypatch.setattr(runtime, "SIZED_FILES", 2)
    assert abs(runtime.spread(spark.read.parquet(odd)) - many) <= 2
    wide = shape.string_table(fx.doms(spark, sf))
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, few.collect()))
    # One shuffle, with the larger number of tasks, for sensors, strings and the kernels of events.
    plan = shape.cluster_scores(wide)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(event_no#" in plan and f", {runtime.spread(fx.hits(spark, sf))})" in plan
