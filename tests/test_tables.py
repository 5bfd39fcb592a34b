"""Truth assembly, selection, geometry, files and SQLite."""

import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from pulsegrid.functions import ids, scaling
from pulsegrid.operators import detector, quality, select, stats
from pulsegrid.operators import truth as labels
from pulsegrid.plans import fixtures as fx
from pulsegrid.schema import SIDE_TABLES, TRUTH_WIDTH, SummaryMode, cast_to, summary_columns
from pulsegrid.operators.summary import dom_summary
from pulsegrid.sources import files
from pulsegrid.sources.sqlite import read_sqlite, resolve_table, write_sqlite

SF = "/root/testdata/sf0.001"


def test_truth_has_130_declared_columns(spark):
    full = labels.build_truth(fx.truth(spark, SF).drop("InteractionType"), fx.hits(spark, SF), fx.doms(spark, SF),
                              {"daughter": fx.daughter(spark, SF)}, 22012, ids.SIGNAL, 100)
    assert len(full.columns) == TRUTH_WIDTH == 130
    assert full.columns[:2] == ["event_no", "original_event_no"]
    assert full.schema["energy"].dataType.simpleString() == "float"
    row = full.limit(1).collect()[0]
    assert row.InteractionType == -1 and row.BjorkenX == pytest.approx(-1e8)


def test_summary_with_enhanced_id_has_34_37_42_columns(spark):
    pulses = fx.pulses(spark, SF).where("event_no = 3")
    for mode, width in ((SummaryMode.CLASSIC, 34), (SummaryMode.SECOND, 37), (SummaryMode.EQUINOX, 42)):
        rows = cast_to(dom_summary(pulses, mode), summary_columns(mode)).withColumn("part_no", F.lit(1))
        assert len(labels.with_enhanced_id(rows, 22012, ids.SIGNAL).drop("part_no").columns) == width


def test_side_defaults(spark):
    truth = spark.createDataFrame([(1,), (2,), (3,)], "event_no int")
    nan = float("nan")
    side = spark.createDataFrame([(1, nan, 0.5), (2, None, None)], "event_no int, pos_x_GNHighestEDaughter double, dir_x_GNHighestEDaughter double")
    rows = labels.attach_side(truth, side, SIDE_TABLES["daughter"]).orderBy("event_no").collect()
    assert [r.pos_x_GNHighestEDaughter for r in rows] == [-1e8] * 3
    assert [r.dir_x_GNHighestEDaughter for r in rows] == [0.5, 0, 0]
    assert [r.energy_GNHighestEDaughter for r in rows] == [-1] * 3


def test_null_string_is_no_sensor(spark):
    df = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (1, None, 2), (2, None, 1)], "event_no int, string int, dom_number int")
    assert {r.event_no: r.N_doms for r in labels.count_doms(df).collect()} == {1: 1, 2: 0}


def test_long_event_numbers_widen_the_id(spark):
    df = spark.createDataFrame([(1, 5), (12345, 123456789)], "part int, event int")
    got = df.select(ids.enhanced_event_no(1, F.lit(12), F.col("part"), F.col("event")).alias("e")).collect()
    assert [r.e for r in got] == [112000100000005, 11212345123456789]
    name = spark.createDataFrame([("0002000-0002999",)], "n string")
    assert name.select(ids.dataset_tag(F.col("n"), ids.NOISE).alias("t")).collect()[0].t == 2029


def test_selection_keyword_empty_and_nothing_found(spark):
    truth = spark.createDataFrame([(1, 1, 1, 0, 10.0, 2)], "event_no int, part_no int, shard_no int, InteractionType int, post_vertex_intraIceCube_segment double, N_doms int")
    chosen = select.Selection({"IntraTravelDistance": select.TravelDistance(300), "CC": select.ChargedCurrent()})
    assert chosen.keyword() == "CC_IntraTravelDistance_300"
    assert chosen.truth(truth.withColumn("offset", F.lit(2))).count() == 0
    assert select.Selection().keep(truth).count() == 0 and select.Selection().keyword() == "None"


def test_conditions_reach_the_scan(spark, tmp_path):
    fx.truth(spark, SF).write.parquet(str(tmp_path / "t"))
    plan = select.ChargedCurrent().apply(spark.read.parquet(str(tmp_path / "t"))).select("event_no")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(InteractionType,1)" in text and "energy" not in text.split("ReadSchema")[1]


def test_geometry_completion(spark):
    rows = [(1, d, 5.0, 6.0, 100.0 - 10 * d) for d in (3, 4, 7, 8)]
    filled = {r.dom_number: r for r in detector.completed_geometry(spark.createDataFrame(rows, "string int, dom_number int, dom_x double, dom_y double, dom_z double")).collect()}
    assert len(filled) == 60
    assert filled[1].dom_z == 90 and filled[5].dom_z == 50 and filled[10].dom_z == 0 and filled[1].dom_x == 5.0


def test_box_takes_the_first_match_and_edges_count(spark):
    geometry = spark.createDataFrame([(1, 1, 0.0, 0.0, 0.0), (1, 2, 5.0, 0.0, 1.0)], "string int, dom_number int, dom_x double, dom_y double, dom_z double")
    rows = spark.createDataFrame([(10.0, 10.0, 2.0), (15.0, -10.0, 3.0), (15.1, 0.0, 0.0), (-10.0, 0.0, -2.0)], "dom_x double, dom_y double, dom_z double")
    got = {r.dom_x: r.dom_number for r in detector.assign_sensor(rows, geometry).collect()}
    assert got == {10.0: 1, 15.0: 2, 15.1: None, -10.0: 1}


def test_table_comparison(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    assert detector.tables_equal(a, a) and not detector.tables_equal(a, b)
    assert detector.table_differences(a, b).count() == 0


def test_chi2_tail():
    assert stats.chi2_tail(3.841458820694124, 1) == pytest.approx(0.05)
    assert stats.chi2_tail(18.307038053275146, 10) == pytest.approx(0.05)
    assert stats.chi2_tail(2.0, 10) == pytest.approx(0.9963401531726563)


def test_histogram_keeps_the_maximum_in_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 3, 4)] + [(float("nan"),), (None,)], "v double")
    assert [tuple(r) for r in stats.histogram(df, "v", bins=2).orderBy("bin").collect()] == [(0, 0.0, 2), (1, 2.0, 3)]
    assert [tuple(r) for r in stats.histogram(df, "v", width=2).orderBy("bin").collect()] == [(0, 0.0, 2), (1, 2.0, 3)]


def test_listing_files(spark, tmp_path):
    source = tmp_path / "raw.csv"
    source.write_text("RunID,Sub,EventID,SubEvent\n2201000001,0,5,0,x\n2201000001,0,5,1\n2201000250,0,7,0\nbroken,1\n2201000020,0,1,0\n")
    rows = files.reduced_listing(files.read_lines(spark, str(source)))
    assert rows.count() == 3
    out = str(tmp_path / "out")
    files.write_bucketed_listing(rows, out)
    back = spark.read.csv(out, header=True)
    assert {(int(r.RunID), r.file_name) for r in back.collect()} == {
        (2201000001, "clean_event_ids_0000000-0000099.csv"), (2201000250, "clean_event_ids_0000200-0000299.csv")}


def test_job_logs(spark, tmp_path):
    folder = tmp_path / "22012"
    folder.mkdir()
    (folder / "a.log").write_text(
        "Source part file size: 1.50 GB\nMemory: 251.00 GB total, 245.71 GB available\nElapsed time for shard 1: 9h 0m 0s\n"
        "+---+---+\n| Metric | Value |\n+---+---+\n| Total X Size | 2.00 GB |\n| Avg X Shard Size | 3.00 MB |\n| Truth File Size | 512 KB |\n+---+---+\nElapsed time: 1h 2m 3s\n")
    row = files.read_logs(spark, str(tmp_path)).collect()[0]
    assert (row.subdir_no, row.elapsed_time_sec, row.source_file_size_GB) == (22012, 3723, 1.5)
    assert (row.total_shard_size_GB, row.avg_shard_size_MB, row.truth_file_size_MB) == (2.0, 3.0, 0.5)
    table = spark.createDataFrame([("a", "r1", 1.0), ("a", "r2", 2.5)], "f string, r string, v double")
    assert [r.row for r in files.latex_rows(table, ["f", "r", "v"]).orderBy("place").collect()] == [
        "    a & r1 & 1.00 \\\\", "     & r2 & 2.50 \\\\"]


def test_layout_and_receipt(spark, tmp_path):
    doms = spark.createDataFrame([(e, 1, d, 1 + e % 2, 1) for e in range(6) for d in (1, 2)], "event_no int, string int, dom_number int, part_no int, shard_no int")
    files.write_summary(doms, str(tmp_path), ids.SIGNAL, "22012")
    back = files.read_dataset(spark, str(tmp_path), ids.SIGNAL, "22012", "doms")
    assert back.count() == 12 and back.where("part_no = 1").count() == 6
    report = files.size_report(spark, str(tmp_path)).collect()[0]
    assert report.n_files >= 2 and report.total_bytes > 0
    files.write_receipt(spark.createDataFrame([(22012, 0.25)], "subdir_no int, survival_ratio double"), str(tmp_path / "r"))
    written = "".join(f.read_text() for f in (tmp_path / "r").glob("*.json"))
    assert json.loads(written)["survival_ratio"] == 0.25


def test_range_overlap_and_negative_values(spark):
    ranges = spark.createDataFrame([("a", 1, 10), ("b", 8, 12), ("c", 13, 20)], "file_name string, first_event int, last_event int")
    assert [tuple(r) for r in quality.range_overlaps(ranges).collect()] == [("b", "a", 8, 12, 3)]
    charges = spark.createDataFrame([(-1.0,), (-2.0,), (3.0,)], "q1 double")
    assert quality.negative_charges(charges, "q1").count() == 1


def test_synopsis_is_incremental(spark):
    rows = spark.createDataFrame([("f", 1, 1), ("f", 2, 2), ("g", 3, 1)], "file_name string, event_no int, row_id long")
    done = quality.synopsis(rows.where("file_name = 'f'"), "row_id")
    assert [r.file_name for r in quality.without_synopsis(rows, done).collect()] == ["g"]
    shifted = quality.synopsis(rows, "row_id", dataset=12).where("event_no = (12L << 24) | 3")
    assert shifted.count() == 1


def test_lazy_normalisation_protects_markers(spark):
    df = spark.createDataFrame([(-1.0, 10000.0)], "q1 double, t1 double")
    row = scaling.lazily_normalised(df).collect()[0]
    assert (row.q1, row.t1) == (-1.0, 0.0)


# --------------------------------------------------------------------------- SQLite
@pytest.fixture()
def folder(tmp_path):
    for part in (1, 2):
        con = sqlite3.connect(tmp_path / f"merged_part_{part}.db")
        con.execute("CREATE TABLE Pulses (event_no INTEGER, charge REAL, note TEXT)")
        con.executemany("INSERT INTO Pulses VALUES (?, ?, ?)", [(part * 100 + i // 3, i / 2, None if i % 5 else f"n{i}") for i in range(50)])
        con.execute("CREATE TABLE Truth (event_no INTEGER)")
        con.commit()
        con.close()
    return str(tmp_path)


def test_sqlite_scan(spark, folder):
    df = read_sqlite(spark, folder, "Pulses", row_ids=True, bytesPerTask=4096)
    assert dict(df.dtypes)["event_no"] == "bigint" and df.rdd.getNumPartitions() == 6
    assert df.count() == 100 and df.agg(F.sum("charge")).collect()[0][0] == 2 * sum(i / 2 for i in range(50))
    assert df.where("event_no = 105").count() == 3
    assert df.where("event_no IN (105, 201) AND charge > 1.0").count() == 6
    assert df.unionByName(df.where("event_no = 105")).count() == 103
    part = read_sqlite(spark, folder, "Pulses", columns="charge, event_no", where="event_no IN (105, 201)")
    assert part.columns == ["charge", "event_no"] and part.count() == 6
    spans = quality.synopsis(df, "row_id").where("event_no = 100").collect()[0]
    assert (spans.file_name, spans.start_offset, spans.end_offset) == ("merged_part_1.db", 1, 3)
    assert {r.part_no for r in df.select("part_no").distinct().collect()} == {1, 2}
    assert resolve_table(folder, ["truth", "Truth"]) == "Truth"
    with pytest.raises(ValueError):
        resolve_table(folder, ["nothing"])


def test_sqlite_round_trip(spark, folder, tmp_path):
    df = read_sqlite(spark, folder, "Pulses")
    out = str(tmp_path / "copy")
    write_sqlite(df.repartition(3), out, "Pulses", overwrite=True)
    write_sqlite(df.where("event_no = 100"), out, "Pulses")
    back = read_sqlite(spark, out, "Pulses")
    assert back.count() == 103 and detector.tables_equal(back, df.unionByName(df.where("event_no = 100")))


def test_sqlite_append_never_replaces(spark, tmp_path):
    con = sqlite3.connect(tmp_path / "merged_part_3.db")
    con.execute("CREATE TABLE Pulses (event_no INTEGER, charge REAL)")
    con.execute("CREATE TABLE Other (event_no INTEGER)")
    con.executemany("INSERT INTO Pulses VALUES (?, ?)", [(1, 1.0), (2, 2.0), (3, 3.0)])
    con.execute("INSERT INTO Other VALUES (9)")
    con.commit()
    con.close()
    df = spark.range(10, 18).selectExpr("id AS event_no", "double(id) AS charge")
    write_sqlite(df.repartition(4), str(tmp_path), "Pulses")
    names = sorted(p.name for p in tmp_path.glob("*.db"))
    assert names[0] == "merged_part_3.db" and "merged_part_4.db" in names
    assert read_sqlite(spark, str(tmp_path / "merged_part_[3-9].db"), "Pulses").count() == 11
    write_sqlite(df, str(tmp_path), "Pulses", overwrite=True)
    con = sqlite3.connect(tmp_path / "merged_part_3.db")
    assert [r[0] for r in con.execute("SELECT name FROM sqlite_master WHERE type = 'table'")] == ["Other"]
    con.close()
    left = [p.name for p in tmp_path.glob("*.db") if p.name != "merged_part_3.db"]
    assert sum(read_sqlite(spark, str(tmp_path / n), "Pulses").count() for n in left) == 8


def test_crossings_of_known_lines(spark):
    """Each case of a line with the prism, and the faces it passes."""
    from pulsegrid.functions.geometry import PRISM_XY, Z_RANGE
    from pulsegrid.operators.crossings import prism_face_crossings

    (ax, ay), (bx, by), (cx, cy) = (PRISM_XY[i] for i in (5, 0, 1))
    rows = [
        (1, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0),  # inside, upwards
        (2, 0.0, 0.0, -900.0, 0.0, 0.0, 2.0),  # below, upwards
        (3, 0.0, 0.0, 900.0, 0.0, 0.0, 2.0),  # above, upwards
        (4, bx, by, 0.0, cx - ax, cy - ay, 0.0),  # touches an upright edge
        (5, 5000.0, 0.0, 0.0, 0.0, 1.0, 0.0),  # far away
        (6, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0),  # no direction
        (7, None, 0.0, 0.0, 0.0, 0.0, 1.0),
        (8, 0.0, 0.0, Z_RANGE[1], 1.0, 0.0, 0.0),  # within the top face
    ]
    frame = spark.createDataFrame(rows, "event_no int, x double, y double, z double, u double, v double, w double")
    got = {}
    for r in prism_face_crossings(frame, ("x", "y", "z"), ("u", "v", "w")).collect():
        got.setdefault(r.event_no, []).append((r.place, r.face, r.crossing_case, r.behind_vertex))
    got = {k: sorted(v, key=lambda x: x[0] or 0) for k, v in got.items()}
    assert got[1] == [(1, "bottom", "ENTRY_VERTEX_EXIT", 0), (2, "top", "ENTRY_VERTEX_EXIT", 1)]
    assert got[2] == [(1, "bottom", "VERTEX_ENTRY_EXIT", 1), (2, "top", "VERTEX_ENTRY_EXIT", 1)]
    assert got[3] == [(1, "bottom", "ENTRY_EXIT_VERTEX", 0), (2, "top", "ENTRY_EXIT_VERTEX", 0)]
    assert [(c[0], c[2]) for c in got[4]] == [(1, "SINGLE_INTERSECTION")] and got[4][0][1].startswith("side")
    assert all(got[k] == [(None, None, "NO_INTERSECTION", None)] for k in (5, 6, 7))
    assert [c[2] for c in got[8]] == ["ENTRY_VERTEX_EXIT"] * 2


def test_many_histograms_equal_single_ones(spark):
    from pulsegrid.operators import stats

    frame = spark.range(500).selectExpr(
        "IF(id % 9 = 0, NULL, id * 0.37) AS a", "IF(id % 7 = 0, double('NaN'), pow(1.03, id) - 1) AS b", "5 AS c", "CAST(NULL AS double) AS d", "id % 3 AS k"
    )
    grids = {"a": stats.Bins(12.5), "b": stats.Bins(bins=20, log=True), "c": stats.Bins(bins=4), "d": stats.Bins(1)}
    got = sorted(map(tuple, stats.histograms(frame, grids, ["k"]).collect()))
    want = []
    for name, g in grids.items():
        want += [(name, *r) for r in map(tuple, stats.histogram(frame, name, g.width, g.bins, g.log, ["k"]).collect())]
    assert got == sorted(want)
    plan = stats.histograms(frame, grids)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") <= 2


def test_log_lines_in_order(spark):
    """The last of repeated lines counts; cells outside of the first table do not."""
    lines = [
        "Source part file size: 9.00 GB", "| Truth File Size | 8 MB |", "+--+--+", "| Truth Title Size | 5 MB |", "+--+--+", "| Truth File Size | 6 MB |",
        "| Truth Last Size | 4 MB |", "+--+--+", "| Truth File Size | 3 MB |", "Elapsed time: 9h 0m 0s", "Elapsed time: 1h 0m 1s", "+--+--+",
        "Source part file size: 512.00 MB", "Memory: 9.0 GB total, 8.0 GB available", "Memory: 7.0 GB total, 6.0 GB available",
    ]
    frame = spark.createDataFrame([("x", i, v) for i, v in enumerate(lines)] + [("y", 0, "nothing")], "log string, line int, value string").repartition(5)
    rows = {r.log: r for r in files.parse_log_lines(frame).collect()}
    x = rows["x"]
    assert (x.source_file_size_GB, x.truth_file_size_MB, x.elapsed_time_sec, x.memory_total_GB, x.memory_available_GB) == (0.5, 4.0, 3601, 7.0, 6.0)
    assert set(rows["y"].asDict().values()) == {"y", None}


def test_footers_equal_a_full_read(spark, tmp_path):
    from pulsegrid.sources.footers import footers

    rows = spark.range(1000).selectExpr("IF(id % 10 = 0, NULL, id) AS event_no", "string(id) AS s", "IF(id % 3 = 0, NULL, double(id)) AS v", "array(id) AS a", "id % 4 AS part_no")
    rows.repartition(3, "part_no").write.partitionBy("part_no").parquet(str(tmp_path / "a b"))
    spark.createDataFrame([], "event_no long, s string").coalesce(1).write.parquet(str(tmp_path / "none"))
    got = {r.file_path: r for r in footers(spark, str(tmp_path / "a b"), "event_no", files_per_task=2).collect()}
    whole = spark.read.parquet(str(tmp_path / "a b")).select("*", F.col("_metadata.file_path").alias("f"))
    want = whole.groupBy("f").agg(F.count("*").alias("n"), F.min("event_no").alias("a"), F.max("event_no").alias("b"), F.count_if(F.isnull("v")).alias("v"), F.count_if(F.isnull("event_no")).alias("e")).collect()
    assert len(got) == len(want) == 4
    for r in want:
        g = next(g for path, g in got.items() if path.rsplit("/", 1)[1] == r.f.rsplit("/", 1)[1] and path.split("part_no=")[1][0] == r.f.split("part_no=")[1][0])
        assert (g.n_rows, g.first_key, g.last_key, g.nulls["v"], g.nulls["event_no"]) == (r.n, r.a, r.b, r.v, r.e)
        assert g.n_columns == 4 and g.columns["s"] == "string"
    empty = footers(spark, str(tmp_path / "none"), "event_no").collect()
    assert [(r.n_rows, r.first_key) for r in empty] == [(0, None)]


def test_synopsis_opens_new_files_only(spark, tmp_path):
    from pulsegrid.sources import ledger

    data, target = tmp_path / "data", str(tmp_path / "target")
    data.mkdir()

    def put(name, events):
        spark.createDataFrame([(e,) for e in events], "event_no long").coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "new"))
        part = next((tmp_path / "new").glob("*.parquet"))
        (data / name).write_bytes(part.read_bytes())

    def rows():
        return sorted((r.file_path.rsplit("/", 1)[1], r.event_no, r.start_offset, r.end_offset) for r in ledger.read_synopsis(spark, target).collect())

    put("one.parquet", [1, 1, 2])
    put("two.parquet", [7])
    assert ledger.update_synopsis(spark, str(data), target) == 2
    assert rows() == [("one.parquet", 1, 1, 2), ("one.parquet", 2, 3, 3), ("two.parquet", 7, 1, 1)]
    assert ledger.unfinished(spark, str(data), target).count() == 0
    assert ledger.update_synopsis(spark, str(data), target) == 0
    put("three.parquet", [9, 9])
    put("one.parquet", [5, 6, 6, 6])  # written anew
    assert ledger.update_synopsis(spark, str(data), target) == 2
    assert rows() == [("one.parquet", 5, 1, 1), ("one.parquet", 6, 2, 4), ("three.parquet", 9, 1, 2), ("two.parquet", 7, 1, 1)]
    # Rows of a run that never reached the ledger do not count.
    stray = spark.createDataFrame([(1, "x/two.parquet", 1, 1, "lost")], "event_no long, file_path string, start_offset long, end_offset long, run string")
    stray.write.mode("append").parquet(f"{target}/synopsis")
    assert len(rows()) == 4


def test_older_scaling_of_no_charge_is_minus_infinity(spark):
    df = spark.createDataFrame([(q, q) for q in (0.0, -0.5, -1.0, 10.0, None)], "q1 double, Qtotal double")
    rows = scaling.formerly_normalised(df).collect()
    assert rows[0] == (float("-inf"), float("-inf")) and rows[2] == (-1.0, -1.0) and rows[3] == (1.0, -1.0) and rows[4] == (None, None)
    assert rows[1].q1 != rows[1].q1 and rows[1].Qtotal != rows[1].Qtotal


def test_log_lines_are_read_before_they_move(spark):
    lines = [("a", i, t) for i, t in enumerate([
        "+--+", "| Truth X Size | 1 KB |", "+--+", "| Truth A Size | 2 MB | 7 |", " | Total B Size |3.5 GB|", "| Avg C Shard Size | x |",
        "| Avg C Shard Size | 9 KB |", None, "+--+", "| Truth Q Size | 8 GB |", "Elapsed time: 1h 2m 3s", "Elapsed time: 4h 5m 6s shard",
        "Source part file size: 1.2.3 GB", "x Source part file size:7MB", "Memory: 1 GB total, 2 GB available", "Memory: 1.. GB total,5 GB available",
    ])] + [("b", 0, None)]
    found = files.parse_log_lines(spark.createDataFrame(lines, "log string, line int, value string"))
    rows = {r.log: tuple(r)[1:] for r in found.collect()}
    assert rows == {"a": (7 / 1024, 3.5, 9 / 1024, 2.0, 3723, 1.0, 5.0), "b": (None,) * 7}
    # Above the shuffle there are numbers only: no pattern is matched there.
    above = found._jdf.queryExecution().optimizedPlan().toString().split("Window")[0]
    assert "regexp_extract" not in above and "RLIKE" not in above


def test_nested_ranges(spark):
    from pulsegrid.operators import quality

    ranges = spark.createDataFrame([("a", 1, 1000), ("b", 10, 20), ("c", 30, 40), ("d", 900, 1100), ("e", 1050, 1060), ("f", 2000, 2001)], "file_name string, first_event int, last_event int")
    got = {r.file_name: (r.earlier, r.overlap) for r in quality.range_conflicts(ranges).collect()}
    assert got == {"b": ("a", 11), "c": ("a", 11), "d": ("a", 101), "e": ("d", 11)}
    assert {r.file_name for r in quality.range_overlaps(ranges).collect()} == {"b", "e"}


def test_digests_see_multiplicity_and_nulls(spark):
    from pulsegrid.operators import quality

    rows = [(1, "a", None), (1, "a", None), (1, None, "a"), (2, "b", "c"), (None, "n", "n")]
    left = spark.createDataFrame(rows, "k int, x string, y string")
    equal = lambda other: {r.k: (r.n_left, r.n_right, r.equal) for r in quality.compare_tables(left, other, ["k"]).collect()}
    assert equal(left.repartition(4).select("y", "k", "x")) == {1: (3, 3, 1), 2: (1, 1, 1), None: (1, 1, 1)}
    other = spark.createDataFrame([(1, "a", None), (1, None, "a"), (1, None, "a"), (3, "b", "c"), (None, "n", "n")], "k int, x string, y string")
    assert equal(other) == {1: (3, 3, 0), 2: (1, 0, 0), 3: (0, 1, 0), None: (1, 1, 1)}
    with pytest.raises(ValueError, match="other columns"):
        quality.compare_tables(left, left.drop("y"), ["k"])
