"""The batch jobs end to end: SQLite parts -> summary and truth -> filter, blend."""

import random
import sqlite3

import pytest
from pyspark.sql import functions as F

from pulsegrid.__main__ import main
from pulsegrid.operators import quality
from pulsegrid.plans import jobs
from pulsegrid.schema import SummaryMode
from pulsegrid.sources import files


def write_parts(folder, with_sensor=True):
    draw = random.Random(7)
    folder.mkdir()
    for part in (1, 2):
        con = sqlite3.connect(folder / f"merged_part_{part}.db")
        con.execute("CREATE TABLE SRTInIcePulses (event_no INTEGER, string INTEGER, dom_number INTEGER, dom_x REAL, dom_y REAL, dom_z REAL,"
                    " dom_time REAL, charge REAL, hlc INTEGER, pmt_area REAL, rde REAL, is_saturated_dom INTEGER, is_bad_dom INTEGER, is_bright_dom INTEGER)")
        con.execute("CREATE TABLE Truth (event_no INTEGER, energy REAL, RunID INTEGER, EventID INTEGER, MuonFilter_13 INTEGER, GNLabelEnergyPrimary REAL)")
        con.execute("CREATE TABLE GNHighestEDaughter (event_no INTEGER, pos_x REAL, pos_y REAL, pos_z REAL, dir_x REAL, dir_y REAL, dir_z REAL)")
        con.execute("CREATE TABLE MCWeightDict (event_no INTEGER, InteractionType INTEGER)")
        for event in range(1, 13):  # the same numbers in both parts
            for i in range(draw.randrange(3, 30)):
                s, d = draw.randrange(1, 6), draw.randrange(1, 4)
                con.execute("INSERT INTO SRTInIcePulses VALUES (?,?,?,?,?,?,?,?,?,?,?,?,?,?)",
                            (event, s, d, s * 100.0, s * s * 30.0, -17.0 * d, 1e4 + i * 7.5, draw.random() * 90, i % 2, 0.04, 1.0, 0, 0, 0))
            con.execute("INSERT INTO Truth VALUES (?,?,?,?,?,?)", (event, 9e4 + 1e4 * event, 2201200000 + part, event, event % 2, float(event)))
            if event != 5:
                con.execute("INSERT INTO GNHighestEDaughter VALUES (?,0,0,0,0,0,1)", (event,))
            con.execute("INSERT INTO MCWeightDict VALUES (?,?)", (event, event % 3))
        con.commit()
        con.close()


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("jobs")
    write_parts(base / "db")
    for subdir in ("22011", "22012"):
        jobs.summarise(spark, str(base / "db"), str(base / "out"), "Snowstorm", subdir, 5, SummaryMode.SECOND)
    return base


def read(spark, root, table, subdir="22012", source="Snowstorm"):
    return files.read_dataset(spark, str(root), source, subdir, table)


def test_summarised_dataset(spark, root):
    truth, doms = read(spark, root / "out", "truth"), read(spark, root / "out", "doms")
    assert truth.count() == 24 and len(truth.columns) == 130
    assert len(doms.columns) == 37 + 2  # and the partition columns
    assert truth.where("part_no = 2 AND original_event_no = 7 AND event_no = 112000200000007").count() == 1
    assert quality.slice_audit(truth, doms).where("NOT consistent").count() == 0
    shards = {(r.part_no, r.shard_no): r["count"] for r in truth.groupBy("part_no", "shard_no").count().collect()}
    assert shards == {(p, s): 5 if s < 3 else 2 for p in (1, 2) for s in (1, 2, 3)}
    row = truth.where("original_event_no = 5 AND part_no = 1").collect()[0]
    assert row.pos_x_GNHighestEDaughter == pytest.approx(-1e8) and row.GNLabelEnergyPrimary == 5 and row.isWithinIceCube == 0
    assert truth.where("isWithinIceCube = 1 AND post_vertex_intraIceCube_segment BETWEEN 524.5 AND 524.6").count() == 22


def test_filtered_dataset(spark, root):
    main(["filter", "Snowstorm", "22012", str(root / "out"), str(root / "kept"), "--charged-current", "--min-travel-distance", "300"])
    kept = root / "kept" / "CC_IntraTravelDistance_300"
    truth, doms = read(spark, kept, "truth"), read(spark, kept, "doms")
    assert sorted(r.original_event_no for r in truth.collect()) == sorted([1, 4, 7, 10] * 2)
    assert quality.slice_audit(truth, doms).where("NOT consistent").count() == 0
    receipt = spark.read.json(str(kept / "Snowstorm" / "22012" / "receipt"))
    assert {(r.part_no, r.selected_events, r.initial_events) for r in receipt.collect()} == {(1, 4, 12), (2, 4, 12)}


def test_blended_dataset(spark, root):
    jobs.blend_datasets(spark, str(root / "out"), "Snowstorm", "22011", "22012", "22031", events_per_part=20, events_per_shard=6)
    truth, doms = read(spark, root / "out", "truth", "22031"), read(spark, root / "out", "doms", "22031")
    assert truth.count() == 44  # 22 of 24 low events are above the cut
    assert quality.slice_audit(truth, doms).where("NOT consistent").count() == 0
    assert truth.where("subdirectory_no <> 31").count() == 0 and truth.select("event_no").distinct().count() == 44
    assert {r.part_no: r["count"] for r in truth.groupBy("part_no").count().collect()} == {1: 20, 2: 20, 3: 4}


def one_part(folder, name, events, labelled, with_sensor=True, sensors=3):
    folder.mkdir(exist_ok=True)
    con = sqlite3.connect(folder / name)
    con.execute("CREATE TABLE SRTInIcePulses (event_no INTEGER, string INTEGER, dom_number INTEGER, dom_x REAL, dom_y REAL, dom_z REAL,"
                " dom_time REAL, charge REAL, hlc INTEGER, pmt_area REAL, rde REAL, is_saturated_dom INTEGER, is_bad_dom INTEGER, is_bright_dom INTEGER)")
    con.execute("CREATE TABLE Truth (event_no INTEGER, energy REAL, RunID INTEGER, EventID INTEGER)")
    for event in events:
        for i in range(2 * sensors):
            con.execute("INSERT INTO SRTInIcePulses VALUES (?,?,?,?,?,?,?,?,?,?,?,?,?,?)",
                        (event, 1, i % sensors + 1, 100.0, 30.0, -17.0 * (i % sensors), 1e4 - i, 1.0 + i, 0, 0.04, 1.0, 0, 0, 0))
        if event in labelled:
            con.execute("INSERT INTO Truth VALUES (?,?,?,?)", (event, 2e5, 2201200000, event))
    con.commit()
    con.close()


def test_one_shard_numbering_with_an_orphan(spark, tmp_path):
    one_part(tmp_path / "db", "sample_98.db", range(1, 9), {1, 3, 4, 5, 6, 7, 8})
    jobs.summarise(spark, str(tmp_path / "db"), str(tmp_path / "out"), "Snowstorm", "22012", 3)
    truth, doms = read(spark, tmp_path / "out", "truth"), read(spark, tmp_path / "out", "doms")
    assert {r.part_no for r in truth.select("part_no").distinct().collect()} == {98}
    assert {r.subdirectory_no for r in truth.select("subdirectory_no").distinct().collect()} == {12}
    both = truth.select("original_event_no", F.col("shard_no").alias("t")).join(doms.select("original_event_no", "shard_no").distinct(), "original_event_no")
    assert sorted((r.original_event_no, r.t, r.shard_no) for r in both.collect()) == [(e, (e - 1) // 3 + 1, (e - 1) // 3 + 1) for e in (1, 3, 4, 5, 6, 7, 8)]
    ends = {r.original_event_no: r.offset for r in truth.collect()}
    assert ends == {1: 3, 3: 9, 4: 3, 5: 6, 6: 9, 7: 3, 8: 6}


def test_range_dataset_and_stored_order(spark, tmp_path):
    one_part(tmp_path / "db", "merged_part_7.db", [1, 2], {1, 2})
    for name, order in (("time", []), ("stored", ["--stored-order"])):
        main(["summarise", "Corsika", "0002000-0002999", str(tmp_path / "db"), str(tmp_path / name), "--events-per-shard", "5", *order])
    truth = read(spark, tmp_path / "time", "truth", "0002000-0002999", "Corsika")
    assert {(r.subdirectory_no, r.part_no) for r in truth.collect()} == {(2029, 7)}
    first = [read(spark, tmp_path / n, "doms", "0002000-0002999", "Corsika").where("dom_z = 0").first().q1 for n in ("time", "stored")]
    assert first == [4.0, 1.0]  # later pulses of the file are earlier in time


def test_part_without_number_is_an_error(spark, tmp_path):
    one_part(tmp_path / "db", "sample.db", [1], {1})
    with pytest.raises(Exception, match="no part number"):
        jobs.summarise(spark, str(tmp_path / "db"), str(tmp_path / "out"), "Snowstorm", "22012", 3)


def test_blend_without_sensor_rows_is_an_error(spark, tmp_path):
    for subdir, sensors in (("22011", 3), ("22012", 2)):
        one_part(tmp_path / subdir, "merged_part_1.db", [1, 2, 3], {1, 2, 3}, sensors=sensors)
        jobs.summarise(spark, str(tmp_path / subdir), str(tmp_path / "out"), "Snowstorm", subdir, 5)
    lost = read(spark, tmp_path / "out", "doms", "22012").where("original_event_no <> 2")
    lost.write.partitionBy("part_no", "shard_no").parquet(str(tmp_path / "less" / "Snowstorm" / "22012" / "doms"))
    read(spark, tmp_path / "out", "truth", "22012").write.partitionBy("part_no").parquet(str(tmp_path / "less" / "Snowstorm" / "22012" / "truth"))
    for table in ("doms", "truth"):
        keys = ["part_no", "shard_no"] if table == "doms" else ["part_no"]
        read(spark, tmp_path / "out", table, "22011").write.partitionBy(*keys).parquet(str(tmp_path / "less" / "Snowstorm" / "22011" / table))
    with pytest.raises(ValueError, match="sensor rows are missing"):
        jobs.blend_datasets(spark, str(tmp_path / "less"), "Snowstorm", "22011", "22012", "22031")


def test_pins_of_others_stay(spark):
    from pulsegrid.runtime import pin, released_pins

    mine = pin(spark.range(5))
    with released_pins(spark):
        inside = pin(spark.range(7))
        assert inside.count() == 7
    assert mine.count() == 5
    with pytest.raises(Exception):
        inside.count()


def test_features_of_two_flavours(spark, root, tmp_path):
    jobs.summarise(spark, str(root / "db"), str(root / "out"), "Snowstorm", "22014", 5)
    listing = ["string,dom_number,dom_x,dom_y,dom_z"] + [f"{s},{d},{s * 100.0},{s * s * 30.0},{-17.0 * d}" for s in range(1, 6) for d in range(1, 4)]
    (tmp_path / "geometry.csv").write_text("\n".join(listing) + "\n")
    for name, extra, width in (("full", [], 17), ("compact", ["--compact", "--unbalanced"], 9)):
        main(["features", "Snowstorm", str(root / "out"), str(tmp_path / name), str(tmp_path / "geometry.csv"), "22012", "22014", *extra])
        rows = spark.read.parquet(str(tmp_path / name / "features"))
        assert len(rows.columns) == width + 2
        assert {r.flavour: r["count"] for r in rows.groupBy("flavour").count().collect()} == {"nu_mu": 24, "nu_e": 24}
        stats = spark.read.parquet(str(tmp_path / name / "statistics"))
        assert stats.count() == 2 * width and stats.where("n <> 24").count() == 0
        bars = spark.read.parquet(str(tmp_path / name / "histograms")).groupBy("flavour", "feature").agg(F.sum("n").alias("n"))
        known = {(r.flavour, r.feature): r.n - r.n_missing for r in stats.collect()}
        assert all(known[r.flavour, r.feature] == r.n for r in bars.collect())
    assert spark.read.parquet(str(tmp_path / "full" / "features")).where("stretch_max is null").count() == 0


def snapshot(folder):
    return {p.relative_to(folder).as_posix(): (p.stat().st_mtime_ns, p.stat().st_ino) for p in folder.rglob("*.parquet")}


def test_one_part_again(spark, tmp_path):
    """A part is read, written and exchanged alone; a fault leaves everything as it was."""
    write_parts(tmp_path / "db")
    out = tmp_path / "out"
    for events in (5, 4):
        args = ["summarise", "Snowstorm", "22012", str(tmp_path / "db"), str(out), "--events-per-shard", str(events), "--stored-order"]
        if events == 4:
            before = snapshot(out)
            con = sqlite3.connect(tmp_path / "db" / "merged_part_2.db")
            con.execute("DELETE FROM SRTInIcePulses WHERE event_no > 6")
            con.commit()
            con.close()
            args += ["--parts", "2"]
        main(args)
    after = snapshot(out)
    first = lambda files: {k: v for k, v in files.items() if "part_no=1" in k}
    assert first(before) == first(after) and first(before)
    assert not any(".staged" in p.as_posix() for p in out.rglob("*"))
    truth, doms = read(spark, out, "truth"), read(spark, out, "doms")
    assert {(r.part_no, r.shard_no): r["count"] for r in truth.groupBy("part_no", "shard_no").count().collect()} == {
        (1, 1): 5, (1, 2): 5, (1, 3): 2, (2, 1): 4, (2, 2): 2}
    assert quality.slice_audit(truth, doms).where("NOT consistent").count() == 0
    numbers = spark.read.csv(str(out / "Snowstorm" / "22012" / "numbers"), header=True, inferSchema=True).collect()
    assert {(r.part_no, r.source_file): sum(x.part_no == r.part_no for x in numbers) for r in numbers} == {(1, "merged_part_1.db"): 12, (2, "merged_part_2.db"): 6}
    assert {(r.original_event_no, r.event_no) for r in numbers} == {(r.original_event_no, r.event_no) for r in truth.collect()}

    chosen = ["filter", "Snowstorm", "22012", str(out), str(tmp_path / "kept"), "--charged-current"]
    main(chosen)
    kept = tmp_path / "kept" / "CC"
    before = snapshot(kept)
    main([*chosen, "--parts", "1"])
    after = snapshot(kept)
    second = lambda files: {k: v for k, v in files.items() if "part_no=2" in k}
    assert second(before) == second(after) and second(before) and first(before) != first(after)
    receipt = spark.read.json(str(kept / "Snowstorm" / "22012" / "receipt"))
    assert sorted(r.part_no for r in receipt.collect()) == [1, 2]

    before = snapshot(out)
    with pytest.raises(ValueError, match="nothing was replaced"):
        files.write_summary(doms.where("event_no % 2 = 0"), str(out), "Snowstorm", "22012", [1], lambda rows: "rows are missing")
    assert snapshot(out) == before and not any(".staged" in p.as_posix() for p in out.rglob("*"))


def test_wanted_events_are_looked_up(spark, tmp_path):
    """Two reads of one folder with different wishes, beside the plain read; ids that are not there give nothing."""
    from pulsegrid.sources.sqlite import read_events, read_sqlite

    write_parts(tmp_path / "db")
    folder, table = str(tmp_path / "db"), "SRTInIcePulses"
    whole = read_sqlite(spark, folder, table, row_ids=True)
    wishes = [[(1, 3), (2, 3), (1, 7), (1, 99), (1, 3)], [(2, 12)], []]
    frames = [read_events(spark, folder, table, spark.createDataFrame(w, "part_no int, event_no long")) for w in wishes]
    for wish, frame in zip(wishes, frames):
        ids = set(wish)
        want = sorted((r.part_no, r.row_id, r.event_no, r.charge) for r in whole.collect() if (r.part_no, r.event_no) in ids)
        assert sorted((r.part_no, r.row_id, r.event_no, r.charge) for r in frame.collect()) == want
    both = frames[0].unionByName(frames[1]).groupBy("part_no", "event_no").count().count()
    assert both == 4
