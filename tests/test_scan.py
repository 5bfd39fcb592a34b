"""Distributed numbering and running totals against plain window functions."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pulsegrid.operators import blend, scan, stats
from pulsegrid.operators.truth import assign_shards, number_by_key

LARGE = {"one_task_rows": 0}  # take the way meant for large tables
SMALL = {"one_task_rows": 10**9}  # and the one for small tables


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(3)
    # One group holds a third of the rows.
    data = [(("hot" if i % 3 == 0 else f"g{draw.randrange(20)}"), draw.randrange(50), i, draw.randrange(100)) for i in range(3000)]
    return spark.createDataFrame(data, "g string, t int, id int, v int").repartition(7)


@pytest.mark.parametrize("within", [(), ("g",)])
def test_number_rows(rows, within):
    got = scan.number_rows(rows, ["t", "id"], within, "n", partitions=6, **LARGE)
    want = F.row_number().over(Window.partitionBy(*within).orderBy("t", "id"))
    assert got.columns == [*rows.columns, "n"]
    bad = got.withColumn("want", want).where("n <> want")
    assert got.count() == 3000 and bad.count() == 0


def test_number_by_key_keeps_wide_rows(rows):
    got = number_by_key(rows, ["t", "id"], ["g"], "n", **LARGE)
    small = number_by_key(rows, ["t", "id"], ["g"], "n", **SMALL)
    assert got.exceptAll(small).count() == 0 and got.count() == 3000


@pytest.mark.parametrize("within", [(), ("g",)])
def test_running_totals(rows, within):
    sums = {"upto": F.col("v"), "k": F.lit(1)}
    got = scan.running_totals(rows, ["t", "id"], sums, within, partitions=5, **LARGE)
    small = scan.running_totals(rows, ["t", "id"], sums, within, **SMALL)
    assert got.select(*small.columns).exceptAll(small).count() == 0 and got.count() == 3000


def test_null_groups_are_numbered(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "g string, t int")
    got = scan.number_rows(df, ["t"], ["g"], "n", **LARGE).collect()
    assert sorted((r.g or "", r.t, r.n) for r in got) == [("", 1, 1), ("", 2, 2), ("a", 1, 1)]


@pytest.mark.parametrize("within", [[], ["g"]])
def test_null_keys_and_values_either_way(spark, within):
    data = [(g, t, t if t and t >= 9 and t % 5 > 2 else None) for g in (None, "a", "b") for t in [None, *range(40)]]
    df = spark.createDataFrame([(g, t, i, v) for i, (g, t, v) in enumerate(data, 1) for t in (t if t is not None else 0,)], "g string, t int, id int, v int")
    df = df.withColumn("t", F.when(F.col("t") > 0, F.col("t")))
    keys = ["t", "id"]
    ways = [{**SMALL}, {**LARGE, "partitions": 7}]
    numbered = [number_by_key(df, keys, within, "n", **way) for way in ways]
    totals = [scan.running_totals(df, keys, {"upto": F.col("v"), "k": F.lit(1)}, within, **way) for way in ways]
    for small, large in (numbered, totals):
        assert small.count() == large.count() == len(data)
        assert small.select(*large.columns).exceptAll(large).count() == 0
    assert totals[1].where("upto is null and v is not null").count() == 0


def test_counted_size(spark):
    from pulsegrid.runtime import settled

    small, few = settled(spark.range(5), 5)
    assert few and small._is_pinned and settled(small, 4) == (small, False)
    frame = spark.range(6)
    assert settled(frame, 0) == (frame, False)



def test_hot_groups_and_split(rows):
    hot = scan.hot_groups(rows, ["g"], 500, fraction=1)
    assert [r.g for r in hot.collect()] == ["hot"]
    usual, large = scan.split_by_groups(rows, hot, ["g"], 1)
    assert (usual.count(), large.count()) == (2000, 1000)


@pytest.mark.parametrize("by", [[], ["g"]])
def test_exact_quantiles(rows, by):
    got = stats.exact_quantiles(rows, "v", [0.0, 0.157, 0.5, 1.0], by, **LARGE)
    want = stats.exact_quantiles(rows, "v", [0.0, 0.157, 0.5, 1.0], by, **SMALL)
    a = sorted(map(tuple, got.collect()))
    b = sorted(map(tuple, want.collect()))
    assert len(a) == len(b)
    for left, right in zip(a, b):
        assert left[: len(by)] == right[: len(by)]
        assert left[len(by) :] == pytest.approx(right[len(by) :])


def test_shards_of_exact_size(spark):
    events = spark.createDataFrame([(p, e) for p in (1, 2) for e in range(10) for _ in range(2)], "part_no int, event_no int")
    for scale in (SMALL, LARGE):
        got = assign_shards(events, 5, **scale).collect()
        assert sorted((r.part_no, r.event_no, r.shard_no) for r in got) == [
            (p, e, e // 5 + 1) for p in (1, 2) for e in range(10)
        ]


def _truth(spark, first, count, energy=2e5):
    data = [(e, 1 + e % 2, 3, energy, 0) for e in range(first, first + count)]
    return spark.createDataFrame(data, "event_no int, part_no int, N_doms int, energy double, subdirectory_no int")


@pytest.mark.parametrize("scale", [SMALL, LARGE])
def test_blend_of_unequal_sets(spark, scale):
    low, high = _truth(spark, 0, 11), _truth(spark, 100, 7, energy=1.0)
    got = blend.blend_truth(low, high, 22031, events_per_part=6, events_per_shard=4, **scale).orderBy("position").collect()
    assert len(got) == 14
    assert [r.event_no >= 100 for r in got] == [False, True] * 7
    assert [r.part_no for r in got] == [1] * 6 + [2] * 6 + [3] * 2
    assert [r.shard_no for r in got] == [1, 1, 1, 1, 2, 2] * 2 + [1, 1]
    assert [r.offset for r in got][:6] == [3, 6, 9, 12, 3, 6]
    lows = [(r.source_part_no, r.event_no) for r in got if r.event_no < 100]
    assert lows == sorted(lows)


def test_energy_cut_spares_high_set(spark):
    low, high = _truth(spark, 0, 5, energy=1e5), _truth(spark, 100, 5, energy=1e5)
    assert blend.blend_truth(low, high, 22031).count() == 0
    assert blend.blend_receipt(low, high, 22031).collect()[0].events_from_high_energy == 5


@pytest.mark.parametrize("scale", [SMALL, LARGE])
def test_balanced_classes(spark, scale):
    df = spark.createDataFrame([(i, "a" if i < 9 else "b" if i < 12 else "c") for i in range(30)], "event_no int, flavour string")
    got = blend.balance_classes(df, **scale).groupBy("flavour").count().collect()
    assert {r.flavour: r["count"] for r in got} == {"a": 3, "b": 3, "c": 3}


class Jobs:
    """Rows that leaves of executed plans gave since it was made: how often an input was read."""

    def __init__(self, spark):
        self.seen = spark.sparkContext.accumulator(0)

    def watched(self, df):
        seen = self.seen

        def count(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return df.mapInArrow(count, df.schema)


def test_inputs_are_read_once(spark):
    """Counting what is written takes the place of running a plan for its count."""
    from pulsegrid.operators import blend
    from pulsegrid.operators import truth as labels

    rows = spark.range(4000).selectExpr("int(id % 2 + 1) AS part_no", "int(id div 4) AS event_no", "int(id % 3) AS string", "1 AS dom_number")
    jobs = Jobs(spark)
    labels.place_events(jobs.watched(rows), 50).write.format("noop").mode("overwrite").save()
    assert jobs.seen.value == 4000
    sides = [spark.range(300).selectExpr("1 AS part_no", "id AS event_no"), spark.range(500).selectExpr("1 AS part_no", "id AS event_no")]
    jobs = Jobs(spark)
    mixed = blend.interleave(*[jobs.watched(s) for s in sides])
    assert mixed.count() == 600 and jobs.seen.value == 800
    jobs = Jobs(spark)
    stats.describe_columns(jobs.watched(rows), ["part_no", "event_no"]).collect()
    assert jobs.seen.value == 4000


@pytest.mark.parametrize("by", [[], ["k"]])
def test_quantiles_of_many_columns(spark, by):
    """Ranges closed in give what the built-in percentile gives, in four reads of what is written."""
    frame = spark.range(3000).selectExpr(
        "IF(id % 5 = 0, NULL, 'k') AS k", "int(id % 7) AS few", "CASE WHEN id % 11 = 0 THEN NULL WHEN id % 13 = 0 THEN double('NaN') ELSE (id - 1500) * 1.0000001e-7 END AS fine",
        "IF(id % 2 = 0, -1, 1) * pow(10D, (id % 600) - 300) AS wide", "CAST(NULL AS double) AS none", "1e15 + id * 0.125 AS close",
        "CASE WHEN id < 3 THEN double('Infinity') WHEN id < 5 THEN double('-Infinity') ELSE 0 END AS ends",
    )
    columns, shares = ["few", "fine", "wide", "none", "close", "ends"], [0.0, 0.157, 0.5, 0.843, 0.9999, 1.0]
    rows = lambda limit: {(r["k"] if by else 0, r.feature): [r[f"q{j}"] for j in range(len(shares))] for r in stats.column_quantiles(frame, columns, shares, by, limit).collect()}
    large, small = rows(0), rows(None)
    assert large.keys() == small.keys() and len(small) == 5 * (2 if by else 1)
    for key, want in small.items():
        assert large[key] == pytest.approx(want, rel=1e-15, abs=0), key
