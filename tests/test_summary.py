"""Sensor summary on small literal events, and the chunked way against the windowed one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import summary
from pulsegrid.plans import fixtures as fx
from pulsegrid.schema import SummaryMode, cast_to, summary_columns

SCHEMA = "event_no int, string int, dom_number int, pulse_id int, dom_time double, charge double, hlc int"


def frame(spark, sensors):
    """sensors: list of pulse lists [(t, q), ...], one sensor each of event 7."""
    rows = []
    for number, pulses in enumerate(sensors, 1):
        rows += [(7, 1, number, i, float(t), float(q), i % 2) for i, (t, q) in enumerate(pulses)]
    return fx.with_sensor_constants(spark.createDataFrame(rows, SCHEMA))


def reference(pulses):
    """The features restated in numpy for one sensor."""
    t, q = (np.array(v, dtype=float) for v in zip(*pulses))
    n, total, cum = len(t), q.sum(), np.cumsum(q)
    out = {f"q{j + 1}": q[j] if j < n else -1.0 for j in range(5)}
    out |= {f"t{j + 1}": t[j] if j < n else -1.0 for j in range(5)}
    out |= {f"Q{w}": q[t - t[0] < w].sum() for w in (25, 75)}
    for p in (10, 50, 70, 90):
        passed = np.flatnonzero(cum > p / 100 * total)
        out[f"T{p}"] = t[passed[0]] - t[0] if n > 1 and len(passed) else -1.0
    out["sigmaT"] = t.std() if n > 1 else -1.0
    middle = (t[-1] + t[0]) / 2
    out["t_qmax"] = t[q.argmax()]
    late = t > middle
    out["t_qmax_secondhalf"] = t[q[late].argmax()] if n >= 6 and late.any() else -1.0
    out["Q_halftime"] = q[t < middle].sum() if n > 1 else -1.0
    return out


CASES = {
    "single": [(5, 2)],
    "same time": [(5, 2), (5, 3)],
    "five": [(i * 10, 1 + i) for i in range(5)],
    "six": [(i * 10, 6 - i) for i in range(6)],
    "seven with tie": [(0, 1), (20, 4), (40, 4), (60, 2), (80, 4), (90, 4), (95, 1)],
    "no charge": [(0, 0), (30, 0), (80, 0)],
    "negative": [(0, 3), (30, -1), (60, 2), (200, 1)],
    "all at once": [(9, q) for q in (1, 2, 3, 4, 5, 6, 7)],
}
SCALES = {"windows": {}, "chunks": dict(one_task_rows=0, hot_rows=0, sample_fraction=1, partitions=5),
          "mixed": dict(one_task_rows=0, hot_rows=5, sample_fraction=1, partitions=5)}


@pytest.mark.parametrize("scale", SCALES)
def test_features_match_restatement(spark, scale):
    df = frame(spark, CASES.values())
    rows = summary.sensor_features(df, late=True, **SCALES[scale]).orderBy("dom_number").collect()
    assert len(rows) == len(CASES)
    for row, (name, pulses) in zip(rows, CASES.items()):
        for feature, value in reference(pulses).items():
            assert row[feature] == pytest.approx(value), (name, feature)
        assert row.n_pulses == len(pulses)


@pytest.mark.parametrize("compat", [True, False])
def test_chunks_equal_windows_with_a_hot_sensor(spark, compat):
    rng = np.random.default_rng(5)
    rows = [
        (i % 4 if i % 3 else 1, 1, 1 if i % 3 == 0 else int(rng.integers(1, 4)), i, float(rng.integers(0, 400)), float(rng.integers(1, 50)), i % 2)
        for i in range(4000)
    ]
    df = fx.with_sensor_constants(spark.createDataFrame(rows, SCHEMA)).withColumn("charge", F.col("charge").cast("decimal(12,2)"))
    plain = summary.sensor_features(df, late=True, compat=compat)
    chunked = summary.sensor_features(df, late=True, compat=compat, one_task_rows=0, hot_rows=900, sample_fraction=1, partitions=7)
    keys = ["event_no", "string", "dom_number"]
    names = [c for c in plain.columns if c not in keys]
    both = plain.alias("a").join(chunked.alias("b"), keys)
    assert both.count() == plain.count() == chunked.count()
    for name in names:
        off = both.where(F.abs(F.col(f"a.{name}") - F.col(f"b.{name}")) > 1e-9).count()
        assert off == 0, name


def test_other_pulse_order(spark):
    """With an order other than time, late pulses need not be the last ones."""
    pulses = [(50, 1), (0, 9), (60, 5), (10, 2), (90, 7), (20, 1), (40, 3)]
    df = frame(spark, [pulses])
    row = summary.sensor_features(df, late=True, order_by=("pulse_id",)).collect()[0]
    for feature, value in reference(pulses).items():
        assert row[feature] == pytest.approx(value), feature


def test_centroid_without_charge(spark):
    df = frame(spark, [[(0, 0), (1, 0)]])
    row = summary.charge_centroid(df).collect()[0]
    assert (row.mean_x, row.mean_y, row.mean_z) == (0, 0, 0)


@pytest.mark.parametrize("mode, width", [(SummaryMode.CLASSIC, 33), (SummaryMode.SECOND, 36), (SummaryMode.EQUINOX, 41)])
def test_schema_width(spark, mode, width):
    df = frame(spark, CASES.values())
    rows = cast_to(summary.dom_summary(df, mode), summary_columns(mode))
    assert len(rows.columns) == width and rows.count() == len(CASES)
    assert rows.schema["q1"].dataType.simpleString() == "float"


def test_no_bright_sensor_gives_markers(spark):
    row = summary.dom_summary(frame(spark, [[(0, 1), (5, 2)]]), SummaryMode.SECOND).collect()[0]
    assert (row.eccentricity_PCA, row.aspect_contrast_PCA, row.hypotenuse) == (-1, -1, -1)


def test_first_k_prunes_before_the_shuffle(spark):
    plan = summary.first_hlc_times(frame(spark, CASES.values()))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_unreached_fraction_of_the_list_variant(spark):
    df = frame(spark, [CASES["no charge"]])
    assert summary.sensor_features(df).collect()[0].T50 == -1
    assert summary.sensor_features(df, unreached=0.0).collect()[0].T50 == 0
