"""One row per (event, sensor): charge and timing features of its pulses.

Pulses of a sensor are ordered by time, ties by `pulse_id`.  Events with a bounded
number of pulses take one hash shuffle by event and window functions; events found
to be very large are spread by sensor, and sensors found to be very large are split
into ordered chunks (`operators.scan`), so no task ever holds a whole large sensor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.operators import scan
from pulsegrid.operators.shape import second_round_features
from pulsegrid.runtime import pin
from pulsegrid.schema import FIRST_K, NOT_ENOUGH_PULSES, SENSOR_KEYS, SummaryMode

PULSE_ORDER = ("dom_time", "pulse_id")
# Events, and sensors, of more pulses are not left to one task.
HOT_ROWS = 4_000_000
_PASS_THROUGH = {
    "dom_x": "dom_x",
    "dom_y": "dom_y",
    "dom_z": "dom_z",
    "pmt_area": "pmt_area",
    "rde": "rde",
    "saturation_status": "is_saturated_dom",
    "bad_dom_status": "is_bad_dom",
    "bright_dom_status": "is_bright_dom",
}


_LATE = "(dom_time > (t_last + t_first) / 2)"
# Of the highest late pulse: its place among the late pulses, or its own time.
_LATE_PICK = "min_by({chosen}, CASE WHEN " + _LATE + " THEN struct(-charge, i) END)"


def _dbl(column: Column) -> Column:
    return column.cast("double")


def _late_pick(compat: bool) -> str:
    return _LATE_PICK.format(chosen="late_i" if compat else "dom_time")


def _annotate_in_windows(pulses: DataFrame, order_by: Sequence[str], late: bool, compat: bool) -> DataFrame:
    """Rank, running charge and sensor totals; one shuffle, one sort."""
    spec = f"PARTITION BY {', '.join(SENSOR_KEYS)} ORDER BY {', '.join(order_by)} ROWS BETWEEN UNBOUNDED PRECEDING AND"
    running, whole = f"OVER ({spec} CURRENT ROW)", f"OVER ({spec} UNBOUNDED FOLLOWING)"
    rows = pulses.selectExpr(
        "*",
        f"row_number() {running} AS i",
        f"sum(charge) {running} AS q_running",
        f"count(*) {whole} AS n",
        f"sum(charge) {whole} AS q_all",
        f"max(charge) {whole} AS q_max",
        f"first_value(dom_time) {whole} AS t_first",
        f"last_value(dom_time) {whole} AS t_last",
    )
    if not late:
        return rows
    rows = rows.selectExpr("*", f"sum(int({_LATE})) {running} AS late_i")
    return rows.selectExpr("*", f"{_late_pick(compat)} {whole} AS late_pick")


def _annotate_in_chunks(
    pulses: DataFrame, order_by: Sequence[str], late: bool, compat: bool, partitions: int | None, n_hot: int
) -> DataFrame:
    """Same columns as `_annotate_in_windows`, for `n_hot` sensors too large for one task."""
    chunked = scan.sorted_chunks(pulses, SENSOR_KEYS, order_by, partitions)
    place = f"struct({', '.join(order_by)})"
    # One row per hot sensor.
    totals = chunked.groupBy(*SENSOR_KEYS).agg(
        F.expr("count(*) AS n"),
        F.expr("sum(charge) AS q_all"),
        F.expr("max(charge) AS q_max"),
        F.expr(f"min_by(dom_time, {place}) AS t_first"),
        F.expr(f"max_by(dom_time, {place}) AS t_last"),
    )
    rows = _join_sensor(chunked, totals, n_hot)
    sums = {"i": F.lit(1), "q_running": F.col("charge")}
    if late:
        sums["late_i"] = F.expr(f"int({_LATE})")
    rows = scan.chunked_totals(rows, SENSOR_KEYS, sums)
    if late:
        picks = rows.groupBy(*SENSOR_KEYS).agg(F.expr(f"{_late_pick(compat)} AS late_pick"))
        rows = _join_sensor(rows, picks, n_hot)
    return rows


def _join_sensor(rows: DataFrame, per_sensor: DataFrame, n_sensors: int) -> DataFrame:
    renamed = scan.broadcast_checked(per_sensor, n_sensors).withColumnsRenamed({k: f"_s_{k}" for k in SENSOR_KEYS})
    on = F.expr(" AND ".join(f"{k} <=> _s_{k}" for k in SENSOR_KEYS))
    return rows.join(renamed, on, "inner").drop(*[f"_s_{k}" for k in SENSOR_KEYS])


def _first_k(source: str, prefix: str, kind: str, k: int) -> list[str]:
    return [
        f"coalesce({kind}(max(CASE WHEN i = {j} THEN {source} END)), {kind}(-1)) AS {prefix}{j}"
        for j in range(1, k + 1)
    ]


def _charge_within(interval: int) -> str:
    return f"coalesce(double(sum(CASE WHEN dom_time - t_first < {interval} THEN charge END)), 0D) AS Q{interval}"


def _time_to_fraction(percent: int, unreached: float) -> str:
    """Elapsed time at the first pulse whose running charge exceeds the fraction."""
    passed = f"double(q_running) > {percent / 100}D * double(q_all)"
    first = f"min_by(dom_time - t_first, CASE WHEN {passed} THEN i END)"
    return f"CASE WHEN max(n) < 2 THEN -1D ELSE coalesce({first}, {float(unreached)}D) END AS T{percent}"


def _late_features(compat: bool, unreached: float) -> list[str]:
    """Times of the highest pulse overall and in the second half, first-half charge.

    With `compat` the place of the highest late pulse among the late pulses is
    looked up among all pulses; otherwise its own time is returned.
    """
    late_time = "max(CASE WHEN i = late_pick THEN dom_time END)" if compat else "max(late_pick)"
    first_half = "CASE WHEN dom_time < (t_last + t_first) / 2 THEN charge END"
    return [
        "min_by(dom_time, CASE WHEN charge = q_max THEN i END) AS t_qmax",
        f"CASE WHEN max(n) < 6 THEN -1D ELSE coalesce({late_time}, -1D) END AS t_qmax_secondhalf",
        f"CASE WHEN max(n) < 2 THEN -1D ELSE coalesce(double(sum({first_half})), 0D) END AS Q_halftime",
        _time_to_fraction(70, unreached),
        _time_to_fraction(90, unreached),
    ]


def _fold(annotated: DataFrame, late: bool, compat: bool, k: int, unreached: float) -> DataFrame:
    """One row per sensor; aggregates of primitives only, so all of it is generated code."""
    passed_on = [
        f"max(CASE WHEN i = 1 THEN {source} END) AS {name}"
        for name, source in _PASS_THROUGH.items()
        if source in annotated.columns
    ]
    aggregates = [
        *passed_on,
        *_first_k("charge", "q", "double", k),
        _charge_within(25),
        _charge_within(75),
        "double(max(q_all)) AS Qtotal",
        *_first_k("hlc", "hlc", "int", k),
        *_first_k("dom_time", "t", "double", k),
        _time_to_fraction(10, unreached),
        _time_to_fraction(50, unreached),
        "CASE WHEN max(n) <= 1 THEN -1D ELSE stddev_pop(dom_time) END AS sigmaT",
        "max(n) AS n_pulses",
        "max(q_all) AS _q",
        *[f"sum(dom_{axis} * charge) AS _q{axis}" for axis in "xyz"],
        *(_late_features(compat, unreached) if late else []),
    ]
    return annotated.groupBy(*SENSOR_KEYS).agg(*map(F.expr, aggregates))


_HIDDEN = ("_q", "_qx", "_qy", "_qz")


def sensor_features(pulses: DataFrame, *args, **kwargs) -> DataFrame:
    """Features of each (event, string, dom_number), without event-level columns.

    `unreached` is the time to a charge fraction that is never exceeded, as with
    sensors without charge; an older list-based variant gives 0 there.
    """
    return _sensor_features(pulses, *args, **kwargs).drop(*_HIDDEN)


def _sensor_features(
    pulses: DataFrame,
    late: bool = False,
    order_by: Sequence[str] = PULSE_ORDER,
    compat: bool = True,
    k: int = FIRST_K,
    unreached: float = NOT_ENOUGH_PULSES,
    hot_rows: int = HOT_ROWS,
    one_task_rows: int | None = None,
    sample_fraction: float = 0.001,
    partitions: int | None = None,
) -> DataFrame:
    def fold(rows: DataFrame) -> DataFrame:
        return _fold(_annotate_in_windows(rows, order_by, late, compat), late, compat, k, unreached)

    def by_event(rows: DataFrame) -> DataFrame:
        # One exchange: windows, grouping and event means all lie within an event.
        return fold(rows.repartition("event_no"))

    # No event can hold more than all rows do; pulses as they are read are counted from footers.
    limit = hot_rows if one_task_rows is None else one_task_rows
    if limit and pulses.count() <= limit:
        return by_event(pulses)
    hot_events = pin(scan.hot_groups(pulses, ["event_no"], hot_rows, sample_fraction))
    n_events = hot_events.count()
    if n_events == 0:
        return by_event(pulses)
    usual, large = scan.split_by_groups(pulses, hot_events, ["event_no"], n_events)
    hot = pin(scan.hot_groups(large, SENSOR_KEYS, hot_rows, sample_fraction))
    n_hot = hot.count()
    by_sensor, huge = scan.split_by_groups(large, hot, SENSOR_KEYS, n_hot)
    out = by_event(usual).unionByName(fold(by_sensor))
    if n_hot == 0:
        return out
    in_chunks = _annotate_in_chunks(huge, order_by, late, compat, partitions, n_hot)
    return out.unionByName(_fold(in_chunks, late, compat, k, unreached))


def _centroid(rows: DataFrame, charge: Column, moments: dict[str, Column]) -> DataFrame:
    total = _dbl(F.sum(charge))
    means = [
        F.when(total > 0, F.try_divide(_dbl(F.sum(moment)), total)).otherwise(F.lit(0.0)).alias(f"mean_{axis}")
        for axis, moment in moments.items()
    ]
    return rows.groupBy("event_no").agg(*means)


def charge_centroid(pulses: DataFrame) -> DataFrame:
    """Charge-weighted mean position per event; the origin if there is no charge."""
    return _centroid(pulses, F.col("charge"), {a: F.col(f"dom_{a}") * F.col("charge") for a in "xyz"})


def _relative(rows: DataFrame) -> DataFrame:
    kept = [c for c in rows.columns if not c.startswith("mean_")]
    return rows.selectExpr(*kept, *[f"dom_{a} - mean_{a} AS dom_{a}_rel" for a in "xyz"])


def dom_summary(
    pulses: DataFrame,
    mode: SummaryMode = SummaryMode.CLASSIC,
    order_by: Sequence[str] = PULSE_ORDER,
    compat: bool = True,
    q_cut: float = 0.0,
    **scale,
) -> DataFrame:
    """Sensor summary with event-relative positions and, by mode, shape features.

    CLASSIC shuffles the pulses once; event means are windows over the sensor rows,
    which lie together already.  The other modes use the sensor rows several times,
    so these are written once.
    """
    features = _sensor_features(pulses, mode is SummaryMode.EQUINOX, order_by, compat, **scale)
    if mode is SummaryMode.CLASSIC:
        return _relative(_with_means(features, "PARTITION BY event_no", "sum(_q)").drop(*_HIDDEN))
    features = pin(features)
    centroid = _centroid(features, F.col("_q"), {a: F.col(f"_q{a}") for a in "xyz"})
    rows = _relative(features.drop(*_HIDDEN).join(centroid, "event_no", "inner"))
    return rows.join(second_round_features(features, q_cut), "event_no", "inner")


def _with_means(features: DataFrame, group: str, total: str) -> DataFrame:
    """Charge-weighted mean position of each group of sensor rows, 0 without charge; at most one row per sensor in a window."""
    means = [
        f"CASE WHEN double({total} OVER ({group})) > 0 THEN double(sum(_q{a}) OVER ({group})) / double({total} OVER ({group})) ELSE 0D END AS mean_{a}"
        for a in "xyz"
    ]
    return features.selectExpr("*", *means)


def legacy_summary(pulses: DataFrame, order_by: Sequence[str] = PULSE_ORDER, **scale) -> DataFrame:
    """Prototype summary: three readouts, and -1 for what a saturated sensor measured.

    Positions are relative to the mean of position times charge per (event,
    string), scaled by the highest sensor charge of that string.
    """
    rows = _sensor_features(pulses, order_by=order_by, k=3, **scale)
    saturated = F.col("saturation_status") == 1
    hidden = {"q1", "q2", "q3", "t1", "t2", "t3", "Q25", "Q75", "Qtotal", "T10", "T50"}
    out = []
    for name in rows.columns:
        if name in hidden:
            out.append(F.when(saturated, F.lit(NOT_ENOUGH_PULSES)).otherwise(F.col(name)).alias(name))
        elif name == "sigmaT":
            few = F.col("n_pulses") <= 1
            out.append(F.when(saturated | few, F.lit(0.0)).otherwise(F.col(name)).alias(name))
        else:
            out.append(F.col(name))

    group = "OVER (PARTITION BY event_no, string)"
    means = [f"double(sum(_q{a}) {group}) / double(sum(n_pulses) {group}) / double(max(_q) {group}) AS mean_{a}" for a in "xyz"]
    return _relative(rows.select(*out).selectExpr("*", *means).drop(*_HIDDEN))


def first_hlc_times(pulses: DataFrame, order_by: Sequence[str] = PULSE_ORDER, k: int = 3) -> DataFrame:
    """Times of the first k locally coincident pulses; Spark prunes to k per task before the shuffle."""
    spec = f"PARTITION BY {', '.join(SENSOR_KEYS)} ORDER BY {', '.join(order_by)}"
    ranked = pulses.where("hlc = 1").selectExpr("*", f"row_number() OVER ({spec}) AS i").where(f"i <= {k}")
    return ranked.groupBy(*SENSOR_KEYS).agg(*map(F.expr, _first_k("dom_time", "t", "double", k)))
