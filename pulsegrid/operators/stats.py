"""Histograms, summary statistics and fits."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.operators.scan import broadcast_checked, number_rows, running_totals
from pulsegrid.runtime import pin, settled


def valid(name: str) -> Column:
    """Neither null nor NaN."""
    return F.col(name).isNotNull() & ~F.isnan(F.col(name).cast("double"))


def _binned(
    df: DataFrame, column: str, width: float | None, bins: int | None, log: bool, by: Sequence[str]
) -> DataFrame:
    """Per bin: count n, number, and start and size of the bin grid (in log10 with `log`)."""
    value = F.col(column).cast("double")
    rows = df.where(valid(column))
    if log:
        rows = rows.where(value > 0)
        value = F.log10(value)
    rows = rows.select(*by, value.alias("v"))
    span = rows.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
    lo, hi = span["lo"], span["hi"]
    if width is None:
        size = F.when(hi > lo, (hi - lo) / F.lit(bins)).otherwise(F.lit(1.0))
        count = F.lit(bins)
    else:
        size = F.lit(float(width))
        count = F.greatest(F.lit(1), F.ceil((hi - lo) / size))
    place = F.least(count - 1, F.floor((F.col("v") - lo) / size)).cast("int")
    counted = rows.select(*by, place.alias("bin")).groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumns({"lo": lo, "size": size})


def histogram(
    df: DataFrame,
    column: str,
    width: float | None = None,
    bins: int | None = None,
    log: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """Counts per bin: `by` columns, bin number, its left edge, count.

    Edges begin at the minimum; a value at the maximum falls into the last bin.
    With `log`, edges are even in log10 and values <= 0 are left out.
    """
    edge = F.col("lo") + F.col("bin") * F.col("size")
    left = F.pow(F.lit(10.0), edge) if log else edge
    return _binned(df, column, width, bins, log, by).select(*by, "bin", left.alias("left_edge"), "n")


@dataclass(frozen=True)
class Bins:
    """Grid of a histogram: bins of `width` from the least value on, or `bins` even ones; with `log` of the logarithm to base 10."""

    width: float | None = None
    bins: int | None = None
    log: bool = False


def histograms(df: DataFrame, grids: Mapping[str, Bins], by: Sequence[str] = ()) -> DataFrame:
    """The histograms of many columns at once: feature, `by` columns, bin number, its left edge, count.

    As `histogram` gives them one by one, in two reads of `df` however many there are: the first finds all ranges in one
    aggregation, the second turns every row into (feature, value) pairs and counts them by bin before anything is shuffled.
    Ranges are over all rows, so classes share their edges; a column without values has no rows.
    """
    values = []
    for name, grid in grids.items():
        v = f"double(`{name}`)"
        values.append(f"CASE WHEN NOT isnan({v}) AND {v} > 0 THEN log10({v}) END" if grid.log else f"nullif({v}, double('NaN'))")
    each = ", ".join(f"named_struct('i', {i}, 'v', {v})" for i, v in enumerate(values))
    rows = df.selectExpr(*[f"`{k}`" for k in by], f"inline(array({each}))").where("v IS NOT NULL")
    ends = [f"{rule}({v})" for rule in ("min", "max") for v in values]
    n = len(values)
    span = df.selectExpr(f"struct(array({', '.join(ends[:n])}) AS lo, array({', '.join(ends[n:])}) AS hi) AS span").select("span")
    place = F.col("i") + 1
    of = lambda cells, kind: F.element_at(F.expr(f"array({', '.join('NULL' if c is None else str(c) for c in cells)})").cast(f"array<{kind}>"), place)
    width, bins = of([g.width for g in grids.values()], "double"), of([g.bins for g in grids.values()], "int")
    spanned = rows.withColumn("span", span.scalar())
    placed = spanned.select(*by, "i", "v", F.element_at("span.lo", place).alias("lo"), F.element_at("span.hi", place).alias("hi"), width.alias("w"), bins.alias("b"))
    size = F.coalesce("w", F.when(F.col("hi") > F.col("lo"), (F.col("hi") - F.col("lo")) / F.col("b")).otherwise(1.0))
    count = F.coalesce("b", F.greatest(F.lit(1), F.ceil((F.col("hi") - F.col("lo")) / F.col("w"))))
    binned = placed.withColumns({"size": size, "bin": F.least(count - 1, F.floor((F.col("v") - F.col("lo")) / size)).cast("int")})
    counted = binned.groupBy(*by, "i", "bin").agg(F.count(F.lit(1)).alias("n"), F.first("lo").alias("lo"), F.first("size").alias("size"))
    edge = F.col("lo") + F.col("bin") * F.col("size")
    left = F.when(of([g.log for g in grids.values()], "boolean"), F.pow(F.lit(10.0), edge)).otherwise(edge)
    name = F.element_at(F.array(*[F.lit(c) for c in grids]), place)
    return counted.select(name.alias("feature"), *by, "bin", left.alias("left_edge"), "n")


def exact_quantiles(df: DataFrame, column: str, shares: Sequence[float], by: Sequence[str] = (), **scale) -> DataFrame:
    """Linearly interpolated quantiles, one column q0, q1, ... per share.

    Small inputs use the built-in exact percentile, which holds all distinct
    values of a group in one buffer.  Larger ones count equal values first and
    find the wanted ranks with a distributed running total.
    """
    rows = df.where(valid(column)).select(*by, F.col(column).cast("double").alias("v"))
    rows, few = settled(rows, scale.get("one_task_rows"))
    if few:
        return rows.groupBy(*by).agg(*[F.percentile("v", s).alias(f"q{i}") for i, s in enumerate(shares)])
    counts = rows.groupBy(*by, "v").agg(F.count(F.lit(1)).alias("c"))
    ranked = running_totals(counts, ["v"], {"upto": F.col("c")}, by, **scale)
    totals = ranked.groupBy(*by).agg(F.max("upto").alias("n"))
    if by:
        named = totals.withColumnsRenamed({k: f"_t_{k}" for k in by})
        same = F.expr(" AND ".join(f"{k} <=> _t_{k}" for k in by))
        both = ranked.join(named, same, "inner").select(*by, "v", "c", "upto", "n")
    else:
        both = ranked.withColumn("n", totals.scalar())
    picks = []
    for i, share in enumerate(shares):
        at = F.lit(float(share)) * (F.col("n") - 1)
        for name, rank in ((f"lo{i}", F.floor(at)), (f"hi{i}", F.ceil(at))):
            holds = (F.col("upto") - F.col("c") <= rank) & (rank < F.col("upto"))
            picks.append(F.max(F.when(holds, F.col("v"))).alias(name))
    found = both.groupBy(*by).agg(*picks, F.max("n").alias("n"))
    out = []
    for i, share in enumerate(shares):
        at = F.lit(float(share)) * (F.col("n") - 1)
        lo, hi = F.col(f"lo{i}"), F.col(f"hi{i}")
        out.append((lo + (hi - lo) * (at - F.floor(at))).alias(f"q{i}"))
    return found.select(*by, *out)


def column_quantiles(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float], by: Sequence[str] = (), one_task_rows: int | None = None
) -> DataFrame:
    """`by`, feature and linearly interpolated quantiles q0, q1, ... of many columns, exactly; a column without values has no row.

    For few classes: small tables take the built-in percentile in one aggregation.  Larger ones are not sorted: the two values
    around each quantile are closed in by ranges, of all columns together, in four reads of the written columns.  The first
    counts values by sign, power of two and 32nd of it, the next two count 2^16 even parts of the range that holds the
    rank, and the last counts the distinct values left, no more than 2^16 of double precision.
    """
    rows = df.select(*[F.col(f"`{k}`") for k in by], *[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    rows, few = settled(rows if one_task_rows != 0 else pin(rows), one_task_rows)
    names = ", ".join(f"'{c}'" for c in columns)
    if few:
        cells = [F.percentile(F.nanvl(F.col(f"`{c}`"), F.lit(None)), float(s)).alias(f"_{i}_{j}") for i, c in enumerate(columns) for j, s in enumerate(shares)]
        wide = rows.groupBy(*by).agg(*cells)
        each = ", ".join(f"struct('{c}' AS feature, " + ", ".join(f"_{i}_{j} AS q{j}" for j in range(len(shares))) + ")" for i, c in enumerate(columns))
        return wide.selectExpr(*[f"`{k}`" for k in by], f"inline(array({each}))").where("q0 IS NOT NULL")

    pairs = ", ".join(f"struct({i} AS f, nullif(`{c}`, double('NaN')) AS v)" for i, c in enumerate(columns))
    long = rows.selectExpr(*[f"`{k}`" for k in by], f"inline(array({pairs}))").where("v IS NOT NULL")
    keys = [*by, "f"]
    power = "CASE WHEN v = 0 THEN 0 ELSE floor(log2(abs(v))) END"
    first = long.withColumns({"_sign": F.signum("v"), "_power": F.expr(power)})
    first = first.withColumn("_part", F.floor(F.abs("v") * F.pow(F.lit(2.0), -F.col("_power")) * 32))
    counts = first.groupBy(*keys, "_sign", "_power", "_part")
    ranges = pin(counts.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("c")))
    totals = ranges.groupBy(*keys).agg(F.sum("c").alias("n"))
    at = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.lit(float(s)).alias("share")) for j, s in enumerate(shares)]))
    wanted = totals.select(*keys, "n", at.alias("t")).select(*keys, "t.j", (F.col("t.share") * (F.col("n") - 1)).alias("at"))
    ends = F.explode(F.array(F.struct(F.lit(0).alias("end"), F.floor("at").alias("rank")), F.struct(F.lit(1).alias("end"), F.ceil("at").alias("rank"))))
    wanted = pin(wanted.select(*keys, "j", "at", ends.alias("e")).select(*keys, "j", "at", "e.end", "e.rank"))

    def meets(counted: DataFrame) -> DataFrame:
        """The range of each wanted rank, with the rank counted from its start; `counted` has few rows for each class and column."""
        before = Window.partitionBy(*keys, "j", "end").orderBy("lo").rowsBetween(Window.unboundedPreceding, -1)
        below = counted.withColumn("_below", F.coalesce(F.sum("c").over(before), F.lit(0)))
        here = (F.col("rank") >= F.col("_below")) & (F.col("rank") < F.col("_below") + F.col("c"))
        return below.where(here).select(*keys, "j", "at", "end", (F.col("rank") - F.col("_below")).alias("rank"), "lo", "hi")

    def matched(a: DataFrame, b: DataFrame) -> DataFrame:
        other = b.withColumnsRenamed({k: f"_o_{k}" for k in keys})
        return a.join(other, F.expr(" AND ".join(f"`{k}` <=> `_o_{k}`" for k in keys))).drop(*[f"_o_{k}" for k in keys])

    found = pin(meets(matched(ranges, wanted)))
    for last in (False, False, True):
        # Two rows for each share, column and class.
        spans = broadcast_checked(found.withColumnsRenamed({"lo": "_lo", "hi": "_hi"}), found.count())
        inside = matched(long, spans).where("v BETWEEN _lo AND _hi")
        # A range of one value needs no parts.
        place = F.when(F.col("_hi") > F.col("_lo"), F.floor((F.col("v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * 65536)).otherwise(0)
        part = F.col("v") if last else place
        counted = inside.groupBy(*keys, "j", "at", "end", "rank", part.alias("_part")).agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("c"))
        found = pin(meets(counted))
    value = lambda end: F.max(F.when(F.col("end") == end, F.col("lo")))
    both = found.groupBy(*keys, "j", "at").agg(value(0).alias("a"), value(1).alias("b"))
    q = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.col("a") + (F.col("b") - F.col("a")) * (F.col("at") - F.floor("at")))
    wide = both.withColumn("q", q).groupBy(*keys).agg(*[F.max(F.when(F.col("j") == j, F.col("q"))).alias(f"q{j}") for j in range(len(shares))])
    return wide.select(*by, F.element_at(F.expr(f"array({names})"), F.col("f") + 1).alias("feature"), *[f"q{j}" for j in range(len(shares))])


def describe_columns(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), sample_std: bool = False, one_task_rows: int | None = None) -> DataFrame:
    """Per feature (and class): N, missing, max, min, mean, standard deviation and median.  The columns are written once and read from there."""
    spread = "stddev_samp" if sample_std else "stddev_pop"
    names = ["n", "n_missing", "max", "min", "mean", "std"]
    rows = pin(df.select(*by, *[F.col(f"`{c}`").cast("double").alias(c) for c in columns]))
    cells = []
    for i, c in enumerate(columns):
        ok = f"nullif(`{c}`, double('NaN'))"
        whole = ("count(*)", f"count(*) - count({ok})", f"max({ok})", f"min({ok})", f"avg({ok})", f"{spread}({ok})")
        cells += [F.expr(f"{rule} AS {name}_{i}") for name, rule in zip(names, whole)]
    # All features in one aggregation; the few results are then turned into rows.
    wide = rows.groupBy(*by).agg(*cells)
    each = ", ".join(f"'{c}', " + ", ".join(f"{name}_{i}" for name in names) for i, c in enumerate(columns))
    basic = wide.selectExpr(*by, f"stack({len(columns)}, {each}) AS (feature, {', '.join(names)})")
    median = column_quantiles(rows, columns, [0.5], by, one_task_rows).withColumnRenamed("q0", "median")
    keys = [*by, "feature"]
    named = median.withColumnsRenamed({k: f"_m_{k}" for k in keys})
    same = F.expr(" AND ".join(f"`{k}` <=> `_m_{k}`" for k in keys))
    return basic.join(named, same, "left").select(*keys, *names, "median")


def five_numbers(df: DataFrame, column: str, by: Sequence[str] = (), **scale) -> DataFrame:
    """count, mean, sample std, min, quartiles, max of one column."""
    rows = df.where(valid(column))
    v = F.col(column).cast("double")
    basic = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max")
    )
    quartiles = exact_quantiles(rows, column, [0.25, 0.5, 0.75], by, **scale)
    if by:
        joined = basic.join(quartiles, list(by), "left")
    else:
        joined = basic.withColumns({f"q{i}": quartiles.select(f"q{i}").scalar() for i in range(3)})
    return joined.select(
        *by, "count", "mean", "std", "min",
        F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75"), "max",
    )


def power_law_fit(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Weighted straight line through log10(count) against log10(bin centre).

    Bins are even in log10, empty ones are dropped, and a count n weighs n
    (error 1 / sqrt(n)).  One row; only the binned counts are summed.
    """
    # The centre of a bin is the mean of its two edges, not of their logarithms.
    left = "pow(10D, lo + bin * size)"
    points = _binned(df, column, None, bins, True, ()).selectExpr(
        "double(n) AS w", "log10(n) AS y", f"log10({left} * (1 + pow(10D, size)) / 2) AS x"
    )
    # At most `bins` rows here: centre before squaring, and sum the squared residuals themselves.
    whole = Window.partitionBy()
    w, x, y = F.col("w"), F.col("x"), F.col("y")
    centred = points.withColumns({"mx": F.sum(w * x).over(whole) / F.sum(w).over(whole), "my": F.sum(w * y).over(whole) / F.sum(w).over(whole)})
    dx, dy = x - F.col("mx"), y - F.col("my")
    slope = F.try_divide(F.sum(w * dx * dy).over(whole), F.sum(w * dx * dx).over(whole))
    fitted = centred.withColumn("slope", slope).withColumn("residual", dy - F.col("slope") * dx)
    return fitted.agg(
        F.max("slope").alias("slope"), F.max(F.col("my") - F.col("slope") * F.col("mx")).alias("intercept"),
        F.sum(w * F.col("residual") ** 2).alias("chi2"), (F.count(F.lit(1)) - 2).alias("dof"),
    )


def chi2_tail(chi2: float, dof: int) -> float:
    """Probability of a larger chi-square; applied to the one row of a fit."""
    if dof <= 0 or chi2 <= 0:
        return 1.0
    a, x = dof / 2.0, chi2 / 2.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-15:
            n += 1
            term *= x / n
            total += term
        return 1.0 - front * total
    b, c = x + 1 - a, 1e300
    d = h = 1.0 / b
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1.0 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def with_p_value(fit: DataFrame) -> DataFrame:
    """Adds the probability of a larger chi-square to the rows of `power_law_fit`."""

    def add(frames):
        for frame in frames:
            frame["p_value"] = [chi2_tail(c, int(d)) for c, d in zip(frame["chi2"], frame["dof"])]
            yield frame

    return fit.mapInPandas(add, "slope double, intercept double, chi2 double, dof bigint, p_value double")


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Counts per value, most frequent first; ties by value."""
    out = df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.col(column))
    return out if top is None else out.limit(top)


def largest_events(pulses: DataFrame, top: int = 1) -> DataFrame:
    return value_counts(pulses, "event_no", top)


def nth_event(df: DataFrame, index: int, **scale) -> DataFrame:
    """All rows of the index-th (0-based) event in order of event number."""
    numbered = number_rows(df.select("event_no").distinct(), ["event_no"], name="_n", **scale)
    return df.join(numbered.where(F.col("_n") == index + 1).select("event_no"), "event_no", "left_semi")


def first_events(df: DataFrame, count: int) -> DataFrame:
    """All rows of the first `count` events in order of event number."""
    chosen = df.select("event_no").distinct().orderBy("event_no").limit(count)
    return df.join(chosen, "event_no", "left_semi")


def marker_scale(df: DataFrame, column: str, share: float = 0.8, by: Sequence[str] = ("event_no",), **scale) -> DataFrame:
    """(value - min) / (max - min) per event, and whether the value reaches the quantile."""
    keys = list(by)
    edges = df.groupBy(*keys).agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    limits = edges.join(exact_quantiles(df, column, [share], keys, **scale), keys, "left")
    scaled = F.try_divide(F.col(column) - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    return df.join(limits, keys, "inner").select(
        *df.columns, scaled.alias("marker"), (F.col(column) >= F.col("q0")).alias("bright")
    )


def numbered_bins(df: DataFrame, order_by: Sequence[str], size: int, **scale) -> DataFrame:
    """Fixed-size chunks of a globally ordered table."""
    return number_rows(df, order_by, name="_n", **scale).withColumn(
        "chunk", F.floor((F.col("_n") - 1) / size) + 1
    ).drop("_n")


def class_fractions(df: DataFrame, column: str, limits: Sequence[float]) -> DataFrame:
    """Share of rows below each limit."""
    return df.agg(*[F.avg((F.col(column) < limit).cast("double")).alias(f"below_{limit:g}") for limit in limits])


def busy_sensor_series(pulses: DataFrame, more_than: int, order_by: Sequence[str] = ("dom_time", "pulse_id")) -> DataFrame:
    """Pulses of (event, sensor) groups with more than the given number of pulses."""
    keys = ["event_no", "string", "dom_number"]
    busy = pulses.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_pulses")).where(F.col("n_pulses") > more_than)
    return pulses.join(busy, keys, "inner").select(*keys, "n_pulses", *order_by, "charge")


def busy_sensor_summary(pulses: DataFrame, more_than: int, stored: str = "pulse_id") -> DataFrame:
    """Statistics of the (event, sensor) groups with more than so many pulses.

    n_pulses; largest, least, median and mean charge and time; T10 and T50 with the pulses in order of time, Q25 and Q75
    counted from the pulse that was stored first; sigmaT.  Pulses of other sensors are left out before anything is sorted.
    """
    from pulsegrid.operators.summary import sensor_features

    keys = ["event_no", "string", "dom_number"]
    busy = pin(pulses.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > more_than).select(*keys))
    chosen = pulses.join(broadcast_checked(busy, busy.count()), keys, "left_semi")
    spread = [
        rule(F.col(column).cast("double")).alias(f"{name}_{short}")
        for column, short in (("charge", "charge"), ("dom_time", "time"))
        for name, rule in (("max", F.max), ("min", F.min), ("median", lambda c: F.percentile(c, 0.5)), ("mean", F.avg))
    ]
    plain = chosen.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_pulses"), *spread)
    by_time = sensor_features(chosen).select(*keys, "T10", "T50", "sigmaT")
    as_stored = sensor_features(chosen, order_by=(stored,)).select(*keys, "Q25", "Q75")
    return plain.join(by_time, keys).join(as_stored, keys)


def sensor_pulse_counts(pulses: DataFrame, event_index: int | None = None, more_than: int = 0) -> DataFrame:
    """Pulses of each sensor (of one event, by its place from 0) that has more than so many."""
    rows = pulses if event_index is None else nth_event(pulses, event_index)
    counts = rows.groupBy("event_no", "string", "dom_number").agg(F.count(F.lit(1)).alias("n_pulses"))
    return counts.where(F.col("n_pulses") > more_than)


def busy_sensors_per_event(pulses: DataFrame, more_than: int) -> DataFrame:
    """Number of sensors above a pulse count, per event that has any."""
    per_sensor = pulses.groupBy("event_no", "string", "dom_number").agg(F.expr("count(*) AS n_pulses"))
    return per_sensor.where(F.col("n_pulses") > more_than).groupBy("event_no").agg(
        F.expr("count(*) AS n_sensors"), F.expr("max(n_pulses) AS most_pulses")
    )
