"""Sensor positions: assignment of strings and sensors, completeness of the grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.operators.scan import broadcast_checked
from pulsegrid.runtime import pin
from pulsegrid.schema import DOMS_PER_STRING, N_STRINGS

BOX = (10.0, 10.0, 2.0)
STRING_TOLERANCE = 2.0


def _cell(value: Column | str, width: float) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.floor(column / F.lit(width)).cast("long")


def _spread_to_cells(reference: DataFrame, axes: list[str], widths: list[float]) -> DataFrame:
    """Copy each reference position into its own and all neighbouring grid cells.

    A partner within one cell width is then always found by equality of cells.
    """
    out = reference
    for axis, width in zip(axes, widths):
        steps = F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))
        out = out.withColumn("_step", steps).withColumn(f"_cell_{axis}", _cell(f"ref_{axis}", width) + F.col("_step"))
    return out.drop("_step")


def _cells_match(axes: list[str]) -> list[str]:
    return [f"_cell_{axis}" for axis in axes]


def _counted(found: DataFrame) -> DataFrame:
    """The table of distinct positions, written and counted: rows need not move if it is small."""
    found = pin(found)
    return broadcast_checked(found, found.count())


def assign_sensor(pulses: DataFrame, geometry: DataFrame, box: tuple[float, float, float] = BOX) -> DataFrame:
    """Add string and dom_number of the first reference sensor within the box, else null.

    The range join runs on distinct positions and on grid cells, as an equality
    join; pulses then join the small position table.
    """
    axes = ["dom_x", "dom_y", "dom_z"]
    reference = geometry.select(
        F.col("string"), F.col("dom_number"), *[F.col(a).alias(f"ref_{a}") for a in axes]
    )
    near = _spread_to_cells(reference, axes, list(box))
    places = pulses.select(*axes).distinct()
    for axis, width in zip(axes, box):
        places = places.withColumn(f"_cell_{axis}", _cell(axis, width))
    met = places.join(near, _cells_match(axes), "inner")
    for axis, width in zip(axes, box):
        met = met.where(F.abs(F.col(axis) - F.col(f"ref_{axis}")) <= width)
    found = met.groupBy(*axes).agg(F.min(F.struct("string", "dom_number")).alias("_sensor"))
    rows = pulses.drop("string", "dom_number").join(_counted(found), axes, "left")
    return rows.select(
        *[c for c in rows.columns if c != "_sensor"],
        F.col("_sensor.string").alias("string"),
        F.col("_sensor.dom_number").alias("dom_number"),
    )


def assign_string(doms: DataFrame, geometry: DataFrame, tolerance: float = STRING_TOLERANCE) -> DataFrame:
    """Add the string of the nearest reference sensor in x, y within the tolerance, else null."""
    axes = ["dom_x", "dom_y"]
    reference = geometry.select("string", *[F.col(a).alias(f"ref_{a}") for a in axes]).distinct()
    near = _spread_to_cells(reference, axes, [tolerance] * 2)
    places = doms.select(*axes).distinct()
    for axis in axes:
        places = places.withColumn(f"_cell_{axis}", _cell(axis, tolerance))
    met = places.join(near, _cells_match(axes), "inner").withColumn(
        "_gap", F.sqrt((F.col("dom_x") - F.col("ref_dom_x")) ** 2 + (F.col("dom_y") - F.col("ref_dom_y")) ** 2)
    )
    found = (
        met.where(F.col("_gap") <= tolerance)
        .groupBy(*axes)
        .agg(F.min_by("string", F.struct("_gap", "string")).alias("string"))
    )
    return doms.drop("string").join(_counted(found), axes, "left")


def unique_sensors(pulses: DataFrame) -> DataFrame:
    """Position of each sensor; ties between records resolved by the smallest."""
    place = F.min(F.struct("dom_x", "dom_y", "dom_z")).alias("_p")
    return pulses.groupBy("string", "dom_number").agg(place).select("string", "dom_number", "_p.*")


def full_grid(spark: SparkSession) -> DataFrame:
    """All (string, dom_number) pairs of the detector: a fixed 86 x 60 rows."""
    cell = F.col("id")
    return spark.range(N_STRINGS * DOMS_PER_STRING).select(
        (F.floor(cell / DOMS_PER_STRING) + 1).cast("int").alias("string"),
        (cell % DOMS_PER_STRING + 1).cast("int").alias("dom_number"),
    )


def missing_sensors(sensors: DataFrame) -> DataFrame:
    present = sensors.select("string", "dom_number").distinct()
    return full_grid(sensors.sparkSession).join(present, ["string", "dom_number"], "left_anti")


def table_differences(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows found in one table only, with the side they come from."""
    names = first.columns
    sides = first.select(*names, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        second.select(*names, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    counted = sides.groupBy(*names).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    return counted.where(F.col("_a") != F.col("_b")).select(
        *names, F.when(F.col("_a") == 1, "first").otherwise("second").alias("only_in")
    )


def tables_equal(first: DataFrame, second: DataFrame) -> bool:
    """Same rows with the same multiplicities, in any order; one shuffle of counts."""
    names = first.columns
    if sorted(names) != sorted(second.columns):
        return False
    signed = first.withColumn("_n", F.lit(1)).unionByName(second.withColumn("_n", F.lit(-1)))
    return signed.groupBy(*names).agg(F.sum("_n").alias("_n")).where("_n != 0").isEmpty()


def completed_geometry(sensors: DataFrame) -> DataFrame:
    """Add missing sensors to known strings, z interpolated or extrapolated.

    Windows run over the 60 sensors of a string.
    """
    known = sensors.select("string", "dom_number", "dom_x", "dom_y", "dom_z")
    grid = (
        full_grid(sensors.sparkSession)
        .join(known.select("string").distinct(), "string", "left_semi")
        .join(known, ["string", "dom_number"], "left")
    )
    here = F.when(F.col("dom_z").isNotNull(), F.struct(F.col("dom_number").alias("d"), F.col("dom_z").alias("z")))
    line = Window.partitionBy("string").orderBy("dom_number")
    before = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = line.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy("string")
    marked = grid.withColumn("_here", here).select(
        "string",
        "dom_number",
        "dom_z",
        F.first("dom_x", ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("dom_x"),
        F.first("dom_y", ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("dom_y"),
        F.last("_here", ignorenulls=True).over(before).alias("_lo"),
        F.first("_here", ignorenulls=True).over(after).alias("_hi"),
        F.sort_array(F.collect_list("_here").over(whole)).alias("_all"),  # at most 60
    )
    number, count = F.col("dom_number"), F.size("_all")
    first, second = F.get("_all", F.lit(0)), F.get("_all", F.lit(1))
    last, prior = F.get("_all", count - 1), F.get("_all", count - 2)

    def beyond(edge: Column, inner: Column) -> Column:
        slope = F.try_divide(edge["z"] - inner["z"], F.abs(edge["d"] - inner["d"]))
        return edge["z"] + slope * F.abs(number - edge["d"])

    share = F.try_divide((number - F.col("_lo.d")), (F.col("_hi.d") - F.col("_lo.d")))
    guess = (
        F.when(F.col("_lo").isNull(), beyond(first, second))
        .when(F.col("_hi").isNull(), beyond(last, prior))
        .otherwise(F.col("_lo.z") + share * (F.col("_hi.z") - F.col("_lo.z")))
    )
    filled = F.when(F.col("dom_z").isNull(), F.round(guess, 2)).otherwise(F.col("dom_z"))
    return marked.select("string", "dom_number", "dom_x", "dom_y", filled.alias("dom_z"))


def activation_grid(pulses: DataFrame) -> DataFrame:
    """Dense counts on the sensor grid: row 60 - dom_number, column string - 1."""
    counts = (
        pulses.where(F.col("string").between(1, N_STRINGS) & F.col("dom_number").between(1, DOMS_PER_STRING))
        .groupBy("string", "dom_number")
        .count()
    )
    return (
        full_grid(pulses.sparkSession)
        .join(counts, ["string", "dom_number"], "left")
        .select(
            (F.lit(DOMS_PER_STRING) - F.col("dom_number")).alias("grid_row"),
            (F.col("string") - 1).alias("grid_column"),
            F.coalesce("count", F.lit(0)).cast("long").alias("n_pulses"),
        )
    )


def event_activation(pulses: DataFrame) -> DataFrame:
    """Counts on the sensor grid of each event; cells without pulses are left out."""
    on_grid = pulses.where(F.col("string").between(1, N_STRINGS) & F.col("dom_number").between(1, DOMS_PER_STRING))
    return on_grid.groupBy(
        "event_no",
        (F.lit(DOMS_PER_STRING) - F.col("dom_number")).alias("grid_row"),
        (F.col("string") - 1).alias("grid_column"),
    ).agg(F.expr("count(*) AS n_pulses"))


def sensor_counts(pulses: DataFrame, least_share: float = 0.7) -> DataFrame:
    """Pulses per sensor relative to the busiest one; keeps the busiest sensors."""
    counts = pulses.groupBy("string", "dom_number").agg(
        F.count(F.lit(1)).alias("n_pulses"), F.min(F.struct("dom_x", "dom_y", "dom_z")).alias("_p")
    )
    top = counts.agg(F.max("n_pulses")).scalar()
    share = F.col("n_pulses") / top
    return counts.select("string", "dom_number", "n_pulses", "_p.*", share.alias("share")).where(
        F.col("share") > least_share
    )
