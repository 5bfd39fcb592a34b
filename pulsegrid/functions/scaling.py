"""Feature scalings used before plotting and shape analysis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Scale factors.
TIME_SHIFT = 1e4
TIME_SCALE = 3e-4
CHARGE_SHIFT = 2.0
POSITION_SCALE = 2e-3
POSITION_UNIT = 500.0
CHARGE_FLOOR = 1e-9
LAZY_EPSILON = 1e-10
OLD_TIME_SCALE = 1e-3
# End of fixed values.
POSITIONS = ("dom_x", "dom_y", "dom_z", "dom_x_rel", "dom_y_rel", "dom_z_rel")
READOUTS = ("q1", "q2", "q3", "q4", "q5")
TOTALS = ("Q25", "Q75", "Qtotal")
ARRIVALS = ("t1", "t2", "t3")
SPREADS = ("T10", "T50", "sigmaT")


def adjusted_charge_sql(charge: str) -> str:
    """log10 of the charge, floored, minus two."""
    return f"(log10(greatest({charge}, {CHARGE_FLOOR}D)) - {CHARGE_SHIFT}D)"


def adjusted_charge(charge: Column) -> Column:
    return F.log10(F.greatest(charge, F.lit(CHARGE_FLOOR))) - CHARGE_SHIFT


def log10_signed(value: Column) -> Column:
    """log10 as arrays have it: minus infinity at zero and not a number below, where Spark's gives null."""
    return F.when(value == 0, F.lit(float("-inf"))).when(value < 0, F.lit(float("nan"))).otherwise(F.log10(value))


def _replace(df: DataFrame, changes: dict[str, Column]) -> DataFrame:
    return df.select(*[changes.get(c, F.col(c)).alias(c) for c in df.columns])


def pseudo_normalised(df: DataFrame) -> DataFrame:
    """Scales every known column that is present; -1 markers are not protected."""
    changes = {c: F.col(c) * POSITION_SCALE for c in POSITIONS}
    changes |= {c: adjusted_charge(F.col(c)) for c in (*READOUTS, *TOTALS)}
    changes |= {c: (F.col(c) - TIME_SHIFT) * TIME_SCALE for c in ARRIVALS}
    changes |= {c: F.col(c) * TIME_SCALE for c in SPREADS}
    return _replace(df, changes)


def lazily_normalised(df: DataFrame, time_scale: float = TIME_SCALE, epsilon: float = LAZY_EPSILON) -> DataFrame:
    """Scales only measured values: -1 markers stay -1."""

    def kept(name: str, value: Column) -> Column:
        return F.when(F.col(name) != -1, value).otherwise(F.col(name))

    changes = {c: F.col(c) / POSITION_UNIT for c in POSITIONS}
    changes |= {c: kept(c, (F.col(c) - TIME_SHIFT) * time_scale) for c in ARRIVALS}
    changes |= {c: kept(c, log10_signed(F.col(c) + epsilon)) for c in READOUTS[:3]}
    changes |= {c: kept(c, log10_signed(F.col(c) + epsilon) - CHARGE_SHIFT) for c in TOTALS}
    changes |= {c: kept(c, F.col(c) * time_scale) for c in SPREADS}
    return _replace(df, changes)


def formerly_normalised(df: DataFrame) -> DataFrame:
    """The older variant: coarser time scale and no epsilon below the logarithm, so no charge gives minus infinity."""
    return lazily_normalised(df, OLD_TIME_SCALE, 0.0)


def repeat_weight(weight: Column, largest: Column) -> Column:
    """Weight quantised to 1..10 relative to the largest."""
    return F.greatest(F.lit(1.0), F.least(F.lit(10.0), weight / (largest + 1e-7) * 10)).cast("int")


def size_in(value: Column, unit: str) -> Column:
    return value / {"KB": 1024.0, "MB": 1024.0**2, "GB": 1024.0**3}[unit]


def duration_text(seconds: Column) -> Column:
    """Seconds as '1h 2m 3s'."""
    whole = F.floor(seconds).cast("long")
    return F.format_string("%dh %dm %ds", F.floor(whole / 3600), F.floor(whole % 3600 / 60), whole % 60)
