"""Column names, types and default values of the tables this package produces."""

from __future__ import annotations

from enum import Enum

from pyspark.sql import DataFrame
from pyspark.sql import types as T

FIRST_K = 5
NOT_ENOUGH_PULSES = -1.0
SENSOR_KEYS = ("event_no", "string", "dom_number")


class SummaryMode(Enum):
    """How many features a sensor row carries."""

    CLASSIC = 0
    SECOND = 1
    EQUINOX = 2


# Output columns of the sensor summary, in order.
_SUMMARY_CLASSIC = """
event_no int
dom_x float
dom_y float
dom_z float
dom_x_rel float
dom_y_rel float
dom_z_rel float
pmt_area float
rde float
saturation_status int
bad_dom_status int
bright_dom_status int
q1 float
q2 float
q3 float
q4 float
q5 float
Q25 float
Q75 float
Qtotal float
hlc1 int
hlc2 int
hlc3 int
hlc4 int
hlc5 int
t1 float
t2 float
t3 float
t4 float
t5 float
T10 float
T50 float
sigmaT float
"""
_SUMMARY_LATE = """
t_qmax float
t_qmax_secondhalf float
Q_halftime float
T70 float
T90 float
"""
_SUMMARY_SHAPE = """
eccentricity_PCA float
aspect_contrast_PCA float
hypotenuse float
"""

# Truth columns, their type and the value that replaces null or NaN
# ("-" = none; first line of a side table = its own event number).
_TRUTH = """
event_no int -
subdirectory_no int -
part_no int -
shard_no int -
N_doms int -
offset int -
energy float -
azimuth float -
zenith float -
pid int -
position_x float -
position_y float -
position_z float -
event_time float -
interaction_type int -
elasticity float -
RunID bigint -
SubrunID bigint -
EventID int -
SubEventID int -
dbang_decay_length float -
track_length float -
stopped_muon int -
energy_track float -
energy_cascade float -
inelasticity float -
DeepCoreFilter_13 int -
CascadeFilter_13 int -
MuonFilter_13 int -
OnlineL2Filter_17 int -
L3_oscNext_bool int -
L4_oscNext_bool int -
L5_oscNext_bool int -
L6_oscNext_bool int -
L7_oscNext_bool int -
Homogenized_QTot float -
MCLabelClassification int -
MCLabelCoincidentMuons int -
MCLabelBgMuonMCPE int -
MCLabelBgMuonMCPECharge int -
"""
_GN_LABEL = """
GNLabelTrackEnergyDeposited float -1
GNLabelTrackEnergyOnEntrance float -1
GNLabelTrackEnergyOnEntrancePrimary float -1
GNLabelTrackEnergyDepositedPrimary float -1
GNLabelEnergyPrimary float -1
GNLabelCascadeEnergyDepositedPrimary float -1
GNLabelCascadeEnergyDeposited float -1
GNLabelEnergyDepositedTotal float -1
GNLabelEnergyDepositedPrimary float -1
GNLabelHighestEInIceParticleIsChild int -1
GNLabelHighestEInIceParticleDistance float -1e8
GNLabelHighestEInIceParticleEFraction float -1
GNLabelHighestEDaughterDistance float -1e8
GNLabelHighestEDaughterEFraction float -1
"""
_PARTICLE = """
zenith float -1
azimuth float -1
dir_x float 0
dir_y float 0
dir_z float 0
pos_x float -1e8
pos_y float -1e8
pos_z float -1e8
time float -1
speed float -1
energy float -1
"""
_WEIGHTS = """
BjorkenX float -1e8
BjorkenY float -1e8
CylinderHeight float -1
CylinderRadius float -1
DirectionWeight float -1
EnergyLost float -1
ImpactParam float -1
InIceNeutrinoEnergy float -1
InIceNeutrinoType int -1
InjectionAreaCGS float -1
InjectionCylinderHeight float -1
InjectionCylinderRadius float -1
InjectionOrigin_x float -1
InjectionOrigin_y float -1
InjectionOrigin_z float -1
InteractionColumnDepthCGS float -1
InteractionPositionWeight float -1
InteractionType int -1
InteractionTypeWeight float -1
InteractionWeight float -1
InteractionXsectionCGS float -1
LengthInVolume float -1
MaxAzimuth float -1
MaxEnergyLog float -1
MaxZenith float -1
MinAzimuth float -1
MinEnergyLog float -1
MinZenith float -1
NEvents float -1
NInIceNus float -1
OneWeight float -1
OneWeightPerType float -1
PowerLawIndex float -1
PrimaryNeutrinoAzimuth float -1
PrimaryNeutrinoEnergy float -1
PrimaryNeutrinoType int -1
PrimaryNeutrinoZenith float -1
PropagationWeight float -1
RangeInMWE float -1
RangeInMeter float -1
SelectionWeight float -1
SimMode int -1
SolidAngle float -1
TotalColumnDepthCGS float -1
TotalPrimaryWeight float -1
TotalWeight float -1
TotalXsectionCGS float -1
TrueActiveLengthAfter float -1
TrueActiveLengthBefore float -1
TypeWeight float -1
"""
# End of fixed values.


def _pairs(text: str) -> list[tuple[str, str]]:
    return [tuple(line.split()[:2]) for line in text.strip().splitlines()]


def _side(text: str, suffix: str = "") -> dict[str, tuple[str, float]]:
    out = {}
    for line in text.strip().splitlines():
        name, kind, default = line.split()
        out[f"{name}{suffix}"] = (kind, float(default))
    return out


TRUTH_COLUMNS = dict(_pairs(_TRUTH))
# Side tables in the order in which their columns follow the truth columns.
SIDE_TABLES: dict[str, dict[str, tuple[str, float]]] = {
    "labels": _side(_GN_LABEL),
    "inice": _side(_PARTICLE, "_GNHighestEInIceParticle"),
    "daughter": _side(_PARTICLE, "_GNHighestEDaughter"),
    "weights": _side(_WEIGHTS),
}
DERIVED_TRUTH = {
    "max_interPMT_distance": "float",
    "isWithinIceCube": "int",
    "post_vertex_intraIceCube_segment": "float",
}
TRUTH_WIDTH = len(TRUTH_COLUMNS) + sum(len(s) for s in SIDE_TABLES.values()) + len(DERIVED_TRUTH) + 1


def summary_columns(mode: SummaryMode) -> list[tuple[str, str]]:
    columns = _pairs(_SUMMARY_CLASSIC)
    if mode is SummaryMode.EQUINOX:
        columns += _pairs(_SUMMARY_LATE)
    if mode is not SummaryMode.CLASSIC:
        columns += _pairs(_SUMMARY_SHAPE)
    return columns


def cast_to(df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """Project to declared names and types; done once, at the sink."""
    return df.selectExpr(*[f"CAST(`{name}` AS {kind}) AS `{name}`" for name, kind in columns])


def filled(source: str, kind: str, default: float, name: str) -> str:
    """SQL replacing null and NaN by `default`, in the declared type."""
    if kind in ("float", "double"):
        return f"CAST(nanvl(coalesce(double({source}), {default}D), {default}D) AS {kind}) AS `{name}`"
    return f"coalesce(CAST({source} AS {kind}), {int(default)}) AS `{name}`"


GEOMETRY = T.StructType(
    [
        T.StructField("string", T.IntegerType()),
        T.StructField("dom_number", T.IntegerType()),
        T.StructField("dom_x", T.DoubleType()),
        T.StructField("dom_y", T.DoubleType()),
        T.StructField("dom_z", T.DoubleType()),
    ]
)
N_STRINGS = 86
DOMS_PER_STRING = 60
