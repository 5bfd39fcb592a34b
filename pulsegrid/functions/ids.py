"""Event-number encodings and dataset lookups as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIGNAL, NOISE = "Snowstorm", "Corsika"
SOURCE_TAGS = {SIGNAL: 1, NOISE: 2}

# Dataset number -> (energy range, flavour).
DATASETS = {
    "22010": ("100GeV-10TeV", "nu_mu"),
    "22011": ("10TeV-1PeV", "nu_mu"),
    "22012": ("1PeV-100PeV", "nu_mu"),
    "22013": ("100GeV-10TeV", "nu_e"),
    "22014": ("10TeV-1PeV", "nu_e"),
    "22015": ("1PeV-100PeV", "nu_e"),
    "22016": ("100GeV-10TeV", "nu_tau"),
    "22017": ("10TeV-1PeV", "nu_tau"),
    "22018": ("1PeV-100PeV", "nu_tau"),
    "22031": ("100TeV-100PeV", "nu_mu"),
    "22032": ("100TeV-100PeV", "nu_e"),
    "22033": ("100TeV-100PeV", "nu_tau"),
}
# Flavour -> (particle code, LaTeX).
FLAVOURS = {"nu_e": (12, r"\nu_e"), "nu_mu": (14, r"\nu_\mu"), "nu_tau": (16, r"\nu_\tau")}
# End of fixed values.


def source_tag(source: str) -> int:
    return SOURCE_TAGS.get(source, 0)


def dataset_tag(name: Column, source: str) -> Column:
    """Short tag of a dataset folder: its last two digits, or for ranges the
    fourth and fifth digit of both ends."""
    if source == NOISE:
        ends = F.split(name, "-")
        return F.concat(*[F.substring(F.get(ends, F.lit(i)), 4, 2) for i in (0, 1)]).cast("int")
    return F.right(name, F.lit(2)).cast("int")


def dataset_tag_number(name: str, source: str) -> int:
    """`dataset_tag` of one known folder name."""
    if source == NOISE:
        return int("".join(end[3:5] for end in name.split("-")))
    return int(name[-2:])


def _append(prefix: Column, value: Column, width: int) -> Column:
    """prefix followed by value, zero-padded to at least `width` digits."""
    digits = F.greatest(F.lit(width), F.length(value.cast("string")))
    return prefix * F.pow(F.lit(10.0), digits).cast("long") + value.cast("long")


def enhanced_event_no(tag: int, dataset: Column, part: Column, event: Column) -> Column:
    """tag, dataset, part and event number written one after another, as one long."""
    out = _append(F.lit(tag).cast("long"), dataset, 2)
    out = _append(out, part, 4)
    return _append(out, event, 8)


def decoded_event_no(event_no: Column) -> dict[str, Column]:
    """Inverse for two-digit dataset tags: dataset number, part, original event."""
    text = event_no.cast("string")
    return {
        "subdir": F.concat(F.lit("220"), F.substring(text, 2, 2)),
        "part_no": F.substring(text, 4, 4).cast("int"),
        "original_event_no": F.substring(text, 8, 20).cast("int"),
    }


def shifted_event_no(dataset: Column, event: Column, bits: int = 24) -> Column:
    return F.shiftleft(dataset.cast("long"), bits).bitwiseOR(event.cast("long"))


def _lookup(pairs: dict[str, str | int], key: Column) -> Column:
    cells = [F.lit(v) for pair in pairs.items() for v in pair]
    return F.create_map(*cells)[key]


def energy_range(dataset: Column) -> Column:
    return _lookup({k: v[0] for k, v in DATASETS.items()}, dataset)


def flavour(dataset: Column) -> Column:
    return _lookup({k: v[1] for k, v in DATASETS.items()}, dataset)


def dataset_of(energy: Column, flavour_name: Column) -> Column:
    return _lookup({f"{v[0]}|{v[1]}": k for k, v in DATASETS.items()}, F.concat_ws("|", energy, flavour_name))


def particle_code(flavour_name: Column) -> Column:
    return _lookup({k: v[0] for k, v in FLAVOURS.items()}, flavour_name)
