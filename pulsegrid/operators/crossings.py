"""Lines through the instrumented volume, one row per crossed face."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from pulsegrid.functions import geometry as geo

Axes = tuple[str, str, str]


def prism_face_crossings(rows: DataFrame, pos: Axes, direction: Axes, keep: Sequence[str] = ("event_no",)) -> DataFrame:
    """The columns `keep` with one row for each face of the prism that the line through the vertex crosses.

    place (1: first along the line), face, t (in units of the direction), x, y, z of the point, n_crossings,
    crossing_case by the vertex's place among the crossings, and behind_vertex (1: reached after the vertex).
    A line that misses the prism, or an event without vertex or direction, has one row without a face.
    """
    found = rows.selectExpr(*keep, *[f"double({p}) AS _p{a}" for a, p in zip("xyz", pos)], *[f"double({d}) AS _d{a}" for a, d in zip("xyz", direction)])
    crossed = geo.face_crossings(("_px", "_py", "_pz"), ("_dx", "_dy", "_dz"))
    found = found.selectExpr("*", f"coalesce({crossed}, array()) AS _c")
    case = geo.crossing_case("size(_c)", "_c[0].t", "element_at(_c, -1).t")
    each = found.selectExpr(*keep, "_px", "_py", "_pz", "_dx", "_dy", "_dz", "size(_c) AS n_crossings", f"IF(size(_c) = 0, 'NO_INTERSECTION', {case}) AS crossing_case", "posexplode_outer(_c) AS (i, c)")
    names = ", ".join(f"'{n}'" for n in geo.face_names())
    return each.selectExpr(
        *keep, "i + 1 AS place", f"CASE WHEN i IS NOT NULL THEN element_at(array({names}), c.face + 1) END AS face", "c.t AS t",
        *[f"_p{a} + c.t * _d{a} AS {a}" for a in "xyz"], "n_crossings", "crossing_case", "int(c.t > 0) AS behind_vertex",
    )
