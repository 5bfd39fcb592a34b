"""Column expressions about positions inside the instrumented volume."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Outline of the instrumented volume in x, y [m].
OUTLINE_XY = (
    (-256.14, -521.08), (-132.80, -501.45), (-9.13, -481.74), (114.39, -461.99),
    (237.78, -442.42), (361.0, -422.83), (405.83, -306.38), (443.60, -194.16),
    (500.43, -58.45), (544.07, 55.89), (576.37, 170.92), (505.27, 257.88),
    (429.76, 351.02), (338.44, 463.72), (224.58, 432.35), (101.04, 412.79),
    (22.11, 509.5), (-101.06, 490.22), (-224.09, 470.86), (-347.88, 451.52),
    (-392.38, 334.24), (-437.04, 217.80), (-481.60, 101.39), (-526.63, -15.60),
    (-570.90, -125.14), (-492.43, -230.16), (-413.46, -327.27), (-334.80, -424.5),
)
# Vertical range [m] and base corners of the enclosing prism, clockwise.
Z_RANGE = (-512.82, 524.56)
PRISM_XY = (
    (269.70961549, 548.30058428), (576.36999512, 170.91999817), (361.0, -422.82998657),
    (-256.14001465, -521.08001709), (-570.90002441, -125.13999939), (-347.88000488, 451.51998901),
)
# End of fixed values.
PARALLEL = 1e-12


def _edges(corners):
    return list(zip(corners, corners[1:] + corners[:1]))


def _inside_outline(x: str, y: str) -> str:
    """Even-odd rule: an odd number of outline edges lies to the right of the point.

    The corners cut the y axis into bands; a point is compared only with the few
    edges that cross its band, found by halving.
    """
    levels = sorted({cy for _, cy in OUTLINE_XY})

    def crossings(low: float, high: float) -> str:
        terms = []
        for (ax, ay), (bx, by) in _edges(OUTLINE_XY):
            if min(ay, by) <= low and high <= max(ay, by):
                terms.append(f"int({x} < {(bx - ax) / (by - ay)!r}D * ({y} - {ay}D) + {ax}D)")
        return f"({' + '.join(terms)}) % 2 = 1"

    def search(first: int, last: int) -> str:
        if last - first == 1:
            return crossings(levels[first], levels[last])
        middle = (first + last) // 2
        return f"IF({y} < {levels[middle]}D, {search(first, middle)}, {search(middle, last)})"

    return f"({y} >= {levels[0]}D AND {y} < {levels[-1]}D AND {search(0, len(levels) - 1)})"


def bound(name: str, value: str, use: str) -> str:
    """SQL of `use`, in which `name` stands for `value`, computed once per row.

    Catalyst copies the definition of a column into every place that names it
    when it moves a filter below a projection.  The lambda keeps such copies
    small; written out, they exceed the size limit of generated methods.
    """
    return f"get(transform(array({value}), {name} -> {use}), 0)"


def within_detector(x: str, y: str, z: str) -> Column:
    """1 if the point is inside outline and vertical range, else 0; 0 for nulls."""
    held = f"int({_inside_outline('p.x', 'p.y')} AND p.z BETWEEN {Z_RANGE[0]}D AND {Z_RANGE[1]}D)"
    return F.expr(f"coalesce({bound('p', f'named_struct(\'x\', {x}, \'y\', {y}, \'z\', {z})', held)}, 0)")


def prism_planes() -> list[tuple[float, float, float, float]]:
    """Outward unit normal and offset of each bounding plane: n . p <= offset inside."""
    planes = [(0.0, 0.0, 1.0, Z_RANGE[1]), (0.0, 0.0, -1.0, -Z_RANGE[0])]
    for (ax, ay), (bx, by) in _edges(PRISM_XY):
        nx, ny = -(by - ay), bx - ax  # left of a clockwise edge points outward
        norm = (nx * nx + ny * ny) ** 0.5
        planes.append((nx / norm, ny / norm, 0.0, (nx * ax + ny * ay) / norm))
    return planes


def _dot(factors: tuple[float, ...], names: tuple[str, str, str]) -> str:
    return "(" + " + ".join(f"{f!r}D * {n}" for f, n in zip(factors, names) if f) + ")"


def line_span(pos: tuple[str, str, str], direction: tuple[str, str, str]) -> str:
    """SQL of struct(t_in, t_out): where the line pos + t * direction runs through the prism.

    Clipping against the eight bounding planes of a convex body; null if the
    line misses it or has no direction.
    """
    planes = [
        f"named_struct('speed', {_dot(normal, direction)}, 'room', {offset!r}D - {_dot(normal, pos)})"
        for *normal, offset in prism_planes()
    ]
    start = "named_struct('t_in', double(NULL), 't_out', double(NULL), 'missed', false)"
    t = "try_divide(plane.room, plane.speed)"
    clip = f"""named_struct(
        't_in', CASE WHEN plane.speed < -{PARALLEL}D THEN greatest(span.t_in, {t}) ELSE span.t_in END,
        't_out', CASE WHEN plane.speed > {PARALLEL}D THEN least(span.t_out, {t}) ELSE span.t_out END,
        'missed', span.missed OR (abs(plane.speed) <= {PARALLEL}D AND plane.room < 0))"""
    checked = """CASE WHEN NOT span.missed AND span.t_in < span.t_out
        THEN named_struct('t_in', span.t_in, 't_out', span.t_out) END"""
    return f"aggregate(array({', '.join(planes)}), {start}, (span, plane) -> {clip}, span -> {checked})"


def segment_after_vertex(span: str, direction: tuple[str, str, str]) -> Column:
    """Path length inside the prism from the vertex on; 0 without one."""
    steps = "CASE WHEN s.t_in >= 0 THEN s.t_out - s.t_in WHEN s.t_out > 0 THEN s.t_out ELSE 0D END"
    length = "sqrt(" + " + ".join(f"{d} * {d}" for d in direction) + ")"
    return F.expr(f"coalesce({bound('s', span, steps)} * {length}, 0D)")


def crossing_points(span: str, pos: tuple[str, str, str], direction: tuple[str, str, str]) -> dict[str, Column]:
    """Where the line enters and leaves the prism, and how often it crosses its surface."""
    out = {"n_intersections": F.expr(f"IF({span} IS NULL, 0, 2)")}
    for end, t in (("entry", "s.t_in"), ("exit", "s.t_out")):
        for axis, p, d in zip("xyz", pos, direction):
            out[f"{end}_{axis}"] = F.expr(bound("s", span, f"{p} + {t} * {d}"))
    return out


def vertex_place(span: str) -> Column:
    """0: vertex before the prism, 1: inside it, 2: behind it; null if the line misses."""
    return F.expr(bound("s", span, "CASE WHEN s.t_in > 0 THEN 0 WHEN s.t_out >= 0 THEN 1 WHEN s.t_out < 0 THEN 2 END"))


# The cases of a line with a vertex, as (number of crossings, place of the vertex among them).
CROSSING_CASES = (
    ("NO_INTERSECTION", 0, 0), ("SINGLE_INTERSECTION", 1, 0), ("ENTRY_EXIT_VERTEX", 2, 0), ("ENTRY_VERTEX_EXIT", 2, 1), ("VERTEX_ENTRY_EXIT", 2, 2),
)
# End of fixed values.
TOUCH = 1e-9


def face_names() -> list[str]:
    """Names of the bounding planes in the order of `prism_planes`."""
    return ["top", "bottom", *[f"side_{i}" for i in range(len(PRISM_XY))]]


def face_crossings(pos: tuple[str, str, str], direction: tuple[str, str, str]) -> str:
    """SQL of array<struct(t, face)>: where the line pos + t * direction meets the surface of the prism, in order of t.

    A plane is crossed where its point lies within all other planes, `TOUCH` metres of tolerance included.  At an edge
    or corner several faces meet: the first of them stands for the point.  Null without a vertex or direction.
    """
    planes = prism_planes()
    cells = [
        f"named_struct('t', try_divide({offset!r}D - {_dot(normal, pos)}, {_dot(normal, direction)}), 'face', {i})"
        for i, (*normal, offset) in enumerate(planes)
    ]
    rooms = ", ".join(f"named_struct('room', {offset!r}D - {_dot(normal, pos)}, 'speed', {_dot(normal, direction)})" for *normal, offset in planes)
    speeds = f"array({rooms})"
    on = f"forall(planes, p -> p.room - c.t * p.speed >= -{TOUCH}D)"
    moving = f"abs(planes[c.face].speed) > {PARALLEL}D"
    found = f"array_sort(filter(array({', '.join(cells)}), c -> c.t IS NOT NULL AND {moving} AND {on}))"
    # Neighbours in order of t that are one point: the first stays.
    length = "sqrt(" + " + ".join(f"{d} * {d}" for d in direction) + ")"
    once = f"filter(crossed, (m, i) -> i = 0 OR (m.t - crossed[i - 1].t) * {length} > {TOUCH}D)"
    return f"CASE WHEN {length} > 0 THEN {bound('planes', speeds, bound('crossed', found, once))} END"


def crossing_case(n: str, t_first: str, t_last: str) -> str:
    """SQL of the case: how often the line crosses and where the vertex (t = 0) stands among the crossings, counted from the entry."""
    place = f"CASE WHEN {t_first} > 0 THEN 2 WHEN {t_last} >= 0 THEN 1 ELSE 0 END"
    whens = " ".join(f"WHEN {n} = {count} AND {'true' if count < 2 else f'({place}) = {order}'} THEN '{name}'" for name, count, order in CROSSING_CASES)
    return f"CASE {whens} END"


def opening_angle(first: tuple[Column, Column, Column], second: tuple[Column, Column, Column]) -> Column:
    """Angle between two unit vectors in degrees; rounding beyond 1 is clamped."""
    dot = first[0] * second[0] + first[1] * second[1] + first[2] * second[2]
    return F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot))))


def horizontal_radius(x: Column, y: Column) -> Column:
    return F.sqrt(x * x + y * y)


def interior_flag(x: Column, y: Column, z: Column, radius: float = 2500.0, half_height: float = 2500.0) -> Column:
    return (horizontal_radius(x, y) < radius) & (z > -half_height) & (z < half_height)


def corner_of_lines(a: tuple, b: tuple, c: tuple, d: tuple) -> tuple[float, float] | None:
    """Intersection of line a-b with line c-d in the plane; None if parallel."""
    ux, uy, vx, vy = b[0] - a[0], b[1] - a[1], d[0] - c[0], d[1] - c[1]
    det = ux * vy - uy * vx
    if abs(det) < PARALLEL:
        return None
    s = ((c[0] - a[0]) * vy - (c[1] - a[1]) * vx) / det
    return a[0] + s * ux, a[1] + s * uy


def polygon_area(corners) -> float:
    return abs(sum(ax * by - bx * ay for (ax, ay), (bx, by) in _edges(tuple(corners)))) / 2


def convex_outline() -> list[tuple[float, float]]:
    """Corners of the convex hull of the outline (driver-side, 28 fixed points)."""
    points = sorted(OUTLINE_XY)

    def half(ordered):
        kept: list[tuple[float, float]] = []
        for p in ordered:
            while len(kept) > 1 and (
                (kept[-1][0] - kept[-2][0]) * (p[1] - kept[-2][1])
                - (kept[-1][1] - kept[-2][1]) * (p[0] - kept[-2][0])
            ) <= 0:
                kept.pop()
            kept.append(p)
        return kept[:-1]

    return half(points) + half(points[::-1])


OUTLINE_AREA = polygon_area(convex_outline())
