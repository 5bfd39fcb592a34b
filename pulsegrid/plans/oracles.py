"""Independent SQL for every registered query that plain SQL can express."""

from __future__ import annotations

from pulsegrid.functions.scaling import CHARGE_FLOOR, CHARGE_SHIFT
from pulsegrid.plans.fixtures import STRING_X, STRING_Y
from pulsegrid.schema import SIDE_TABLES


def _case(values, index="string"):
    return "CASE " + index + " " + " ".join(f"WHEN {i} THEN {float(v)}" for i, v in enumerate(values, 1)) + " END"


_SENSOR = f"""
       CAST({_case(STRING_X)} AS DOUBLE) AS dom_x, CAST({_case(STRING_Y)} AS DOUBLE) AS dom_y,
       CAST(500 - 17 * dom_number - string AS DOUBLE) AS dom_z,
       CAST(0.0444 AS DOUBLE) AS pmt_area,
       CAST(CASE WHEN string % 2 = 1 THEN 1.35 ELSE 1.0 END AS DOUBLE) AS rde,
       CAST(dom_number = 3 AND string = 4 AS INTEGER) AS is_saturated_dom,
       CAST(dom_number = 1 AND string = 2 AS INTEGER) AS is_bad_dom,
       CAST(dom_number = 2 AND string = 5 AS INTEGER) AS is_bright_dom
"""
PULSES = f"""
pulses_raw AS (
  SELECT event_id AS pulse_id, CAST(user_id AS INTEGER) AS event_no,
         CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3
              WHEN 'error' THEN 4 ELSE 5 END AS INTEGER) AS string,
         CAST(event_id % 3 + 1 AS INTEGER) AS dom_number,
         CAST(epoch_us(ts) - 1704067200000000 AS DOUBLE) / CAST(3600000000.0 AS DOUBLE) AS dom_time,
         CAST(value AS DECIMAL(12,2)) AS charge, CAST(event_id % 2 AS INTEGER) AS hlc
  FROM events),
pulses AS (SELECT *, {_SENSOR} FROM pulses_raw)"""


def hits(event: str = "l_orderkey") -> str:
    return f"""
hits_raw AS (
  SELECT CAST({event} AS INTEGER) AS event_no, l_linenumber AS string,
         CAST(l_partkey % 5 + 1 AS INTEGER) AS dom_number,
         CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE) AS dom_time,
         CAST(l_quantity AS DECIMAL(12,2)) AS charge, CAST(l_quantity AS INTEGER) % 2 AS hlc,
         l_partkey AS part_key, l_orderkey AS order_key, l_extendedprice AS price, l_discount AS discount, l_tax AS tax
  FROM lineitem),
hits AS (SELECT *, {_SENSOR} FROM hits_raw)"""


TRUTH = """
truth AS (
  SELECT CAST(o_orderkey AS INTEGER) AS event_no, 22012 AS subdirectory_no,
         CAST(o_orderkey % 3 + 1 AS INTEGER) AS part_no, o_totalprice AS energy,
         CAST(CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 0 END AS INTEGER) AS InteractionType,
         CAST(o_orderkey % 2 AS INTEGER) AS MuonFilter_13,
         CAST(2201200000 + o_custkey % 1000 AS BIGINT) AS RunID, CAST(o_orderkey AS INTEGER) AS EventID,
         CAST(o_custkey % 32 AS DOUBLE) / 10.0 AS zenith, CAST(o_custkey % 63 AS DOUBLE) / 10.0 AS azimuth,
         CASE o_orderstatus WHEN 'O' THEN 'nu_e' WHEN 'F' THEN 'nu_mu' ELSE 'nu_tau' END AS flavour
  FROM orders)"""
DAUGHTER = """
daughter AS (
  SELECT CAST(o_orderkey AS INTEGER) AS event_no, c_acctbal / 10.0 - 450 AS px,
         CAST(c_custkey * 37 % 1100 - 550 AS DOUBLE) AS py, CAST(c_custkey * 53 % 1200 - 600 AS DOUBLE) AS pz,
         CAST(c_custkey % 7 - 3 AS DOUBLE) AS dx, CAST(c_custkey % 5 - 2 AS DOUBLE) AS dy,
         CAST(c_custkey % 3 - 1 AS DOUBLE) AS dz,
         CASE WHEN c_custkey % 4 = 0 THEN CAST('NaN' AS DOUBLE) ELSE c_acctbal END AS e
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal >= 0)"""
CLEAN_IDS = """
listing AS (
  SELECT CAST(2201200000 + o_custkey % 1000 AS BIGINT) AS RunID, CAST(o_orderkey AS INTEGER) AS EventID,
         o_orderpriority AS priority FROM orders),
clean_ids AS (
  SELECT RunID, EventID FROM listing WHERE priority <> '5-LOW'
  UNION ALL SELECT RunID, EventID FROM listing WHERE priority = '1-URGENT')"""
GEOMETRY = """
geometry AS (
  SELECT string, dom_number, (string - 1) % 10 * 125.0 - 560.0 AS dom_x,
         (string - 1) // 10 * 125.0 - 500.0 AS dom_y,
         500.0 - dom_number * 17.0 - (dom_number % 7) * 0.25 - string AS dom_z
  FROM (SELECT DISTINCT CAST(user_id % 86 + 1 AS INTEGER) AS string, CAST(event_id % 60 + 1 AS INTEGER) AS dom_number
        FROM events))"""


def _annotated(source: str, order: str) -> str:
    return f"""
marked AS (
  SELECT *, row_number() OVER w AS i, sum(charge) OVER w AS cq, count(*) OVER g AS n, sum(charge) OVER g AS qt,
         first_value(dom_time) OVER g AS t0,
         last_value(dom_time) OVER g AS tl
  FROM {source}
  WINDOW w AS (PARTITION BY event_no, string, dom_number ORDER BY {order} ROWS UNBOUNDED PRECEDING),
         g AS (PARTITION BY event_no, string, dom_number ORDER BY {order}
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
centre AS (
  SELECT event_no, CASE WHEN sum(charge) > 0 THEN CAST(sum(dom_x * charge) AS DOUBLE) / CAST(sum(charge) AS DOUBLE) ELSE 0 END AS mx,
         CASE WHEN sum(charge) > 0 THEN CAST(sum(dom_y * charge) AS DOUBLE) / CAST(sum(charge) AS DOUBLE) ELSE 0 END AS my,
         CASE WHEN sum(charge) > 0 THEN CAST(sum(dom_z * charge) AS DOUBLE) / CAST(sum(charge) AS DOUBLE) ELSE 0 END AS mz
  FROM {source} GROUP BY event_no)"""


def _nth(source: str, prefix: str, kind: str, k: int = 5) -> str:
    return ", ".join(
        f"CAST(coalesce(max({source}) FILTER (WHERE i = {j}), -1) AS {kind}) AS {prefix}{j}" for j in range(1, k + 1)
    )


def _t_fraction(p: int) -> str:
    return (
        f"CASE WHEN max(n) < 2 THEN -1.0 ELSE coalesce(arg_min(dom_time - t0, i) FILTER "
        f"(WHERE CAST(cq AS DOUBLE) > CAST({p / 100.0} AS DOUBLE) * CAST(qt AS DOUBLE)), -1.0) END AS T{p}"
    )


def _window_charge(width: int) -> str:
    return f"CAST(coalesce(sum(charge) FILTER (WHERE dom_time - t0 < {width}), 0) AS DOUBLE) AS Q{width}"


def _classic_features(k: int = 5) -> str:
    return f"""event_no, string, dom_number,
  max(dom_x) FILTER (WHERE i = 1) AS dom_x, max(dom_y) FILTER (WHERE i = 1) AS dom_y,
  max(dom_z) FILTER (WHERE i = 1) AS dom_z, max(pmt_area) FILTER (WHERE i = 1) AS pmt_area,
  max(rde) FILTER (WHERE i = 1) AS rde, max(is_saturated_dom) FILTER (WHERE i = 1) AS saturation_status,
  max(is_bad_dom) FILTER (WHERE i = 1) AS bad_dom_status, max(is_bright_dom) FILTER (WHERE i = 1) AS bright_dom_status,
  {_nth('charge', 'q', 'DOUBLE', k)}, {_window_charge(25)}, {_window_charge(75)},
  CAST(max(qt) AS DOUBLE) AS Qtotal, {_nth('hlc', 'hlc', 'INTEGER', k)}, {_nth('dom_time', 't', 'DOUBLE', k)},
  {_t_fraction(10)}, {_t_fraction(50)},
  CASE WHEN max(n) <= 1 THEN -1.0 ELSE stddev_pop(dom_time) END AS sigmaT, max(n) AS n_pulses"""


FEATURE_NAMES = (
    [f"q{j}" for j in range(1, 6)] + ["Q25", "Q75", "Qtotal"] + [f"t{j}" for j in range(1, 6)] + ["T10", "T50", "sigmaT"]
)
SUMMARY_OUT = (
    "event_no, string, dom_number, dom_x, dom_y, dom_z, round(dom_x - mx, 6) AS dom_x_rel, "
    "round(dom_y - my, 6) AS dom_y_rel, round(dom_z - mz, 6) AS dom_z_rel, pmt_area, rde, saturation_status, "
    "bad_dom_status, bright_dom_status, hlc1, hlc2, hlc3, hlc4, hlc5, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in FEATURE_NAMES)
)


def summary_sql(fixture: str, source: str, order: str) -> str:
    return f"""WITH {fixture}, {_annotated(source, order)},
features AS (SELECT {_classic_features()} FROM marked GROUP BY event_no, string, dom_number)
SELECT {SUMMARY_OUT} FROM features JOIN centre USING (event_no)"""


ORACLES: dict[str, str] = {}
ORACLES["dom_summary_classic"] = summary_sql(PULSES, "pulses", "dom_time, pulse_id")
ORACLES["dom_summary_hits"] = summary_sql(hits("l_suppkey"), "hits", "dom_time, order_key, part_key, price, discount, tax")

KEYS = "event_no, string, dom_number"


def _rounded(names, digits=6):
    return ", ".join(f"round({n}, {digits}) AS {n}" for n in names)


# ------------------------------------------------------------- outlines of point sets
def outline(points: str) -> str:
    """Hull vertices by containment: a point is no vertex if it lies in a triangle of others."""

    def turn(p, q, r):
        return f"(({q}.x - {p}.x) * ({r}.y - {p}.y) - ({q}.y - {p}.y) * ({r}.x - {p}.x))"

    ab, bc, ca = turn("a", "b", "p"), turn("b", "c", "p"), turn("c", "a", "p")
    return f"""
place AS (SELECT row_number() OVER (ORDER BY x, y) AS id, x, y FROM (SELECT DISTINCT x, y FROM {points})),
cover AS (
  SELECT p.id AS p, a.id AS a, b.id AS b, c.id AS c FROM place p
  JOIN place a ON a.id <> p.id JOIN place b ON b.id > a.id AND b.id <> p.id JOIN place c ON c.id > b.id AND c.id <> p.id
  WHERE ({ab} >= 0 AND {bc} >= 0 AND {ca} >= 0) OR ({ab} <= 0 AND {bc} <= 0 AND {ca} <= 0)),
spot AS (SELECT DISTINCT event_no, id, place.x, place.y FROM {points} q JOIN place ON place.x = q.x AND place.y = q.y),
covered AS (
  SELECT DISTINCT e.event_no, e.id FROM spot e JOIN cover ON cover.p = e.id
  JOIN spot a ON a.event_no = e.event_no AND a.id = cover.a
  JOIN spot b ON b.event_no = e.event_no AND b.id = cover.b
  JOIN spot c ON c.event_no = e.event_no AND c.id = cover.c),
border AS (SELECT s.* FROM spot s LEFT JOIN covered c ON c.event_no = s.event_no AND c.id = s.id WHERE c.id IS NULL),
reach AS (
  SELECT a.event_no, max(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))) AS extent
  FROM spot a JOIN spot b ON a.event_no = b.event_no GROUP BY a.event_no),
ends AS (
  SELECT r.event_no, min((a.id, b.id)) AS pair FROM reach r JOIN spot a ON a.event_no = r.event_no
  JOIN spot b ON b.event_no = r.event_no
  WHERE sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) = r.extent GROUP BY r.event_no),
turned AS (
  SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny, first_value(x) OVER w AS fx, first_value(y) OVER w AS fy FROM (
    SELECT *, atan2(y - avg(y) OVER (PARTITION BY event_no), x - avg(x) OVER (PARTITION BY event_no)) AS theta FROM border)
  WINDOW w AS (PARTITION BY event_no ORDER BY theta)),
moments AS (
  SELECT event_no, count(*) AS n_border, var_samp(x) AS vx, var_samp(y) AS vy, covar_samp(x, y) AS cxy,
         CASE WHEN count(*) >= 3 THEN abs(sum(x * coalesce(ny, fy) - coalesce(nx, fx) * y)) / 2 END AS area
  FROM turned GROUP BY event_no),
axes AS (
  SELECT event_no, n_border, area, sqrt((vx + vy) / 2 + sqrt(((vx - vy) / 2) ** 2 + cxy ** 2)) AS major,
         CASE WHEN n_border > 1 THEN sqrt(greatest((vx + vy) / 2 - sqrt(((vx - vy) / 2) ** 2 + cxy ** 2), 0)) END AS raw_minor,
         atan2(2 * cxy, vx - vy) / 2 AS angle FROM moments),
shape AS (
  SELECT a.event_no, (SELECT 1) AS one, n.n_points, a.n_border, r.extent, a.major,
         CASE WHEN a.raw_minor <= 1e-7 * a.major THEN 0 ELSE a.raw_minor END AS minor, a.area,
         p.x AS end1_x, p.y AS end1_y, q.x AS end2_x, q.y AS end2_y, cos(a.angle) AS ux, sin(a.angle) AS uy
  FROM axes a JOIN reach r USING (event_no) JOIN ends USING (event_no)
  JOIN (SELECT event_no, count(*) AS n_points FROM spot GROUP BY event_no) n USING (event_no)
  JOIN place p ON p.id = pair[1] JOIN place q ON q.id = pair[2])"""


DOMS = (
    hits()
    + """,
doms AS (SELECT event_no, string, dom_number, dom_x, dom_y, dom_z, CAST(sum(charge) AS DOUBLE) AS Qtotal, min(dom_time) AS t1
         FROM hits GROUP BY ALL)"""
)
PLACED = (
    hits()
    + ","
    + TRUTH
    + """,
ndoms AS (SELECT event_no, CAST(count(DISTINCT string || '-' || dom_number) AS INTEGER) AS N_doms FROM hits GROUP BY event_no),
ranked AS (SELECT truth.*, N_doms, row_number() OVER (PARTITION BY part_no ORDER BY event_no) AS rn FROM truth JOIN ndoms USING (event_no)),
sharded AS (SELECT *, CAST((rn - 1) // 500 + 1 AS INTEGER) AS shard_no FROM ranked),
placed AS (SELECT *, CAST(sum(N_doms) OVER (PARTITION BY part_no, shard_no ORDER BY event_no) AS INTEGER) AS "offset" FROM sharded)"""
)

# ------------------------------------------------------------------- sensor summary
LATE = """
late AS (
  SELECT *, sum(CASE WHEN dom_time > (t0 + tl) / 2 THEN 1 ELSE 0 END)
              OVER (PARTITION BY event_no, string, dom_number ORDER BY i ROWS UNBOUNDED PRECEDING) AS late_i,
         row_number() OVER (PARTITION BY event_no, string, dom_number, dom_time > (t0 + tl) / 2
              ORDER BY charge DESC, i) AS in_half
  FROM marked),
chosen AS (
  SELECT *, max(CASE WHEN in_half = 1 AND dom_time > (t0 + tl) / 2 THEN late_i END)
              OVER (PARTITION BY event_no, string, dom_number) AS late_rank FROM late)"""


def _late_columns(late_time: str) -> str:
    return f"""
  arg_min(dom_time, (-charge, i)) AS t_qmax,
  CASE WHEN max(n) < 6 THEN -1.0 ELSE coalesce({late_time}, -1.0) END AS t_qmax_secondhalf,
  CASE WHEN max(n) < 2 THEN -1.0 ELSE CAST(coalesce(sum(charge) FILTER (WHERE dom_time < (t0 + tl) / 2), 0) AS DOUBLE) END AS Q_halftime,
  {_t_fraction(70)}, {_t_fraction(90)}"""


def bright_shape(cut: str) -> str:
    return f"""
bright AS (SELECT DISTINCT event_no, string, dom_x AS x, dom_y AS y FROM features WHERE Qtotal >= {cut}),
{outline('bright')},
tall AS (SELECT event_no, max(s) AS s FROM (SELECT event_no, max(dom_z) - min(dom_z) AS s FROM features
         WHERE Qtotal >= {cut} GROUP BY event_no, string) GROUP BY event_no),
second AS (
  SELECT e.event_no,
    CASE WHEN major > 0 AND minor > 0 THEN sqrt(1 - (minor / major) ** 2) ELSE -1 END AS eccentricity_PCA,
    CASE WHEN major > 0 AND minor > 0 THEN (major - minor) / (major + minor) ELSE -1 END AS aspect_contrast_PCA,
    CASE WHEN n_points >= 2 AND extent > 0 AND s > 0 THEN sqrt(extent * extent + s * s)
         WHEN n_points >= 2 AND extent > 0 THEN extent WHEN s > 0 THEN s ELSE -1 END AS hypotenuse
  FROM (SELECT DISTINCT event_no FROM features) e LEFT JOIN shape USING (event_no) LEFT JOIN tall USING (event_no))"""


_SHAPE3 = ["eccentricity_PCA", "aspect_contrast_PCA", "hypotenuse"]
_COMPAT_TIME = "max(dom_time) FILTER (WHERE i = late_rank)"
_OWN_TIME = "max(dom_time) FILTER (WHERE in_half = 1 AND dom_time > (t0 + tl) / 2)"
_BASE = f"WITH {PULSES}, {_annotated('pulses', 'dom_time, pulse_id')}"
ORACLES["dom_summary_equinox"] = f"""{_BASE}, {LATE},
features AS (SELECT {_classic_features()}, {_late_columns(_COMPAT_TIME)} FROM chosen GROUP BY {KEYS}),
{bright_shape('100')}
SELECT {KEYS}, {_rounded(FEATURE_NAMES + ['t_qmax', 't_qmax_secondhalf', 'Q_halftime', 'T70', 'T90'] + _SHAPE3)}
FROM features JOIN second USING (event_no)"""
ORACLES["dom_summary_second"] = f"""{_BASE},
features AS (SELECT {_classic_features()} FROM marked GROUP BY {KEYS}), {bright_shape(str(10.0 ** 2.4))}
SELECT {KEYS}, {_rounded(['Qtotal'] + _SHAPE3)} FROM features JOIN second USING (event_no)"""
ORACLES["late_peak_corrected"] = f"""{_BASE}, {LATE}
SELECT {KEYS}, round(arg_min(dom_time, (-charge, i)), 6) AS t_qmax,
  round(CASE WHEN max(n) < 6 THEN -1.0 ELSE coalesce({_OWN_TIME}, -1.0) END, 6) AS t_qmax_secondhalf
FROM chosen GROUP BY {KEYS}"""
_HIDDEN = ["q1", "q2", "q3", "Q25", "Q75", "Qtotal", "t1", "t2", "t3", "T10", "T50"]
ORACLES["dom_summary_legacy"] = f"""{_BASE},
features AS (SELECT {_classic_features(3)} FROM marked GROUP BY {KEYS}),
middle AS (
  SELECT event_no, string, avg(dom_x * CAST(charge AS DOUBLE)) / max(q) AS mx, avg(dom_y * CAST(charge AS DOUBLE)) / max(q) AS my,
         avg(dom_z * CAST(charge AS DOUBLE)) / max(q) AS mz
  FROM (SELECT *, CAST(sum(charge) OVER (PARTITION BY {KEYS}) AS DOUBLE) AS q FROM pulses) GROUP BY event_no, string)
SELECT {KEYS}, hlc1, hlc2, hlc3,
  {', '.join(f'CASE WHEN saturation_status = 1 THEN -1.0 ELSE round({c}, 6) END AS {c}' for c in _HIDDEN)},
  CASE WHEN saturation_status = 1 OR n_pulses <= 1 THEN 0.0 ELSE round(sigmaT, 6) END AS sigmaT,
  round(dom_x - mx, 6) AS dom_x_rel, round(dom_y - my, 6) AS dom_y_rel, round(dom_z - mz, 6) AS dom_z_rel
FROM features JOIN middle USING (event_no, string)"""
ORACLES["first_hlc_times"] = f"""WITH {PULSES},
ranked AS (SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY dom_time, pulse_id) AS i FROM pulses WHERE hlc = 1)
SELECT {KEYS}, {', '.join(f'round(coalesce(max(dom_time) FILTER (WHERE i = {j}), -1), 6) AS t{j}' for j in (1, 2, 3))}
FROM ranked GROUP BY {KEYS}"""
ORACLES["event_charge_centroid"] = f"""{_BASE}
SELECT event_no, round(mx, 6) AS mean_x, round(my, 6) AS mean_y, round(mz, 6) AS mean_z FROM centre"""

# ------------------------------------------------------------------ shards, identities
ORACLES["event_n_doms_offset"] = f"""WITH {PLACED}
SELECT event_no, part_no, shard_no, N_doms, "offset" AS offset_end, "offset" - N_doms AS offset_start FROM placed"""
ORACLES["running_dom_count"] = f"""WITH {PLACED}
SELECT event_no, N_doms, CAST(sum(N_doms) OVER (ORDER BY event_no) AS BIGINT) AS doms_so_far FROM placed"""
ORACLES["enhanced_event_no"] = f"""WITH {TRUTH}
SELECT CAST(format('112{{:04d}}{{:08d}}', part_no, event_no) AS BIGINT) AS event_no, event_no AS original_event_no FROM truth
UNION ALL SELECT CAST(format('22029{{:04d}}{{:08d}}', part_no, event_no) AS BIGINT), event_no FROM truth"""
_RANGES = {0: ("100GeV-10TeV", "nu_mu", 14), 1: ("10TeV-1PeV", "nu_mu", 14), 2: ("1PeV-100PeV", "nu_mu", 14),
           3: ("100GeV-10TeV", "nu_e", 12), 4: ("10TeV-1PeV", "nu_e", 12), 5: ("1PeV-100PeV", "nu_e", 12),
           6: ("100GeV-10TeV", "nu_tau", 16), 7: ("10TeV-1PeV", "nu_tau", 16), 8: ("1PeV-100PeV", "nu_tau", 16)}
ORACLES["decoded_event_no"] = f"""WITH {TRUTH},
lookup(k, energy_range, flavour, pdg) AS (VALUES {', '.join(f"({k}, '{a}', '{b}', {c})" for k, (a, b, c) in _RANGES.items())})
SELECT CAST(format('1{{:02d}}{{:04d}}{{:08d}}', event_no % 9 + 10, part_no, event_no) AS BIGINT) AS event_no,
       CAST(event_no % 9 + 22010 AS VARCHAR) AS subdir, part_no, event_no AS original_event_no,
       energy_range, lookup.flavour, CAST(pdg AS INTEGER) AS pdg, CAST(event_no % 9 + 22010 AS VARCHAR) AS dataset
FROM truth JOIN lookup ON k = event_no % 9"""
ORACLES["shifted_event_no"] = f"""WITH {TRUTH}
SELECT event_no, CAST(part_no AS BIGINT) * 16777216 + event_no AS shifted FROM truth"""

# -------------------------------------------------------------------------- truth table
_D = {"pos_x": "px", "pos_y": "py", "pos_z": "pz", "dir_x": "dx", "dir_y": "dy", "dir_z": "dz"}


def _sql_edges(corners):
    pairs = list(zip(corners, [*corners[1:], corners[0]]))
    return ", ".join(f"({a[0]!r}, {a[1]!r}, {b[0]!r}, {b[1]!r})" for a, b in pairs)


def _labelled() -> str:
    """truth with daughter defaults, containment and segment."""
    from pulsegrid.functions.geometry import OUTLINE_XY, PRISM_XY, Z_RANGE

    return f"""{TRUTH}, {DAUGHTER},
outline_edge(e1x, e1y, e2x, e2y) AS (SELECT CAST(a AS DOUBLE), CAST(b AS DOUBLE), CAST(c AS DOUBLE), CAST(d AS DOUBLE)
  FROM (VALUES {_sql_edges(OUTLINE_XY)}) AS v(a, b, c, d)),
side(e1x, e1y, e2x, e2y) AS (SELECT CAST(a AS DOUBLE), CAST(b AS DOUBLE), CAST(c AS DOUBLE), CAST(d AS DOUBLE)
  FROM (VALUES {_sql_edges(PRISM_XY)}) AS v(a, b, c, d)),
plane AS (
  SELECT (e1y - e2y) / sqrt((e2x - e1x) ** 2 + (e2y - e1y) ** 2) AS nx, (e2x - e1x) / sqrt((e2x - e1x) ** 2 + (e2y - e1y) ** 2) AS ny,
         CAST(0 AS DOUBLE) AS nz, ((e1y - e2y) * e1x + (e2x - e1x) * e1y) / sqrt((e2x - e1x) ** 2 + (e2y - e1y) ** 2) AS c FROM side
  UNION ALL SELECT 0, 0, 1, CAST({Z_RANGE[1]} AS DOUBLE) UNION ALL SELECT 0, 0, -1, CAST({-Z_RANGE[0]} AS DOUBLE)),
vertex AS (
  SELECT t.*, coalesce(px, -1e8) AS px, coalesce(py, -1e8) AS py, coalesce(pz, -1e8) AS pz, coalesce(dx, 0) AS dx,
         coalesce(dy, 0) AS dy, coalesce(dz, 0) AS dz, CASE WHEN e IS NULL OR isnan(e) THEN -1 ELSE e END AS e
  FROM truth t LEFT JOIN daughter USING (event_no)),
cast_vertex AS (SELECT * REPLACE (CAST(CAST(px AS FLOAT) AS DOUBLE) AS px, CAST(CAST(py AS FLOAT) AS DOUBLE) AS py,
  CAST(CAST(pz AS FLOAT) AS DOUBLE) AS pz) FROM vertex),
crossing AS (
  SELECT event_no, sum(CASE WHEN (e1y > py) <> (e2y > py) AND px < (e2x - e1x) / (e2y - e1y) * (py - e1y) + e1x THEN 1 ELSE 0 END) % 2 AS odd
  FROM cast_vertex, outline_edge GROUP BY event_no),
facing AS (
  SELECT v.event_no, nx * dx + ny * dy + nz * dz AS v, c - (nx * px + ny * py + nz * pz) AS room FROM cast_vertex v, plane),
clipped AS (
  SELECT event_no, max(CASE WHEN v < -1e-12 THEN room / v END) AS t_in, min(CASE WHEN v > 1e-12 THEN room / v END) AS t_out,
         bool_or(abs(v) <= 1e-12 AND room < 0) AS missed FROM facing GROUP BY event_no),
labelled AS (
  SELECT v.*, CAST(odd = 1 AND pz BETWEEN {Z_RANGE[0]} AND {Z_RANGE[1]} AS INTEGER) AS isWithinIceCube,
         coalesce(CASE WHEN missed OR NOT t_in < t_out THEN 0 WHEN t_in >= 0 THEN t_out - t_in WHEN t_out > 0 THEN t_out ELSE 0 END, 0)
           * sqrt(dx * dx + dy * dy + dz * dz) AS segment
  FROM cast_vertex v JOIN crossing USING (event_no) JOIN clipped USING (event_no))"""


LABELLED = _labelled()
_SUFFIX = "_GNHighestEDaughter"
ORACLES["truth_assembled"] = f"""WITH {LABELLED}
SELECT event_no, part_no, RunID, {', '.join(f'round({v}, 2) AS {k}{_SUFFIX}' for k, v in _D.items())},
  round(CAST(CAST(e AS FLOAT) AS DOUBLE), 2) AS energy{_SUFFIX}, CAST(-1 AS DOUBLE) AS zenith{_SUFFIX}, CAST(-1 AS DOUBLE) AS GNLabelEnergyPrimary FROM labelled"""
_PAIRS = """
pairs AS (
  SELECT a.event_no, max(sqrt((a.dom_x - b.dom_x) ** 2 + (a.dom_y - b.dom_y) ** 2 + (a.dom_z - b.dom_z) ** 2)) AS d
  FROM doms a JOIN doms b ON a.event_no = b.event_no GROUP BY a.event_no)"""
ORACLES["truth_max_interpmt_distance"] = f"""WITH {DOMS}, {_PAIRS}
SELECT event_no, round(d, 6) AS max_interPMT_distance FROM pairs"""


def _single(value: str) -> str:
    """A value as it comes out of a column of single precision."""
    return f"CAST(CAST({value} AS FLOAT) AS DOUBLE)"


def _rest(side: str, *given: str) -> str:
    """Sum of the defaults of a side table's columns but those given."""
    return f"CAST({sum(default for name, (_, default) in SIDE_TABLES[side].items() if name not in given)} AS DOUBLE)"


# Of the 40 truth columns the tables define these; the others are null.
_KNOWN_TRUTH = len(
    "event_no subdirectory_no part_no shard_no N_doms offset energy azimuth zenith RunID EventID MuonFilter_13".split()
)
ORACLES["truth_complete"] = f"""WITH {PLACED}, {LABELLED.replace(TRUTH + ',', '')},
doms AS (SELECT DISTINCT event_no, dom_x, dom_y, dom_z FROM hits), {_PAIRS}
SELECT CAST(format('112{{:04d}}{{:08d}}', p.part_no, p.event_no) AS BIGINT) AS event_no, p.event_no AS original_event_no,
  12 AS subdirectory_no, p.part_no, p.shard_no, p.N_doms, p."offset",
  CASE WHEN p.event_no % 11 <> 0 THEN p.InteractionType ELSE -1 END AS InteractionType, l.isWithinIceCube,
  round(CAST(CAST(d AS FLOAT) AS DOUBLE), 2) AS max_interPMT_distance,
  round(CAST(CAST(segment AS FLOAT) AS DOUBLE), 2) AS post_vertex_intraIceCube_segment,
  round(CASE WHEN p.event_no % 3 <> 0 THEN {_rest("labels", "GNLabelHighestEInIceParticleIsChild", "GNLabelEnergyPrimary")} + p.event_no % 2
    + CASE WHEN p.event_no % 7 = 0 THEN -1 ELSE {_single("p.energy")} END ELSE {_rest("labels")} END, 1) AS sum_labels,
  round(CASE WHEN p.event_no % 5 <> 0 THEN {_rest("inice", "pos_x_GNHighestEInIceParticle", "energy_GNHighestEInIceParticle")} + p.event_no % 100
    + {_single("p.energy")} ELSE {_rest("inice")} END, 1) AS sum_inice,
  round(CASE WHEN g.px IS NOT NULL THEN {_rest("daughter", *[f"{k}_{a}_GNHighestEDaughter" for k in ("pos", "dir") for a in "xyz"], "energy_GNHighestEDaughter")}
    + {" + ".join(_single(f"g.{k}{a}") for k in "pd" for a in "xyz")} + CASE WHEN isnan(g.e) THEN -1 ELSE {_single("g.e")} END
    ELSE {_rest("daughter")} END, 1) AS sum_daughter,
  round({_rest("weights", "InteractionType")} + CASE WHEN p.event_no % 11 <> 0 THEN p.InteractionType ELSE -1 END, 1) AS sum_weights,
  {_KNOWN_TRUTH} + {sum(len(c) for c in SIDE_TABLES.values())} + 3 + 1 AS n_filled, 130 AS n_columns
FROM placed p JOIN labelled l USING (event_no) JOIN pairs USING (event_no) LEFT JOIN daughter g USING (event_no)"""
ORACLES["truth_is_within"] = f"WITH {LABELLED} SELECT event_no, isWithinIceCube FROM labelled"
ORACLES["truth_prism_segment"] = f"""WITH {LABELLED.replace('CAST(CAST(px AS FLOAT) AS DOUBLE)', 'px').replace('CAST(CAST(py AS FLOAT) AS DOUBLE)', 'py').replace('CAST(CAST(pz AS FLOAT) AS DOUBLE)', 'pz')}
SELECT d.event_no, CAST(CASE WHEN missed OR NOT t_in < t_out THEN NULL WHEN t_in > 0 THEN 0 WHEN t_out >= 0 THEN 1 WHEN t_out < 0 THEN 2 END AS INTEGER) AS vertex_place,
  round(CASE WHEN NOT missed AND t_in < t_out THEN t_in END, 5) AS t_in,
  round(CASE WHEN NOT missed AND t_in < t_out THEN t_out END, 5) AS t_out, round(segment, 5) AS segment
FROM daughter d JOIN clipped USING (event_no) JOIN labelled USING (event_no)"""
ORACLES["opening_angle"] = f"""WITH {TRUTH}, {DAUGHTER}
SELECT event_no, CASE WHEN dx * dx + dy * dy + dz * dz > 0 THEN round(degrees(acos(greatest(-1, least(1,
  (dx * sin(zenith) * cos(azimuth) + dy * sin(zenith) * sin(azimuth) + dz * cos(zenith)) / sqrt(dx * dx + dy * dy + dz * dz))))), 4) END AS angle
FROM truth JOIN daughter USING (event_no)"""
ORACLES["interior_vertices"] = f"""WITH {DAUGHTER}
SELECT event_no, round(sqrt(px * px + py * py), 6) AS radius,
  CAST(sqrt(px * px + py * py) < 400 AND pz > -300 AND pz < 300 AS INTEGER) AS interior,
  round(cos(event_no % 4), 6) AS cos_zenith FROM daughter"""
ORACLES["coordinate_fractions"] = f"""WITH {DAUGHTER}
SELECT {', '.join(f'round(avg(CASE WHEN abs(p{a}) < 400 THEN 1.0 ELSE 0.0 END), 6) AS within_{a}' for a in 'xyz')} FROM daughter"""

# ---------------------------------------------------------------------------- selection
_CLEAN = "EXISTS (SELECT 1 FROM clean_ids c WHERE c.RunID = labelled.RunID AND c.EventID = labelled.EventID)"
_ALL3 = f"InteractionType = 1 AND CAST(segment AS FLOAT) > 300 AND {_CLEAN}".replace("CAST(segment AS FLOAT)", "segment")
for _name, _rule in {
    "filter_cc": "InteractionType = 1",
    "filter_muon": "MuonFilter_13 = 1",
    "filter_contained": "isWithinIceCube <> 0",
    "filter_travel": "segment > 300",
    "filter_clean_ids": _CLEAN,
}.items():
    ORACLES[_name] = f"WITH {LABELLED}, {CLEAN_IDS} SELECT event_no, RunID, part_no FROM labelled WHERE {_rule}"
_SELECTED = f"{LABELLED}, {CLEAN_IDS}, chosen AS (SELECT * FROM labelled WHERE {_ALL3})"
ORACLES["filter_composite"] = f"WITH {_SELECTED} SELECT event_no, part_no FROM chosen"
ORACLES["filter_composite_doms"] = f"""WITH {_SELECTED}, {DOMS}
SELECT {KEYS}, Qtotal FROM doms WHERE event_no IN (SELECT event_no FROM chosen)"""
_SELECTED_PLACED = f"{PLACED}, {_SELECTED.replace(TRUTH + ',', '')}"
ORACLES["offset_recomputed"] = f"""WITH {_SELECTED_PLACED}
SELECT p.event_no, p.part_no, p.shard_no, p.N_doms,
  CAST(sum(p.N_doms) OVER (PARTITION BY p.part_no, p.shard_no ORDER BY p.event_no) AS INTEGER) AS "offset"
FROM placed p JOIN chosen USING (event_no)"""
ORACLES["filter_receipt"] = f"""WITH {_SELECTED},
counted AS (SELECT subdirectory_no, part_no, count(*) AS initial_events, count(*) FILTER (WHERE event_no IN (SELECT event_no FROM chosen)) AS selected_events
  FROM truth GROUP BY 1, 2)
SELECT *, 'CC_CRclean_IntraTravelDistance_300' AS filter_applied, round(CAST(selected_events AS DOUBLE) / initial_events, 4) AS survival_ratio,
  round(1 - CAST(selected_events AS DOUBLE) / initial_events, 4) AS reduction_ratio FROM counted"""
ORACLES["busy_events"] = f"WITH {PLACED} SELECT event_no, N_doms FROM placed WHERE N_doms > 6"

# ----------------------------------------------------------------------------- blending
_BLEND = f"""{PLACED},
low AS (SELECT *, row_number() OVER (ORDER BY part_no, event_no) AS k, 0 AS side FROM placed WHERE flavour = 'nu_mu' AND energy > 100000),
high AS (SELECT *, row_number() OVER (ORDER BY part_no, event_no) AS k, 1 AS side FROM placed WHERE flavour = 'nu_e'),
reach AS (SELECT least((SELECT count(*) FROM low), (SELECT count(*) FROM high)) AS n),
mixed AS (SELECT *, (k - 1) * 2 + side AS position FROM (SELECT * FROM low UNION ALL SELECT * FROM high) WHERE k <= (SELECT n FROM reach)),
blended0 AS (SELECT event_no, position, 31 AS subdirectory_no, part_no AS source_part_no, N_doms,
  CAST(position // 3000 + 1 AS INTEGER) AS part_no, CAST(position % 3000 // 300 + 1 AS INTEGER) AS shard_no FROM mixed),
blended AS (SELECT *, CAST(sum(N_doms) OVER (PARTITION BY part_no, shard_no ORDER BY position) AS INTEGER) AS "offset" FROM blended0)"""
ORACLES["blend_truth_interleaved"] = f"""WITH {_BLEND}
SELECT event_no, position, subdirectory_no, source_part_no, part_no, shard_no, N_doms, "offset" FROM blended"""
ORACLES["blend_shards"] = f"""WITH {_BLEND}, {DOMS.replace(hits() + ',', '')}
SELECT {', '.join('d.' + k for k in KEYS.split(', '))}, b.part_no, b.shard_no, b.position, d.Qtotal FROM doms d JOIN blended b USING (event_no)"""
ORACLES["blend_receipt"] = f"""WITH {TRUTH}, c AS (
  SELECT count(*) FILTER (WHERE flavour = 'nu_mu' AND energy > 100000) AS l, count(*) FILTER (WHERE flavour = 'nu_e') AS h FROM truth)
SELECT 22031 AS subdir_no, l AS events_from_low_energy, h AS events_from_high_energy, 2 * least(l, h) AS total_events_combined FROM c"""
ORACLES["blend_incomplete"] = f"""WITH {_BLEND}, f AS (SELECT event_no, count(*) AS found FROM hits GROUP BY event_no)
SELECT b.event_no, b.N_doms, coalesce(found, 0) AS found FROM blended b LEFT JOIN f USING (event_no) WHERE coalesce(found, 0) <> b.N_doms"""
ORACLES["slice_lookup"] = f"""WITH {PLACED}, {DOMS.replace(hits() + ',', '')}
SELECT d.event_no, d.string, d.dom_number, d.event_no AS owner,
  CAST(row_number() OVER (PARTITION BY p.part_no, p.shard_no ORDER BY d.event_no, d.string, d.dom_number) - 1 AS INTEGER) AS row_in_shard
FROM doms d JOIN placed p USING (event_no)"""
ORACLES["class_balanced"] = f"""WITH {TRUTH},
n AS (SELECT min(c) AS m FROM (SELECT count(*) AS c FROM truth GROUP BY flavour)),
r AS (SELECT event_no, flavour, row_number() OVER (PARTITION BY flavour ORDER BY event_no) AS k FROM truth)
SELECT event_no, flavour FROM r WHERE k <= (SELECT m FROM n)"""
ORACLES["events_in_chunks"] = f"""WITH {TRUTH}
SELECT event_no, RunID, (row_number() OVER (ORDER BY RunID, event_no) - 1) // 1000 + 1 AS chunk FROM truth"""

# ----------------------------------------------------------------------------- detector
_DISPLACED = """
displaced AS (
  SELECT l_orderkey, l_linenumber, (l_suppkey % 86) % 10 * 125.0 - 560.0 + (l_quantity - 25) * 0.5 AS dom_x,
    (l_suppkey % 86) // 10 * 125.0 - 500.0 - (l_quantity - 25) * 0.5 / 2 AS dom_y,
    500.0 - (l_partkey % 60 + 1) * 17.0 - ((l_partkey % 60 + 1) % 7) * 0.25 - (l_suppkey % 86 + 1) + 0.0625 * (l_quantity - 25) AS dom_z
  FROM lineitem)"""
ORACLES["string_assign_box"] = f"""WITH {_DISPLACED}, {GEOMETRY},
spots AS (SELECT DISTINCT dom_x, dom_y, dom_z FROM displaced),
met AS (SELECT s.dom_x, s.dom_y, s.dom_z, min(g.string * 100 + g.dom_number) AS k FROM spots s JOIN geometry g
  ON abs(s.dom_x - g.dom_x) <= 10 AND abs(s.dom_y - g.dom_y) <= 10 AND abs(s.dom_z - g.dom_z) <= 2 GROUP BY ALL)
SELECT l_orderkey, l_linenumber, dom_x, dom_z, CAST(k // 100 AS INTEGER) AS string, CAST(k % 100 AS INTEGER) AS dom_number
FROM displaced LEFT JOIN met USING (dom_x, dom_y, dom_z)"""
ORACLES["string_assign_nearest"] = f"""WITH {_DISPLACED}, {GEOMETRY},
strings AS (SELECT DISTINCT string, dom_x AS gx, dom_y AS gy FROM geometry),
spots AS (SELECT DISTINCT dom_x, dom_y FROM displaced),
near AS (SELECT dom_x, dom_y, arg_min(string, (sqrt((dom_x - gx) ** 2 + (dom_y - gy) ** 2), string)) AS string,
  min(sqrt((dom_x - gx) ** 2 + (dom_y - gy) ** 2)) AS d FROM spots, strings GROUP BY ALL)
SELECT l_orderkey, l_linenumber, dom_x, dom_y, CASE WHEN d <= 2 THEN string END AS string FROM displaced JOIN near USING (dom_x, dom_y)"""
ORACLES["unique_sensors"] = f"WITH {PULSES} SELECT DISTINCT string, dom_number, dom_x, dom_y, dom_z FROM pulses"
_GRID = "grid AS (SELECT CAST(s AS INTEGER) AS string, CAST(d AS INTEGER) AS dom_number FROM range(1, 87) a(s), range(1, 61) b(d))"
ORACLES["missing_doms"] = f"WITH {GEOMETRY}, {_GRID} SELECT string, dom_number FROM grid EXCEPT SELECT string, dom_number FROM geometry"
ORACLES["geometry_diff"] = f"""WITH {GEOMETRY},
a AS (SELECT string, dom_number FROM geometry),
b AS (SELECT DISTINCT CAST(l_suppkey % 86 + 1 AS INTEGER) AS string, CAST(l_partkey % 60 + 1 AS INTEGER) AS dom_number FROM lineitem)
SELECT *, 'first' AS only_in FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT *, 'second' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)"""
ORACLES["geometry_filled"] = f"""WITH {GEOMETRY}, {_GRID},
g AS (SELECT grid.string, grid.dom_number, dom_z FROM grid LEFT JOIN geometry USING (string, dom_number)
      WHERE grid.string IN (SELECT string FROM geometry)),
xy AS (SELECT string, min(dom_x) AS dom_x, min(dom_y) AS dom_y FROM geometry GROUP BY string),
r AS (SELECT string, dom_number AS d, dom_z AS z, row_number() OVER (PARTITION BY string ORDER BY dom_number) AS up,
  row_number() OVER (PARTITION BY string ORDER BY dom_number DESC) AS down FROM geometry),
e AS (SELECT string, max(d) FILTER (WHERE up = 1) AS d1, max(z) FILTER (WHERE up = 1) AS z1, max(d) FILTER (WHERE up = 2) AS d2,
  max(z) FILTER (WHERE up = 2) AS z2, max(d) FILTER (WHERE down = 1) AS e1, max(z) FILTER (WHERE down = 1) AS y1,
  max(d) FILTER (WHERE down = 2) AS e2, max(z) FILTER (WHERE down = 2) AS y2 FROM r GROUP BY string),
n AS (SELECT g.string, g.dom_number, g.dom_z, (SELECT max(d) FROM r WHERE r.string = g.string AND r.d < g.dom_number) AS lo,
  (SELECT min(d) FROM r WHERE r.string = g.string AND r.d > g.dom_number) AS hi FROM g)
SELECT n.string, n.dom_number, dom_x, dom_y, round(CASE WHEN n.dom_z IS NOT NULL THEN n.dom_z
  WHEN lo IS NULL THEN z1 + (z1 - z2) / (d2 - d1) * (d1 - n.dom_number)
  WHEN hi IS NULL THEN y1 + (y1 - y2) / (e1 - e2) * (n.dom_number - e1)
  ELSE a.z + (n.dom_number - lo) / CAST(hi - lo AS DOUBLE) * (b.z - a.z) END, 2) AS dom_z
FROM n JOIN xy USING (string) JOIN e USING (string) LEFT JOIN r a ON a.string = n.string AND a.d = lo LEFT JOIN r b ON b.string = n.string AND b.d = hi"""
ORACLES["dom_activation_grid"] = f"""WITH {_GRID},
c AS (SELECT user_id % 90 + 1 AS string, event_id % 60 + 1 AS dom_number, count(*) AS n FROM events GROUP BY 1, 2)
SELECT 60 - grid.dom_number AS grid_row, grid.string - 1 AS grid_column, coalesce(n, 0) AS n_pulses FROM grid LEFT JOIN c USING (string, dom_number)"""
ORACLES["sensor_counts"] = f"""WITH {PULSES},
c AS (SELECT string, dom_number, count(*) AS n_pulses, min(dom_x) AS dom_x, min(dom_y) AS dom_y, min(dom_z) AS dom_z FROM pulses GROUP BY 1, 2),
s AS (SELECT *, CAST(n_pulses AS DOUBLE) / (SELECT max(n_pulses) FROM c) AS share FROM c)
SELECT string, dom_number, n_pulses, dom_x, dom_y, dom_z, round(share, 6) AS share FROM s WHERE share > 0.7"""

# ------------------------------------------------------------------------------- shapes
def _stretches(source: str) -> str:
    return f"""
lines AS (SELECT event_no, string, min(dom_z) AS lo, max(dom_z) AS hi, max(dom_z) - min(dom_z) AS s FROM {source} GROUP BY event_no, string),
stretch AS (SELECT event_no, avg(s) AS stretch_mean, max(s) AS stretch_max,
  (quantile_cont(s, 0.843) - quantile_cont(s, 0.157)) / 2 AS stretch_hiqr, arg_min(string, (-s, string)) AS stretch_string,
  arg_min(lo, (-s, string)) AS stretch_z_low, arg_min(hi, (-s, string)) AS stretch_z_high FROM lines GROUP BY event_no)"""


ORACLES["z_stretch"] = f"""WITH {DOMS}, {_stretches('doms')}
SELECT event_no, stretch_string, {_rounded(['stretch_mean', 'stretch_max', 'stretch_hiqr', 'stretch_z_low', 'stretch_z_high'])} FROM stretch"""
ORACLES["string_nearest_mean"] = f"""WITH {DOMS}, {_stretches('doms')}
SELECT event_no, arg_min(string, (abs(s - stretch_mean), string)) AS string, arg_min(s, (abs(s - stretch_mean), string)) AS stretch
FROM lines JOIN stretch USING (event_no) GROUP BY event_no"""
_POINTS = "pts AS (SELECT DISTINCT event_no, dom_x AS x, dom_y AS y FROM doms)"
ORACLES["xy_extent"] = f"""WITH {DOMS}, {_POINTS}, {outline('pts')}
SELECT event_no, n_points, {_rounded(['extent', 'end1_x', 'end1_y', 'end2_x', 'end2_y'])} FROM shape"""
ORACLES["pca_axes"] = f"""WITH {DOMS}, {_POINTS}, {outline('pts')}
SELECT event_no, n_points, n_border, {_rounded(['extent', 'major', 'minor', 'area'])} FROM shape"""
ORACLES["string_table"] = f"""WITH {DOMS}
SELECT event_no, string, round(avg(dom_x), 6) AS x, round(avg(dom_y), 6) AS y,
  round(sum(log10(greatest(Qtotal, 1e-9)) - 2), 6) AS w FROM doms GROUP BY event_no, string"""
_STRINGS = "strings AS (SELECT event_no, string, avg(dom_x) AS x, avg(dom_y) AS y, sum(Qtotal) AS w FROM doms GROUP BY event_no, string)"
ORACLES["charge_spread"] = f"""WITH {DOMS}, {_STRINGS},
c AS (SELECT event_no, sum(x * w) / sum(w) AS cx, sum(y * w) / sum(w) AS cy FROM strings GROUP BY event_no),
d AS (SELECT event_no, w, sqrt((x - cx) ** 2 + (y - cy) ** 2) AS d FROM strings JOIN c USING (event_no)),
m AS (SELECT event_no, max(d) AS top FROM d GROUP BY event_no)
SELECT event_no, round(CASE WHEN count(*) >= 3 AND max(d) > 0 THEN sum(CASE WHEN d * 10 >= 5 * top THEN w ELSE 0 END) / (sum(w) + 1e-8) END, 6) AS outer_mass_fraction,
  round(CASE WHEN count(*) >= 3 THEN sum(d * w) / sum(w) END, 6) AS normalised_weighted_distance FROM d JOIN m USING (event_no) GROUP BY event_no"""
ORACLES["repeated_points"] = f"""WITH {DOMS}, {_STRINGS},
q AS (SELECT *, CAST(floor(greatest(1, least(10, w / (max(w) OVER (PARTITION BY event_no) + 1e-7) * 10))) AS INTEGER) AS n FROM strings)
SELECT event_no, string, x, y FROM q, range(10) r(i) WHERE i < n"""
_COS = "((end2_x - end1_x) / nullif(extent, 0) * ux + (end2_y - end1_y) / nullif(extent, 0) * uy)"
_SIN = "((end2_y - end1_y) / nullif(extent, 0) * ux - (end2_x - end1_x) / nullif(extent, 0) * uy)"
_CUT = "cut AS (SELECT * FROM doms WHERE log10(greatest(Qtotal, 1e-9)) - 2 > -1)"


def _area() -> str:
    from pulsegrid.functions.geometry import OUTLINE_AREA

    return repr(OUTLINE_AREA)


ORACLES["shape_features_geometry"] = f"""WITH {DOMS}, {_POINTS}, {_CUT}, {outline('pts')}, {_stretches('cut')},
f AS (SELECT event_no, extent AS extent_max, stretch_max, stretch_mean, stretch_hiqr, greatest(extent, stretch_max) AS max_extent_stretch,
  sqrt(extent * stretch_max) AS product, sqrt(extent ** 2 + stretch_max ** 2) AS hypotenuse, major AS major_PCA, minor AS minor_PCA,
  sqrt(1 - (minor / nullif(major, 0)) ** 2) AS eccentricity_PCA, (major - minor) / nullif(major + minor, 0) AS aspect_contrast_PCA,
  CASE WHEN major > 0 AND extent > 0 THEN greatest(0, least(1, {_COS} ** 2)) END AS cos_sq_extent_PCA_major, area / {_area()} AS area_ratio
  FROM shape LEFT JOIN stretch USING (event_no))
SELECT event_no, {_rounded(['extent_max', 'stretch_max', 'stretch_mean', 'stretch_hiqr', 'max_extent_stretch', 'product', 'hypotenuse', 'major_PCA', 'minor_PCA', 'eccentricity_PCA', 'aspect_contrast_PCA', 'cos_sq_extent_PCA_major', 'area_ratio'], 5)} FROM f"""
_A, _B = f"least(1, abs({_COS})) ** 6", f"least(1, abs({_SIN})) ** 6"
_NINE = ["hypotenuse", "major_PCA", "minor_PCA", "eccentricity_PCA", "aspect_contrast_PCA", "cos_power_extent_PCA_major", "abs_diff", "gaussian_sum", "quadratic_diff_sum"]
ORACLES["shape_features_compact"] = f"""WITH {DOMS}, {_CUT}, pts AS (SELECT DISTINCT event_no, dom_x AS x, dom_y AS y FROM cut), {outline('pts')}, {_stretches('cut')},
f AS (SELECT event_no, sqrt(extent ** 2 + stretch_max ** 2) AS hypotenuse, major AS major_PCA, minor AS minor_PCA,
  sqrt(1 - (minor / major) ** 2) AS eccentricity_PCA, (major - minor) / (major + minor) AS aspect_contrast_PCA,
  greatest(0, least(1, {_COS} ** 6)) AS cos_power_extent_PCA_major, abs({_A} - {_B}) AS abs_diff,
  exp(-({_A})) + exp(-({_B})) AS gaussian_sum, ({_A} - 0.5) ** 2 + ({_B} - 0.5) ** 2 AS quadratic_diff_sum
  FROM shape JOIN stretch USING (event_no) WHERE n_border >= 3)
SELECT e.event_no, {_rounded(_NINE, 5)} FROM (SELECT DISTINCT event_no FROM doms) e LEFT JOIN f USING (event_no)"""

# ------------------------------------------------------------------------------ scaling
_PLAIN = f"""{_BASE}, features AS (SELECT {_classic_features()} FROM marked GROUP BY {KEYS}),
plain AS (SELECT {KEYS}, dom_x, dom_y, dom_z, dom_x - mx AS dom_x_rel, dom_y - my AS dom_y_rel, dom_z - mz AS dom_z_rel,
  q1, q2, q3, Q25, Q75, Qtotal, t1, t2, t3, T10, T50, sigmaT FROM features JOIN centre USING (event_no))"""


def _scaled(position, charge, total, arrival, spread) -> str:
    cells = [f"round({position.format(c=c)}, 6) AS {c}" for c in ("dom_x", "dom_y", "dom_z", "dom_x_rel", "dom_y_rel", "dom_z_rel")]
    for rule, names in ((charge, ("q1", "q2", "q3")), (total, ("Q25", "Q75", "Qtotal")), (arrival, ("t1", "t2", "t3")), (spread, ("T10", "T50", "sigmaT"))):
        cells += [f"round({rule.format(c=c)}, 6) AS {c}" for c in names]
    return f"{_PLAIN} SELECT {KEYS}, {', '.join(cells)} FROM plain"


def _kept(rule: str) -> str:
    return "CASE WHEN {c} <> -1 THEN " + rule + " ELSE {c} END"


ORACLES["pseudo_normalised"] = _scaled(
    "{c} * 0.002", "log10(greatest({c}, 1e-9)) - 2", "log10(greatest({c}, 1e-9)) - 2", "({c} - 10000) * 3e-4", "{c} * 3e-4"
)
ORACLES["lazy_normalised"] = _scaled(
    "{c} / 500", _kept("log10({c} + 1e-10)"), _kept("log10({c} + 1e-10) - 2"), _kept("({c} - 10000) * 3e-4"), _kept("{c} * 3e-4")
)
ORACLES["former_normalised"] = _scaled(
    "{c} / 500", _kept("log10({c})"), _kept("log10({c}) - 2"), _kept("({c} - 10000) * 1e-3"), _kept("{c} * 1e-3")
)
ORACLES["adjusted_charge_cut"] = f"""WITH {DOMS}, a AS (SELECT * REPLACE (log10(greatest(Qtotal, 1e-9)) - 2 AS Qtotal) FROM doms)
SELECT {KEYS}, dom_x, dom_y, dom_z, round(Qtotal, 6) AS Qtotal FROM a WHERE Qtotal > -0.5"""


# --------------------------------------------------------------------------- statistics
def _hist(fixture: str, rows: str, value: str, width=None, bins=None, log=False, by="") -> str:
    keep = f"WHERE {value} > 0" if log else f"WHERE {value} IS NOT NULL"
    v = f"log10(CAST({value} AS DOUBLE))" if log else f"CAST({value} AS DOUBLE)"
    lead = f"{by}, " if by else ""
    size = f"CAST({width} AS DOUBLE)" if width else f"(hi - lo) / {bins}"
    count = f"greatest(1, ceil((hi - lo) / {width}))" if width else str(bins)
    edge = "lo + bin * size"
    left = f"pow(10, {edge})" if log else edge
    return f"""WITH {fixture}, v AS (SELECT {lead}{v} AS v FROM {rows} {keep}), r AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
b AS (SELECT {lead}lo, {size} AS size, CAST(least({count} - 1, floor((v - lo) / ({size}))) AS INTEGER) AS bin FROM v, r)
SELECT {lead}bin, round({left}, 4) AS left_edge, count(*) AS n FROM b GROUP BY ALL"""


def _hists(fixture: str, rows: str, grids: dict[str, tuple], by="") -> str:
    """One histogram after another; each grid is (width, bins)."""
    lead = f"{by}, " if by else ""
    parts = []
    for name, (width, bins) in grids.items():
        size = f"CAST({width} AS DOUBLE)" if width else f"(CASE WHEN hi > lo THEN (hi - lo) / {bins} ELSE 1 END)"
        count = f"greatest(1, ceil((hi - lo) / {width}))" if width else str(bins)
        parts.append(f"""SELECT '{name}' AS feature, {lead}bin, round(lo + bin * size, 4) AS left_edge, count(*) AS n FROM (
  SELECT {lead}lo, {size} AS size, CAST(least({count} - 1, floor((v - lo) / {size})) AS INTEGER) AS bin
  FROM (SELECT {lead}CAST({name} AS DOUBLE) AS v FROM {rows} WHERE {name} IS NOT NULL),
       (SELECT min(CAST({name} AS DOUBLE)) AS lo, max(CAST({name} AS DOUBLE)) AS hi FROM {rows})) GROUP BY ALL""")
    return f"{fixture} " + " UNION ALL ".join(parts)


_NDOMS = "nd AS (SELECT event_no, count(DISTINCT string || '-' || dom_number) AS n FROM hits GROUP BY event_no)"
_PER_DOM = f"pd AS (SELECT {KEYS}, count(*) AS n FROM hits GROUP BY {KEYS})"
ORACLES["hist_doms_per_event"] = _hist(f"{hits()}, {_NDOMS}", "nd", "n", width=2)
ORACLES["hist_pulses_per_event"] = _hist(f"{PULSES}, pe AS (SELECT event_no, count(*) AS n FROM pulses GROUP BY 1)", "pe", "n", width=10)
ORACLES["hist_pulses_per_dom"] = _hist(f"{hits('l_suppkey')}, {_PER_DOM}", "pd", "n", width=3)
ORACLES["hist_pulses_per_dom_by_direction"] = _hist(
    f"""{hits()}, {TRUTH}, {_PER_DOM}, j AS (SELECT n, CASE WHEN zenith < 1.5707963267948966 THEN 'down' ELSE 'up' END AS direction
    FROM pd JOIN truth USING (event_no))""", "j", "n", width=1, by="direction")
ORACLES["hist_pulses_per_dom_by_interaction"] = _hist(
    f"""{hits()}, {TRUTH}, {_PER_DOM}, j AS (SELECT n, CASE InteractionType WHEN 1 THEN 'CC' WHEN 2 THEN 'NC' ELSE 'other' END AS interaction
    FROM pd JOIN truth USING (event_no))""", "j", "n", width=1, by="interaction")
ORACLES["hist_charge_log"] = _hist(PULSES, "pulses", "charge", bins=49, log=True)
ORACLES["hist_charge_per_dom"] = _hist(f"{PULSES}, t AS (SELECT sum(charge) AS q FROM pulses GROUP BY string, dom_number)", "t", "q", bins=49, log=True)
ORACLES["hist_charge_per_event"] = _hist(f"{PULSES}, t AS (SELECT sum(charge) AS q FROM pulses GROUP BY event_no)", "t", "q", bins=49, log=True)
ORACLES["hist_position_z"] = _hist(DOMS, "doms", "dom_z", width=50)
_FIRST = """first AS (SELECT event_no, string, dom_number, arg_min(charge, (dom_time, pulse_id)) AS q1, min(dom_time) AS t1,
  sum(charge) AS Qtotal, CASE WHEN count(*) <= 1 THEN -1 ELSE stddev_pop(dom_time) END AS sigmaT,
  CAST(coalesce(sum(charge) FILTER (WHERE dom_time - t_first < 25), 0) AS DOUBLE) AS Q25
  FROM (SELECT *, min(dom_time) OVER (PARTITION BY event_no, string, dom_number) AS t_first FROM pulses) GROUP BY 1, 2, 3)"""
for _axis in "xy":
    ORACLES[f"hist_position_{_axis}"] = _hist(DOMS, "doms", f"dom_{_axis}", width=50)
ORACLES["hist_first_charge"] = _hist(f"{PULSES}, {_FIRST}", "first", "q1", bins=49)
ORACLES["hist_first_time"] = _hist(f"{PULSES}, {_FIRST}", "first", "t1", width=12)
ORACLES["hist_total_charge_log"] = _hist(f"{PULSES}, {_FIRST}", "first", "Qtotal", bins=49, log=True)
ORACLES["hist_total_charge_adjusted"] = _hist(
    f"{PULSES}, {_FIRST}, a AS (SELECT log10(greatest(CAST(Qtotal AS DOUBLE), {CHARGE_FLOOR})) - {CHARGE_SHIFT} AS q FROM first)", "a", "q", bins=49
)
ORACLES["hist_early_charge"] = _hist(f"{PULSES}, {_FIRST}", "first", "Q25", width=20)
ORACLES["hist_time_spread"] = _hist(f"{PULSES}, {_FIRST}", "first", "sigmaT", width=10)
ORACLES["hist_zenith"] = _hist(TRUTH, "truth", "zenith", bins=50)
ORACLES["hist_azimuth"] = _hist(TRUTH, "truth", "azimuth", bins=50)
ORACLES["charge_raw_and_adjusted"] = f"""WITH {DOMS}, a AS (SELECT *, log10(greatest(Qtotal, {CHARGE_FLOOR})) - {CHARGE_SHIFT} AS adjusted FROM doms)
SELECT event_no, count(*) AS n_doms, round(sum(Qtotal), 4) AS raw_sum, round(max(Qtotal), 4) AS raw_max, round(avg(adjusted), 6) AS adjusted_mean,
  round(max(adjusted), 6) AS adjusted_max, count(*) FILTER (WHERE adjusted > -1) AS n_above_cut FROM a GROUP BY event_no"""
ORACLES["hist_energy_log"] = _hist(TRUTH, "truth", "energy", bins=49, log=True)
ORACLES["hist_cos_zenith"] = _hist(f"{TRUTH}, z AS (SELECT cos(zenith) AS c FROM truth)", "z", "c", bins=50)


def _feature_stats(rows: str, names, by="", digits=3, std="stddev_pop", with_std=True, missing=True) -> str:
    lead = f"{by}, " if by else ""
    parts = []
    for name in names:
        miss = f", count(*) - count({name}) AS n_missing" if missing else ""
        spread = f", round({std}({name}), {digits}) AS std" if with_std else ""
        parts.append(
            f"SELECT {lead}'{name}' AS feature, count(*) AS n{miss}, round(CAST(max({name}) AS DOUBLE), {digits}) AS max, "
            f"round(CAST(min({name}) AS DOUBLE), {digits}) AS min, round(avg({name}), {digits}) AS mean, "
            f"round(quantile_cont(CAST({name} AS DOUBLE), 0.5), {digits}) AS median{spread} FROM {rows} " + (f"GROUP BY {by}" if by else "")
        )
    return " UNION ALL ".join(parts)


ORACLES["feature_stats_by_class"] = f"""WITH {TRUTH}, {DOMS}, {_stretches('doms')}, j AS (SELECT * FROM truth LEFT JOIN stretch USING (event_no))
{_feature_stats('j', ['stretch_mean', 'stretch_max', 'energy'], 'flavour')}"""
ORACLES["summary_feature_stats"] = f"""{_PLAIN} {_feature_stats('plain', ['q1', 'Qtotal', 't1', 'T50', 'sigmaT'], digits=4, std='stddev_samp')}"""
ORACLES["energy_stats_by_part"] = f"WITH {PLACED} {_feature_stats('placed', ['energy', 'N_doms'], 'part_no', with_std=False, missing=False)}"
ORACLES["energy_five_numbers"] = f"""WITH {TRUTH} SELECT count(*) AS count, round(avg(energy), 3) AS mean, round(stddev_samp(energy), 3) AS std,
  round(min(energy), 3) AS min, {', '.join(f'round(quantile_cont(energy, {p / 100}), 3) AS p{p}' for p in (25, 50, 75))}, round(max(energy), 3) AS max FROM truth"""
_FIT = f"""{TRUTH}, v AS (SELECT log10(energy) AS v FROM truth WHERE energy > 0), r AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
b AS (SELECT least(49, floor((v - lo) / ((hi - lo) / 50))) AS bin, count(*) AS n FROM v, r GROUP BY 1),
p AS (SELECT log10(n) AS y, n AS w, log10((pow(10, lo + bin * (hi - lo) / 50) + pow(10, lo + (bin + 1) * (hi - lo) / 50)) / 2) AS x FROM b, r),
m AS (SELECT sum(w * x) / sum(w) AS mx, sum(w * y) / sum(w) AS my FROM p),
f AS (SELECT sum(w * (x - mx) * (y - my)) / sum(w * (x - mx) ** 2) AS slope, max(mx) AS mx, max(my) AS my FROM p, m),
fit AS (SELECT max(slope) AS slope, max(my - slope * mx) AS intercept, sum(w * (y - (my - slope * mx) - slope * x) ** 2) AS chi2, count(*) - 2 AS dof FROM p, f)"""
ORACLES["energy_powerlaw_fit"] = f"WITH {_FIT} SELECT round(slope, 5) AS slope, round(intercept, 5) AS intercept, round(chi2, 5) AS chi2, dof FROM fit"
# The incomplete gamma function by its series; where the tail is below 1e-100 it is 0.
ORACLES["energy_powerlaw_p_value"] = f"""WITH RECURSIVE {_FIT}, g AS (SELECT dof / 2.0 AS a, chi2 / 2 AS x FROM fit),
s AS (SELECT 0 AS n, CAST(1 AS DOUBLE) AS term, CAST(1 AS DOUBLE) AS total
  UNION ALL SELECT n + 1, term * x / (a + n + 1), total + term * x / (a + n + 1) FROM s, g WHERE term > 1e-17 * total AND x < a + 400)
SELECT round(slope, 5) AS slope, round(intercept, 5) AS intercept, round(chi2, 5) AS chi2, dof,
  round(CASE WHEN x < a + 400 THEN 1 - exp(a * ln(x) - x - lgamma(a + 1)) * (SELECT max(total) FROM s) ELSE 0 END, 8) AS p_value FROM fit, g"""
ORACLES["doms_below_limits"] = f"""WITH {hits()}, {_NDOMS}
SELECT round(avg(CASE WHEN n < 3 THEN 1.0 ELSE 0.0 END), 6) AS below_3, round(avg(CASE WHEN n < 5 THEN 1.0 ELSE 0.0 END), 6) AS below_5 FROM nd"""
for _name, _top in {"largest_event": 1, "busiest_events": 10}.items():
    ORACLES[_name] = f"WITH {PULSES} SELECT event_no, count(*) AS n FROM pulses GROUP BY 1 ORDER BY n DESC, event_no LIMIT {_top}"
ORACLES["run_value_counts"] = f"WITH {TRUTH} SELECT RunID, count(*) AS n FROM truth GROUP BY 1"
ORACLES["row_and_event_counts"] = "SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_events FROM events"
ORACLES["nth_event"] = f"""WITH {PULSES}, k AS (SELECT DISTINCT event_no FROM pulses ORDER BY 1 LIMIT 1 OFFSET 42)
SELECT event_no, pulse_id, CAST(charge AS DOUBLE) AS charge FROM pulses WHERE event_no IN (SELECT event_no FROM k)"""
ORACLES["first_events"] = f"""WITH {PULSES}, k AS (SELECT DISTINCT event_no FROM pulses ORDER BY 1 LIMIT 20)
SELECT event_no, pulse_id, string, dom_number FROM pulses WHERE event_no IN (SELECT event_no FROM k)"""
ORACLES["busy_sensor_series"] = f"""WITH {PULSES}, n AS (SELECT *, count(*) OVER (PARTITION BY {KEYS}) AS n_pulses FROM pulses)
SELECT {KEYS}, n_pulses, pulse_id, round(dom_time, 6) AS dom_time, CAST(charge AS DOUBLE) AS charge FROM n WHERE n_pulses > 7"""
ORACLES["marker_scale"] = f"""WITH {DOMS}, e AS (SELECT event_no, min(Qtotal) AS lo, max(Qtotal) AS hi, quantile_cont(Qtotal, 0.8) AS q FROM doms GROUP BY 1)
SELECT {KEYS}, round((Qtotal - lo) / nullif(hi - lo, 0), 6) AS marker, CAST(Qtotal >= q AS INTEGER) AS bright FROM doms JOIN e USING (event_no)"""

# ------------------------------------------------------------------------------ quality
ORACLES["nan_audit"] = f"""WITH {DAUGHTER}
SELECT event_no % 3 + 1 AS part_no, count(*) AS n_rows, count(*) - count(px) AS undefined_pos_x, count(*) FILTER (WHERE e IS NULL OR isnan(e)) AS undefined_energy,
  CAST(count(*) FILTER (WHERE e IS NULL OR isnan(e)) + count(*) - count(px) = 0 AS INTEGER) AS is_clean FROM daughter GROUP BY 1"""
ORACLES["event_range_overlap"] = f"""WITH {TRUTH}, r AS (SELECT RunID % 50 AS file_name, min(event_no) AS first_event, max(event_no) AS last_event FROM truth GROUP BY 1),
s AS (SELECT *, lag(file_name) OVER w AS previous, lag(last_event) OVER w AS before FROM r WINDOW w AS (ORDER BY first_event, last_event, file_name))
SELECT file_name, previous, first_event, last_event, least(before, last_event) - first_event + 1 AS overlap FROM s WHERE before >= first_event"""
ORACLES["offset_edges"] = f"""WITH {PLACED}, s AS (SELECT *, lag("offset") OVER w AS o, lag(shard_no) OVER w AS h FROM placed WINDOW w AS (PARTITION BY part_no ORDER BY event_no)),
f AS (SELECT part_no, event_no, shard_no, "offset", CAST(coalesce("offset" < o, FALSE) AS INTEGER) AS offset_fell, CAST(coalesce(shard_no <> h, TRUE) AS INTEGER) AS shard_edge FROM s)
SELECT * FROM f WHERE offset_fell = 1 OR shard_edge = 1"""
ORACLES["slice_audit"] = f"""WITH {PLACED}, {DOMS.replace(hits() + ',', '')},
p AS (SELECT part_no, shard_no, CAST(sum(N_doms) AS BIGINT) AS promised, max("offset") AS last_offset FROM placed GROUP BY 1, 2),
d AS (SELECT part_no, shard_no, count(*) AS present FROM doms JOIN placed USING (event_no) GROUP BY 1, 2)
SELECT part_no, shard_no, promised, last_offset, present, CAST(promised = present AND promised = last_offset AS INTEGER) AS consistent FROM p JOIN d USING (part_no, shard_no)"""
ORACLES["synopsis"] = """SELECT user_id AS event_no, 'events.parquet' AS file_name, min(event_id) + 1 AS start_offset, max(event_id) + 1 AS end_offset FROM events GROUP BY 1"""
ORACLES["missing_runs"] = f"""WITH {TRUTH} SELECT r AS RunID FROM range(2201200000, 2201202000) t(r) WHERE r NOT IN (SELECT RunID FROM truth)"""
ORACLES["negative_charge_audit"] = "SELECT c_custkey AS event_no, c_acctbal AS charge FROM customer WHERE c_acctbal < 0 AND c_acctbal <> -1"
ORACLES["constant_per_sensor"] = f"""WITH {PULSES} SELECT string, count(DISTINCT dom_z) AS n_values FROM pulses GROUP BY 1 HAVING count(DISTINCT dom_z) > 1"""

# ----------------------------------------------------------------------------- listings
_LINES = """lines AS (SELECT CASE WHEN o_orderstatus = 'P' THEN (o_custkey + 2201000000) || ',' || o_orderkey
  ELSE (o_custkey + 2201000000) || ',0,' || (o_orderkey % 5) || ',0' END AS line FROM orders)"""
_REDUCED = f"""{_LINES}, reduced AS (SELECT DISTINCT split_part(line, ',', 1) AS RunID, split_part(line, ',', 3) AS EventID
  FROM lines WHERE len(string_split(line, ',')) >= 4)"""
ORACLES["clean_ids_dedup"] = f"WITH {_REDUCED} SELECT RunID, EventID FROM reduced"
ORACLES["clean_ids_bucketed"] = f"""WITH {_REDUCED}, b AS (SELECT CAST(RunID AS BIGINT) % 1000 // 100 * 100 AS bucket FROM reduced
  WHERE CAST(RunID AS BIGINT) NOT IN (2201000020, 2201000107, 2201000731, 2201000858, 2201000904, 2201000963))
SELECT bucket, format('clean_event_ids_{{:07d}}-{{:07d}}.csv', bucket, bucket + 99) AS file_name, count(*) AS n FROM b GROUP BY 1, 2"""
ORACLES["listing_validity"] = f"""WITH {_LINES}
SELECT line, CAST(regexp_full_match(split_part(line, ',', 1), '\\d+') AS INTEGER) AS run_ok, CAST(line = trim(line) AS INTEGER) AS stripped,
  CASE WHEN len(string_split(line, ',')) >= 3 THEN split_part(line, ',', 3) END AS third FROM lines"""
ORACLES["job_log_table"] = """
SELECT o_custkey AS log, round(arg_max(round(o_totalprice / 1000, 2), o_orderkey), 4) AS source_file_size_GB,
  round(arg_min(round(o_totalprice / 100, 1), o_orderkey), 4) AS truth_file_size_MB,
  CAST(251.0 AS DOUBLE) AS memory_total_GB, CAST(245.71 AS DOUBLE) AS memory_available_GB,
  arg_max(o_orderkey % 48, o_orderkey) * 3600 + 307 AS elapsed_time_sec, arg_max(o_orderkey % 48, o_orderkey) || 'h 5m 7s' AS elapsed_time FROM orders GROUP BY 1"""

_CROSSED = "NOT missed AND t_in < t_out"
_EXACT_VERTEX = LABELLED.replace("CAST(CAST(px AS FLOAT) AS DOUBLE)", "px").replace("CAST(CAST(py AS FLOAT) AS DOUBLE)", "py").replace(
    "CAST(CAST(pz AS FLOAT) AS DOUBLE)", "pz"
)
ORACLES["prism_crossings"] = f"""WITH {_EXACT_VERTEX}
SELECT d.event_no, CASE WHEN {_CROSSED} THEN 2 ELSE 0 END AS n_intersections,
  {', '.join(f'round(CASE WHEN {_CROSSED} THEN d.p{a} + {t} * d.d{a} END, 4) AS {end}_{a}' for end, t in (('entry', 't_in'), ('exit', 't_out')) for a in 'xyz')}
FROM daughter d JOIN clipped USING (event_no)"""
ORACLES["event_activation"] = """SELECT CAST(user_id AS INTEGER) AS event_no, CAST(59 - event_id % 60 AS INTEGER) AS grid_row,
  CAST(user_id % 90 AS INTEGER) AS grid_column, count(*) AS n_pulses FROM events WHERE user_id % 90 < 86 GROUP BY 1, 2, 3"""
ORACLES["busy_sensors_per_event"] = f"""WITH {PULSES}, s AS (SELECT {KEYS}, count(*) AS n FROM pulses GROUP BY {KEYS})
SELECT event_no, count(*) AS n_sensors, max(n) AS most_pulses FROM s WHERE n > 6 GROUP BY event_no"""
ORACLES["shard_allow_list"] = f"""WITH {PLACED}, {DOMS.replace(hits() + ',', '')}
SELECT d.event_no, d.string, d.dom_number, p.shard_no FROM doms d JOIN placed p USING (event_no) WHERE p.N_doms >= 5"""


_GEOMETRY = ORACLES["shape_features_geometry"]
_FLAVOURED = f"shapes AS ({_GEOMETRY}), {TRUTH}, j AS (SELECT shapes.*, flavour FROM shapes JOIN truth USING (event_no))"
ORACLES["features_by_flavour"] = (
    f"WITH {_FLAVOURED} " + _feature_stats("j", ["extent_max", "stretch_max", "hypotenuse", "major_PCA", "area_ratio"], by="flavour")
)
ORACLES["feature_histograms_by_flavour"] = _hist(_FLAVOURED, "j", "hypotenuse", width=50, by="flavour")
ORACLES["first_rows"] = f"WITH {PULSES} SELECT pulse_id, event_no, string, dom_number, CAST(charge AS DOUBLE) AS charge, hlc FROM pulses ORDER BY pulse_id LIMIT 1000"


def _grids(grids) -> dict[str, tuple]:
    return {name: (grid.width, grid.bins) for name, grid in grids.items()}


def _histogram_oracles() -> dict[str, str]:
    from pulsegrid.plans.catalog import MEASURED_GRIDS, NORMALISED_GRIDS, SHAPE_GRIDS

    return {
        "all_feature_histograms": _hists(f"WITH c AS ({ORACLES['dom_summary_classic']})", "c", _grids(MEASURED_GRIDS)),
        "all_normalised_histograms": _hists(f"WITH c AS ({ORACLES['pseudo_normalised']})", "c", _grids(NORMALISED_GRIDS)),
        "shape_histograms_by_flavour": _hists(f"WITH {_FLAVOURED}", "j", _grids(SHAPE_GRIDS), by="flavour"),
    }


ORACLES |= _histogram_oracles()


def _face_rows() -> str:
    """Crossings by joining every line with every plane, and a second time for what lies within the others."""
    from pulsegrid.functions.geometry import CROSSING_CASES, PARALLEL, PRISM_XY, TOUCH, face_names, prism_planes

    (ax, ay), (bx, by), (cx, cy) = (PRISM_XY[i] for i in (5, 0, 1))
    touching = {"px": repr(bx), "py": repr(by), "pz": "event_no % 400", "dx": repr(cx - ax), "dy": repr(cy - ay), "dz": "0"}
    cells = ", ".join(f"CASE WHEN event_no % 17 = 0 THEN CAST({v} AS DOUBLE) ELSE {n} END AS {n}" for n, v in touching.items())
    dot = lambda normal, v: "(" + " + ".join(f"CAST({f!r} AS DOUBLE) * {v}{a}" for f, a in zip(normal, "xyz") if f) + ")"
    faces = " UNION ALL ".join(
        f"SELECT event_no, {i} AS i, '{name}' AS face, CAST({offset!r} AS DOUBLE) - {dot(normal, 'p')} AS room, {dot(normal, 'd')} AS speed FROM line"
        for i, (name, (*normal, offset)) in enumerate(zip(face_names(), prism_planes()))
    )
    cases = " ".join(
        f"WHEN n = {n}" + (f" AND (CASE WHEN t1 > 0 THEN 2 WHEN t2 >= 0 THEN 1 ELSE 0 END) = {order}" if n == 2 else "") + f" THEN '{name}'"
        for name, n, order in CROSSING_CASES
    )
    return f"""{DAUGHTER}, line AS (SELECT event_no, {cells} FROM daughter), plane AS ({faces}),
hit AS (SELECT event_no, i, face, room / speed AS t FROM plane WHERE abs(speed) > {PARALLEL}),
surface AS (SELECT h.event_no, h.i, any_value(h.face) AS face, any_value(h.t) AS t FROM hit h JOIN plane o USING (event_no)
  GROUP BY h.event_no, h.i HAVING min(o.room - h.t * o.speed) >= -{TOUCH}),
spaced AS (SELECT s.*, l.*, (t - lag(t) OVER (PARTITION BY s.event_no ORDER BY t, i)) * sqrt(dx * dx + dy * dy + dz * dz) AS gap
  FROM surface s JOIN line l USING (event_no)),
met AS (SELECT *, row_number() OVER (PARTITION BY event_no ORDER BY t, i) AS place FROM spaced WHERE gap IS NULL OR gap > {TOUCH}),
of_line AS (SELECT event_no, count(*) AS n, min(t) AS t1, max(t) AS t2 FROM met GROUP BY event_no),
named AS (SELECT l.*, coalesce(n, 0) AS n, CASE WHEN n IS NULL THEN 'NO_INTERSECTION' {cases} END AS crossing_case FROM line l LEFT JOIN of_line USING (event_no)),
crossed AS (SELECT n.event_no, CAST(m.place AS INTEGER) AS place, m.face, round(m.t, 4) AS t, {', '.join(f'round(n.p{a} + m.t * n.d{a}, 4) AS {a}' for a in 'xyz')},
  CAST(n.n AS INTEGER) AS n_crossings, crossing_case, CAST(m.t > 0 AS INTEGER) AS behind_vertex FROM named n LEFT JOIN met m USING (event_no))"""


ORACLES["prism_face_crossings"] = f"WITH {_face_rows()} SELECT * FROM crossed"
ORACLES["crossing_case_counts"] = f"WITH {_face_rows()} SELECT crossing_case, count(*) AS n_events FROM crossed WHERE place IS NULL OR place = 1 GROUP BY 1"

ORACLES["event_range_conflicts"] = f"""WITH {TRUTH}, r AS (
  SELECT CASE WHEN event_no % 13 = 0 THEN 'long' ELSE 'run ' || event_no // 300 END AS file_name, min(event_no) AS first_event, max(event_no) AS last_event
  FROM truth WHERE event_no % 300 < 250 GROUP BY 1),
p AS (SELECT b.*, a.file_name AS earlier, a.last_event AS reach, row_number() OVER (PARTITION BY b.file_name ORDER BY a.last_event DESC, a.file_name DESC) AS place
  FROM r a JOIN r b ON (a.first_event, a.last_event, a.file_name) < (b.first_event, b.last_event, b.file_name) AND a.last_event >= b.first_event)
SELECT file_name, earlier, first_event, last_event, least(reach, last_event) - first_event + 1 AS overlap FROM p WHERE place = 1"""
ORACLES["table_comparison"] = """WITH a AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderkey % 16 AS part FROM orders),
b AS (SELECT o_orderkey, CASE WHEN part = 7 AND o_orderkey % 480 = 7 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey,
  CASE WHEN part = 9 AND o_orderkey % 480 = 9 THEN NULL ELSE o_orderstatus END AS o_orderstatus, part FROM a WHERE NOT (part = 3 AND o_orderkey % 480 = 3)),
c AS (FROM b UNION ALL FROM b WHERE part = 5 AND o_orderkey % 480 = 5),
d AS (SELECT part, count(*) AS n FROM (FROM (FROM a EXCEPT ALL FROM c) UNION ALL FROM (FROM c EXCEPT ALL FROM a)) GROUP BY part)
SELECT x.part, n_left, n_right, CAST(d.n IS NULL AS INTEGER) AS equal
FROM (SELECT part, count(*) AS n_left FROM a GROUP BY part) x JOIN (SELECT part, count(*) AS n_right FROM c GROUP BY part) y ON x.part = y.part LEFT JOIN d ON d.part = x.part"""


def _audited() -> str:
    from pulsegrid.plans.catalog import AUDITED

    return " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, count(*) AS n_rows, CAST(min({key}) AS BIGINT) AS first_event, CAST(max({key}) AS BIGINT) AS last_event,
  CAST(len(names) AS BIGINT) AS n_columns, array_to_string(list_sort(list_filter({expected!r}, lambda c: NOT list_contains(names, c))), ',') AS missing,
  CAST(len(list_filter(names, lambda c: NOT list_contains({expected!r}, c))) AS BIGINT) AS n_surplus
FROM {t}, (SELECT list(column_name) AS names FROM (DESCRIBE {t})) GROUP BY names"""
        for t, (key, expected) in AUDITED.items()
    )


ORACLES["footer_audit"] = _audited()

ORACLES["summary_list_variant"] = f"""WITH {PULSES}, dark AS (SELECT * REPLACE (CASE WHEN string = 3 THEN 0 ELSE charge END AS charge) FROM pulses),
{_annotated('dark', 'dom_time, pulse_id')}
SELECT {KEYS}, round(CAST(max(qt) AS DOUBLE), 6) AS Qtotal, {', '.join(f"round({_t_fraction(p).replace('), -1.0) END', '), 0.0) END').replace(f' AS T{p}', '')}, 6) AS T{p}" for p in (10, 50))}
FROM marked GROUP BY {KEYS}"""
_STORED = """stored AS (SELECT *, first_value(dom_time) OVER (PARTITION BY event_no, string, dom_number ORDER BY pulse_id) AS ts,
  count(*) OVER (PARTITION BY event_no, string, dom_number) AS m FROM pulses)"""
_SPREAD = ", ".join(
    f"round({rule}(CAST({c} AS DOUBLE){', 0.5' if name == 'median' else ''}), 6) AS {name}_{short}"
    for c, short in (("charge", "charge"), ("dom_time", "time"))
    for name, rule in (("max", "max"), ("min", "min"), ("median", "quantile_cont"), ("mean", "avg"))
)
ORACLES["busy_sensor_summary"] = f"""{_BASE}, {_STORED},
a AS (SELECT {KEYS}, {_t_fraction(10)}, {_t_fraction(50)}, stddev_pop(dom_time) AS sigmaT FROM marked WHERE n > 6 GROUP BY {KEYS})
SELECT {KEYS}, count(*) AS n_pulses, {_SPREAD}, {', '.join(f'round(any_value({t}), 6) AS {t}' for t in ('T10', 'T50', 'sigmaT'))},
  {', '.join(f'round(CAST(coalesce(sum(charge) FILTER (WHERE dom_time - ts < {w}), 0) AS DOUBLE), 6) AS Q{w}' for w in (25, 75))}
FROM stored JOIN a USING ({KEYS}) WHERE m > 6 GROUP BY {KEYS}"""
_COUNTED = "n AS (SELECT {k}, count(*) AS n FROM pulses GROUP BY {k})".format(k=KEYS)
ORACLES["hist_pulses_per_dom_of_event"] = _hist(
    f"{PULSES}, {_COUNTED}, e AS (SELECT * FROM n WHERE n > 2 AND event_no = (SELECT event_no FROM (SELECT DISTINCT event_no FROM pulses) ORDER BY 1 LIMIT 1 OFFSET 42))",
    "e", "n", width=1,
)
ORACLES["hist_busy_pulses_per_dom"] = _hist(f"{PULSES}, {_COUNTED}, e AS (SELECT * FROM n WHERE n > 4)", "e", "n", width=5)
ORACLES["event_number_receipt"] = f"""WITH {TRUTH} SELECT event_no AS original_event_no, CAST(format('112{{:04d}}{{:08d}}', part_no, event_no) AS BIGINT) AS event_no,
  'merged_part_' || part_no || '.db' AS source_file FROM truth"""


def _event_statistics() -> str:
    from pulsegrid.operators.shape import EVENT_STATISTICS

    values = {"raw_Qtotal": "Qtotal", "raw_t1": "t1", "adjusted_Qtotal": "CASE WHEN a > -0.5 THEN a END", "kept_t1": "CASE WHEN a > -0.5 THEN t1 END"}
    rules = {"max": "max({})", "min": "min({})", "mean": "avg({})", "median": "quantile_cont({}, 0.5)"}
    cells = []
    for name in EVENT_STATISTICS:
        value, rule = name.rsplit("_", 1)
        cells.append(f"round({rules[rule].format(values[value])}, 5) AS {name}")
    return f"""WITH {PULSES}, {_FIRST}, q AS (SELECT event_no, CAST(Qtotal AS DOUBLE) AS Qtotal, t1, log10(greatest(CAST(Qtotal AS DOUBLE), {CHARGE_FLOOR})) - {CHARGE_SHIFT} AS a FROM first)
SELECT event_no, count(*) AS n_doms, count(*) FILTER (WHERE a > -0.5) AS n_kept, {', '.join(cells)} FROM q GROUP BY event_no"""


ORACLES["charge_and_time_statistics"] = _event_statistics()
