"""Array kernels over grouped points.

Groups lie one after another; `starts` and `sizes` give their rows.  All groups
are processed together, no loop runs over events except where noted.
"""

from __future__ import annotations

import numpy as np

PAIR_BLOCK = 2_000_000


def _blocks(sizes: np.ndarray, budget: int = PAIR_BLOCK):
    """Runs of groups whose pair count stays within the budget (at least one group)."""
    cost = np.cumsum(sizes.astype(np.int64) ** 2)
    at, spent = 0, 0
    while at < len(sizes):
        stop = max(at + 1, int(np.searchsorted(cost, spent + budget, side="right")))
        yield at, stop
        at, spent = stop, int(cost[stop - 1])


def _pair_index(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ordered pairs of rows of the same group, as two index arrays."""
    per_row = np.repeat(sizes, sizes)
    rows = np.repeat(starts, sizes) + _within(sizes)
    left = np.repeat(rows, per_row)
    right = np.repeat(np.repeat(starts, sizes), per_row) + _within(per_row)
    return left, right


def _within(sizes: np.ndarray) -> np.ndarray:
    """0..size-1 for each group in turn."""
    total = int(sizes.sum())
    return np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def farthest_pairs(points: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
    """Largest distance in each group and the rows of the first pair that has it."""
    best = np.zeros(len(sizes))
    end_a, end_b = starts.copy(), starts.copy()
    for lo, hi in _blocks(sizes):
        if hi - lo == 1 and int(sizes[lo]) ** 2 > PAIR_BLOCK:
            best[lo], end_a[lo], end_b[lo] = _farthest_in_large(points, int(starts[lo]), int(sizes[lo]))
            continue
        left, right = _pair_index(starts[lo:hi], sizes[lo:hi])
        d2 = ((points[left] - points[right]) ** 2).sum(axis=1)
        counts = sizes[lo:hi].astype(np.int64) ** 2
        first = np.cumsum(counts) - counts
        top = np.maximum.reduceat(d2, first)
        hit = np.flatnonzero(d2 == np.repeat(top, counts))
        group = np.repeat(np.arange(hi - lo), counts)[hit]
        place = hit[np.searchsorted(group, np.arange(hi - lo))]
        best[lo:hi] = np.sqrt(top)
        end_a[lo:hi], end_b[lo:hi] = left[place], right[place]
    return best, end_a, end_b


def _farthest_in_large(points: np.ndarray, start: int, size: int):
    """Exact: only points that could reach the longest distance found so far are paired."""
    own = points[start : start + size]
    centre = (own.min(axis=0) + own.max(axis=0)) / 2
    radius = np.sqrt(((own - centre) ** 2).sum(axis=1))
    seed = own[int(np.argmax(radius))]
    bound = 0.0
    for _ in range(4):
        away = np.sqrt(((own - seed) ** 2).sum(axis=1))
        bound = max(bound, float(away.max()))
        seed = own[int(np.argmax(away))]
    rows = np.flatnonzero(radius + radius.max() >= bound * (1 - 1e-12))
    kept = own[rows]
    best, a, b = -1.0, 0, 0
    step = max(1, PAIR_BLOCK // max(1, len(kept)))
    for at in range(0, len(kept), step):
        d2 = ((kept[at : at + step, None, :] - kept[None, :, :]) ** 2).sum(axis=2)
        flat = int(np.argmax(d2))
        if d2.flat[flat] > best:
            best = float(d2.flat[flat])
            a, b = at + flat // len(kept), flat % len(kept)
    return np.sqrt(best), start + rows[a], start + rows[b]


def hull_rows(x: np.ndarray, y: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
    """Rows of the convex hull of each group, counter-clockwise, and hull sizes.

    Points must be distinct and sorted by (x, y) in each group.  Both chains are
    grown for all groups at once, one rank at a time.
    """
    lower, lower_n = _chain(x, y, starts, sizes, starts, np.ones(len(sizes), dtype=np.int64))
    last = starts + sizes - 1
    upper, upper_n = _chain(x, y, starts, sizes, last, -np.ones(len(sizes), dtype=np.int64))
    # Each chain ends where the other begins; drop the shared ends.
    take_lower, take_upper = np.maximum(lower_n - 1, 1), np.maximum(upper_n - 1, 0)
    take_upper = np.where(sizes == 1, 0, take_upper)
    hull_n = take_lower + take_upper
    lower_at = np.repeat(starts, take_lower) + _within(take_lower)
    upper_at = np.repeat(starts, take_upper) + _within(take_upper)
    group = np.concatenate([np.repeat(np.arange(len(sizes)), take_lower), np.repeat(np.arange(len(sizes)), take_upper)])
    rows = np.concatenate([lower[lower_at], upper[upper_at]])
    order = np.argsort(group, kind="stable")
    return rows[order], hull_n


def _chain(x, y, starts, sizes, first, step):
    stack = np.zeros(len(x), dtype=np.int64)
    depth = np.zeros(len(sizes), dtype=np.int64)
    for rank in range(int(sizes.max())):
        alive = np.flatnonzero(sizes > rank)
        point = first[alive] + step[alive] * rank
        popping = np.arange(len(alive))
        while len(popping):
            g = alive[popping]
            popping = popping[depth[g] >= 2]
            g = alive[popping]
            if not len(popping):
                break
            a, b, c = stack[starts[g] + depth[g] - 2], stack[starts[g] + depth[g] - 1], point[popping]
            ux, uy, vx, vy = x[b] - x[a], y[b] - y[a], x[c] - x[a], y[c] - y[a]
            turn = ux * vy - uy * vx
            flat = 1e-12 * (np.abs(ux * vy) + np.abs(uy * vx))
            popping = popping[turn <= flat]
            depth[alive[popping]] -= 1
        stack[starts[alive] + depth[alive]] = point
        depth[alive] += 1
    return stack, depth


def group_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts)


def principal_axes(x: np.ndarray, y: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
    """Lengths along both principal axes (sample variance) and the major direction."""
    mx = group_sums(x, starts) / sizes
    my = group_sums(y, starts) / sizes
    dx, dy = x - np.repeat(mx, sizes), y - np.repeat(my, sizes)
    dof = np.maximum(sizes - 1, 1)
    a, c, b = (group_sums(v, starts) / dof for v in (dx * dx, dy * dy, dx * dy))
    half, gap = (a + c) / 2, np.hypot((a - c) / 2, b)
    major, minor = np.sqrt(half + gap), np.sqrt(np.maximum(half - gap, 0.0))
    minor = np.where(minor <= 1e-7 * major, 0.0, minor)
    angle = np.arctan2(2 * b, a - c) / 2
    return major, minor, np.cos(angle), np.sin(angle)


def boundary_features(columns, starts, sizes):
    """Extent, principal axes and area of the outline of each group of distinct points."""
    x, y = columns["x"].astype(float), columns["y"].astype(float)
    rows, hull_n = hull_rows(x, y, starts, sizes)
    proper = hull_n >= 3
    # Collinear groups keep all their points.
    keep_n = np.where(proper, hull_n, sizes)
    hull_start = np.cumsum(hull_n) - hull_n
    all_rows = np.repeat(starts, keep_n) + _within(keep_n)
    hull_at = np.repeat(hull_start, keep_n) + _within(keep_n)
    border = np.where(np.repeat(proper, keep_n), rows[np.minimum(hull_at, len(rows) - 1)], all_rows)
    bx, by = x[border], y[border]
    first = np.cumsum(keep_n) - keep_n
    # In row order, so that of several longest lines the smallest one is named.
    ordered = np.sort(border)
    extent, end_a, end_b = farthest_pairs(np.column_stack([x[ordered], y[ordered]]), first, keep_n)
    end_a, end_b = ordered[end_a], ordered[end_b]
    major, minor, ux, uy = principal_axes(bx, by, first, keep_n)
    following = np.where(_within(keep_n) + 1 < np.repeat(keep_n, keep_n), np.arange(len(bx)) + 1, np.repeat(first, keep_n))
    area = np.abs(group_sums(bx * by[following] - bx[following] * by, first)) / 2
    single = sizes < 2
    return {
        "n_points": sizes.astype(np.int64),
        "n_border": keep_n.astype(np.int64),
        "extent": np.where(single, 0.0, extent),
        "end1_x": x[end_a], "end1_y": y[end_a], "end2_x": x[end_b], "end2_y": y[end_b],
        "major": np.where(single, np.nan, major),
        "minor": np.where(single, np.nan, minor),
        "axis_x": ux, "axis_y": uy,
        "area": np.where(proper, area, np.nan),
    }


def repeat_counts(weights, starts, sizes):
    """Weights quantised to 1..10 relative to the largest of the group."""
    top = np.maximum.reduceat(weights, starts)
    return np.clip(weights / (np.repeat(top, sizes) + 1e-7) * 10, 1, 10).astype(np.int64)


def _spread(x, y, starts, sizes):
    out = 0.0
    for v in (x, y):
        mean = group_sums(v, starts) / sizes
        out = out + np.sqrt(group_sums((v - np.repeat(mean, sizes)) ** 2, starts) / sizes)
    return out / 2


def _kmeans_once(x, y, w, starts, sizes, near, rounds=100):
    """Lloyd iterations for two centres per group from a first split; (cost, centres x, centres y).

    A group that has settled stays as it is, so a group's result does not depend on its neighbours.
    """
    cx, cy = (np.repeat((group_sums(w * v, starts) / group_sums(w, starts))[:, None], 2, axis=1) for v in (x, y))
    for _ in range(rounds):
        for k, member in enumerate((~near, near)):
            mass = group_sums(w * member, starts)
            safe = np.where(mass > 0, mass, 1)
            cx[:, k] = np.where(mass > 0, group_sums(w * member * x, starts) / safe, cx[:, k])
            cy[:, k] = np.where(mass > 0, group_sums(w * member * y, starts) / safe, cy[:, k])
        d = [(x - np.repeat(cx[:, k], sizes)) ** 2 + (y - np.repeat(cy[:, k], sizes)) ** 2 for k in (0, 1)]
        now = d[1] < d[0]
        if np.array_equal(now, near):
            break
        near = now
    return group_sums(w * np.minimum(*d), starts), cx, cy


def two_means(x, y, w, starts, sizes, directions=8):
    """Best of fixed starts per group: the points split at their mean along each of several directions.

    Ties go to the first direction, so results are the same in any grouping of events.
    """
    best = np.full(len(sizes), np.inf)
    bx, by = np.zeros((len(sizes), 2)), np.zeros((len(sizes), 2))
    mass = group_sums(w, starts)
    mx, my = (np.repeat(group_sums(w * v, starts) / mass, sizes) for v in (x, y))
    for i in range(directions):
        angle = np.pi * i / directions
        along = (x - mx) * np.cos(angle) + (y - my) * np.sin(angle)
        cost, cx, cy = _kmeans_once(x, y, w, starts, sizes, along > 0)
        better = cost < best * (1 - 1e-12)
        best = np.where(better, cost, best)
        bx[better], by[better] = cx[better], cy[better]
    return bx, by


def two_gaussians(x, y, w, starts, sizes, cx, cy, rounds=100, tolerance=1e-3, floor=1e-6):
    """Full-covariance EM for two components per group, begun at the given centres."""
    groups = len(sizes)
    mass = group_sums(w, starts).astype(float)
    d = [(x - np.repeat(cx[:, k], sizes)) ** 2 + (y - np.repeat(cy[:, k], sizes)) ** 2 for k in (0, 1)]
    share = np.column_stack([d[0] <= d[1], d[1] < d[0]]).astype(float)
    mx, my = cx.copy(), cy.copy()
    last = np.full(groups, -np.inf)
    settled = np.zeros(groups, dtype=bool)
    for _ in range(rounds):
        density = []
        for k in (0, 1):
            r = w * share[:, k]
            n = group_sums(r, starts) + 1e-12
            nx, ny = group_sums(r * x, starts) / n, group_sums(r * y, starts) / n
            mx[:, k], my[:, k] = np.where(settled, mx[:, k], nx), np.where(settled, my[:, k], ny)
            dx, dy = x - np.repeat(nx, sizes), y - np.repeat(ny, sizes)
            a, c, b = (group_sums(r * v, starts) / n for v in (dx * dx, dy * dy, dx * dy))
            a, c = a + floor, c + floor
            det = np.maximum(a * c - b * b, 1e-300)
            form = (np.repeat(c / det, sizes) * dx * dx - 2 * np.repeat(b / det, sizes) * dx * dy
                    + np.repeat(a / det, sizes) * dy * dy)
            density.append(np.repeat(np.log(np.maximum(n / mass, 1e-300)) - np.log(2 * np.pi) - np.log(det) / 2, sizes) - form / 2)
        both = np.logaddexp(*density)
        share = np.exp(np.column_stack(density) - both[:, None])
        likelihood = group_sums(w * both, starts) / mass
        settled |= np.abs(likelihood - last) < tolerance
        last = likelihood
        if settled.all():
            break
    return mx, my


def _shifted(px, py, x, y, w, bandwidth):
    """One step of every moving point of one group, in strips of bounded size: (new x, new y, mass seen)."""
    nx, ny, crowd = np.empty_like(px), np.empty_like(py), np.empty_like(px)
    step = max(1, PAIR_BLOCK // len(x))
    for at in range(0, len(px), step):
        part = slice(at, at + step)
        mass = w * ((px[part, None] - x) ** 2 + (py[part, None] - y) ** 2 <= bandwidth**2)
        crowd[part] = mass.sum(axis=1)
        nx[part], ny[part] = mass @ x / np.maximum(crowd[part], 1), mass @ y / np.maximum(crowd[part], 1)
    return nx, ny, crowd


def shifted_means(x, y, w, starts, sizes, bandwidth=150.0, rounds=300):
    """Flat-kernel mean shift from every point; returns the largest centre distance per group.

    Loops over groups, each of which stops by itself; pairs are formed in strips.
    """
    out = np.zeros(len(sizes))
    for g, (start, size) in enumerate(zip(starts.tolist(), sizes.tolist())):
        own = slice(start, start + size)
        gx, gy, gw = x[own].astype(float), y[own].astype(float), w[own].astype(float)
        px, py = gx, gy
        for _ in range(rounds):
            nx, ny, crowd = _shifted(px, py, gx, gy, gw, bandwidth)
            moved = np.hypot(nx - px, ny - py).max()
            px, py = nx, ny
            if moved < 1e-3 * bandwidth:
                break
        order = np.lexsort((py, px, -crowd))
        cx, cy = px[order], py[order]
        free, centres = np.ones(size, dtype=bool), []
        for i in range(size):
            if free[i]:
                centres.append(i)
                free &= np.hypot(cx - cx[i], cy - cy[i]) > bandwidth
        out[g] = np.hypot(cx[centres][:, None] - cx[centres], cy[centres][:, None] - cy[centres]).max()
    return out


def cluster_scores(columns, starts, sizes, mean_shift=False):
    """Separation scores of the charge-weighted string positions of each event."""
    x, y = columns["x"].astype(float), columns["y"].astype(float)
    w = repeat_counts(columns["w"].astype(float), starts, sizes)
    scale = _spread(x, y, starts, sizes) + 1e-7
    kx, ky = two_means(x, y, w, starts, sizes)
    gx, gy = two_gaussians(x, y, w, starts, sizes, kx, ky)
    gaps = {
        "gmm_score": np.hypot(gx[:, 0] - gx[:, 1], gy[:, 0] - gy[:, 1]),
        "kmeans_score": np.hypot(kx[:, 0] - kx[:, 1], ky[:, 0] - ky[:, 1]),
    }
    if mean_shift:
        gaps["meanshift_score"] = shifted_means(x, y, w, starts, sizes)
    return {name: np.where(sizes >= 2, gap / scale, np.nan) for name, gap in gaps.items()}


def _scatter(values: np.ndarray, groups: np.ndarray, count: int) -> np.ndarray:
    out = np.full(count, np.nan)
    out[groups] = values
    return out


def stretch_features(stretch, starts, sizes):
    """Mean, maximum and half the central range of the values of each group."""
    group = np.repeat(np.arange(len(sizes)), sizes)
    ordered = stretch[np.lexsort((stretch, group))]

    def quantile(share):
        at = share * (sizes - 1)
        low = np.floor(at).astype(np.int64)
        a, b = ordered[starts + low], ordered[starts + np.minimum(low + 1, sizes - 1)]
        return a + (b - a) * (at - low)

    return {
        "stretch_mean": group_sums(stretch, starts) / sizes,
        "stretch_max": ordered[starts + sizes - 1],
        "stretch_hiqr": (quantile(0.843) - quantile(0.157)) / 2,
    }


def spread_features(x, y, w, starts, sizes, bins=10):
    """Outer charge share and charge-weighted mean distance of each group; NaN below three strings."""
    total = group_sums(w, starts)
    with np.errstate(divide="ignore", invalid="ignore"):
        cx, cy = group_sums(x * w, starts) / total, group_sums(y * w, starts) / total
        d = np.hypot(x - np.repeat(cx, sizes), y - np.repeat(cy, sizes))
        top = np.maximum.reduceat(d, starts)
        place = np.minimum(np.floor(d * bins / np.repeat(top, sizes)), bins - 1)
        outer = group_sums(np.where(place >= bins // 2, w, 0.0), starts) / (total + 1e-8)
        mean = group_sums(d * w, starts) / total
    enough = (sizes >= 3) & (total != 0)
    return {
        "outer_mass_fraction": np.where(enough & (top > 0), outer, np.nan),
        "normalised_weighted_distance": np.where(enough, mean, np.nan),
    }


def event_shape(columns, starts, sizes, outline_of_cut=False, clusters=True):
    """All shape features of each event from rows per (string, x, y).

    Columns: string (-1 = none), x, y; of the sensors above the charge cut n
    (count), w (charge) and z_low, z_high.  The outline uses all rows, or only
    those with sensors above the cut.
    """
    count = len(sizes)
    group = np.repeat(np.arange(count), sizes)
    above = columns["n"] > 0

    points = np.flatnonzero(above) if outline_of_cut else np.arange(len(group))
    order = points[np.lexsort((columns["y"][points], columns["x"][points], group[points]))]
    px, py, pg = columns["x"][order], columns["y"][order], group[order]
    fresh = np.concatenate([[True], (pg[1:] != pg[:-1]) | (px[1:] != px[:-1]) | (py[1:] != py[:-1])])[: len(pg)]
    px, py, pg = px[fresh], py[fresh], pg[fresh]
    out = {}
    if len(pg):
        at, held = _runs(pg)
        for name, values in boundary_features({"x": px, "y": py}, at, held).items():
            out[name] = _scatter(values.astype(float), pg[at], count)
    else:
        out |= {name: np.full(count, np.nan) for name in BOUNDARY}

    rows = np.flatnonzero(above & (columns["string"] >= 0))
    names = [*STRETCH, *SPREAD, *(CLUSTERS if clusters else [])]
    if not len(rows):
        return out | {name: np.full(count, np.nan) for name in names}
    # Rows of one string are joined first: it may have more than one position.
    rows = rows[np.lexsort((columns["string"][rows], group[rows]))]
    key = group[rows] * np.int64(1 << 32) + columns["string"][rows].astype(np.int64)
    at, _ = _runs(key)
    n, w = (np.add.reduceat(columns[c][rows].astype(float), at) for c in ("n", "w"))
    sx, sy = (np.add.reduceat(columns[c][rows] * columns["n"][rows], at) / n for c in ("x", "y"))
    tall = np.maximum.reduceat(columns["z_high"][rows], at) - np.minimum.reduceat(columns["z_low"][rows], at)
    sg = group[rows][at]
    first, held = _runs(sg)
    found = stretch_features(tall, first, held) | spread_features(sx, sy, w, first, held)
    if clusters:
        place = np.lexsort((sy, sx, sg))
        found |= cluster_scores({"x": sx[place], "y": sy[place], "w": w[place]}, first, held)
    return out | {name: _scatter(values, sg[first], count) for name, values in found.items()}


def _runs(keys):
    at = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1]).astype(np.int64)
    return at, np.diff(np.append(at, len(keys)))


BOUNDARY = (
    "n_points", "n_border", "extent", "end1_x", "end1_y", "end2_x", "end2_y", "major", "minor", "axis_x", "axis_y", "area",
)
STRETCH = ("stretch_mean", "stretch_max", "stretch_hiqr")
SPREAD = ("outer_mass_fraction", "normalised_weighted_distance")
CLUSTERS = ("gmm_score", "kmeans_score")
