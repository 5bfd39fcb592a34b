"""Runs of repeated words, found from string synchronising sets.

A run is a stretch of words with a smallest period q, at least max(12, 2q) long, that
neither neighbour extends.  The words of many texts stand in one array, each text closed
by a word of its own, so nothing matches across texts, and every step below is array
arithmetic over the slice.

Periods below `DIRECT` are read off directly by comparing the array with itself.  For
each larger scale t = 4, 8, 16, ... the periods from 3t to 6t - 1 are proposed by

* the synchronising set: positions whose hash of the next t words is least among those
  from it to t words on, or that of the position t words on is; positions within regions of period
  t/3 or less take no part.  Whether a position belongs depends on its next 2t words only,
  so a run that holds a position and its copy one period on has both in the set, with
  equal contexts.  Pairs of equal contexts at a distance of 3t to 6t - 1 propose it.
* junctions of two regions of one small period, found at smaller scales: where both copies of
  a run's period lie within such regions, the set is empty, and the periods that map the
  one region onto the other are proposed.

A proposal is extended by comparing hashes of stretches, and what is found is compared
word by word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import with_scanned

LEAST_LENGTH = 12
DIRECT = 12  # periods below this are compared directly; three times the first scale
FIRST_SCALE = 4

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * _MIX
    x = (x ^ x >> np.uint64(32)) * _MIX
    return x ^ x >> np.uint64(32)


class Words:
    """An array of word numbers with hashes of all its stretches."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        n = len(words)
        powers = np.full(n + 1, _BASE, np.uint64)
        powers[0] = 1
        self.powers = np.multiply.accumulate(powers)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(words.astype(np.uint64) + np.uint64(1)) * self.powers[:n])])

    def __len__(self) -> int:
        return len(self.words)

    def hashes(self, length: int) -> np.ndarray:
        """Of the `length` words from every position, comparable with each other."""
        n = len(self) - length + 1
        return (self.sums[length:] - self.sums[:n]) * self.powers[:n][::-1]

    def same(self, i: np.ndarray, j: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        """Whether the stretches from i and from j > i are equal."""
        return (self.sums[i + length] - self.sums[i]) * self.powers[j - i] == self.sums[j + length] - self.sums[j]

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest equal stretches from i and j > i on."""
        found, room = np.zeros(len(i), np.int64), len(self) - j
        for bit in range(int(room.max(initial=0)).bit_length() - 1, -1, -1):
            step = 1 << bit
            at = np.flatnonzero(found + step <= room)
            grown = at[self.same(i[at] + found[at], j[at] + found[at], step)]
            found[grown] += step
        return found

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest equal stretches that end before i and j > i."""
        found = np.zeros(len(i), np.int64)
        for bit in range(int(i.max(initial=0)).bit_length() - 1, -1, -1):
            step = 1 << bit
            at = np.flatnonzero(found + step <= i)
            grown = at[self.same(i[at] - found[at] - step, j[at] - found[at] - step, step)]
            found[grown] += step
        return found


def _direct(words: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of at least twice the period."""
    equal = np.zeros(len(words) - period + 2, np.int8)
    equal[1:-1] = words[:-period] == words[period:]
    turns = np.diff(equal)
    start, end = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1) + period
    long = end - start >= 2 * period
    return start[long], end[long]


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of the `width` values from each position."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


class Runs:
    """Runs found so far: start, end, period; one of each stretch, that of the smallest period."""

    def __init__(self) -> None:
        self.rows = np.zeros((0, 3), np.int64)

    def add(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        rows = np.concatenate([self.rows, np.column_stack([start, end, period]).astype(np.int64)])
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        first = np.ones(len(rows), bool)
        first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
        self.rows = rows[first]


def synchronising_set(words: Words, scale: int, regions: np.ndarray) -> np.ndarray:
    """Positions of the set at this scale; `regions` are runs of periods up to a third of it (start, end)."""
    n = len(words)
    if n < 2 * scale:
        return np.zeros(0, np.int64)
    value = _mixed(words.hashes(scale)) >> np.uint64(1)
    inside = np.zeros(len(value) + 1, np.int64)
    held = regions[regions[:, 1] - regions[:, 0] >= scale]
    np.add.at(inside, held[:, 0], 1)
    np.add.at(inside, np.minimum(held[:, 1] - scale + 1, len(value)), -1)
    value[np.cumsum(inside[:-1]) > 0] = np.uint64(0xFFFFFFFFFFFFFFFF)
    least = _window_least(value, scale + 1)
    at = slice(0, len(least))
    chosen = (least != np.uint64(0xFFFFFFFFFFFFFFFF)) & ((value[at] == least) | (value[scale : scale + len(least)] == least))
    return np.flatnonzero(chosen)


def _equal_contexts(words: Words, chosen: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (position, distance) of the set with equal contexts of 2 * scale words, at distances of 3 to below 6 scales."""
    chosen = chosen[chosen + 2 * scale <= len(words)]
    context = words.hashes(2 * scale)[chosen]
    order = np.argsort(context, kind="stable")
    place, context = chosen[order], context[order]
    near, far = [], []
    # Outside of regions of small period, equal contexts are more than a third of the scale apart: few steps reach 6 scales.
    for lag in range(1, len(place)):
        gap = place[lag:] - place[:-lag]
        equal = (context[lag:] == context[:-lag]) & (gap < 6 * scale)
        if not equal.any():
            break
        wanted = equal & (gap >= 3 * scale)
        near.append(place[:-lag][wanted])
        far.append(gap[wanted])
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *near]), np.concatenate([empty, *far])


def _junctions(words: Words, regions: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (position, period) where a region of small period is followed by another of the same that it touches or overlaps."""
    rows = regions[regions[:, 1] - regions[:, 0] >= 3 * scale]
    where, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for q in np.unique(rows[:, 2]).tolist():
        own = rows[rows[:, 2] == q]
        own = own[np.argsort(own[:, 0])]
        # Two regions of one period overlap by less than it, so only neighbours can meet.
        touch = np.flatnonzero((own[1:, 0] <= own[:-1, 1]) & (own[1:, 0] > own[:-1, 1] - q))
        # A run across the junction of 2p to below 2p + q words holds this period of the first region and its copy.
        at = own[touch, 1] - 2 * q + 1
        for first in range(q):
            ok = at + 3 * scale + first + q <= len(words)
            i = at[ok]
            fits = words.same(i, i + 3 * scale + first, q)
            for p in range(3 * scale + first, 6 * scale, q):
                here = i[fits & (i + p < len(words))]
                where.append(here)
                periods.append(np.full(len(here), p))
    return np.concatenate(where), np.concatenate(periods)


def find_runs(words: np.ndarray, longest: int | None = None, least: int = LEAST_LENGTH) -> np.ndarray:
    """(start, end, period) of all runs of an array of word numbers, by start, then period.

    `longest` bounds the length of a run, where separators do; no larger period is looked for than half of it.
    """
    n = len(words)
    longest = min(n, n if longest is None else longest)
    runs = Runs()
    for period in range(1, min(DIRECT - 1, longest // 2) + 1):
        start, end = _direct(words, period)
        runs.add(start, end, np.full(len(start), period))
    scale = FIRST_SCALE
    whole = Words(words) if 6 * scale <= longest else None
    while 6 * scale <= longest:  # a run of period 3 * scale is twice as long
        regions = runs.rows[runs.rows[:, 2] * 3 <= scale]
        pairs = _equal_contexts(whole, synchronising_set(whole, scale, regions), scale)
        more = _junctions(whole, regions, scale)
        i, p = (np.concatenate(x) for x in zip(pairs, more, strict=True))
        if len(i):
            # Neighbouring proposals of one period mostly belong to one run: keep those not within the stretch of the one before.
            order = np.lexsort((i, p))
            i, p = i[order], p[order]
            while len(i):
                lead = np.ones(len(i), bool)
                lead[1:] = (p[1:] != p[:-1]) | (i[1:] - i[:-1] > scale)
                a, b = i[lead], p[lead]
                start, end = a - whole.behind(a, a + b), a + b + whole.ahead(a, a + b)
                _add_checked(runs, words, start, end, b, least)
                group = np.cumsum(lead) - 1
                # The others lie in the run of their leader, or lead in the next turn.
                rest = ~lead & (i >= end[group] - b[group])
                i, p = i[rest], p[rest]
        scale *= 2
    rows = runs.rows[runs.rows[:, 1] - runs.rows[:, 0] >= least]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _add_checked(runs: Runs, words: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray, least: int) -> None:
    """Add the stretches that are long enough, each compared word by word."""
    long = end - start >= 2 * period
    rows = np.unique(np.column_stack([start, end, period])[long], axis=0)
    for k, (s, e, p) in enumerate(rows.tolist()):
        if not np.array_equal(words[s : e - p], words[s + p : e]):  # two stretches of one hash: extend from the start again
            differ = np.flatnonzero(words[s : e - p] != words[s + p : e])
            rows[k, 1] = s + int(differ[0]) + p
    rows = rows[rows[:, 1] - rows[:, 0] >= 2 * rows[:, 2]]
    runs.add(rows[:, 0], rows[:, 1], rows[:, 2])


def split_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space."""
    return [] if text is None else text.encode().split()


def of_texts(texts: Sequence[str | None]) -> list[tuple[list[bytes], np.ndarray]]:
    """Words and runs (start, end, period) of every text."""
    split = [split_words(t) for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    codes, distinct = pd.factorize(np.array([w for words in split for w in words] or [b""], dtype=object)[: int(sizes.sum())])
    # Each text is followed by a word that occurs nowhere else.
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    whole = np.empty(int(starts[-1]), np.int64)
    ends = starts[1:] - 1
    whole[ends] = len(distinct) + np.arange(len(texts))
    inner = np.ones(len(whole), bool)
    inner[ends] = False
    whole[inner] = codes
    runs = find_runs(whole, int(sizes.max(initial=0)))
    cuts = np.searchsorted(runs[:, 0], starts)
    return [(split[k], runs[cuts[k] : cuts[k + 1]] - [[starts[k], starts[k], 0]]) for k in range(len(texts))]


def _kept(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """Words that no run holds after its first period."""
    if not len(runs):
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 1], -1)
    inside = np.cumsum(depth[:-1]) > 0
    return [w for w, drop in zip(words, inside.tolist(), strict=True) if not drop]


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_RUNS_SQL = "array<struct<start:long,length:long,period:long>>"


def periodic_runs(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None, collapse: bool = False) -> DataFrame:
    """`docs` (or its columns `keep`) with `runs`, an array of (start, length, period) by start, then period; with
    `collapse` also `collapsed`, the text with every run reduced to its first period, words joined by one blank.

    Words are what stands between ASCII white space, numbered from 0.  A null text has
    none: no runs, and an empty collapsed text.  Every row is searched, repeated ones too; own columns of these names are replaced.
    """

    def make():
        def work(texts):
            found = of_texts(texts)
            runs = [[{"start": s, "length": e - s, "period": p} for s, e, p in rows.tolist()] for _, rows in found]
            out = [pa.array(runs, _RUNS)]
            if collapse:
                out.append(pa.array([b" ".join(_kept(words, rows)).decode() for words, rows in found], pa.string()))
            return out

        return work

    new = [("runs", _RUNS, _RUNS_SQL), *([("collapsed", pa.string(), "string")] if collapse else [])]
    return with_scanned(docs, text, new, make, keep)


def digest(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """`keep`, n_runs; of the longest run (ties: smallest start, then period) start, length, period, exponent_milli, null without runs;
    runs_sha256 of all runs as lines `start,length,period`, collapsed_sha256 of the collapsed text."""
    rows = periodic_runs(docs, text, keep, collapse=True)
    top = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("l"), (-r.start).alias("s"), (-r.period).alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period, F.lit(None).cast("string"))), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return rows.withColumn("_top", top).select(
        *[F.col(f"`{c}`") for c in keep],
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_top.s")).alias("start"), F.col("_top.l").alias("length"), (-F.col("_top.p")).alias("period"),
        F.expr("(1000 * _top.l) div (-_top.p)").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_planted_runs(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """`key` and `text`; of every tenth document (by h = crc32 of its key) the words from a on repeat the p words from there.

    With g = h div 10 and n words: a = g mod n, p = 1 + (n - a) div (3 + g mod 8).  Such a text has its words joined by
    blanks; all others, and rows without a key, stay as they are.
    """
    h = F.crc32(F.col(f"`{key}`").cast("string").cast("binary"))
    rows = docs.select(F.col(f"`{key}`"), F.col(f"`{text}`").alias("_t"), h.alias("_h"), F.expr("_h div 10").alias("_g"))
    words = F.filter(F.split("_t", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    rows = rows.withColumn("_w", F.when(F.col("_h") % 10 == 0, words)).withColumn("_n", F.size("_w").cast("long"))
    rows = rows.withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")))
    rows = rows.withColumn("_p", F.when(F.col("_n") > 0, 1 + F.expr("(_n - _a) div (3 + _g % 8)")))
    place = lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + F.pmod(i - F.col("_a"), F.col("_p"))).cast("int")
    planted = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1), lambda i: F.get("_w", place(i))), " ")
    return rows.select(F.col(f"`{key}`"), F.when(F.col("_n") > 0, planted).otherwise(F.col("_t")).alias(text))
