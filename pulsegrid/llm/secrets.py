"""Secrets in text: fixed patterns, and character Markov models for random strings they do not name.

Two first-order character models are trained, one on random strings (the values
that the fixed patterns find) and one on ordinary identifiers (runs of the same
characters outside them, without those that look random themselves).  What the base
spans leave of a run is searched for the segment of the greatest summed
log-likelihood ratio; it is reported, out to the next separators, if the sum exceeds
the odds against a secret.

The models are fitted on a bounded sample: documents chosen by hash, about
`SAMPLE_DOCS` of them, and at most `SAMPLE_STRINGS` strings of each kind, none above `LONGEST_SAMPLE` characters.  Every
whole text is scanned.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import with_scanned

SAMPLE_DOCS = 20_000
SAMPLE_STRINGS = 20_000
LONGEST_SAMPLE = 4096
LEAST_RUN = 8
ODDS = 10_000.0  # against a run being random; the threshold of summed log-likelihood ratios is its logarithm
ROUNDS = 20  # of removing random runs from the ordinary ones, at most

# The patterns and least lengths asked for.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_VALUE, LEAST_ACCESS = 8, 16
KINDS = ("assign", "access", "hex", "markov")

_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % LEAST_RUN)
_SEPARATORS = "/.=-_+"
_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
_CODE = np.full(128, len(_CHARS), np.int64)
_CODE[[ord(c) for c in _CHARS]] = np.arange(len(_CHARS))
_START = len(_CHARS)
# Pseudo-counts: random strings are nearly even over all characters, ordinary ones are not.
_EVEN_RANDOM, _EVEN_ORDINARY = 20.0, 0.1

Span = tuple[int, int, int]  # start, place in KINDS, end
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, by start and kind; of each kind without overlap."""
    found: list[Span] = []
    lower = text.lower()
    if any(word in lower for word in ("passw", "secret", "token", "api")) or not text.isascii():
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _outside(runs: Iterable[re.Match], base: Sequence[Span]) -> Iterator[tuple[int, int, list[Span]]]:
    """(start, end, base spans that it touches) of each run; runs and spans are sorted by their starts and both read once."""
    base_ends = list(accumulate((e for _, _, e in base), max))
    first = 0
    for m in runs:
        start, end = m.span()
        # No span before `first` reaches into this run or a later one.
        while first < len(base) and base_ends[first] <= start:
            first += 1
        touched, i = [], first
        while i < len(base) and base[i][0] < end:
            if base[i][2] > start:
                touched.append(base[i])
            i += 1
        yield start, end, touched


def labelled_strings(text: str) -> tuple[list[str], list[str]]:
    """(random strings, ordinary identifiers) of a text."""
    base = base_spans(text)
    random = []
    for start, kind, end in base:
        value = text[start:end]
        random.append(ASSIGN.fullmatch(value)[2] if kind == 0 else value)
    ordinary = [text[a:b] for a, b, touched in _outside(_RUN.finditer(text), base) if not touched]
    return random, ordinary


def joined(spans: Sequence[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


@dataclass(frozen=True)
class StringModel:
    ratio: np.ndarray  # log-likelihood ratio of each character after each other one or the start
    threshold: float

    def gains(self, strings: Sequence[str]) -> list[np.ndarray]:
        """Log-likelihood ratio of every character of each string."""
        if not strings:
            return []
        c = _CODE[np.frombuffer("".join(strings).encode("ascii"), np.uint8)]
        starts = np.concatenate([[0], np.cumsum([len(s) for s in strings])])
        before = np.concatenate([[_START], c[:-1]])
        before[starts[:-1]] = _START
        return np.split(self.ratio[before, c], starts[1:-1])

    def sums(self, strings: Sequence[str]) -> np.ndarray:
        """Log-likelihood ratio of each string."""
        return np.array([g.sum() for g in self.gains(strings)])

    def _segments(self, run: str, gains: np.ndarray) -> list[tuple[int, int]]:
        """Random segments of a run, out to the next separators; the whole run if the rest of it costs less than half of the best."""
        out, todo = [], [(0, len(run))]
        while todo:
            low, high = todo.pop()
            if high - low < LEAST_RUN:
                continue
            total = np.concatenate([[0.0], np.cumsum(gains[low:high])])
            rise = total - np.minimum.accumulate(total)
            end = int(rise.argmax())
            if rise[end] <= self.threshold:
                continue
            start = int(total[: end + 1].argmin())
            if 2 * total[-1] >= rise[end]:
                out.append((low, high))
                continue
            start, end = low + start, low + end
            while start > low and run[start - 1] not in _SEPARATORS:
                start -= 1
            while end < high and run[end] not in _SEPARATORS:
                end += 1
            if end - start >= LEAST_RUN:
                out.append((start, end))
            todo += [(low, start), (end, high)]
        return out

    def spans(self, text: str) -> list[Span]:
        """Base spans and what the models take for random outside them."""
        base = base_spans(text)
        runs = []
        for at, end, touched in _outside(_RUN.finditer(text), base):
            for s, _, e in touched:
                if s - at >= LEAST_RUN:
                    runs.append((at, s))
                at = max(at, e)
            if end - at >= LEAST_RUN:
                runs.append((at, end))
        strings = [text[a:b] for a, b in runs]
        found = []
        for (a, _), run, gains in zip(runs, strings, self.gains(strings), strict=True):
            if gains[gains > 0].sum() > self.threshold:
                found += [(a + i, 3, a + j) for i, j in self._segments(run, gains)]
        return sorted([*base, *found])


def _log_model(strings: Sequence[str], even: float) -> np.ndarray:
    n = len(_CHARS)
    counts = np.full((n + 1, n), even)
    for s in strings:
        c = _CODE[np.frombuffer(s.encode("ascii"), np.uint8)]
        np.add.at(counts, (np.concatenate([[_START], c[:-1]]), c), 1.0)
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def fit(random: Sequence[str], ordinary: Sequence[str]) -> StringModel:
    """Models from labelled strings.

    Ordinary ones that a model takes for random, or for even over all characters, are taken out and the model is
    fitted again, until none changes sides; bare secrets among them thus neither train it nor move the threshold.
    """
    threshold = float(np.log(ODDS))
    of_random, even = _log_model(random, _EVEN_RANDOM), _log_model([], 1.0)
    kept = np.ones(len(ordinary), bool)
    for _ in range(ROUNDS):
        of_ordinary = _log_model([s for s, k in zip(ordinary, kept, strict=True) if k], _EVEN_ORDINARY)
        model = StringModel(of_random - of_ordinary, threshold)
        looks = np.maximum(model.sums(ordinary), StringModel(even - of_ordinary, threshold).sums(ordinary))
        stay = looks <= threshold
        if not stay.any() or (stay == kept).all():
            break
        kept = stay
    return model


def train(docs: DataFrame, text: str = "text", sample_docs: int = SAMPLE_DOCS) -> StringModel:
    """Fit on the labelled strings of about `sample_docs` documents chosen by a hash of the text.

    Without any string of a kind its model is even over all characters.
    """
    share = min(1.0, sample_docs / max(1, docs.count()))
    chosen = docs.where(F.col(text).isNotNull() & (F.pmod(F.xxhash64(text, F.lit(7)), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))))

    def make():
        def work(texts: list[str | None]) -> list:
            pairs = [labelled_strings(t or "") for t in texts]
            return [[p[0] for p in pairs], [p[1] for p in pairs]]

        return work

    kinds = [(k, pa.list_(pa.string()), "array<string>") for k in ("random", "ordinary")]
    strings = with_scanned(chosen, text, kinds, make, keep=[])
    found = []
    for k in ("random", "ordinary"):
        each = strings.select(F.explode(k).alias("s")).where(F.length("s") <= LONGEST_SAMPLE).distinct()
        found.append([r.s for r in each.orderBy(F.xxhash64("s"), "s").limit(SAMPLE_STRINGS).collect()])
    return fit(*found)


def scan(docs: DataFrame, model: StringModel, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """`docs` (or its columns `keep`) with `spans`: array of (kind, start, end) in code points, by start and kind.

    A null or empty text has no spans.  Repeated rows are each scanned.
    """

    def make():
        def work(texts: list[str | None]) -> list:
            found = [model.spans(t or "") for t in texts]
            return [pa.array([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in x] for x in found], _SPANS)]

        return work

    return with_scanned(docs, text, [("spans", _SPANS, "array<struct<kind:string,start:long,end:long>>")], make, keep)


def digest(docs: DataFrame, spans: str = "spans") -> DataFrame:
    """Counts of the base kinds, SHA-256 of the base spans and all spans as text."""
    as_text = lambda c: F.concat_ws(",", F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    of = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    base = F.filter(spans, lambda s: s["kind"] != "markov")
    return docs.select(
        *[c for c in docs.columns if c != spans],
        *[of(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(as_text(base), 256).alias("base_sha256"),
        as_text(F.col(spans)).alias("spans"),
    )


def redact(docs: DataFrame, model: StringModel, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """`docs` with every span replaced by `mark`; overlapping spans become one. Null texts stay null."""

    def clean(value: str | None) -> str | None:
        spans = model.spans(value) if value else []
        if not spans:
            return value
        out, at = [], 0
        for start, _, end in spans:
            if start >= at:
                out += [value[at:start], mark]
            at = max(at, end)
        return "".join([*out, value[at:]])

    order = docs.columns
    return with_scanned(docs, text, [(text, pa.string(), "string")], lambda: lambda texts: [[clean(t) for t in texts]]).select(*order)
