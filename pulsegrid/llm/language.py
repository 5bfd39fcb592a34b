"""Language identification by rank-order n-gram profiles.

A profile lists the most frequent letter n-grams (n = 1 to 3, words padded with a
blank) of a language in order of frequency.  A document's own list is compared
with each profile by the out-of-place distance: the sum over its n-grams of how
far their ranks lie apart, and the greatest possible distance for an n-gram the
profile lacks.  The nearest profile names the language.

N-grams are counted over the whole texts of all documents that may be learned
from; each task adds up what it has read, Spark adds up the tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import batch_of, pieces, slices, with_scanned

PROFILE_GRAMS = 300
UNKNOWN = "und"
_SALTS = 16
_MERGE_ROWS = 1 << 20
_BITS = 21  # of a code point
_BLANK = 32


class _Letters:
    """Lower-case letter of each code point; blank for all that is no letter. Filled as code points are met."""

    def __init__(self) -> None:
        self.known = np.zeros(0x110000, bool)
        self.lower = np.full(0x110000, _BLANK, np.uint32)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        if len(new := codes[~self.known[codes]]):
            for code in np.unique(new).tolist():
                self.known[code] = True
                if chr(code).isalpha():
                    self.lower[code] = ord(chr(code).lower()[0])
        return self.lower[codes]


def _gram_runs(texts: list[str], letters: _Letters) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, packed n-gram, count) in order of index and n-gram, for a slice of texts."""
    codes = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    blank = np.array([_BLANK], np.uint32)
    joined = letters(np.concatenate([x for c in codes for x in (blank, c)] + [blank]))
    owner = np.repeat(np.arange(len(texts)), [len(c) + 1 for c in codes])
    owner = np.append(owner, len(texts) - 1)
    is_blank = joined == _BLANK
    keep = ~is_blank
    keep[0] = True
    keep[1:] |= ~is_blank[:-1]
    joined, owner, is_blank = joined[keep], owner[keep], is_blank[keep]
    present = np.flatnonzero(np.bincount(joined))
    dense = np.zeros(int(present[-1]) + 1, np.int64)
    dense[present] = np.arange(1, len(present) + 1)
    width = max(1, int(len(present)).bit_length())
    c = dense[joined]
    one = np.flatnonzero(~is_blank)
    two = np.flatnonzero(~is_blank[:-1] | ~is_blank[1:]) if len(c) > 1 else one[:0]
    three = np.flatnonzero(~is_blank[1:-1]) if len(c) > 2 else one[:0]
    first = lambda at: owner[np.where(is_blank[at], at + 1, at)]
    keys = np.concatenate(
        [
            (owner[one] << (3 * width)) | c[one],
            (first(two) << (3 * width)) | (c[two] << width) | c[two + 1],
            (first(three) << (3 * width)) | (c[three] << (2 * width)) | (c[three + 1] << width) | c[three + 2],
        ]
    )
    keys.sort()
    edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(edges, len(keys)))
    keys = keys[edges]
    back = np.concatenate([[0], present]).astype(np.int64)
    mask = (1 << width) - 1
    gram = (back[(keys >> (2 * width)) & mask] << (2 * _BITS)) | (back[(keys >> width) & mask] << _BITS) | back[keys & mask]
    return keys >> (3 * width), gram, counts


def _merge(owner: np.ndarray, gram: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((gram, owner))
    owner, gram, count = owner[order], gram[order], count[order]
    if not len(owner):
        return owner, gram, count
    edges = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (gram[1:] != gram[:-1])]))
    return owner[edges], gram[edges], np.add.reduceat(count, edges)


def gram_counts(texts: list[str], letters: _Letters) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`_gram_runs` for texts of any length: a long one is counted in pieces."""
    parts = [list(pieces(t)) for t in texts]
    if all(len(p) == 1 for p in parts):
        return _gram_runs(texts, letters)
    owner = np.concatenate([np.full(len(p), i) for i, p in enumerate(parts)])
    found = [(owner[k] + part[0], part[1], part[2]) for k, piece in enumerate(p for ps in parts for p in ps) for part in [_gram_runs([piece], letters)]]
    return _merge(*(np.concatenate(x) for x in zip(*found, strict=True)))


def profiles(docs: DataFrame, text: str = "text", lang: str = "lang", grams: int = PROFILE_GRAMS) -> dict[str, np.ndarray]:
    """Most frequent n-grams of each language over the whole texts of `docs`, best first; ties by n-gram.

    Rows with a null text or language teach nothing.  The driver gets at most
    `grams` rows for each language and salt.
    """
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, names, index = _Letters(), [], {}
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        rows = 0

        def flush() -> pa.RecordBatch:
            owner, gram, n = held[0]
            return batch_of(schema, [pa.array(np.array(names, object)[owner], pa.string()), pa.array(gram), pa.array(n)])

        for part in slices(batches, "text"):
            langs = part.column("lang").to_pylist()
            for name in langs:
                if name not in index:
                    index[name] = len(names)
                    names.append(name)
            owner, gram, n = gram_counts(part.column("text").to_pylist(), letters)
            held.append((np.array([index[x] for x in langs])[owner], gram, n))
            rows += len(n)
            if rows > _MERGE_ROWS:
                held = [_merge(*(np.concatenate(x) for x in zip(*held, strict=True)))]
                rows = len(held[0][0])
                if rows > _MERGE_ROWS // 2:
                    yield flush()
                    held, rows = [], 0
        if held:
            held = [_merge(*(np.concatenate(x) for x in zip(*held, strict=True)))]
            yield flush()

    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    totals = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    salted = totals.withColumn("salt", F.pmod(F.xxhash64("gram"), F.lit(_SALTS)))
    best = Window.partitionBy("lang", "salt").orderBy(F.desc("n"), "gram")
    top = salted.withColumn("place", F.row_number().over(best)).where(F.col("place") <= grams)
    found: dict[str, list[tuple[int, int]]] = {}
    for row in top.select("lang", "gram", "n").collect():
        found.setdefault(row.lang, []).append((-row.n, row.gram))
    return {name: np.array([g for _, g in sorted(found[name])[:grams]], np.int64) for name in sorted(found)}


def identify(
    docs: DataFrame, learned: dict[str, np.ndarray], text: str = "text", grams: int = PROFILE_GRAMS, keep: Sequence[str] | None = None
) -> DataFrame:
    """`docs` (or its columns `keep`) with `lang_pred`, `score` (1 less the distance as a share of the greatest
    possible) and `margin` (how much nearer the winner is than the second, in the same measure).

    A null text or one without letters gives `und` with score 0; so does every
    text if nothing was learned.  Equal distances: the first language by name.
    Repeated rows are each predicted; input columns with the new names are replaced.
    """
    names = list(learned)
    known = np.unique(np.concatenate([learned[n] for n in names])) if names else np.zeros(0, np.int64)
    ranks = np.full((len(known) + 1, max(1, len(names))), -1, np.int64)
    for k, name in enumerate(names):
        ranks[np.searchsorted(known, learned[name]), k] = np.arange(len(learned[name]))

    def nearest(owner: np.ndarray, gram: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(texts with n-grams, nearness to each language)."""
        most = int(count.max())
        order = np.argsort(owner * (most + 1) + (most - count), kind="stable")  # equal counts stay in n-gram order
        owner, gram = owner[order], gram[order]
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        place = np.arange(len(owner)) - np.repeat(starts, np.diff(np.append(starts, len(owner))))
        top = place < grams
        owner, gram, place = owner[top], gram[top], place[top]
        at = np.searchsorted(known, gram)
        at = np.where(known[np.minimum(at, len(known) - 1)] == gram, at, len(known))
        theirs = ranks[at]
        apart = np.where(theirs < 0, grams, np.abs(theirs - place[:, None]))
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        most_apart = np.diff(np.append(starts, len(owner)))[:, None] * grams
        return owner[starts], 1.0 - np.add.reduceat(apart, starts, axis=0) / most_apart

    def make():
        letters = _Letters()

        def work(texts: list[str | None]) -> list:
            pred, score, margin = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts)), np.zeros(len(texts))
            owner, gram, count = gram_counts([t or "" for t in texts], letters)
            if len(owner) and names:
                who, near = nearest(owner, gram, count)
                pred[who] = np.array(names, object)[np.argmax(near, axis=1)]
                score[who] = near.max(axis=1)
                if len(names) > 1:
                    margin[who] = score[who] - np.partition(near, -2, axis=1)[:, -2]
            return [pa.array(pred, pa.string()), score, margin]

        return work

    new = [("lang_pred", pa.string(), "string"), ("score", pa.float64(), "double"), ("margin", pa.float64(), "double")]
    return with_scanned(docs, text, new, make, keep)
