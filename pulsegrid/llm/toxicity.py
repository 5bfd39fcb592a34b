"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on windows of ordinary text, one on
the passages of toxic text that set it apart.  A window of a document is
compressed with the ordinary dictionary and with both together; the bytes saved
by the toxic one are the window's gain.  Ordinary text matches the ordinary
dictionary equally well either way, so its gain is about 0.

How often each gain occurs in windows of toxic and of ordinary labelled texts
gives a log-likelihood ratio per window; a logistic curve fitted on labelled
documents turns a document's sums into a score.  For both, each half of the sample
is compressed with dictionaries trained on the other half; the final dictionaries
are trained on all of it.

The models are fitted on a bounded sample of labelled rows (`SAMPLE_DOCS` of
each label, those with the smallest id hash); scores cover every window of every
text.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import pieces, with_scanned
from pulsegrid.runtime import pin

WINDOW, STRIDE = 64, 48
THRESHOLD = 0.7
SAMPLE_DOCS = 2_000
SAMPLE_WINDOWS = 10_000
SAMPLE_WINDOW_CHARS = 1_000
ORDINARY_BYTES, TOXIC_BYTES = 8_192, 4_096
GRAM = 5
LIFT, CERTAIN = 4.0, 3.0
_LOW, _HIGH = -4, 12  # gains outside count as the nearest of these
_WORD = re.compile(r"[^\W\d_]+")


def plain(text: str) -> str:
    """Lower-case words with single blanks between and around."""
    return " " + " ".join(_WORD.findall(text.lower())) + " "


def windows(text: str) -> list[bytes]:
    """Overlapping windows over the UTF-8 bytes of the whole plain text; at least one."""
    raw = plain(text).encode("utf-8", "surrogatepass")
    return [raw[i : i + WINDOW] for i in range(0, max(1, len(raw) - (WINDOW - STRIDE)), STRIDE)]


def _contexts(texts: Sequence[str]) -> tuple[Counter, int]:
    """For each n-gram of the words: in how many different neighbourhoods it occurs, and how many there are; copies count once."""
    around = defaultdict(set)
    for text in texts:
        words = ["", *text.split(), ""]
        for before, word, after in zip(words, words[1:], words[2:]):
            around[word].add(hash((before, after)))
    found: Counter = Counter()
    for word, places in around.items():
        padded = f" {word} "
        for gram in {padded[i : i + GRAM] for i in range(len(padded) - GRAM + 1)}:
            found[gram] += len(places)
    return found, sum(map(len, around.values()))


def telling_passages(toxic: Sequence[str], ordinary: Sequence[str]) -> list[str]:
    """Stretches of toxic text whose n-grams occur `LIFT` times as often as in ordinary text, and surely so; rarest first."""
    mine, n_mine = _contexts(toxic)
    theirs, n_theirs = _contexts(ordinary)
    share = n_mine / (n_mine + n_theirs)
    least = math.log(len(mine) + 1) + CERTAIN
    telling = set()
    for gram, n in mine.items():
        m = theirs[gram]
        expected = (n + m) * share
        # Bound of the chance to see so many by accident, times the number of n-grams looked at.
        if n * n_theirs >= LIFT * n_mine * (m + 0.5) and n * math.log(n / expected) - (n - expected) >= least:
            telling.add(gram)
    found: Counter = Counter()
    for text in toxic:
        for word in text.split():
            padded = f" {word} "
            at = [i for i in range(len(padded) - GRAM + 1) if padded[i : i + GRAM] in telling]
            first = None
            for k, i in enumerate(at):
                first = i if first is None else first
                if k + 1 == len(at) or at[k + 1] != i + 1:
                    found[padded[first : i + GRAM]] += 1
                    first = None
    return sorted(found, key=lambda p: (found[p], p))


@dataclass(frozen=True)
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    ratio: tuple[float, ...] = ()  # log-likelihood ratio of each gain from _LOW to _HIGH
    weights: tuple[float, ...] = ()

    def _packer(self, content: bytes):
        settings = zstandard.ZstdCompressionParameters(
            window_log=15, hash_log=13, chain_log=14, search_log=5, min_match=6, target_length=16,
            strategy=zstandard.STRATEGY_LAZY2, write_checksum=False, write_content_size=False, write_dict_id=False,
        )
        words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if content else None
        return zstandard.ZstdCompressor(dict_data=words, compression_params=settings).compress

    def gain_counter(self):
        """Function from a text to how many of its windows have each gain."""
        alone, both = self._packer(self.ordinary), self._packer(self.toxic + self.ordinary)

        def count(text: str) -> np.ndarray:
            tally = np.zeros(_HIGH - _LOW + 1, np.int64)
            for part in pieces(text):
                gains = np.array([len(alone(w)) - len(both(w)) for w in windows(part)])
                tally += np.bincount(np.clip(gains, _LOW, _HIGH) - _LOW, minlength=len(tally))
            return tally

        return count

    def features(self, tallies: np.ndarray) -> np.ndarray:
        """One row per document from its tally: 1, root of the summed ratio, that per window, windows, windows by least gain."""
        tallies = np.atleast_2d(tallies).astype(float)
        n = tallies.sum(axis=1)
        evidence = tallies @ np.array(self.ratio)
        at_least = [np.log1p(tallies[:, gain - _LOW :].sum(axis=1)) for gain in (2, 3, 4, 6)]
        return np.column_stack([np.ones(len(n)), np.cbrt(evidence), evidence / np.maximum(n, 1), np.log1p(n), *at_least])

    def scores(self, tallies: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.features(tallies) @ np.array(self.weights), -40, 40)))


def _fit_weights(rows: np.ndarray, labels: np.ndarray, counts: dict[int, int], ridge: float = 0.3, rounds: int = 50) -> tuple[float, ...]:
    """Logistic regression by Newton steps, with a small penalty on all weights but the first.

    Rows weigh so that the labels are as frequent as in the whole, which has `counts` of each.
    """
    share = {k: counts[k] / sum(counts.values()) / (labels == k).mean() for k in (0, 1)}
    weight = np.where(labels == 1, share[1], share[0])
    w = np.zeros(rows.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (rows.shape[1] - 1))
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(rows @ w, -40, 40)))
        step = np.linalg.solve((rows * (weight * p * (1 - p))[:, None]).T @ rows + penalty, rows.T @ (weight * (labels - p)) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(x) for x in w)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", sample_docs: int = SAMPLE_DOCS) -> ToxicityModel:
    """Fit on the rows of `docs` that `labels` (doc_id, toxic) marks 0 or 1; ids with both marks count as toxic.

    At most `sample_docs` ids of each label are used, those with the smallest
    hash.  Without labelled rows of both kinds in both halves every score is 0.
    """
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("_toxic"))
    counts = {r._toxic: r["count"] for r in marks.groupBy("_toxic").count().collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = None
    for kind in (0, 1):
        some = marks.where(F.col("_toxic") == kind).orderBy(*order).limit(sample_docs)
        ids = some if ids is None else ids.union(some)
    # at most two times sample_docs ids: a proven bound
    sample = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")
    sample = pin(sample.select("text", "_toxic", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int").alias("_half")))

    def cut():
        def work(texts: list[str | None]) -> list:
            out = []
            for t in texts:
                p = plain(t or "")
                out.append([p[i : i + SAMPLE_WINDOW_CHARS] for i in range(0, len(p), SAMPLE_WINDOW_CHARS)])
            return [out]

        return work

    parts = with_scanned(sample, "text", [("cut", pa.list_(pa.string()), "array<string>")], cut, keep=["_toxic", "_half"])
    parts = parts.select("_toxic", "_half", F.explode("cut").alias("cut"))
    known: dict[tuple[int, int], list[str]] = {}
    for kind in (0, 1):
        chosen = parts.where(F.col("_toxic") == kind).orderBy(F.xxhash64("cut"), "cut").limit(SAMPLE_WINDOWS).collect()
        for half in (0, 1):
            known[kind, half] = sorted(r.cut for r in chosen if r._half == half)
    if not all(known.values()):
        return ToxicityModel(b"", b"")
    tallies = []
    for half in (0, 1):
        other = _dictionaries(known[1, half], known[0, half])
        tallies += _with_tallies(sample.where(F.col("_half") == 1 - half), other, "text", ["_toxic"]).collect()
    model = _dictionaries(known[1, 0] + known[1, 1], known[0, 0] + known[0, 1])
    gains = np.array([r.tally for r in tallies], np.int64).reshape(-1, _HIGH - _LOW + 1)
    marked = np.array([r._toxic for r in tallies])
    often = [gains[marked == kind].sum(axis=0) + 0.5 for kind in (0, 1)]
    ratio = np.log(often[1] / often[1].sum()) - np.log(often[0] / often[0].sum())
    model = ToxicityModel(model.ordinary, model.toxic, tuple(float(x) for x in ratio))
    return ToxicityModel(model.ordinary, model.toxic, model.ratio, _fit_weights(model.features(gains), marked, counts))


def _dictionaries(toxic: Sequence[str], ordinary: Sequence[str]) -> ToxicityModel:
    """Both dictionaries, of at most ORDINARY_BYTES and TOXIC_BYTES; the most frequent passages stand last, nearest to what follows."""
    whole = [w for t in ordinary for w in windows(t)]
    telling = "".join(telling_passages(toxic, ordinary)).encode("utf-8", "surrogatepass")
    return ToxicityModel(_dictionary(whole[:: max(1, len(whole) // 60_000)], ORDINARY_BYTES), telling[-TOXIC_BYTES:])


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """Trained dictionary; the samples themselves where they are too few to train one."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _with_tallies(docs: DataFrame, model: ToxicityModel, text: str, keep: Sequence[str] | None) -> DataFrame:
    def make():
        count = model.gain_counter()
        return lambda texts: [[count(t or "").tolist() for t in texts]]

    return with_scanned(docs, text, [("tally", pa.list_(pa.int64()), "array<long>")], make, keep)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = THRESHOLD, keep: Sequence[str] | None = None) -> DataFrame:
    """`docs` (or its columns `keep`) with `score` (0 to 1) and `predicted` (1 from `threshold` on).

    Null and empty texts are scored as one blank window.  Repeated rows get equal
    scores.  Columns of `docs` with the new names are replaced.
    """

    def make():
        if not model.weights:
            return lambda texts: [np.zeros(len(texts)), np.zeros(len(texts), np.int32)]
        count = model.gain_counter()

        def work(texts: list[str | None]) -> list:
            scores = model.scores(np.array([count(t or "") for t in texts]))
            return [scores, (scores >= threshold).astype(np.int32)]

        return work

    return with_scanned(docs, text, [("score", pa.float64(), "double"), ("predicted", pa.int32(), "int")], make, keep)
