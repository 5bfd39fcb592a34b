"""Collocations from a weighted de Bruijn graph.

The longest grams, of three words, are the edges of a graph whose nodes are pairs of
words: the edge of w1 w2 w3 leads from (w1, w2) to (w2, w3) and weighs as often as it
occurs.  Where a piece of text ends, its last pair and last word lead to an end mark
instead; so the flow through a node, with these corrections, is the count of its pair,
and the flow through all nodes of a first word is the count of that word.

Most grams are far too rare to be candidates.  A sketch of fixed size, filled in a first
pass, proves that of nearly all of them; they are merged into one edge of their node
before any word is shuffled, which leaves every flow as it is.

Among edges of at least the wanted count, paths whose inner nodes have one edge in, one
out and no other flow are compacted: all edges and inner nodes of such a path occur
equally often, and only the nodes at its ends are looked up.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import slices
from pulsegrid.operators.scan import broadcast_checked
from pulsegrid.runtime import pin

LEAST = 10  # occurrences of a candidate
COVERED = 50  # per cent of its occurrences that a longer candidate must have to replace it
TOP = 2000
SCALE = 1_000_000

SKETCH_BITS = 27  # counters of the sketch, as a power of two
_FULL = np.uint8(15)
_RANGE_BITS = 21  # of which a task of the second step holds so many at a time
_SPLITS = 64  # parts of a class ranked on their own first
_COUNTED_BYTES, _SENT_BYTES, _SLICE_ROWS = 1 << 20, 2 << 20, 1 << 16

# What ends a piece, and small letters for the ASCII capitals.  0xFF is no part of UTF-8.
_END = b"\xff"
_TABLE = bytes.maketrans(b".,;:!?\n\x0b\x0c\r" + bytes(range(65, 91)), _END * 10 + bytes(range(97, 123)))
# End of fixed values.
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


class _Grams:
    """The words of some texts as numbers, with hashes of every gram of up to three words that starts at a word."""

    def __init__(self, texts: list[str | None], langs: list[str]) -> None:
        split = [((t or "").encode().translate(_TABLE).replace(_END, b" \xff ") + b" \xff").split() for t in texts]
        codes, self.words = pd.factorize(np.array([w for words in split for w in words] or [_END], dtype=object))
        names, self.langs = pd.factorize(np.array(langs, dtype=object))
        lang = np.repeat(names, [len(words) for words in split])
        ends = codes == np.flatnonzero(self.words == _END)[0]
        own = pd.util.hash_array(self.words)
        here = own[codes]
        n = len(codes) - 1 if texts else 0  # the last word is an end
        self.at = np.flatnonzero(~ends[:n])
        after = np.concatenate([ends[1:], [True, True]])[: len(codes)]
        later = np.concatenate([ends[2:], [True, True]])[: len(codes)]
        self.pair = ~after[self.at]
        self.triple = self.pair & ~later[self.at]
        step = lambda k: np.minimum(self.at + k, len(codes) - 1)
        self.w = [codes[self.at], codes[step(1)], codes[step(2)]]
        self.lang = lang[self.at]
        whole = here[self.at] * _MIX[0] + pd.util.hash_array(self.langs)[self.lang]
        self.hashes = []
        for k in range(3):
            if k:
                whole = (whole ^ whole >> np.uint64(29)) * _MIX[k] + here[step(k)]
            mixed = (whole ^ whole >> np.uint64(32)) * _MIX[3]
            self.hashes.append((mixed >> np.uint64(64 - SKETCH_BITS)).astype(np.int64))


def _named(docs: DataFrame, text: str, by: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{by}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").cast("string").alias("t"))


def _each(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[_Grams]:
    for part in slices(batches, "t", limit, _SLICE_ROWS):
        yield _Grams(part.column("t").to_pylist(), part.column("lang").to_pylist())


def frequent_slots(named: DataFrame, least: int) -> np.ndarray:
    """Bits of the slots whose grams together occur at least `least` times; all grams of other slots are rarer than that.

    Every task counts all grams of one to three words in 2^SKETCH_BITS counters of four bits, which stop at 15, and sends
    them compressed in ranges; the sums become one bit per counter.  The bits have a fixed size, whatever the input.
    Beyond a few grams for each counter more and more bits are set, and less is merged; results stay the same.
    """
    size = 1 << SKETCH_BITS
    width = min(size, 1 << _RANGE_BITS)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = None
        for grams in _each(batches, _COUNTED_BYTES):
            if counters is None:
                counters = np.zeros(size // 2, np.uint8)
            first, second, third = grams.hashes
            slots, times = np.unique(np.concatenate([first, second[grams.pair], third[grams.triple]]).astype(np.int32), return_counts=True)
            times = np.minimum(times, _FULL).astype(np.uint8)
            for low in (0, 1):  # two counters share a byte
                own = (slots & 1) == low
                at, shift = slots[own] >> 1, np.uint8(4 * low)
                held = counters[at] >> shift & _FULL
                counters[at] += np.minimum(held + times[own], _FULL) - held << shift
        if counters is not None:
            pack = zstandard.ZstdCompressor(level=1).compress
            for i in range(size // width):
                part = counters[i * width // 2 : (i + 1) * width // 2].tobytes()
                yield pa.RecordBatch.from_pydict({"part": pa.array([i], pa.int32()), "counters": [pack(part)]})

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                mine = np.frombuffer(unpack(raw.as_py()), np.uint8)
                held = sums.setdefault(i, np.zeros(width, np.uint8))
                for low in (0, 1):
                    held[low::2] = np.minimum(held[low::2] + (mine >> np.uint8(4 * low) & _FULL), _FULL)
        for i, held in sums.items():
            yield pa.RecordBatch.from_pydict({"part": pa.array([i], pa.int32()), "bits": [np.packbits(held >= min(least, _FULL)).tobytes()]})

    parts = named.mapInArrow(count, "part int, counters binary").repartition(size // width, "part").mapInArrow(add, "part int, bits binary")
    bits = np.zeros(size // 8, np.uint8)
    for row in parts.collect():  # size / 8 bytes
        bits[row.part * width // 8 : (row.part + 1) * width // 8] = np.frombuffer(row.bits, np.uint8)
    return bits


def edges(docs: DataFrame, text: str = "text", by: str = "lang", least: int = LEAST) -> DataFrame:
    """lang, w1, w2, w3, weight: every word occurrence with the two words that follow it in its piece, counted.

    w3 is null at the end of a piece and where the three words are surely rarer than `least`; w2 and w1 likewise.
    So grams that cannot be candidates share one edge of their node, and the flow through every node that can be
    one stays whole.
    """
    named = _named(docs, text, by)
    frequent = named.sparkSession.sparkContext.broadcast(frequent_slots(named, least))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = frequent.value
        for grams in _each(batches, _SENT_BYTES):
            often = [(bits[h >> 3] >> (7 - (h & 7)).astype(np.uint8) & 1).astype(bool) for h in grams.hashes]
            keep = [often[0]]
            keep.append(keep[0] & grams.pair & often[1])
            keep.append(keep[1] & grams.triple & often[2])
            none = len(grams.words)
            rows = np.column_stack([grams.lang, *[np.where(k, w, none) for k, w in zip(keep, grams.w, strict=True)]])
            rows = rows[np.lexsort(rows.T[::-1])]
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
            start = np.flatnonzero(new)
            if not len(start):
                continue
            words = pa.array([*[b"" if w == _END else w for w in grams.words], b""], pa.binary()).cast(pa.string())
            langs = pa.array(list(grams.langs), pa.string())
            gram = pc.binary_join_element_wise(*[words.take(pa.array(rows[start, k])) for k in (1, 2, 3)], " ")
            key = pc.binary_join_element_wise(langs.take(pa.array(rows[start, 0])), gram, "\n")
            yield pa.RecordBatch.from_arrays([key, pa.array(np.diff(np.append(start, len(rows))))], names=["key", "n"])

    # Shuffled as one string; no word has a line end or a blank.
    counted = named.mapInArrow(run, "key string, n long").groupBy("key").agg(F.sum("n").alias("weight"))
    gram = F.substring_index("key", "\n", -1)
    words = F.split(gram, " ")
    return counted.select(
        F.expr("left(key, length(key) - length(substring_index(key, '\\n', -1)) - 1)").alias("lang"),
        *[F.nullif(F.get(words, F.lit(k)), F.lit("")).alias(f"w{k + 1}") for k in range(3)], "weight",
    )


def word_counts(counted: DataFrame, least: int) -> DataFrame:
    """Flow by first word: lang, w, f."""
    return counted.where("w1 IS NOT NULL").groupBy("lang", F.col("w1").alias("w")).agg(F.sum("weight").alias("f")).where(F.col("f") >= least)


def pair_counts(counted: DataFrame, least: int) -> DataFrame:
    """Flow through each node, ends of pieces included, and its heaviest edges of at least `least`: lang, w1, w2, f, into, out."""
    flow = counted.where("w2 IS NOT NULL").groupBy("lang", "w1", "w2").agg(
        F.sum("weight").alias("f"), F.max(F.when(F.col("w3").isNotNull() & (F.col("weight") >= least), F.col("weight"))).alias("out")
    )
    into = (
        counted.where((F.col("weight") >= least) & F.col("w3").isNotNull())
        .groupBy("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"))
        .agg(F.max("weight").alias("into"))
    )
    return flow.where(F.col("f") >= least).join(into, ["lang", "w1", "w2"], "left")


def _unary(nodes: DataFrame, prefix: str) -> DataFrame:
    """Nodes whose whole flow comes in by one edge and leaves by one."""
    whole = nodes.where((F.col("into") == F.col("f")) & (F.col("out") == F.col("f")))
    return whole.select(F.col("lang"), *[F.col(f"w{k}").alias(f"{prefix}{k}") for k in (1, 2)], F.lit(True).alias(f"{prefix}_joint"))


def compacted(heavy: DataFrame, nodes: DataFrame) -> DataFrame:
    """Maximal unary paths of the edges `heavy`: lang, words, weight.

    In every round each path names one of the unary nodes at its two ends, that with the
    smaller hash, and the two paths that meet in a node named by both are joined; about a
    third of such nodes vanish in a round, however long the path.  No path can close to a
    circle, as a piece of text ends.
    """
    first, last = _unary(nodes, "a"), _unary(nodes, "b")
    rows = (
        heavy.withColumns({"a1": F.col("w1"), "a2": F.col("w2"), "b1": F.col("w2"), "b2": F.col("w3")})
        .join(first, ["lang", "a1", "a2"], "left")
        .join(last, ["lang", "b1", "b2"], "left")
        .select(
            "lang", F.array("w1", "w2", "w3").alias("words"), "weight",
            F.coalesce("a_joint", F.lit(False)).alias("a_joint"), F.coalesce("b_joint", F.lit(False)).alias("b_joint"),
        )
    )
    rows = pin(rows)
    is_open = F.col("a_joint") | F.col("b_joint")
    done = rows.where(~is_open)
    rows, turn = rows.where(is_open), 0
    while not rows.isEmpty():
        turn += 1
        start = F.struct(F.get("words", F.lit(0)).alias("n1"), F.get("words", F.lit(1)).alias("n2"))
        end = F.struct(F.element_at("words", -2).alias("n1"), F.element_at("words", -1).alias("n2"))
        drawn = lambda node: F.xxhash64(F.col("lang"), node, F.lit(turn))  # noqa: B023, E731
        at_end = F.col("b_joint") & (~F.col("a_joint") | (drawn(end) < drawn(start)))
        voted = rows.withColumn("_left", at_end).withColumn("_node", F.when(at_end, end).otherwise(start))
        row = F.struct("words", "a_joint", "b_joint")
        # A unary node ends one path and begins one: at most two rows in a group.
        met = voted.groupBy("lang", "_node").agg(
            F.max("weight").alias("weight"), F.max(F.when(F.col("_left"), row)).alias("p"), F.max(F.when(~F.col("_left"), row)).alias("q")
        )
        both = F.concat("p.words", F.slice("q.words", F.lit(3), F.size("q.words")))
        rows = pin(
            met.select(
                "lang", F.when(F.col("p").isNull(), F.col("q.words")).when(F.col("q").isNull(), F.col("p.words")).otherwise(both).alias("words"),
                "weight", F.coalesce("p.a_joint", "q.a_joint").alias("a_joint"), F.coalesce("q.b_joint", "p.b_joint").alias("b_joint"),
            )
        )
        done = done.unionByName(rows.where(~is_open))
        rows = rows.where(is_open)
    return done.select("lang", "words", "weight")


def _longest(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """The edges of the paths with the counts of their first and last pair: lang, phrase, head, tail, a, l2, r2."""
    at = F.sequence(F.lit(0), F.size("words") - 3)
    inner = lambda yes: F.when(yes, F.col("weight"))
    each = F.transform(
        at,
        lambda i: F.struct(
            *[F.get("words", i + k).alias(f"w{k + 1}") for k in range(3)],
            inner(i > 0).alias("l2"), inner(i < F.size("words") - 3).alias("r2"),
        ),
    )
    rows = paths.select("lang", F.col("weight").alias("a"), F.inline(each))
    pair = lambda x, y, f: nodes.select("lang", F.col("w1").alias(x), F.col("w2").alias(y), F.col("f").alias(f))
    known = rows.where("l2 IS NOT NULL AND r2 IS NOT NULL")
    ends = (
        rows.where("l2 IS NULL OR r2 IS NULL")
        .join(pair("w1", "w2", "lf"), ["lang", "w1", "w2"])
        .join(pair("w2", "w3", "rf"), ["lang", "w2", "w3"])
        .withColumns({"l2": F.col("lf"), "r2": F.col("rf")})
    )
    return known.unionByName(ends.select(known.columns)).select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("w1").alias("head"), F.col("w3").alias("tail"), "a", "l2", "r2"
    )


def _score(a: str, left: Column, right: Column) -> Column:
    """floor(SCALE * a * a / (left * right)) in whole numbers of 38 digits; at most SCALE, as neither part is rarer than the whole."""
    wide = lambda c: c.cast("decimal(38,0)")
    return F.call_function("div", F.lit(SCALE) * wide(F.col(a)) * F.col(a).cast("decimal(20,0)"), wide(left) * right.cast("decimal(20,0)")).cast("long")


def scored(docs: DataFrame, text: str = "text", by: str = "lang", least: int = LEAST, covered: int = COVERED) -> DataFrame:
    """Every candidate that stays: lang, phrase, a, l, r, n, score.

    Texts lose their ASCII capitals and are cut into pieces at . , ; : ! ? and line ends,
    pieces into words at blanks and tabs.  All counts are per `by` (null: `und`) over
    all rows; a null text has no words.  Candidates are phrases of two or three words with at
    least `least` occurrences, overlapping ones included; the lowest-scoring cut counts, of
    equal ones the first.  A pair is dropped if a candidate of three words that holds it
    has at least `covered` per cent of its occurrences.
    """
    counted = pin(edges(docs, text, by, least))
    total = counted.groupBy("lang").agg(F.sum("weight").alias("n"))
    words = pin(word_counts(counted, least))
    nodes = pin(pair_counts(counted, least))
    heavy = counted.where((F.col("weight") >= least) & F.col("w3").isNotNull())
    longest = _longest(compacted(heavy, nodes), nodes)
    longer = F.greatest("into", "out")
    pairs = nodes.where(longer.isNull() | (100 * longer < covered * F.col("f"))).select(
        "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("w1").alias("head"), F.col("w2").alias("tail"), F.col("f").alias("a"),
        F.lit(None).cast("long").alias("l2"), F.lit(None).cast("long").alias("r2"),
    )
    n_words = words.count()
    one = lambda name, f: broadcast_checked(words.select("lang", F.col("w").alias(name), F.col("f").alias(f)), n_words)
    rows = pairs.unionByName(longest).join(one("head", "hf"), ["lang", "head"]).join(one("tail", "tf"), ["lang", "tail"])
    cut1 = F.struct(_score("a", F.col("hf"), F.coalesce("r2", "tf")).alias("score"), F.lit(1).alias("k"), F.col("hf").alias("l"), F.coalesce("r2", "tf").alias("r"))
    cut2 = F.when(F.col("l2").isNotNull(), F.struct(_score("a", F.col("l2"), F.col("tf")).alias("score"), F.lit(2).alias("k"), F.col("l2").alias("l"), F.col("tf").alias("r")))
    best = rows.withColumn("_cut", F.least(cut1, cut2))
    return best.join(total, "lang").select("lang", "phrase", "a", "_cut.l", "_cut.r", "n", "_cut.score")


def collocations(docs: DataFrame, text: str = "text", by: str = "lang", least: int = LEAST, covered: int = COVERED, top: int = TOP) -> DataFrame:
    """The first `top` of `scored` per class with their `rank`: score and count descending, then the phrase by its bytes."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    part = F.pmod(F.xxhash64("phrase"), F.lit(_SPLITS))
    rows = scored(docs, text, by, least, covered).withColumn("_part", part)
    first = rows.withColumn("_place", place("lang", "_part")).where(F.col("_place") <= top)
    return first.withColumn("rank", place("lang").cast("long")).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
