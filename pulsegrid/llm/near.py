"""Near duplicates by SimHash, linked through segment bit counts.

Fingerprints are mapped to vectors of bit counts: one per two-bit segment, at
both offsets.  Flipping a bit moves such a vector by at most two, so vectors
close in Manhattan distance are a superset of fingerprints close in bits.  The 64
bits are cut into blocks, one more than what keeps the allowed distance per block
below two; two linked fingerprints then lie in the same or in adjacent cells of
some block's grid.  Each fingerprint stands in its own cell and is probed in the
cells one bit up, so every near pair meets in exactly one of its two directions.
Bit counts of four wide segments bound the distance once more before the exact
comparison.

A fingerprint may have several 64-bit words.  Then two are linked if some word differs
in few enough bits and all words together do; every word has its own grid.

A cell in which many fingerprints meet is not joined pair by pair: its members are
compared in chunks, and each pair of chunks gives only the edges of a spanning
forest, so links between all of its texts are kept without listing all pairs.

By `Similarity`, texts are linked if the Jaccard similarity of their shingle sets is
high enough.  Candidates are near by the SimHash of their sets, found in the grid above;
the pairs whose fingerprints lie farther apart meet in a band of minimum hashes.  Each
link is then checked on the shingles of both texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import whole_rows, with_scanned
from pulsegrid.operators.scan import broadcast_checked
from pulsegrid.runtime import pin

SHINGLE, MOST_BITS = 4, 4


@dataclass(frozen=True)
class Rule:
    """Linked are fingerprints of which some word has at most `most_bits` differing bits, and all words together at most `total_bits`."""

    shingle: int = SHINGLE
    most_bits: int = MOST_BITS
    words: int = 1
    total_bits: int = 64


CONTRACT = Rule()


@dataclass(frozen=True)
class Similarity:
    """Linked are texts whose sets of word shingles have a Jaccard similarity of `least` or more.

    Candidates are near by SimHash (`CONTRACT`), or agree on all `rows` minimum hashes of
    one of `bands` bands: a pair of similarity s whose fingerprints are too far apart (about
    10 bits at 0.8) is missed with probability (1 - s ** rows) ** bands, which is 7e-5 at 0.8.
    """

    shingle: int = 5
    least: float = 0.8
    bands: int = 24
    rows: int = 5


# Texts that meet in a band with more than this many texts are compared in chunks of SET_CHUNK.
SETS_IN_BAND = 32
SET_CHUNK = 256
# Cells in which members times probes exceed this are compared in chunks of CHUNK fingerprints.
PAIRS_IN_CELL = 1_024
CHUNK = 1_024
_PIECE = 1 << 20
_SLICE = 1 << 16


def _byte_pieces(raw: bytes) -> Iterator[bytes]:
    """Parts of a long text that end with a whole word."""
    start, n = 0, len(raw)
    while n - start > _PIECE:
        end = start + _PIECE
        while end < n and raw[end] not in b" \t\n\v\f\r":
            end += 1
        yield raw[start:end]
        start = end
    yield raw[start:]


def _mixed(hashes: np.ndarray, word: int) -> np.ndarray:
    """Hashes for another word of the fingerprint: the same for word 0, else stirred by multiplying and folding."""
    if word:
        hashes = hashes + np.uint64((0x9E3779B97F4A7C15 * word) & (1 << 64) - 1)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            hashes = (hashes ^ (hashes >> np.uint64(shift))) * np.uint64(factor)
        hashes = hashes ^ (hashes >> np.uint64(31))
    return hashes


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprint(raw: bytes, shingle: int = SHINGLE, n_words: int = 1) -> list[int]:
    """Unsigned SimHash words of the word shingles of a UTF-8 text, A-Z in lower case; a bit is set if over half the hashes have it."""
    digest = xxhash.xxh64_intdigest
    tally, n, words = np.zeros((n_words, 64), np.int64), 0, []
    for part in _byte_pieces(raw):
        words += part.lower().split()
        if len(words) < shingle:
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[: len(words) - shingle] + 1])
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends[shingle - 1 :].tolist(), strict=True)]
        found = np.array(hashes, "<u8")
        tally += np.stack([_bits(_mixed(found, w)) for w in range(n_words)])
        n += len(hashes)
        words = words[len(words) - shingle + 1 :]
    if not n and not words:
        return [0] * n_words
    if not n:
        whole = np.array([digest(b" ".join(words), 42)], "<u8")
        return [int(_mixed(whole, w)[0]) for w in range(n_words)]
    return [int(x) for x in np.packbits(2 * tally > n, axis=1, bitorder="little").view("<u8").ravel()]


def shingle_set(raw: bytes, shingle: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a UTF-8 text, A-Z in lower case; of fewer words, the hash of all."""
    words = raw.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    k = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[: len(words) - k] + 1])
    found = {joined[a:b] for a, b in zip(starts.tolist(), ends[k - 1 :].tolist(), strict=True)}
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(x, 42) for x in found), np.uint64, len(found)))


def band_keys(hashes: np.ndarray, rule: Similarity) -> np.ndarray:
    """A key for each band: the mixed minimum hashes of its rows. None for an empty set."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    rng = np.random.default_rng(7)
    n = rule.bands * rule.rows
    factors = rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 1024):
        mixed = hashes[i : i + 1024, None] * factors
        least = np.minimum(least, (mixed ^ (mixed >> np.uint64(29))).min(axis=0))
    weights = rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)
    return _mixed((least * weights).reshape(rule.bands, rule.rows).sum(axis=1, dtype=np.uint64), 1)


def set_fingerprint(hashes: np.ndarray) -> int:
    """SimHash of a shingle set as a signed long: a bit is set if over half the hashes have it; 0 for an empty set."""
    tally = sum((_bits(hashes[i : i + _SLICE]) for i in range(0, len(hashes), _SLICE)), np.zeros(64, np.int64))
    return int(np.packbits(2 * tally > len(hashes), bitorder="little").view("<i8")[0])


def set_prints(docs: DataFrame, text: str, rule: Similarity, keep: list[str]) -> DataFrame:
    """`fp` (128 bits of the shingle set as two longs), `size` of the set, its SimHash `sim` and `keys` of its bands."""

    def make():
        def work(texts: list[bytes | None]) -> list:
            sets = [shingle_set(t or b"", rule.shingle) for t in texts]
            whole = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            fps = [np.frombuffer(d, "<i8").tolist() for d in whole]
            keys = [band_keys(s, rule).view(np.int64).tolist() for s in sets]
            sizes, sims = [len(s) for s in sets], [set_fingerprint(s) for s in sets]
            return [pa.array(fps, pa.list_(pa.int64())), pa.array(sizes, pa.int64()), pa.array(sims, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]

        return work

    longs = (pa.list_(pa.int64()), "array<long>")
    return with_scanned(docs, text, [("fp", *longs), ("size", pa.int64(), "long"), ("sim", pa.int64(), "long"), ("keys", *longs)], make, keep, binary=True)


def _set_forest(sets: list[np.ndarray], least: float) -> np.ndarray:
    """Places of the edges of a spanning forest over all pairs of similarity `least` or more."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    kinds, flat = np.unique(np.concatenate(sets), return_inverse=True)
    parts = np.split(flat, np.cumsum(sizes)[:-1])
    rest, edges = np.arange(n), []
    mark = np.zeros(len(kinds), bool)
    stack: list[int] = []
    while len(rest) or stack:
        if not stack:
            stack, rest = [int(rest[0])], rest[1:]
            flat = flat[sizes[stack[0]] :]
        at = stack.pop()
        if not len(rest):
            break
        mark[parts[at]] = True
        starts = np.concatenate([[0], np.cumsum(sizes[rest])[:-1]])
        both = np.add.reduceat(mark[flat].astype(np.int64), starts)
        mark[parts[at]] = False
        near = both >= least * (sizes[at] + sizes[rest] - both)
        if near.any():
            fresh = rest[near].tolist()
            edges += [(at, x) for x in fresh]
            stack += fresh
            flat = flat[~np.repeat(near, sizes[rest])]
            rest = rest[~near]
    return np.array(edges, np.int64).reshape(-1, 2)


def _pairs_by_fingerprint(prints: DataFrame) -> DataFrame:
    """(a, b) with sizes _m, _n: sets whose SimHashes the grid links, as one set for each SimHash, and the other sets of it with that one."""
    sims = pin(prints.groupBy("sim").agg(F.min(F.struct("fp", "size")).alias("_one")))
    near = links(sims.select(F.col("sim").alias("fp")))
    first, second = sims.withColumnsRenamed({"sim": "a", "_one": "_x"}), sims.withColumnsRenamed({"sim": "b", "_one": "_y"})
    apart = near.join(first, "a").join(second, "b").select("_x", "_y")
    alike = prints.join(sims, "sim").select("_one", F.struct("fp", "size").alias("_y"))
    ordered = apart.union(alike).select(F.least("_x", "_y").alias("_x"), F.greatest("_x", "_y").alias("_y"))
    return ordered.select(F.col("_x.fp").alias("a"), F.col("_y.fp").alias("b"), F.col("_x.size").alias("_m"), F.col("_y.size").alias("_n"))


def set_links(prints: DataFrame, texts: DataFrame, rule: Similarity) -> DataFrame:
    """(a, b): pairs of distinct shingle sets of the least similarity, enough to connect all such pairs that meet in a band, and those that the grid of
    SimHashes links.

    `prints` has one row for each set, `texts` (fp, text) a text of each that may be asked for; both are read several times.
    """
    key = ["_band", "_key"]
    cells = pin(prints.select("fp", "size", F.posexplode("keys").alias(*key)))
    load = cells.groupBy(*key).agg(F.count(F.lit(1)).alias("_all")).where("_all > 1")
    shared = pin(cells.join(load, key))
    calm = shared.where(F.col("_all") <= SETS_IN_BAND)
    left, right = calm.select(*key, F.col("fp").alias("a"), F.col("size").alias("_m")), calm.select(*key, F.col("fp").alias("b"), F.col("size").alias("_n"))
    sized = (F.col("_m") >= rule.least * F.col("_n")) & (F.col("_n") >= rule.least * F.col("_m"))
    met = left.join(right, key).select("a", "b", "_m", "_n")
    pairs = pin(_pairs_by_fingerprint(prints).union(met).where((F.col("a") < F.col("b")) & sized).select("a", "b").distinct())
    asked = shared.select("fp").union(pairs.select("a")).union(pairs.select("b")).distinct()
    texts = pin(texts.join(asked, "fp", "left_semi").dropDuplicates(["fp"]))
    found = pairs.join(texts.withColumnsRenamed({"fp": "a", "text": "_x"}), "a").join(texts.withColumnsRenamed({"fp": "b", "text": "_y"}), "b")
    found = found.select("a", "b", F.col("_x").cast("binary").alias("_x"), F.col("_y").cast("binary").alias("_y"))
    schema = pa.schema([("a", pa.list_(pa.int64())), ("b", pa.list_(pa.int64()))])
    shingle, least = rule.shingle, rule.least

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, None
        for batch in batches:
            close = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = x.as_py() or b"", y.as_py() or b""
                if y != last:
                    last, own = y, shingle_set(y, shingle)
                other = shingle_set(x, shingle)
                both = len(np.intersect1d(own, other, assume_unique=True))
                close.append(both >= least * (len(own) + len(other) - both))
            yield batch.select([0, 1]).filter(pa.array(close, pa.bool_())).cast(schema)

    edges = found.mapInArrow(check, "a array<long>, b array<long>")
    crowded = shared.where(F.col("_all") > SETS_IN_BAND)
    if not crowded.limit(1).count():
        return edges
    chunks = F.ceil(F.col("_all") / SET_CHUNK).cast("int")
    members = crowded.withColumn("_chunks", chunks).withColumn("_chunk", F.pmod(F.xxhash64("fp", F.lit(5)), F.col("_chunks")).cast("int"))
    members = members.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    members = members.select(*key, F.least("_chunk", "_other").alias("_i"), F.greatest("_chunk", "_other").alias("_j"), "fp")
    members = members.join(texts, "fp").select(*key, "_i", "_j", "fp", F.col("text").cast("binary").alias("text"))

    def forest(group: pa.Table) -> pa.Table:
        fps = group.column("fp").combine_chunks()
        made = _set_forest([shingle_set(t.as_py() or b"", shingle) for t in group.column("text")], least)
        return pa.table([fps.take(pa.array(made[:, 0])), fps.take(pa.array(made[:, 1]))], names=["a", "b"]).cast(schema)

    return edges.unionByName(members.groupBy(*key, "_i", "_j").applyInArrow(forest, "a array<long>, b array<long>"))


def fingerprints(docs: DataFrame, text: str = "text", rule: Rule = CONTRACT, keep: list[str] | None = None) -> DataFrame:
    """`docs` (or its columns `keep`) with `fp`: the fingerprint as a signed long, or several as an array.

    0 for a null text or one without words.
    """

    def make():
        def work(texts: list[bytes | None]) -> list:
            found = np.array([fingerprint(t or b"", rule.shingle, rule.words) for t in texts], np.uint64).view(np.int64)
            return [found.ravel() if rule.words == 1 else pa.array(found.tolist(), pa.list_(pa.int64()))]

        return work

    return with_scanned(docs, text, [("fp", _kind(rule), _sql(rule))], make, keep, binary=True)


def _kind(rule: Rule) -> pa.DataType:
    return pa.int64() if rule.words == 1 else pa.list_(pa.int64())


def _sql(rule: Rule) -> str:
    return "long" if rule.words == 1 else "array<long>"


def _words(fp: Column, rule: Rule) -> list[Column]:
    return [fp] if rule.words == 1 else [F.get(fp, F.lit(i)) for i in range(rule.words)]


def _as_matrix(column: pa.Array | pa.ChunkedArray, rule: Rule) -> np.ndarray:
    """Fingerprints as rows of unsigned words."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = whole if rule.words == 1 else whole.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64).reshape(-1, rule.words)


def _as_column(rows: np.ndarray, rule: Rule) -> pa.Array:
    signed = np.ascontiguousarray(rows).view(np.int64)
    if rule.words == 1:
        return pa.array(signed.ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(len(signed) + 1) * rule.words, pa.int32()), pa.array(signed.ravel()))


def block_edges(most_bits: int) -> list[tuple[int, int]]:
    """Bit ranges of the blocks: as few as leave a near pair at most one differing bit in one of them."""
    blocks = most_bits // 2 + 1
    return [(64 * i // blocks, 64 * (i + 1) // blocks) for i in range(blocks)]


def _cells(fps: np.ndarray, blocks: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(block, cell, place of the fingerprint, stands there?) of the own cells and of those one bit up, for words of one kind."""
    out, everyone = [], np.arange(len(fps))
    even = np.uint64(0x5555555555555555)
    for b, (low, high) in enumerate(blocks):
        own = (fps >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)
        variants = [(own, everyone, True)]
        for i in range(high - low):
            bit = np.uint64(1 << i)
            which = np.flatnonzero((own & bit) == 0)
            variants.append((own[which] | bit, which, False))
        for bits, which, stands in variants:
            # Bit counts of the segments {0,1}, {2,3}, ... and of {1,2}, {3,4}, ..., two bits each; blocks have at most 32 bits.
            shifted = bits << np.uint64(1)
            counts = (bits & even) + ((bits >> np.uint64(1)) & even)
            between = (shifted & even) + ((shifted >> np.uint64(1)) & even)
            cell = counts | (between << np.uint64(32)) if high - low < 31 else counts * np.uint64(0x9E3779B97F4A7C15) ^ between
            out.append((np.full(len(bits), b), cell, which, np.full(len(bits), stands)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def grid(prints: DataFrame, rule: Rule = CONTRACT) -> DataFrame:
    """(block, cell, fp, stands): where the distinct fingerprints of `prints` stand and where they are probed."""
    blocks = block_edges(rule.most_bits)
    schema = pa.schema([("block", pa.int32()), ("cell", pa.int64()), ("fp", _kind(rule)), ("stands", pa.bool_())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = _as_matrix(batch.column(0), rule)
            for w in range(rule.words):
                block, cell, which, stands = _cells(fps[:, w], blocks)
                columns = [pa.array(block + w * len(blocks), pa.int32()), pa.array(cell.view(np.int64)), _as_column(fps[which], rule), pa.array(stands)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return prints.select("fp").mapInArrow(run, f"block int, cell long, fp {_sql(rule)}, stands boolean")


def _bits_apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _least_apart(a: Column, b: Column) -> Column:
    """Manhattan distance of the bit counts of four 16-bit segments; never above the differing bits."""
    count = lambda x, i: F.bit_count(F.shiftright(x, 16 * i).bitwiseAND(F.lit(0xFFFF)))
    return reduce(lambda x, y: x + y, [F.abs(count(a, i) - count(b, i)) for i in range(4)])


def _near(a: Column, b: Column, rule: Rule) -> Column:
    """The rule as a condition; the bound by bit counts comes first."""
    pairs = list(zip(_words(a, rule), _words(b, rule), strict=True))
    bound = reduce(lambda x, y: x | y, [_least_apart(x, y) <= rule.most_bits for x, y in pairs])
    apart = [_bits_apart(x, y) for x, y in pairs]
    close = (apart[0] if rule.words == 1 else F.least(*apart)) <= rule.most_bits
    return bound & close & (reduce(lambda x, y: x + y, apart) <= rule.total_bits)


def _forest(fps: np.ndarray, rule: Rule) -> np.ndarray:
    """Places of the edges of a spanning forest, each between two that the rule links."""
    n = len(fps)
    near = np.empty((n, n), bool)
    for i in range(0, n, 256):
        apart = np.bitwise_count(fps[i : i + 256, None, :] ^ fps[None, :, :])
        near[i : i + 256] = (apart.min(axis=2) <= rule.most_bits) & (apart.sum(axis=2, dtype=np.int64) <= rule.total_bits)
    left, edges = np.ones(n, bool), []
    for root in range(n):
        if not left[root]:
            continue
        left[root] = False
        front = np.array([root])
        while len(front):
            reached = near[front].any(axis=0) & left
            left &= ~reached
            fresh = np.flatnonzero(reached)
            via = front[near[np.ix_(front, fresh)].argmax(axis=0)]
            edges += zip(via.tolist(), fresh.tolist(), strict=True)
            front = fresh
    return np.array(edges, np.int64).reshape(-1, 2)


def links(prints: DataFrame, rule: Rule = CONTRACT) -> DataFrame:
    """(a, b): pairs of distinct fingerprints that the rule links, enough to connect all that it links.

    Pairs that meet in a crowded cell are given by spanning forests, all others one by one.
    """
    cells = pin(grid(prints, rule))
    key = ["block", "cell"]
    load = cells.groupBy(*key).agg(F.count(F.when(F.col("stands"), 1)).alias("_own"), F.count(F.lit(1)).alias("_all"))
    crowded = pin(load.where(F.col("_own") * F.col("_all") > PAIRS_IN_CELL))
    n_crowded = crowded.count()
    names = broadcast_checked(crowded.select(*key), n_crowded)
    calm = cells.join(names, key, "left_anti")
    left = calm.where("stands").select(*key, F.col("fp").alias("a"))
    right = calm.select(*key, F.col("fp").alias("b"), "stands")
    once = ~F.col("r.stands") | (F.col("l.a") < F.col("r.b"))
    on = (F.col("l.block") == F.col("r.block")) & (F.col("l.cell") == F.col("r.cell"))
    pairs = left.alias("l").join(right.alias("r"), on & once & _near(F.col("l.a"), F.col("r.b"), rule)).select("a", "b")
    if not n_crowded:
        return pairs

    chunks = F.ceil(F.col("_all") / CHUNK).cast("int")
    members = cells.join(broadcast_checked(crowded.select(*key, chunks.alias("_chunks")), n_crowded), key)
    members = members.withColumn("_chunk", F.pmod(F.xxhash64("fp", F.lit(5)), F.col("_chunks")).cast("int"))
    members = members.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    members = members.select(*key, F.least("_chunk", "_other").alias("_i"), F.greatest("_chunk", "_other").alias("_j"), "fp")
    schema = pa.schema([("a", _kind(rule)), ("b", _kind(rule))])

    def forest(group: pa.Table) -> pa.Table:
        fps = np.unique(_as_matrix(group.column("fp"), rule), axis=0)
        edges = _forest(fps, rule)
        return pa.table([_as_column(fps[edges[:, 0]], rule), _as_column(fps[edges[:, 1]], rule)], schema=schema)

    return pairs.unionByName(members.groupBy(*key, "_i", "_j").applyInArrow(forest, f"a {_sql(rule)}, b {_sql(rule)}"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b): the smallest node reachable.

    Every node hooks to its smallest neighbour, chains of hooks are followed by
    doubling steps, and the edges are drawn again between the ends; edges within one
    end vanish, so each round handles far fewer.  Every step is written, so lineage
    stays short.
    """
    rest = pin(edges.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    roots = None
    while roots is None or rest.limit(1).count():
        ends = _ends(rest)
        if roots is None:
            roots = ends
        else:
            onward = ends.withColumnsRenamed({"node": "_met", "root": "_end"})
            roots = pin(roots.join(onward, roots["root"] == onward["_met"], "left").select("node", F.coalesce("_end", "root").alias("root")))
        first, second = ends.withColumnsRenamed({"node": "_a", "root": "ra"}), ends.withColumnsRenamed({"node": "_b", "root": "rb"})
        drawn = rest.join(first, rest["a"] == first["_a"]).select("ra", "b")
        drawn = drawn.join(second, drawn["b"] == second["_b"]).where("ra <> rb")
        rest = pin(drawn.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
    return roots


def _ends(edges: DataFrame) -> DataFrame:
    """(node, root): where the hooks to smallest neighbours lead from each node; a node without a smaller neighbour leads to itself."""
    lower = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
    alone = edges.select(F.col("a").alias("node")).distinct().join(lower.select("node"), "node", "left_anti")
    steps = pin(lower.union(alone.select("node", F.col("node").alias("root"))))
    while True:
        above = steps.select(F.col("node").alias("_via"), F.col("root").alias("_further"))
        after = pin(steps.join(above, steps["root"] == above["_via"]).select("node", F.col("root").alias("_was"), F.col("_further").alias("root")))
        steps = after.select("node", "root")
        if not after.where(F.col("_was") != F.col("root")).limit(1).count():
            return steps


def classes(prints: DataFrame, rule: Rule = CONTRACT, doc_id: str = "doc_id") -> DataFrame:
    """Rows of `prints` (with `fp`) and `component_id`, the smallest id reachable over links.

    Equal fingerprints are linked, that of empty texts too.  Null ids are members
    but never name a component, unless it has no other.  Repeated rows stay.
    """
    prints = pin(prints)
    firsts = pin(prints.groupBy("fp").agg(F.min(doc_id).alias("_first")))
    roots = components(links(firsts, rule)).select(F.col("node").alias("fp"), "root")
    named = firsts.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("_first").alias("component_id"))
    return prints.join(named.select("fp", "root").join(least, "root").select("fp", "component_id"), "fp")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rule: Rule = CONTRACT) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits a word) and component_id of every row of `docs`."""
    prints = fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", rule, keep=["doc_id"])
    found = classes(prints, rule)
    digits = F.concat(*[F.lpad(F.hex(w), 16, "0") for w in _words(F.col("fp"), rule)])
    return found.select("doc_id", F.lower(digits).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, rule: Rule | Similarity) -> DataFrame:
    """`docs` without near copies: of each component the row with the smallest (id, text hash) stays; null ids come last.

    Rows of one id and text count as copies of each other; the least by all columns stays.  Own columns keep their values,
    whatever their names.  Texts move once, to meet the rows that stay; by similarity,
    those of candidates also move to meet each other.
    """
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("_hash"))
    by_sets = isinstance(rule, Similarity)
    made = set_prints(hashed, "text", rule, ["doc_id", "_hash"]) if by_sets else fingerprints(hashed, "text", rule, keep=["doc_id", "_hash"])
    prints = pin(made.withColumn("_row", F.struct(F.isnull("doc_id").alias("n"), "doc_id", "_hash")))
    firsts = pin(prints.groupBy("fp").agg(F.min("_row").alias("_first"), *([F.first(c).alias(c) for c in ("size", "sim", "keys")] if by_sets else [])))
    if by_sets:
        own = firsts.select("fp", F.col("_first.doc_id").alias("_id"), F.col("_first._hash").alias("_its"))
        met = hashed.join(own, hashed["doc_id"].eqNullSafe(own["_id"]) & (hashed["_hash"] == own["_its"]))
        edges = set_links(firsts, met.select("fp", "text"), rule)
    else:
        edges = links(firsts, rule)
    roots = components(edges).select(F.col("node").alias("fp"), "root")
    named = firsts.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    winners = named.groupBy("root").agg(F.min("_first").alias("w")).select(F.col("w.doc_id").alias("_w_id"), F.col("w._hash").alias("_w_hash"))
    repeated = prints.groupBy("doc_id", "_hash").count().where("count > 1").select(F.col("doc_id").alias("_w_id"), F.col("_hash").alias("_w_hash"), F.lit(True).alias("_repeated"))
    same = lambda a, b: a["_w_id"].eqNullSafe(b["_w_id"]) & (a["_w_hash"] == b["_w_hash"])
    stay = winners.join(repeated, same(winners, repeated), "left").select(winners["_w_id"], winners["_w_hash"], F.coalesce("_repeated", F.lit(False)).alias("_repeated"))
    texts = whole_rows(docs, "doc_id", "text").select("_doc", "doc_id", F.xxhash64("text").alias("_hash"))
    kept = texts.join(stay, texts["doc_id"].eqNullSafe(stay["_w_id"]) & (texts["_hash"] == stay["_w_hash"]))
    if not repeated.limit(1).count():
        return kept.select("_doc.*")
    once = kept.where("not _repeated").select("_doc.*")
    # Of rows of one id and text the least by all columns.
    return once.union(kept.where("_repeated").groupBy("doc_id", "_hash").agg(F.min("_doc").alias("_doc")).select("_doc.*"))
