"""Token-id files: an adaptive context-mixing range coder in independent, checksummed blocks.

A block holds the ids of whole documents, cut into lanes of `LANE_IDS` ids that are
coded side by side, so that a step of the coder is array arithmetic over all lanes.
The lanes share one model, which starts fresh in every block and learns from each
step: an order-0 distribution of ids, and for the contexts of one and two preceding
ids the id that followed last, with how often it was right lately.  Their
predictions are mixed with weights learned for each pair of such confidences, and
the mixture drives a range coder.  Encoder and decoder run the same model.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pulsegrid.llm.common import batch_of, slices
from pulsegrid.llm.packing import byte_letters
from pulsegrid.runtime import shuffle_width

END_ID = 0
LANE_IDS = 256
# A block closes when it has this many ids; a longer document is a block of its own.
BLOCK_IDS = 1 << 20
KEPT_WORDS = 1_000_000
_LONGEST_KEPT = 64

_MAGIC = b"PGT1"
_HEAD = struct.Struct("<4sIIQII")  # magic, crc32 of the rest, documents, ids, size of the vocabulary, lanes

# Probabilities: order 0 in 2^19, mixing weights in 64ths.
_ORDER0_BITS, _WEIGHT_BITS = 19, 6
_TOTAL_BITS = _ORDER0_BITS + _WEIGHT_BITS
_ORDER0, _WEIGHTS = 1 << _ORDER0_BITS, 1 << _WEIGHT_BITS
_PAIR_BITS = 18  # slots for contexts of two ids
_PAIR_SHIFT = np.uint32(32 - _PAIR_BITS)
_MIX1, _MIX2 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)
_STEP, _SUREST = np.int32(1 << 24), np.int32(7 << 24)  # confidences count up to seven
_CLASSES = 128  # pairs of confidences, apart and with equal candidates
_LOW32, _U32, _FIVE = np.uint64(0xFFFFFFFF), np.uint64(32), np.uint64(5)
_UNIT = np.uint64(_TOTAL_BITS)
_RELEARN = (6, 32, 128)  # steps before which distribution and weights are renewed


class Model:
    """Order-0 to order-2 predictions of one block, the same in encoder and decoder."""

    def __init__(self, vocabulary: int, lanes: int) -> None:
        self.size = vocabulary
        self.seen = np.zeros(vocabulary, np.int64)
        self.one = np.zeros(vocabulary + 1, np.int32)  # last id | confidence << 24, by the id before (one past the last: none)
        self.two = np.zeros(1 << _PAIR_BITS, np.int32)
        self.before = np.full(lanes, vocabulary, np.int32)
        self.earlier = np.full(lanes, vocabulary, np.int32)
        self.tried, self.right1, self.right2 = (np.zeros(_CLASSES) for _ in range(3))
        self.kept: list[tuple] = []
        self.renew(0)

    def renew(self, step: int) -> None:
        """Order-0 shares and mixing weights from what has been seen before this step."""
        if self.kept:
            kind, ids, right1, right2 = (np.concatenate(x) for x in zip(*self.kept, strict=True))
            self.seen += np.bincount(ids, minlength=self.size)
            self.tried += np.bincount(kind, minlength=_CLASSES)
            self.right1 += np.bincount(kind[right1], minlength=_CLASSES)
            self.right2 += np.bincount(kind[right2 & (kind < _CLASSES // 2)], minlength=_CLASSES)
        self.kept, self.keeps = [], step < _RELEARN[-1]
        total = int(self.seen.sum())
        spare = _ORDER0 - self.size  # every id has a share of at least one
        width = 1 + (self.seen * (spare / total) if total else np.full(self.size, spare / self.size)).astype(np.int64)
        width[int(width.argmax())] += _ORDER0 - int(width.sum())
        self.width = width.astype(np.int32)
        self.start = np.concatenate([[0], np.cumsum(width)]).astype(np.int32)
        self.id_at = np.repeat(np.arange(self.size, dtype=np.int32), width)
        # The rates of one class never add up to more than the whole.
        most = _WEIGHTS - 2
        w1 = np.minimum(most, np.floor(_WEIGHTS * (self.right1 + 0.02) / (self.tried + 1))).astype(np.int32)
        w2 = np.minimum(most - w1, np.floor(_WEIGHTS * (self.right2 + 0.02) / (self.tried + 1))).astype(np.int32)
        self.masses = w1 << _ORDER0_BITS, w2 << _ORDER0_BITS, _WEIGHTS - w1 - w2

    def predict(self, n: int) -> None:
        """Candidates and weights for the first n lanes."""
        before = self.before[:n]
        self.slot = (before.view(np.uint32) * _MIX1 ^ self.earlier[:n].view(np.uint32) * _MIX2) >> _PAIR_SHIFT
        self.at1, self.at2 = self.one.take(before), self.two.take(self.slot)
        self.id1, self.id2 = self.at1 & 0xFFFFFF, self.at2 & 0xFFFFFF
        self.same = self.id1 == self.id2
        self.kind = (self.at1 >> 21 & 0x38) | self.at2 >> 24 | self.same.astype(np.int32) << 6
        m1, m2, base = self.masses
        self.mass1, self.mass2, self.base = m1.take(self.kind), m2.take(self.kind), base.take(self.kind)

    def interval(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of the ids in the mixture."""
        self.hit1, self.hit2 = self.id1 == ids, self.id2 == ids
        start = self.base * self.start.take(ids)
        start += self.mass1 * (self.id1 < ids)
        start += self.mass2 * (self.id2 < ids)
        width = self.base * self.width.take(ids)
        width += self.mass1 * self.hit1
        width += self.mass2 * self.hit2
        return start, width

    def find(self, value: np.ndarray) -> np.ndarray:
        """The ids whose intervals hold the values."""
        m1, m2 = self.mass1, self.mass2
        # Equal candidates have no mass of their own for the second.
        end1 = self.base * self.start.take(self.id1 + 1) + m1 + m2 * (self.id2 < self.id1)
        end2 = self.base * self.start.take(self.id2 + 1) + m2 + m1 * (self.id1 <= self.id2)
        past1, past2 = value >= end1, value >= end2
        plain = value - m1 * past1
        plain -= m2 * past2
        plain //= self.base
        ids = self.id_at.take(np.minimum(plain, _ORDER0 - 1, out=plain))
        own1 = self.base * self.width.take(self.id1) + m1
        own2 = self.base * self.width.take(self.id2) + m2 + m1 * self.same
        ids = np.where((value >= end1 - own1) > past1, self.id1, ids)
        return np.where((value >= end2 - own2) > past2, self.id2, ids)

    def learn(self, ids: np.ndarray) -> None:
        """Take over the ids given to `interval` last."""
        n = len(ids)
        if self.keeps:
            self.kept.append((self.kind, ids, self.hit1, self.hit2))
        self.one[self.before[:n]] = np.where(self.hit1, np.minimum(self.at1 + _STEP, self.id1 | _SUREST), ids)
        self.two[self.slot] = np.where(self.hit2, np.minimum(self.at2 + _STEP, self.id2 | _SUREST), ids)
        self.earlier[:n] = self.before[:n]
        self.before[:n] = ids


def _lanes(n: int) -> tuple[int, int, int]:
    """Lanes, steps, ids of the last lane."""
    lanes = max(1, -(-n // LANE_IDS))
    return lanes, min(n, LANE_IDS), n - (lanes - 1) * LANE_IDS


def encode_ids(ids: np.ndarray, vocabulary: int) -> tuple[np.ndarray, bytes]:
    """Words (32 bits) written by each lane, and all their words one lane after another."""
    n = len(ids)
    lanes, steps, last = _lanes(n)
    whole = np.zeros(lanes * LANE_IDS, np.int32)
    whole[:n] = ids
    grid = np.ascontiguousarray(whole.reshape(lanes, LANE_IDS)[:, :steps].T)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
    out, row = np.zeros(lanes * (steps + 1), np.uint32), np.arange(lanes) * (steps + 1)
    at = row.copy()
    model = Model(vocabulary, lanes)
    for step in range(steps):
        live = lanes if step < last else lanes - 1  # the last lane may be shorter
        if step in _RELEARN:
            model.renew(step)
        model.predict(live)
        now = grid[step, :live]
        a, b, moved, shift = _narrow(low[:live], span[:live], *model.interval(now))
        out[at[:live]] = a >> _U32
        at[:live] += moved
        a <<= shift
        b <<= shift
        model.learn(now)
    out[at] = (low + _LOW32) >> _U32  # the highest bits of a number within the last interval
    used = at - row + 1
    return used, out.reshape(lanes, -1)[np.arange(steps + 1)[None, :] < used[:, None]].astype("<u4").tobytes()


def _narrow(low: np.ndarray, span: np.ndarray, start: np.ndarray, width: np.ndarray):
    """Narrow the intervals in place; where the upper 32 bits are settled they move out (shift 32).  A span too small for
    the next step is cut so that they settle."""
    unit = span >> _UNIT
    low += unit * start.astype(np.uint64)
    np.multiply(unit, width.astype(np.uint64), out=span)
    settled, small = (low ^ (low + span)) <= _LOW32, span <= _LOW32
    cut = small > settled
    if cut.any():
        span[cut] = (~low[cut] + np.uint64(1)) & _LOW32
    moved = settled | small
    return low, span, moved, moved.astype(np.uint64) << _FIVE


def decode_ids(used: np.ndarray, words: bytes, n: int, vocabulary: int) -> np.ndarray:
    lanes, steps, last = _lanes(n)
    width = int(used.max()) + 3
    held = np.zeros((lanes, width), np.uint64)
    held[np.arange(width)[None, :] < used[:, None]] = np.frombuffer(words, "<u4")
    code = held[:, 0] << _U32 | held[:, 1]
    flat, at = held.reshape(-1), np.arange(lanes) * width + 2
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
    grid = np.zeros((steps, lanes), np.int32)
    model = Model(vocabulary, lanes)
    most = np.uint64((1 << _TOTAL_BITS) - 1)
    for step in range(steps):
        live = lanes if step < last else lanes - 1
        if step in _RELEARN:
            model.renew(step)
        model.predict(live)
        a, b, c = low[:live], span[:live], code[:live]
        now = model.find(np.minimum((c - a) // (b >> _UNIT), most).astype(np.int32))
        a, b, moved, shift = _narrow(a, b, *model.interval(now))
        fresh = flat.take(at[:live])
        fresh *= moved
        c <<= shift
        c |= fresh
        at[:live] += moved
        a <<= shift
        b <<= shift
        grid[step, :live] = now
        model.learn(now)
    whole = np.zeros((lanes, LANE_IDS), np.int32)
    whole[:, :steps] = grid.T
    return whole.reshape(-1)[:n]


def write_block(doc_ids: list[int | None], sizes: list[int], ids: np.ndarray, vocabulary: int) -> bytes:
    """One block: head, document ids and sizes, lanes."""
    if len(ids) and (int(ids.max()) >= vocabulary or int(ids.min()) < 0) or vocabulary > _ORDER0 // 2:
        raise ValueError(f"ids must lie below the vocabulary's size, and that at most at {_ORDER0 // 2}")
    used, words = encode_ids(ids, vocabulary)
    known = np.array([d is not None for d in doc_ids], bool)
    names = np.array([0 if d is None else d for d in doc_ids], "<i8")
    rest = b"".join(
        (np.packbits(known).tobytes(), names.tobytes(), np.array(sizes, "<u4").tobytes(), used.astype("<u2").tobytes(), words)
    )
    head = _HEAD.pack(_MAGIC, 0, len(sizes), len(ids), vocabulary, len(used))[8:]
    return _MAGIC + struct.pack("<I", zlib.crc32(head + rest)) + head + rest


def read_block(block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, sizes and all ids of a block; a damaged block raises."""
    magic, crc, docs, n, vocabulary, lanes = _HEAD.unpack_from(block)
    if magic != _MAGIC or zlib.crc32(block[8:]) != crc:
        raise ValueError("a block of token ids is damaged: its checksum differs")
    at = _HEAD.size
    known = np.unpackbits(np.frombuffer(block, np.uint8, -(-docs // 8), at))[:docs].astype(bool)
    at += -(-docs // 8)
    names = np.frombuffer(block, "<i8", docs, at)
    at += 8 * docs
    sizes = np.frombuffer(block, "<u4", docs, at).astype(np.int64)
    at += 4 * docs
    used = np.frombuffer(block, "<u2", lanes, at).astype(np.int64)
    ids = decode_ids(used, block[at + 2 * lanes :], n, vocabulary)
    return [int(d) if k else None for d, k in zip(names, known, strict=True)], sizes, ids


_PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # no apostrophe: it begins units such as 's
_LETTERS = [letter for _, letter in sorted(byte_letters().items())]
_BLANK, _LATIN_END = _LETTERS[32], "\u0250"


class Tails(dict):
    """Ids of runs of ASCII punctuation."""

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, tail: str) -> bytes:
        ids = self.encode(tail)
        if len(tail) <= 4:
            self[tail] = ids
        return ids


class OtherWhiteSpace(Exception):
    """A text has white space besides single blanks and line feeds between other characters."""


class TextIds(dict):
    """Ids of the stretches of a text that begin with a blank or a line feed, as the byte-level tokenizer gives them.

    Its pre-tokenizer starts a new unit at a single blank or line feed between other
    characters than white space, so a text that has no other white space is encoded
    stretch by stretch, and stretches met before are looked up.  Keys are what follows
    the blank; after a line feed they begin with it.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model.tokenize
        self.size = self.tokenizer.get_vocab_size()
        self.kind = "H" if self.size <= 1 << 16 else "I"
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.older: dict[str, bytes] = {}
        self.feed = self.whole("\n")
        self.tails = Tails(self._unit)

    def whole(self, text: str) -> bytes:
        return array(self.kind, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _unit(self, unit: str) -> bytes:
        """One unit of the pre-tokenizer in the letters of the vocabulary."""
        return array(self.kind, [t.id for t in self.merges(unit)]).tobytes()

    def __missing__(self, word: str) -> bytes:
        if word.isalpha() and word.isascii():
            ids = self.older.get(word) or self._unit(_BLANK + word)
        else:
            ids = self.older.get(word) or self._encode(word)
        if len(word) <= _LONGEST_KEPT:
            if len(self) >= KEPT_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def _encode(self, word: str) -> bytes:
        fed = word[:1] == "\n"
        if (word[1:] if fed else word).split() != [word.strip()] or word[-1].isspace():
            raise OtherWhiteSpace
        bare = word.rstrip(_PUNCTUATION)
        letters = bare[1:] if fed else bare
        if not letters.isalpha() or max(letters) >= _LATIN_END:
            return self.whole(word if fed else " " + word)
        if len(bare) < len(word):  # one unit of punctuation after the letters
            return self[bare] + self.tails[word[len(bare) :]]
        unit = "".join([_LETTERS[b] for b in letters.encode()])
        return self.feed + self._unit(unit) if fed else self._unit(_BLANK + unit)

    def of(self, text: str) -> np.ndarray:
        if not any(s in text for s in self.special):
            first, *words = text.replace("\n", " \n").split(" ")
            try:
                if first.isalpha() and first.isascii():
                    head = self._unit(first)
                elif first.split() == [first]:
                    head = self.whole(first)
                else:
                    raise OtherWhiteSpace
                return np.frombuffer(head + b"".join(map(self.__getitem__, words)), self.kind)
            except OtherWhiteSpace:
                pass
        return np.frombuffer(self.whole(text), self.kind)


@lru_cache(maxsize=2)
def text_ids(path: str) -> TextIds:
    """One per worker process."""
    return TextIds(path)


_FILE = pa.schema(
    [("part", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("payload", pa.binary())]
)


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str, text: str = "text", key: str = "doc_id", end_id: int = END_ID, block_ids: int = BLOCK_IDS
) -> None:
    """Write the token ids of every text, each closed by `end_id`, below `path` in ascending order of `key` (nulls first).

    The container is Parquet, which any store takes and Spark splits and commits; a
    row is one block: part and block number it, first_id counts the ids before it in
    its part, payload is what `write_block` returns.  A null text counts as empty.
    Rows of one key stand in order of their text's hash; equal rows are spread.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))
    # The last column only spreads equal rows, whose order makes no difference.
    order = [F.col("k").asc_nulls_first(), F.xxhash64("t"), F.spark_partition_id()]
    rows = rows.repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order[:2])

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = text_ids(vocabulary), TaskContext.get().partitionId()
        end = np.array([end_id], np.int64)
        names: list[int | None] = []
        held: list[np.ndarray] = []
        number = first = n = 0

        def close() -> pa.RecordBatch:
            payload = write_block(names, [len(x) for x in held], np.concatenate(held), words.size)
            return batch_of(_FILE, [[part], [number], [first], [len(names)], [n], [payload]])

        for batch in slices(batches, "t"):
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.concatenate([words.of(raw or ""), end])
                if names and n + len(ids) > block_ids:
                    yield close()
                    number, first, n = number + 1, first + n, 0
                    names, held = [], []
                names.append(name)
                held.append(ids)
                n += len(ids)
        if names:
            yield close()

    kinds = "part int, block int, first_id long, n_docs long, n_ids long, payload binary"
    rows.mapInArrow(encode, kinds).write.option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of its
    little-endian unsigned 32-bit ids), and with `with_ids` these ids as binary."""
    files = spark.read.parquet(path)
    fields = [("part", pa.int32()), ("at", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema([*fields, ("ids", pa.binary())] if with_ids else fields)

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part, first, payload = (batch.column(c)[i].as_py() for c in range(3))
                names, sizes, ids = read_block(payload)
                raw, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(sizes)
                cuts = [(4 * int(e - s), 4 * int(e)) for s, e in zip(sizes, ends, strict=True)]
                columns = [[part] * len(names), first + ends - sizes, names, sizes, [zlib.crc32(raw[a:b]) for a, b in cuts]]
                yield batch_of(schema, [*columns, [bytes(raw[a:b]) for a, b in cuts]] if with_ids else columns)

    kinds = "part int, at long, doc_id long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    rows = files.select("part", "first_id", "payload").mapInArrow(decode, kinds)
    # One row per part: what the parts before it hold.
    whole = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before: Column = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    earlier = F.broadcast(whole.select("part", before.alias("before")))
    return rows.join(earlier, "part").select("doc_id", (F.col("before") + F.col("at")).alias("start"), *[f[0] for f in fields[3:]], *(["ids"] if with_ids else []))
