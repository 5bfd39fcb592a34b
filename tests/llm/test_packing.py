import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pulsegrid.llm import packing
from pulsegrid.llm.queries import VOCABULARY, op5_binary_packing
from tests.llm.helpers import AWKWARD, SF, clashing, docs


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


@given(st.integers(0, 100_000), st.sampled_from([1, 2, 8, 2048]))
def test_binary_pieces(n, most):
    pieces = packing.binary_pieces(n, most)
    at = 0
    for start, length in pieces:
        assert start == at and length <= most and length & (length - 1) == 0
        at += length
    assert at == n
    short = [k for _, k in pieces if k < most]
    assert short == sorted(set(short), reverse=True)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="aB ,.'s\n\x1c éÉ3<|endoftx>İΣς", max_size=60))
def test_word_ids_equal_the_tokenizer(text):
    try:
        text.encode()
    except UnicodeEncodeError:
        return
    ids = np.frombuffer(packing.word_ids(VOCABULARY).of(text.encode()), "<u4").tolist()
    assert ids == Tokenizer.from_file(VOCABULARY).encode(text, add_special_tokens=False).ids


def check(rows, texts, tokenizer):
    """Pieces of every document join to its ids and the end id."""
    assert len({r.sequence_id for r in rows}) == len(rows)
    by = {}
    for r in rows:
        assert r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= 2048
        by.setdefault(r.doc_id, []).append(r)
    want = {}
    for doc_id, text in texts:
        want.setdefault(doc_id, []).append([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1])
    assert by.keys() == want.keys()
    for doc_id, several in want.items():
        ids = several[0]
        assert len(several) == 1 or all(x == ids for x in several)
        crcs = []
        for start, length in packing.binary_pieces(len(ids)):
            crcs += [(start, length, len(ids), zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes()))] * len(several)
        assert sorted((r.start, r.length, r.doc_tokens, r.ids_crc32) for r in by[doc_id]) == sorted(crcs)


def test_documents_round_trip(spark, tokenizer):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(op5_binary_packing(spark, SF).collect(), texts, tokenizer)


def test_awkward_rows(spark, tokenizer):
    from pyspark.sql import functions as F

    rows = [r for r in AWKWARD if r[0] not in (7, 8)]
    packed = packing.pack(clashing(docs(spark, rows), "tokens", "start"), VOCABULARY, keep=("doc_id", "start"))
    assert packed.columns.count("start") == 1
    check(packed.withColumn("ids_crc32", F.crc32("tokens")).collect(), [(r[0], r[1]) for r in rows], tokenizer)
    assert packing.pack(docs(spark, []), VOCABULARY).count() == 0


def test_very_long_text(spark):
    rows = packing.pack(docs(spark, [r for r in AWKWARD if r[0] == 7]), VOCABULARY).collect()
    assert sum(r.length for r in rows) == rows[0].doc_tokens == 600_001


def test_kept_words_stay_few(monkeypatch):
    monkeypatch.setattr(packing, "KEPT_WORDS", 5)
    words = packing.WordIds(VOCABULARY)
    text = " ".join(f"word{i}" for i in range(40)).encode()
    assert words.of(text) == packing.WordIds(VOCABULARY).of(text)
    assert len(words) <= 5 and len(words.older) <= 5


def test_buckets_on_disk(spark, tmp_path):
    packed = packing.pack(spark.read.parquet(f"{SF}/documents.parquet"), VOCABULARY)
    packing.write_buckets(packed, str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert back.count() == packed.count()
    assert back.where("length <> shiftleft(1, bucket)").count() == 0


def test_sequence_length_must_be_a_power_of_two(spark):
    with pytest.raises(ValueError):
        packing.pack(docs(spark), VOCABULARY, sequence=1000)
