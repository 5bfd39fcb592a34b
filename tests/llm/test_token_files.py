import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pulsegrid.llm import token_files
from pulsegrid.llm.queries import BYTE_VOCABULARY, op13_range_coded_ids
from tests.llm.helpers import AWKWARD, SF, clashing, docs


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(BYTE_VOCABULARY)


@pytest.mark.parametrize("n", [1, 2, 255, 256, 257, 700, 20_000])
@pytest.mark.parametrize("vocabulary", [1, 2, 90, 50_257, 250_000])
@pytest.mark.parametrize("kind", ["skewed", "uniform", "constant", "cycle"])
def test_ids_come_back(n, vocabulary, kind):
    rng = np.random.default_rng(n)
    ids = {
        "skewed": np.minimum(rng.zipf(1.3, n) - 1, vocabulary - 1),
        "uniform": rng.integers(0, vocabulary, n),
        "constant": np.full(n, vocabulary - 1),
        "cycle": np.arange(n) % min(vocabulary, 37),
    }[kind]
    used, words = token_files.encode_ids(ids, vocabulary)
    assert used.sum() * 4 == len(words)
    assert (token_files.decode_ids(used, words, n, vocabulary) == ids).all()


def test_predictable_ids_take_little_room():
    ids = np.tile(np.random.default_rng(0).integers(0, 50_257, 40), 2_000)
    assert len(token_files.encode_ids(ids, 50_257)[1]) < len(ids) / 2  # four bits each; the vocabulary needs sixteen


def test_damage_is_noticed():
    block = token_files.write_block([7, None, -3], [2, 1, 4], np.array([5, 0, 0, 9, 9, 9, 0]), 10)
    names, sizes, ids = token_files.read_block(block)
    assert names == [7, None, -3] and sizes.tolist() == [2, 1, 4] and ids.tolist() == [5, 0, 0, 9, 9, 9, 0]
    for at in range(4, len(block)):
        with pytest.raises(ValueError, match="checksum"):
            token_files.read_block(block[:at] + bytes([block[at] ^ 1]) + block[at + 1 :])


def test_ids_outside_the_vocabulary_raise():
    with pytest.raises(ValueError, match="vocabulary"):
        token_files.write_block([1], [1], np.array([10]), 10)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="aB ,.'s\n\t\x1c\xa0　éÉ3<|endoftx>İΣς", max_size=60))
def test_text_ids_equal_the_tokenizer(text):
    try:
        text.encode()
    except UnicodeEncodeError:
        return
    words = token_files.text_ids(BYTE_VOCABULARY)
    assert words.of(text).tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids


def expected(rows, tokenizer):
    """Rows in order of doc_id (nulls first) by plain counting; equal ids may stand in either order."""
    out, at = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def by_start(rows):
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows), key=lambda r: r[1])


def test_files_of_awkward_documents(spark, tokenizer, tmp_path):
    frame = clashing(docs(spark), "k", "t", "part", "start", "n_tokens", "payload").repartition(3)
    token_files.write_token_files(frame, str(tmp_path / "f"), BYTE_VOCABULARY, block_ids=100)
    rows = token_files.read_token_files(spark, str(tmp_path / "f"), with_ids=True).collect()
    assert by_start(rows) == expected([r[:2] for r in AWKWARD], tokenizer)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.n_tokens for r in rows)


def test_no_documents(spark, tmp_path):
    token_files.write_token_files(docs(spark, []), str(tmp_path / "f"), BYTE_VOCABULARY)
    assert token_files.read_token_files(spark, str(tmp_path / "f")).collect() == []


def test_query_on_a_whole_table(spark, tokenizer):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert by_start(op13_range_coded_ids(spark, SF).collect()) == expected(rows, tokenizer)
