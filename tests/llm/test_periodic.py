import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsegrid.llm import periodic
from pulsegrid.llm.queries import op11_synchronised_runs
from tests.llm.helpers import AWKWARD, SF, clashing, docs


def brute(words, least=12):
    """(start, end, period) of the runs by comparing with every shift."""
    found, n = {}, len(words)
    for p in range(1, n // 2 + 1):
        i = 0
        while i < n - p:
            j = i
            while j < n - p and words[j] == words[j + p]:
                j += 1
            if j - i >= p:
                found.setdefault((i, j + p), p)
            i = j + 1
    return sorted((s, e, p) for (s, e), p in found.items() if e - s >= least)


def ours(words):
    return [tuple(r) for r in periodic.find_runs(np.array(words, np.int64)).tolist()]


def power(draw):
    unit = [draw.randrange(2) for _ in range(draw.randrange(1, 7))]
    out = []
    for _ in range(draw.randrange(1, 6)):
        out += unit * draw.randrange(1, 40) + [draw.randrange(3) for _ in range(draw.randrange(2))]
        out += (unit * draw.randrange(1, 20))[draw.randrange(len(unit)) :]
    return out[:600]


def rotated(draw):
    """A power of a word that is itself nearly periodic, cut anywhere."""
    n = draw.randrange(10, 80)
    word = [0] * n
    word[draw.randrange(n)] = 1
    return (word * draw.randrange(2, 6))[draw.randrange(n) :]


def copied(draw):
    out = [draw.randrange(3)]
    while len(out) < 300:
        start = draw.randrange(len(out))
        out += out[start : start + draw.randrange(1, len(out) + 1)]
        if draw.random() < 0.3:
            out.append(draw.randrange(4))
    return out[:500]


def fibonacci(draw):
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    return b[: draw.randrange(2, 600)]


def thue_morse(draw):
    out = [0]
    while len(out) < 512:
        out += [1 - x for x in out]
    return out * draw.randrange(1, 3)


def noisy(draw):
    words = [draw.randrange(50) for _ in range(draw.randrange(1, 120))] * draw.randrange(1, 8)
    for _ in range(draw.randrange(3)):
        words[draw.randrange(len(words))] = 99
    return words[:700]


@pytest.mark.parametrize("make", [power, rotated, copied, fibonacci, thue_morse, noisy], ids=lambda f: f.__name__)
def test_all_runs_are_found(make):
    draw = random.Random(make.__name__)
    for _ in range(60):
        words = make(draw)
        assert ours(words) == brute(words)


def test_words_that_shift_a_whole_period_across_a_junction():
    words = ([1, 0, 0, 1, 0] * 40)[:195] + ([1, 0, 0, 1, 0] * 12)[3:55]
    assert ours(words) == brute(words)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=120))
def test_two_words(words):
    assert ours(words) == brute(words)


def test_a_long_text_in_bounded_steps():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 5_000, 400_000)
    words[100_000:300_000] = np.tile(words[100_000:150_001], 4)[:200_000]
    words[350_000:360_000] = 7
    got = {tuple(r) for r in periodic.find_runs(words).tolist()}
    assert any(s <= 100_000 and e >= 300_000 and p == 50_001 for s, e, p in got)
    assert any(s <= 350_000 and e >= 360_000 and p == 1 for s, e, p in got)


def planted(doc_id, words):
    if doc_id is None:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc_id, text, runs_of=brute):
    words = planted(doc_id, re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode()))
    runs = [(s, e - s, p) for s, e, p in runs_of(words)]
    drop = {i for s, n, p in runs for i in range(s + p, s + n)}
    top = min(((-n, s, p) for s, n, p in runs), default=None)
    longest = (None,) * 4 if top is None else (top[1], -top[0], top[2], 1000 * -top[0] // top[2])
    sha = lambda b: hashlib.sha256(b).hexdigest()
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in sorted(runs, key=lambda r: (r[0], r[2])))
    return (doc_id, len(runs), *longest, sha(listed.encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in drop)))


def test_awkward_documents(spark):
    frame = clashing(docs(spark), "runs", "collapsed", "_scanned", "_t", "_w", "start")
    rows = periodic.digest(periodic.with_planted_runs(frame)).collect()
    short = [(r[0], r[1]) for r in AWKWARD if r[0] != 7]
    assert sorted(map(str, (tuple(r) for r in rows if r.doc_id != 7))) == sorted(str(expected(*r)) for r in short)
    long = next(r for r in rows if r.doc_id == 7)
    words = planted(7, dict((r[0], r[1]) for r in AWKWARD)[7].split())
    assert long.n_runs >= 1 and long.length <= len(words)


def test_own_columns_stay(spark):
    frame = docs(spark, [(1, "a b c " * 6, "en", "x", 5)]).selectExpr("*", "42 AS _top", "7 AS _scanned", "'k' AS other")
    row = periodic.periodic_runs(frame, collapse=True).first()
    assert (row._top, row.other, row.n_chars, row.collapsed, row.runs) == (42, "k", 5, "a b c", [(0, 18, 3)])


def test_no_documents(spark):
    assert periodic.digest(periodic.with_planted_runs(docs(spark, []))).collect() == []


def test_query_on_a_whole_table(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]

    def by_numpy(words):
        """Every shift of the whole text at once; the same runs as `brute`."""
        codes = np.unique(np.array(words or [b""], dtype=object), return_inverse=True)[1][: len(words)]
        found = {}
        for p in range(1, len(words) // 2 + 1):
            turns = np.diff(np.concatenate([[0], codes[:-p] == codes[p:], [0]]).astype(int))
            for s, e in zip(np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)):
                if e - s >= p and e - s + p >= 12:
                    found.setdefault((int(s), int(e) + p), p)
        return sorted((s, e, p) for (s, e), p in found.items())

    got = {r.doc_id: tuple(r) for r in op11_synchronised_runs(spark, SF).collect()}
    assert len(got) == len(texts)
    for doc_id, text in texts:
        assert got[doc_id] == expected(doc_id, text, by_numpy)
