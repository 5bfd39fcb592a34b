import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pulsegrid.llm import near
from tests.llm.helpers import AWKWARD, SF, clashing, docs

TWO_WORDS = near.Rule(shingle=5, most_bits=7, words=2, total_bits=22)


def naive(text, k):
    words = [w.decode() for w in (text or "").encode().lower().split()]
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("k", [1, 4, 5])
def test_fingerprint(k, monkeypatch):
    texts = ["", "one", "A b C", "a b c d", "a b c d e", "A-Z É ß\x1cx y\x0bz q r s " * 7, " lead and trail \n"]
    assert [near.fingerprint(t.encode(), k) for t in texts] == [[naive(t, k)] for t in texts]
    two = [near.fingerprint(t.encode(), k, 2) for t in texts]
    assert [t[0] for t in two] == [naive(t, k) for t in texts] and two[0][1] == 0 and two[3][1] not in (0, two[3][0])
    monkeypatch.setattr(near, "_PIECE", 13)
    assert [near.fingerprint(t.encode(), k, 2) for t in texts] == two


def brute(fps, most):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= most:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {f: find(f) for f in fps}


def families(seed, n=60, each=12, flips=3):
    rng = random.Random(seed)
    out = {0, (1 << 64) - 1, 1}
    for _ in range(n):
        base = rng.getrandbits(64)
        for _ in range(each):
            out.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(flips + 1))))
    return sorted(out)


@pytest.mark.parametrize("most", [2, 3, 4, 5, 6, 7])
@pytest.mark.parametrize("crowd", [10, 1_000_000])
def test_links_give_all_components(spark, monkeypatch, most, crowd):
    monkeypatch.setattr(near, "PAIRS_IN_CELL", crowd)
    monkeypatch.setattr(near, "CHUNK", 7)
    fps = families(most)
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    frame = spark.createDataFrame([(s,) for s in signed], "fp long")
    edges = near.links(frame, near.Rule(most_bits=most)).collect()
    back = dict(zip(signed, fps, strict=True))
    assert edges and all((back[a] ^ back[b]).bit_count() <= most for a, b in edges)
    got = {back[r.node]: r.root for r in near.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = brute(fps, most)
    sizes = {}
    for f, r in want.items():
        sizes.setdefault(r, []).append(f)
    for members in sizes.values():
        if len(members) == 1:
            assert members[0] not in got
        else:
            assert {got[m] for m in members} == {min(int(np.uint64(m).astype(np.int64)) for m in members)}


@pytest.mark.parametrize("crowd", [10, 1_000_000])
def test_two_words(spark, monkeypatch, crowd):
    monkeypatch.setattr(near, "PAIRS_IN_CELL", crowd)
    monkeypatch.setattr(near, "CHUNK", 7)
    rule = near.Rule(most_bits=3, words=2, total_bits=8)
    fps = families(9, n=25, each=10, flips=4)
    rng = random.Random(4)
    both = sorted({(f, f ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(8)))) for f in fps})
    signed = [[int(np.uint64(w).astype(np.int64)) for w in f] for f in both]
    edges = near.links(spark.createDataFrame([(s,) for s in signed], "fp array<long>"), rule).collect()
    root = {tuple(s): tuple(s) for s in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def linked(f, g):
        apart = [(a ^ b).bit_count() for a, b in zip(f, g, strict=True)]
        return min(apart) <= 3 and sum(apart) <= 8

    back = dict(zip(map(tuple, signed), both, strict=True))
    assert edges and all(linked(back[tuple(a)], back[tuple(b)]) for a, b in edges)
    for i, f in enumerate(both):
        for j in range(i):
            if linked(f, both[j]):
                x, y = sorted((find(tuple(signed[i])), find(tuple(signed[j]))))
                root[y] = x
    got = {tuple(r.node): tuple(r.root) for r in near.components(spark.createDataFrame(edges, "a array<long>, b array<long>")).collect()}
    want = {s: find(s) for s in root}
    assert got == {s: r for s, r in want.items() if sum(x == r for x in want.values()) > 1}


def test_segment_bound_is_a_lower_bound(spark):
    rng = np.random.default_rng(1)
    pairs = rng.integers(-(2**63), 2**63 - 1, (500, 2))
    frame = spark.createDataFrame([(int(a), int(b)) for a, b in pairs], "a long, b long")
    low, bits = near._least_apart(F.col("a"), F.col("b")), near._bits_apart(F.col("a"), F.col("b"))
    assert frame.where(low > bits).count() == 0


def test_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long")
    roots = {r.node: r.root for r in near.components(edges).collect()}
    assert all(roots[i] == 0 for i in range(301)) and roots[1001] == 1000


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(230)] + [(7, 7), (399, 0), (0, 399)]
    root = {i: i for pair in pairs for i in pair}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.node: r.root for r in near.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    linked = {i for a, b in pairs if a != b for i in (a, b)}
    assert got == {i: find(i) for i in linked}


def test_awkward_rows(spark):
    frame = clashing(docs(spark), "fp", "component_id", "root")
    rows = near.near_duplicates(frame).collect()
    assert len(rows) == len(AWKWARD)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add((r.fingerprint, r.component_id))
    for doc_id, text, *_ in AWKWARD:
        assert {f for f, _ in by[doc_id]} == {f"{naive(text, 4):016x}"}
    assert {c for i in (1, 2, 3) for _, c in by[i]} == {1}
    assert {c for i in (5, 6) for _, c in by[i]} == {5}
    assert by[None] == {(f"{naive('a text without an id', 4):016x}", None)}


def test_empty_table(spark):
    assert near.near_duplicates(docs(spark, [])).count() == 0
    assert near.keep_one(docs(spark, []), TWO_WORDS).count() == 0


def test_documents_against_brute_force(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    rows = near.near_duplicates(table).collect()
    texts = {r.doc_id: r.text for r in table.collect()}
    fps = {i: naive(t, 4) for i, t in texts.items()}
    roots = brute(sorted(set(fps.values())), 4)
    least = {}
    for i, f in fps.items():
        least[roots[f]] = min(i, least.get(roots[f], i))
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{f:016x}", least[roots[f]]) for i, f in fps.items()}


def test_keep_one(spark):
    kept = near.keep_one(clashing(docs(spark), "_first"), TWO_WORDS)
    assert kept.columns == [*docs(spark).columns, "_first"]
    ids = sorted((r.doc_id or -1) for r in kept.collect())
    assert ids == [-1, 1, 4, 5, 7, 8, 9, 10]
