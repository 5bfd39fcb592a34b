import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pulsegrid.llm import near
from tests.llm.helpers import SF, clashing, docs


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def kept(rows):
    """Ids that stay by brute force: the smallest of each component of pairs of similarity 0.8 or more."""
    ids, root = sorted(rows), {i: i for i in rows}
    sets = {i: shingles(t) for i, t in rows.items()}
    for i in ids:
        for j in ids:
            both = len(sets[i] & sets[j])
            if j < i and root[i] != root[j] and 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                low, high = sorted((root[i], root[j]))
                root = {k: low if r == high else r for k, r in root.items()}
    return sorted(set(root.values()))


def families(seed):
    """Texts of 9 to 200 words with copies in which words were replaced, so that similarities lie on both sides of 0.8."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    out = []
    for n in [9, 14, 40, 90, 200] * 12:
        base = [word() for _ in range(n)]
        out.append(" ".join(base))
        for _ in range(4):
            copy = list(base)
            for _ in range(rng.randrange(1, 2 + n // 30)):
                copy[rng.choice([0, n - 1, rng.randrange(n)])] = word()
            out.append(" ".join(copy))
    return dict(enumerate(out))


@pytest.mark.parametrize("crowd", [2, 1_000])
def test_stage_keeps_what_brute_force_keeps(spark, monkeypatch, crowd):
    monkeypatch.setattr(near, "SETS_IN_BAND", crowd)
    monkeypatch.setattr(near, "SET_CHUNK", 3)
    rows = families(3)
    frame = docs(spark, [(i, t, "en", "a", len(t)) for i, t in rows.items()])
    after = corpus_pipeline.drop_near_copies(spark, clashing(frame, "fp", "size", "keys", "_key"), SF)
    assert sorted(r.doc_id for r in after.collect()) == kept(rows)


def test_stage_on_documents(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in frame.collect()}
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, frame, SF).collect()) == kept(rows)


@pytest.mark.parametrize("n", [7, 60, 3000])
def test_pairs_of_least_similarity_meet_in_a_band(n):
    rng, rule = np.random.default_rng(n), near.Similarity()
    met = 0
    for _ in range(300):
        common = 4 * n
        pool = rng.integers(0, 1 << 63, common + n, np.uint64)
        a, b = pool[: common + n // 2], np.concatenate([pool[:common], pool[common + n // 2 :]])
        met += bool((near.band_keys(a, rule) == near.band_keys(b, rule)).any())
    assert met >= 299


def test_forest_connects_as_all_pairs_do():
    sets = [near.shingle_set(t.encode(), 5) for t in families(5).values()]
    edges = near._set_forest(sets, 0.8)
    close = lambda a, b: 5 * (n := len(np.intersect1d(a, b))) >= 4 * (len(a) + len(b) - n)
    assert len(edges) and all(close(sets[a], sets[b]) for a, b in edges)
    root = list(range(len(sets)))
    for a, b in edges:
        root = [root[a] if r == root[b] else r for r in root]
    assert all(root[i] == root[j] for i in range(len(sets)) for j in range(i) if close(sets[i], sets[j]))


def test_near_copies_meet_by_their_fingerprints(spark):
    """Sets that share no band: those near by SimHash are linked, each link checked on both texts."""
    rng = random.Random(11)
    texts = [near.shingle_set(t.encode(), 5) for t in families(4).values()]
    assert [near.set_fingerprint(t) & (1 << 64) - 1 for t in texts] == [
        sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in t) > len(t)) for t in texts
    ]
    base = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(400)]
    words = [base, [*base[:-1], "new"], ["new", *base[1:]], [*base, "a", "b"], base[200:]]
    frame = docs(spark, [(i, " ".join(w), "en", "a", 1) for i, w in enumerate(words)])
    prints = near.set_prints(frame, "text", corpus_pipeline.SIMILAR, ["doc_id", "text"])
    alone = prints.withColumn("keys", F.array(F.xxhash64("fp"))).localCheckpoint()
    ids = {tuple(r.fp): r.doc_id for r in alone.collect()}
    edges = near.set_links(alone, alone.select("fp", "text"), corpus_pipeline.SIMILAR).collect()
    met = {i for e in edges for i in (ids[tuple(e.a)], ids[tuple(e.b)])}
    assert met == {0, 1, 2, 3}


def test_awkward_rows(spark):
    kept = near.keep_one(docs(spark), corpus_pipeline.SIMILAR).collect()
    assert sorted((r.doc_id or -1) for r in kept) == [-1, 1, 4, 5, 7, 8, 9, 10]
    assert near.keep_one(docs(spark, []), corpus_pipeline.SIMILAR).count() == 0
