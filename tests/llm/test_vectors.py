import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import ann, exact_search
from pulsegrid.llm.queries import ORACLES, op6_kmeans_tree, op8_approximation_file
from pulsegrid.llm.vectors import Owners
from tests.compare import differences, duck
from tests.llm.helpers import SF

NAN, INF = float("nan"), float("inf")


def usable(rows):
    return {i: np.array(v, np.float64) for i, v in rows if v and i is not None and all(x is not None and math.isfinite(x) for x in v)}


def brute_inner(rows, asked, k):
    vec = {i: [math.floor(256 * float(x)) for x in v] for i, v in usable(rows).items()}
    out = set()
    for q in asked:
        if q in vec:
            near = sorted(((-sum(a * b for a, b in zip(vec[q], v, strict=True)), i) for i, v in vec.items() if i != q))[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(near)}
    return out


def brute_cosine(rows, asked, k):
    vec = {i: v for i, v in usable(rows).items() if v.any()}
    out = {}
    for q in asked:
        if q in vec:
            cos = lambda v: float(np.dot(vec[q], v) / math.sqrt(np.dot(vec[q], vec[q]) * np.dot(v, v)))
            out[q] = sorted(((-cos(v), i) for i, v in vec.items() if i != q))[:k]
    return out


def asked(frame, step):
    return frame.where(F.col("vec_id") % step == 0).select(F.col("vec_id").alias("query_id"), "embedding")


AWKWARD = [
    (0, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 3.0]), (3, [2.0, 4.0, 6.0]), (4, [0.0, 0.0, 0.0]),
    (5, None), (6, []), (7, [1.0, None, 2.0]), (8, [NAN, 1.0, 1.0]), (9, [INF, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]),
    (10, [-1.0, 0.5, 0.25]), (10, [-1.0, 0.5, 0.25]), (11, [-0.0, 0.0009765625, -5.5]),
]


def awkward(spark):
    frame = spark.createDataFrame(AWKWARD, "vec_id long, embedding array<float>")
    return frame.select("*", F.lit("mine").alias("score"), F.lit("mine").alias("ids"), F.lit(0).alias("rank"))


def test_exact_search_on_awkward_rows(spark):
    frame = awkward(spark)
    got = exact_search.search(frame, asked(frame, 1).dropDuplicates(["query_id"]))
    assert {tuple(r) for r in got.collect()} == brute_inner(dict(AWKWARD).items(), {i for i, _ in AWKWARD}, 5)
    none = frame.where("false")
    assert exact_search.search(none, asked(none, 1)).count() == 0


@pytest.mark.parametrize("cells", [2, 16, 200])
def test_exact_search_against_brute_force(spark, monkeypatch, cells):
    monkeypatch.setattr(exact_search, "LEAST_BLOCK", 64)
    monkeypatch.setattr(exact_search, "MOST_BLOCK", 64)
    rng = np.random.default_rng(cells)
    rows = [(i, [float(x) for x in rng.normal(size=8).round(2)]) for i in range(600)] + [(600 + i, [0.5] * 8) for i in range(40)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    original = exact_search.cells_of
    monkeypatch.setattr(exact_search, "cells_of", lambda f: original(f, cells))
    assert {tuple(r) for r in exact_search.search(frame, asked(frame, 7)).collect()} == brute_inner(rows, range(0, 640, 7), 5)


def test_large_components_stay_exact():
    rng = np.random.default_rng(5)
    rows = rng.integers(-(1 << 30), 1 << 30, (50, 4))
    low = rows.min(axis=0)
    grid = exact_search.Cells(low, -(-(rows.max(axis=0) - low + 1) // 64))
    found = exact_search.top_k([-1], rows[:1] + 1, [[i] for i in range(50)], grid.encode(rows), rows, grid, 3)
    exact = sorted(((sum(int(a) * int(b) for a, b in zip(rows[0] + 1, r, strict=True)), i) for i, r in enumerate(rows)), reverse=True)[:3]
    assert [(s, r) for _, r, s in found] == exact


def test_exact_search_reads_few_vectors():
    rng = np.random.default_rng(6)
    rows = rng.integers(-128, 128, (4000, 16))
    grid = exact_search.Cells(np.full(16, -128), np.full(16, 4))
    low, high = grid.bounds(grid.encode(rows))
    query = rng.integers(-128, 128, 16)
    plus, minus = np.maximum(query, 0), np.minimum(query, 0)
    owners = Owners([[i] for i in range(4000)])
    _, found, read = exact_search._top(-1, query, owners, np.zeros(4000, bool), low @ plus + high @ minus, high @ plus + low @ minus, rows, 5)
    assert found.tolist() == sorted((rows @ query).tolist(), reverse=True)[:5] and read < 800


def test_op8_against_sql(spark):
    sf = SF.replace("0.001", "0.01")
    ours = op8_approximation_file(spark, sf).toPandas()
    assert differences(ours, duck(sf).sql(ORACLES["op8_approximation_file"]).df()) is None


def test_tree_search_on_awkward_rows(spark):
    frame = awkward(spark)
    got, _ = ann.search(frame, asked(frame, 1).dropDuplicates(["query_id"]))
    want = brute_cosine(dict(AWKWARD).items(), {i for i, _ in AWKWARD}, 5)
    by = {}
    for r in got.orderBy("query_id", "rank").collect():
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert by.keys() == want.keys()
    for q, near in want.items():
        assert [s for _, s in by[q]] == pytest.approx([-s for s, _ in near], abs=1e-12)
    assert [i for i, _ in by[0]][:2] == [1, 2]
    none = frame.where("false")
    assert ann.search(none, asked(none, 1))[0].count() == 0


def test_recall(spark):
    sf = SF.replace("sf0.001", "sf0.1")
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute_cosine(rows, [i for i, _ in rows if i % 50 == 0], 5)
    got = op6_kmeans_tree(spark, sf).collect()
    found = {(r.query_id, r.vec_id) for r in got}
    assert len(got) == sum(map(len, want.values()))
    hits = sum((q, i) in found for q, near in want.items() for _, i in near)
    assert hits / sum(map(len, want.values())) >= 0.9


def test_best_bin_first_visits_every_leaf_once():
    rng = np.random.default_rng(2)
    tree = ann.grow(rng.normal(size=(500, 6)))
    visits = tree.visits(rng.normal(size=6), tree.leaves)
    assert sorted(visits) == list(range(tree.leaves))
    assert ann.grow(np.ones((100, 3))).leaves == 1


def ranks(frame):
    by = {}
    for r in frame.orderBy("query_id", "rank").collect():
        by.setdefault(r.query_id, []).append(r.vec_id)
    return by


def test_a_query_id_with_many_vectors(spark):
    """The rows of the query's own id take no places."""
    rng = np.random.default_rng(8)
    rows = [(50, [float(x) for x in rng.normal(size=4)]) for _ in range(9)] + [(i, [float(x) for x in rng.normal(size=4)]) for i in range(1, 9)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    exact = exact_search.search(frame, asked(frame, 50))
    # Each of the nine rows is a query of its own there; the search keeps the best for the id.
    best = {}
    for _, q in rows[:9]:
        for i, v in rows[9:]:
            score = sum(math.floor(256 * float(np.float32(a))) * math.floor(256 * float(np.float32(b))) for a, b in zip(q, v, strict=True))
            best.setdefault(i, []).append(score)
    flat = sorted({(-s, i) for i, several in best.items() for s in several})[:5]
    assert [(r["rank"], r.vec_id, r.score) for r in exact.orderBy("rank").collect()] == [(n + 1, i, -s) for n, (s, i) in enumerate(flat)]
    assert len(ranks(ann.search(frame, asked(frame, 50).limit(1))[0])[50]) == 5


def test_scaled_copies_tie_by_id(spark):
    base = np.array([0.3, -1.7, 2.2, 0.9])
    rows = [(i, [float(x) for x in base * 2.0 ** (i % 13 - 6)]) for i in range(30)] + [(100 + i, [1.0, float(i), -3.0, 0.5]) for i in range(40)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ranks(ann.search(frame, asked(frame, 29))[0])
    assert got[0] == [1, 2, 3, 4, 5] and got[29] == [0, 1, 2, 3, 4]


def test_ties_of_zero_queries_are_bounded(spark):
    rows = [(i, [0.0] * 4 if i < 3 else [float(i % 7), 1.0, -2.0, float(i)]) for i in range(2_000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    queries = asked(frame, 1).where("query_id < 3")
    assert ranks(exact_search.search(frame, queries)) == {0: [1, 2, 3, 4, 5], 1: [0, 2, 3, 4, 5], 2: [0, 1, 3, 4, 5]}
    exact = np.array([[math.floor(256 * x) for x in v] for _, v in rows], np.int64)
    grid = exact_search.Cells(exact.min(axis=0), np.maximum(1, -(-(np.ptp(exact, axis=0) + 1) // 64)))
    found = exact_search.top_k([0, 1], exact[:2], [[i] for i, _ in rows], grid.encode(exact), exact, grid, 5)
    assert len(found) == 10
