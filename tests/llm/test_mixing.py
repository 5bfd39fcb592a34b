import re
from collections import defaultdict

from pulsegrid.llm import mixing
from tests.llm.helpers import AWKWARD, SF, clashing, docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights=(5, 2, 1), most=3):
    """Shares by weight, cut at `most` times the size, the excess shared out again until nothing is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
        full = {s for s in open_ if share[s] > most * sizes[s]}
        if not full:
            return out | share
        for s in full:
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ -= full
    return out


def check(rows, sources, tolerance):
    sizes = defaultdict(int)
    for r in rows:
        sizes[sources(r)] += r.size
    want, taken, largest = targets(dict(sizes)), defaultdict(int), defaultdict(int)
    for r in rows:
        s = sources(r)
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 * max(1, want[s])
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(tolerance * want[s], largest[s])


def test_documents(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.mix_report(table).collect()
    texts = {r.doc_id: r.text for r in table.collect()}
    assert len(rows) == len(texts)
    assert all(r.size == len(WORD.findall(texts[r.doc_id])) for r in rows)
    check(rows, lambda r: r.source, 0.0)
    again = mixing.mix_report(table.repartition(7)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_hot_source_and_small_ones(spark):
    rows = [(i, "w " * (1 + i % 90), "en", "hot", 0) for i in range(3000)] + [(9000 + i, "v " * 5, "en", s, 0) for i, s in enumerate(["A", "z", "é", None, ""] * 3)]
    check(mixing.mix_report(docs(spark, rows)).collect(), lambda r: r.source, 0.0)


def test_longer_documents_are_taken_more_often(spark):
    rows = [(i, "w " * (3 if i % 2 else 700), "en", s, 0) for i in range(4000) for s in ("a" if i % 4 < 2 else "b",)]
    got = mixing.mix_report(docs(spark, rows)).collect()
    often = {size: sum(r.taken for r in got if r.size == size and r.source == "b") / sum(r.size for r in got if r.size == size and r.source == "b") for size in (3, 700)}
    assert 0 < often[3] < often[700]


def test_awkward_rows(spark):
    frame = clashing(docs(spark), "size", "target", "taken", "copies", "source_size")
    rows = mixing.mix_report(frame).collect()
    assert len(rows) == len(AWKWARD)
    assert {r.doc_id: r.size for r in rows if r.doc_id in (1, 2, 3)} == {1: 0, 2: 0, 3: 0}
    mixed = mixing.mix_documents(frame)
    assert mixed.columns == frame.columns
    assert mixing.mix_report(docs(spark, [])).count() == 0
    assert mixing.mix_report(docs(spark, [(1, None, None, "a", None)])).first().taken == 0


def test_mix_itself_matches_the_report(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    copies = {r.doc_id: r.copies for r in mixing.mix_report(table).collect()}
    counts = {r.doc_id: r["count"] for r in mixing.mix_documents(table).groupBy("doc_id").count().collect()}
    assert counts == {k: v for k, v in copies.items() if v}


def test_equal_rows_are_drawn_one_by_one(spark, monkeypatch):
    """A source of one document many times over comes near its target, in the report and in the mix."""
    monkeypatch.setattr(mixing, "_NUMBERS", 64)
    rows = [(1, "four words are here", "en", "a", 0)] * 1000 + [(i, "v " * 4, "en", s, 0) for i in range(1000) for s in "bc"]
    frame = docs(spark, rows)
    got = mixing.mix_report(frame).collect()
    check(got, lambda r: r.source, 0.0)
    taken = sum(r.taken for r in got if r.source == "a")
    assert abs(taken - next(r.target for r in got if r.source == "a")) <= 4
    mixed = mixing.mix_documents(frame)
    assert mixed.where("source = 'a'").count() * 4 == taken
    other = mixing.mix_documents(frame.repartition(5)).groupBy("source", "doc_id").count().collect()
    assert sorted(other) == sorted(mixed.groupBy("source", "doc_id").count().collect())


def test_rows_of_one_text_with_other_columns(spark):
    rows = [(1, "same text", lang, "a", n) for lang in ("en", "de") for n in range(50) for _ in range(3)] + [(2, "w " * 900, "en", "b", 0)]
    frame = docs(spark, rows)
    copies = sum(r.copies for r in mixing.mix_report(frame).collect() if r.doc_id == 1)
    assert mixing.mix_documents(frame).where("doc_id = 1").count() == copies
