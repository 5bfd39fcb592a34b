import zlib

from pulsegrid.llm import sharding
from tests.llm.helpers import AWKWARD, SF, clashing, docs


def check(rows, shards=24):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    assert all(0 <= s < shards for s in by)
    for members in by.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
    return by


def test_documents(spark):
    table = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    texts = {r.doc_id: r.text for r in table.collect()}
    rows = sharding.shard_documents(table).collect()
    assert len(rows) == len(texts)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
    by = check(rows)
    mean, largest = sum(r.size for r in rows) / 24, max(r.size for r in rows)
    assert all(abs(sum(r.size for r in members) - mean) <= largest for members in by.values())
    homes = {}
    for r in rows:
        homes.setdefault(texts[r.doc_id], set()).add(r.shard)
    groups = [h for t, h in homes.items() if sum(x == t for x in texts.values()) > 1]
    assert groups and sum(len(h) > 1 for h in groups) <= 0.1 * len(groups)


def test_hot_group_fills_shards(spark):
    rows = [(i, "one text that a third of all rows hold", "en", "a", 0) for i in range(2000)]
    rows += [(5000 + i, f"text number {i} " + "w" * (i % 60), "en", "a", 0) for i in range(4000)]
    got = sharding.shard_documents(docs(spark, rows), shards=8).collect()
    by = check(got, 8)
    sizes = [sum(r.size for r in m) for m in by.values()]
    assert len(by) == 8 and max(sizes) <= 1.03 * min(sizes)
    held = sorted((sum(r.doc_id < 5000 for r in m) for m in by.values()), reverse=True)
    assert sum(held[:4]) > 0.8 * 2000  # evenly spread, four of eight shards would hold half


def test_groups_only(spark):
    rows = [(i, f"group {i % 50} " + "x" * (i % 50), "en", "a", 0) for i in range(1000)]
    by = check(sharding.shard_documents(docs(spark, rows), shards=4).collect(), 4)
    sizes = [sum(r.size for r in m) for m in by.values()]
    assert max(sizes) <= 1.15 * min(sizes)


def test_awkward_rows(spark):
    got = sharding.shard_documents(clashing(docs(spark), "size", "shard", "slot", "law")).collect()
    assert len(got) == len(AWKWARD)
    check(got)
    assert {(r.doc_id, r.size, r.text_crc32) for r in got if r.doc_id in (1, 2)} == {(1, 8, 0), (2, 8, 0)}
    assert sharding.shard_documents(docs(spark, [])).count() == 0


def test_no_python_in_plans(spark):
    plan = sharding.shard_documents(docs(spark, AWKWARD))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
