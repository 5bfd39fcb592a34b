from collections import Counter

from pyspark.sql import functions as F

from pulsegrid.llm import language
from pulsegrid.llm.common import is_held_out, may_learn
from pulsegrid.llm.queries import op1_language
from tests.llm.helpers import AWKWARD, SF, clashing, docs


def grams(text):
    """n-grams of the lower-case letter runs, blanks around them, most frequent first."""
    words = "".join(c.lower()[0] if c.isalpha() else " " for c in text).split()
    count = Counter()
    for w in words:
        padded = f" {w} "
        count.update(w)
        count.update(padded[i : i + 2] for i in range(len(padded) - 1))
        count.update(padded[i : i + 3] for i in range(len(padded) - 2))
    return count


def ordered(count, k):
    return sorted(count, key=lambda g: (-count[g], len(g), g))[:k]


def unpack(packed):
    return "".join(chr(packed >> s & 0x1FFFFF) for s in (42, 21, 0) if packed >> s & 0x1FFFFF)


def test_profiles_and_distances_against_brute_force(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").limit(80)
    rows = table.collect()
    learned = language.profiles(table, grams=50)
    want = {}
    for lang in sorted({r.lang for r in rows}):
        total = Counter()
        for r in rows:
            if r.lang == lang:
                total.update(grams(r.text))
        want[lang] = ordered(total, 50)
    assert {k: [unpack(int(g)) for g in v] for k, v in learned.items()} == want
    for r in language.identify(table, learned, grams=50).collect():
        mine = ordered(grams(r.text), 50)
        near = {}
        for lang, profile in want.items():
            place = {g: i for i, g in enumerate(profile)}
            near[lang] = 1 - sum(abs(place[g] - i) if g in place else 50 for i, g in enumerate(mine)) / (50 * len(mine))
        assert r.lang_pred == max(sorted(near), key=lambda k: near[k])
        assert abs(r.score - max(near.values())) < 1e-12


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    rows = op1_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 200 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_long_texts_are_counted_whole(monkeypatch):
    from pulsegrid.llm import common

    text = "ein Satz mit Wörtern, the other words " * 50
    letters = language._Letters()
    whole = language.gram_counts([text, "ab"], letters)
    monkeypatch.setattr(language, "pieces", lambda t: common.pieces(t, 64))
    cut = language.gram_counts([text, "ab"], letters)
    assert all((a == b).all() for a, b in zip(whole, cut, strict=True))


def test_awkward_rows(spark):
    frame = clashing(docs(spark), "lang_pred", "score", "margin")
    learned = language.profiles(frame)
    assert set(learned) == {"en", "de"}
    rows = {r.doc_id: r for r in language.identify(frame, learned).collect()}
    assert {i: rows[i].lang_pred for i in (1, 2, 3, 4)} == dict.fromkeys((1, 2, 3, 4), "und")
    assert rows[7].lang_pred == "en" and rows[9].lang_pred == "de" and rows[1].score == 0
    assert language.identify(frame, learned).count() == len(AWKWARD)
    assert language.identify(docs(spark, []), learned).count() == 0
    assert language.profiles(docs(spark, [])) == {}
    assert {r.lang_pred for r in language.identify(frame, {}).collect()} == {"und"}


def test_who_may_be_learned_from(spark):
    import zlib

    rows = spark.range(200).select(F.col("id"), is_held_out(F.col("id")).alias("h"), may_learn(F.col("id")).alias("m")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) and r.m != r.h for r in rows)
    null = spark.sql("select cast(null as bigint) id").select(is_held_out(F.col("id")), may_learn(F.col("id"))).first()
    assert null == (False, False)
