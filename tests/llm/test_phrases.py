import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsegrid.llm import phrases
from tests.llm.helpers import AWKWARD, clashing, docs

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, covered=50, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) by counting every phrase of one to three words in the texts."""
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(SMALL)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            counts.update((lang, tuple(words[i : i + k])) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    found = {}
    for (lang, p), a in counts.items():
        if len(p) == 1 or a < least:
            continue
        longer = [x for (other, x), f in counts.items() if other == lang and len(x) == 3 and f >= least and p in (x[:2], x[1:]) and 100 * f >= covered * a]
        if len(p) == 2 and longer:
            continue
        cuts = []
        for k in range(1, len(p)):
            left, right = counts[lang, p[:k]], counts[lang, p[k:]]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((score, a, " ".join(p), left, right))
    out = []
    for lang, several in found.items():
        several.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i + 1, p, a, x, y, total[lang], score) for i, (score, a, p, x, y) in enumerate(several[:top])]
    return sorted(out)


def ours(spark, rows, **options):
    frame = spark.createDataFrame([(i, t, g, None, None) for i, (g, t) in enumerate(rows)], docs(spark, []).schema)
    return sorted(tuple(r) for r in phrases.collocations(frame, **options).collect())


def test_awkward_documents(spark):
    rows = [(r[2], r[1]) for r in AWKWARD if r[0] != 7]
    frame = clashing(docs(spark).where("doc_id IS NULL OR doc_id <> 7"), "phrase", "w1", "weight", "words", "t", "n")
    assert sorted(tuple(r) for r in phrases.collocations(frame, least=2).collect()) == brute(rows, 2)


def test_one_very_long_piece(spark):
    rows = [("en", "the quick brown fox jumps over the lazy dog and " * 3_000), ("en", "x" * 100_000)]
    got = ours(spark, rows)
    n = 30_001
    assert ("en", "brown fox jumps", 3_000, 3_000, 3_000, n, 1_000_000) in [(g, p, a, x, y, m, s) for g, _, p, a, x, y, m, s in got]
    assert len(got) == 10  # every inner triple once; all pairs lie within them


def test_no_rows_and_top(spark):
    assert ours(spark, []) == []
    rows = [("en", "a b c d. a b; b c d a b. é a b a b"), (None, "A b! a B"), ("en", None)] * 3
    assert ours(spark, rows, least=3) == brute(rows, 3)
    assert ours(spark, rows, least=3, top=2) == brute(rows, 3, top=2)


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, seed):
    import random

    draw = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(40))  # a long unary path
    rows = []
    for _ in range(60):
        words = [draw.choice("abcdeFG") + draw.choice(["", "", ",", "\t"]) for _ in range(draw.randrange(30))]
        if draw.random() < 0.4:
            words.insert(draw.randrange(len(words) + 1), passage)
        rows.append((draw.choice(["en", "de", None]), " ".join(words)))
    assert ours(spark, rows, least=4) == brute(rows, 4)


def test_compacted_paths_are_maximal(spark):
    text = "x a b c d e f g h. y a b c d e f g h; q c d e"
    frame = docs(spark, [(1, text, "en", "a", 1)] * 3)
    counted = phrases.edges(frame, least=3)
    nodes = phrases.pair_counts(counted, 3)
    heavy = counted.where((F.col("weight") >= 3) & F.col("w3").isNotNull())
    paths = sorted((" ".join(r.words), r.weight) for r in phrases.compacted(heavy, nodes).collect())
    # (c, d) and (d, e) have flow from the third piece or to its end; (a, b) has two edges in.
    assert paths == [("a b c d", 6), ("c d e", 9), ("d e f g h", 6), ("q c d", 3), ("x a b", 3), ("y a b", 3)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab ,\t\nÄ", max_size=20), max_size=6))
def test_brute_force_counts_overlaps(texts):
    """The reference itself: phrases overlap and never cross pieces."""
    for *_, phrase, a, _, _, n, _ in brute([("en", t) for t in texts], 1):
        assert a <= n and not set(phrase) & set(",\n")
