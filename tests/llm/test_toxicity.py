from pulsegrid.llm import toxicity
from pulsegrid.llm.common import may_learn
from pulsegrid.llm.queries import op10_compression_toxicity
from tests.llm.helpers import AWKWARD, SF, clashing, docs


def test_held_out_accuracy(spark):
    sf = SF.replace("sf0.001", "sf0.1")
    rows = op10_compression_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    toxic, clean = [r.predicted for r in rows if r.toxic == 1], [r.predicted for r in rows if r.toxic == 0]
    assert len(toxic) > 30 and sum(toxic) / len(toxic) > 0.65
    assert sum(clean) / len(clean) < 0.03
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_windows_cover_the_whole_text():
    text = "Ab, cd é " * 40
    plain = toxicity.plain(text).encode()
    found = toxicity.windows(text)
    step = toxicity.STRIDE
    assert b"".join(w[:step] for w in found[:-1]) + found[-1] == plain
    assert toxicity.windows("") == [b"  "]


def varied(n, seed, insults=()):
    """Texts of random words, with insults in random places."""
    import random

    rng = random.Random(seed)
    words = ["".join(rng.choice("abdeglnorstu") for _ in range(rng.randrange(2, 7))) for _ in range(60)]
    out = []
    for _ in range(n):
        text = [rng.choice(words) for _ in range(60)]
        for _ in range(6 if insults else 0):
            text.insert(rng.randrange(len(text)), rng.choice(insults))
        out.append(" ".join(text))
    return out


def test_telling_passages_ignore_copies():
    toxic = [*varied(100, 1, ["gronkwit", "snarfle"]), *["copied nonsense words here"] * 500]
    found = toxicity.telling_passages(toxic, varied(150, 1))
    assert any("gronkwit" in p for p in found) and any("snarfle" in p for p in found) and not any("nonse" in p for p in found)


def test_awkward_rows(spark):
    good, bad = varied(200, 5), varied(200, 5, ["gronkwit", "snarfle"])
    rows = [(100 + i, bad[i] if i % 2 else good[i], "en", "a", 0) for i in range(200)]
    labels = spark.createDataFrame([(100 + i, i % 2) for i in range(200)] + [(None, 1), (2, None), (101, 1), (101, 0)], "doc_id long, toxic int")
    frame = clashing(docs(spark, [*AWKWARD, *rows]), "score", "predicted")
    model = toxicity.train(frame, labels)
    out = toxicity.score(frame, model)
    assert sorted(out.columns) == sorted(frame.columns)
    got = out.collect()
    assert len(got) == len(AWKWARD) + 200
    by = {r.doc_id: r.predicted for r in got}
    assert sum(by[100 + i] == i % 2 for i in range(200)) > 190 and by[1] == by[2] == by[7] == 0
    nothing = toxicity.train(frame, labels.where("toxic = 0"))
    assert {r.score for r in toxicity.score(frame, nothing).collect()} == {0.0}
    assert toxicity.score(docs(spark, []), model).count() == 0


def test_learning_rows(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    from pyspark.sql import functions as F

    assert 0 < labels.where(may_learn(F.col("doc_id"))).count() < labels.count()
