from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from pulsegrid.llm import language, mixing, secrets, toxicity
from pulsegrid.llm.queries import VOCABULARY
from tests.llm.helpers import AWKWARD, SF, docs
from tests.llm.test_similarity import kept


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Rows of every stage over the small documents."""
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_toxicity(spark, steps):
    before, after = steps[0], steps[1]
    assert after.columns == before.columns
    model = toxicity.train(before, spark.read.parquet(f"{SF}/labels.parquet"))
    count = model.gain_counter()
    want = {r.doc_id for r in before.collect() if not model.weights or model.scores(count(r.text))[0] < 0.7}
    assert {r.doc_id for r in after.collect()} == want


def test_near_copies(steps):
    before, after = steps[1].collect(), steps[2].collect()
    assert sorted(r.doc_id for r in after) == kept({r.doc_id: r.text for r in before})
    assert after[0].__fields__ == before[0].__fields__


def test_secrets(steps):
    before, after = {r.doc_id: r for r in steps[2].collect()}, {r.doc_id: r for r in steps[3].collect()}
    assert before.keys() == after.keys()
    model = secrets.train(steps[2])
    for i, r in after.items():
        assert not secrets.base_spans(r.text) and r.n_chars == len(r.text)
        if not model.spans(before[i].text):
            assert r.text == before[i].text


def test_mixing(steps):
    copies = Counter({r.doc_id: r.copies for r in mixing.mix_report(steps[3]).collect()})
    assert Counter(r.doc_id for r in steps[4].collect()) == +copies


def test_packing(steps):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    want = sum(len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in steps[4].collect())
    assert sum(r.length for r in steps[5].collect()) == want


def test_run_equals_its_stages(spark, steps):
    key = ["doc_id", "start", "length", "doc_tokens", "tokens"]
    rows = lambda f: Counter(map(tuple, f.select(*key).collect()))
    assert rows(corpus_pipeline.run(spark, SF)) == rows(steps[5])


OWN = ("size", "fp", "spans", "score", "_row", "_hash", "_scanned", "predicted", "_doc", "_id", "_w_id", "copies", "_u", "keys", "n")


@pytest.mark.parametrize("rows", [AWKWARD, []])
def test_awkward_tables_pass_every_stage(spark, tmp_path, rows):
    """Own columns of any name come out of every stage with their values."""
    frame = docs(spark, rows)
    frame = frame.select("*", *[F.concat_ws("|", F.lit(n), F.coalesce("doc_id", F.lit(-1)), F.xxhash64("text")).alias(n) for n in OWN])
    text_hash = {r.doc_id: r.h for r in frame.select("doc_id", F.xxhash64("text").alias("h")).collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frame, SF).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == frame.columns
            for r in after.collect():
                own = -1 if r.doc_id is None else r.doc_id
                assert all(r[n] == f"{n}|{own}|{text_hash[r.doc_id]}" for n in OWN)
        frame = after


@pytest.mark.parametrize("parts", [1, 3, 5])
def test_of_rows_of_one_id_and_text_the_least_stays(spark, parts):
    rows = [(1, "the same five words again and again", "en", source, 5) for source in "zyx"]
    frame = docs(spark, rows).repartition(parts, "source")
    assert [r.source for r in corpus_pipeline.drop_near_copies(spark, frame, SF).collect()] == ["x"]


def test_the_session_stays_as_it_was(spark):
    settings = lambda: {k: v for k, v in spark.conf.getAll.items() if "arrow" in k}
    before = settings()
    corpus_pipeline.run(spark, SF).count()
    language.identify(docs(spark), language.profiles(docs(spark))).count()
    assert settings() == before
