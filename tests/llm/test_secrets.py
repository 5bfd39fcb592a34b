import hashlib
import re

from hypothesis import given
from hypothesis import strategies as st

from pulsegrid.llm import secrets
from pulsegrid.llm.queries import op7_markov_secrets
from tests.llm.helpers import AWKWARD, SF, clashing, docs

SPELT = {
    "assign": (re.compile(r"""(?a:(?i:(password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
}


def spelt(text):
    found = [(m.start(), i, m.end()) for i, (p, ok) in enumerate(SPELT.values()) for m in p.finditer(text) if ok(m)]
    return sorted(found)


PARTS = st.sampled_from(["token", "SECRET", "api_key", "APIKEY", "paſſwd", "passwd", "=", ":", " ", "\t", "'", '"', "AKIA", "ABCDEFGH1234", "0123456789abcdef" * 2, "abc", "-", "é", "\n", "x" * 9])


@given(st.lists(PARTS, max_size=12).map("".join))
def test_base_spans(text):
    assert secrets.base_spans(text) == spelt(text)


def test_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op7_markov_secrets(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = spelt(texts[r.doc_id])
        named = [f"{list(SPELT)[k]}:{s}:{e}" for s, k, e in base]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in base) for i in range(3))
        assert r.base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert [x for x in r.spans.split(",") if x and not x.startswith("markov")] == named


def test_models_tell_random_strings_from_identifiers(spark):
    import random
    import string

    rng = random.Random(3)
    chars = string.ascii_letters + string.digits + "+/"
    words = "report value stream window batch record number total index shard table token merge level state count".split()
    make = lambda n: "".join(rng.choice(chars) for _ in range(n))
    name = lambda: "_".join(rng.choice(words) for _ in range(5))
    model = secrets.fit([make(40) for _ in range(400)], [name() for _ in range(2000)])
    caught = [bool(model.spans(f"see {make(32)} here")) for _ in range(200)]
    wrong = [bool(model.spans(f"see {name()} here")) for _ in range(200)]
    assert sum(caught) > 190 and sum(wrong) < 4
    text = "a " + make(32) + " b token = " + make(24)
    assert [secrets.KINDS[k] for _, k, _ in model.spans(text)] == ["markov", "assign"]


def test_awkward_rows(spark):
    rows = [*AWKWARD, (20, "token=" + "a1B2c3D4e5F6" * 3 + " end", "en", "b", 0)]
    frame = clashing(docs(spark, rows), "spans", "n_hex")
    model = secrets.train(frame)
    found = {r.doc_id: r.spans for r in secrets.scan(frame, model, keep=["doc_id"]).collect()}
    assert len(found) == 12 and found[1] == [] and [s.kind for s in found[20]] == ["assign"]
    clean = secrets.redact(frame, model)
    assert clean.columns == frame.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[20] == "[SECRET] end" and texts[1] is None and texts[2] == "" and texts[7] == dict((r[0], r[1]) for r in rows)[7]
    empty = docs(spark, [])
    assert secrets.scan(empty, secrets.train(empty)).count() == 0


def test_overlapping_spans_become_one_mark(spark):
    text = "x token = " + "0a" * 20 + " y"
    model = secrets.fit([], [])
    row = secrets.redact(docs(spark, [(1, text, "en", "a", 0)]), model).first()
    assert row.text == "x [SECRET] y"
