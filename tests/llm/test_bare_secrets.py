import random
import string

from pulsegrid.llm import secrets

CHARS = string.ascii_letters + string.digits
WORDS = "report value stream window batch record number total index shard table token merge level state count".split()


def key(rng, n):
    return "".join(rng.choice(CHARS) for _ in range(n))


def name(rng):
    return "_".join(rng.choice(WORDS) for _ in range(5))


def test_bare_keys_among_ordinary_strings_do_not_hide_keys():
    rng = random.Random(5)
    ordinary = [name(rng) for _ in range(4000)] + [key(rng, 40) for _ in range(200)]
    rng.shuffle(ordinary)
    model = secrets.fit([key(rng, 40) for _ in range(400)], ordinary)
    assert sum(bool(model.spans(f"see {key(rng, 40)} here")) for _ in range(200)) > 190
    assert sum(bool(model.spans(f"see {name(rng)} here")) for _ in range(200)) < 4
