import random

from pulsegrid.llm import secrets
from tests.llm.test_bare_secrets import key, name


def test_short_embedded_and_touching_keys():
    rng = random.Random(6)
    model = secrets.fit([key(rng, 40) for _ in range(400)], [name(rng) for _ in range(4000)])
    found = dict.fromkeys(["short", "path", "touching"], 0)
    for _ in range(100):
        k = key(rng, 32)
        texts = {"short": f"see {k[:12]} here", "path": f"at {name(rng)}/{name(rng)}/{k}/{name(rng)}.{name(rng)} here", "touching": f"at /{'0a' * 16}/{k} here"}
        for kind, text in texts.items():
            value = k[:12] if kind == "short" else k
            start = text.index(value)
            found[kind] += any(s <= start and start + len(value) <= e for s, n, e in model.spans(text) if n == 3)
    assert min(found.values()) >= 95, found


def test_runs_and_spans_are_read_once():
    """What each run touches, as comparing all runs with all spans gives it; a long text of many runs takes no longer for each."""
    import random
    import re
    import time

    from pulsegrid.llm import secrets

    draw = random.Random(2)
    for _ in range(300):
        text = "".join(draw.choice("ab  ") for _ in range(60))
        runs = list(re.finditer("[ab]+", text))
        base = sorted((s, draw.randrange(3), s + draw.randrange(1, 20)) for s in draw.sample(range(60), 6))
        want = [(m.start(), m.end(), [b for b in base if b[0] < m.end() and b[2] > m.start()]) for m in runs]
        assert list(secrets._outside(runs, base)) == want
    line = "token = abcdefgh12345678 and ordinary_identifier_name " + "0123456789abcdef" * 2 + "\n"
    seconds = []
    for n in (500, 4_000):
        start = time.perf_counter()
        assert len(secrets.labelled_strings(line * n)[0]) == 2 * n
        seconds.append(time.perf_counter() - start)
    assert seconds[1] < 40 * seconds[0]
