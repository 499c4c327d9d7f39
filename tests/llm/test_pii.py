import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from framelark.llm import pii
from framelark.llm.crf_tagger import TAGS, Tagger, char_ids

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
FILLER = ["the onat erea of", "ndwh and thing is", "élle que des ouaux", "Inea re. Haou in"]


def slow_spans(t):
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(t)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(t):
        d = [int(c) for c in m[0] if c.isdigit()]
        s = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d)))
        if 13 <= len(d) <= 19 and s % 10 == 0:
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(t) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def test_patterns_match_the_plain_expressions():
    rng = random.Random(2)
    bits = ["a", "b.c", "@", "@x.y", "1", "23", ".", "..", "-", " ", "+1 ", "(743) ", "555", "4111111111111111", "4111-1111 1111-1111", "1.2.3.4", "256.1.1.1", "0001.2.3.4", "é", "%", "\n", "٣"]
    for _ in range(20_000):
        t = "".join(rng.choices(bits, k=rng.randrange(14)))
        assert pii.base_spans(t) == slow_spans(t), repr(t)
    assert pii.base_spans("1" * 200_000 + "a" * 200_000) == []


@pytest.fixture(scope="module")
def tagger():
    t = Tagger.fresh()
    t.fit(*pii.examples(FILLER * 20, 1500))
    return t


def test_gradient(monkeypatch):
    t = Tagger.fresh(hidden=3, embed=2, seed=1)
    t.w = {k: v.astype(np.float64) for k, v in t.w.items()}
    rng = np.random.default_rng(0)
    ids, gold = rng.integers(0, 129, (3, 6)), np.array([[0, 1, 2, 2, 0, 3], [3, 4, 0, 0, 0, 0], [0, 0, 5, 6, 6, 0]])
    _, grad = t.gradient(ids, gold)
    for k, g in grad.items():
        flat = t.w[k].reshape(-1)
        for i in rng.choice(len(flat), min(6, len(flat)), replace=False):
            old, step = flat[i], 1e-3
            flat[i] = old + step
            up = t.gradient(ids, gold)[0]
            flat[i] = old - step
            down = t.gradient(ids, gold)[0]
            flat[i] = old
            assert abs((up - down) / (2 * step) - g.reshape(-1)[i]) < 2e-3, k


def test_decode_is_the_best_path():
    t = Tagger.fresh(seed=3)
    em = np.random.default_rng(1).standard_normal((4, 2, len(TAGS))).astype(np.float32)
    move = np.zeros((len(TAGS),) * 2)
    for i, j in itertools.product(range(len(TAGS)), repeat=2):
        if TAGS[j][0] == "I" and TAGS[i][1:] != TAGS[j][1:]:
            move[i, j] = -1e4
    for w in range(2):
        score = lambda p: sum(em[i, w, x] for i, x in enumerate(p)) + sum(move[a, b] for a, b in zip(p, p[1:], strict=False)) - 1e4 * (TAGS[p[0]][0] == "I")  # noqa: B023, E731
        assert tuple(t.decode(em)[w]) == max(itertools.product(range(len(TAGS)), repeat=4), key=score)


def test_held_out_accuracy(tagger):
    ids, gold = pii.examples(["whth onereat ble. Than", "ouierre le éaux, dans"] * 9, 300, seed=77)
    tags = tagger.decode(tagger.emissions(ids))
    right = ((tags == gold) & (gold > 0)).sum()
    assert right > 0.8 * (gold > 0).sum() and right > 0.8 * (tags > 0).sum()


def test_windows_cover_every_trigger():
    rng = random.Random(4)
    for _ in range(300):
        t = "".join(rng.choice("ab 1@") if rng.random() < 0.1 else "x" for _ in range(rng.randrange(900)))
        starts = pii.window_starts(t)
        for i, c in enumerate(t):
            if c in "1@":
                # A span of up to half a window around the trigger lies whole in some window.
                for a in range(max(0, i - 20), i + 1):
                    z = min(len(t), a + 28)
                    assert any(s <= a and z <= s + pii.WINDOW for s in starts)


def test_reconcile_takes_the_best_set():
    rng = random.Random(6)
    for _ in range(200):
        spans = []
        for _ in range(rng.randrange(7)):
            a = rng.randrange(12)
            spans.append((a, a + rng.randrange(1, 6), rng.random(), rng.choice(["ip", "card"])))
        free = lambda s: all(x[1] <= y[0] or y[1] <= x[0] for x, y in itertools.combinations(s, 2))
        sets = [s for k in range(len(spans) + 1) for s in itertools.combinations(spans, k) if free(s)]
        got = pii.reconcile(spans)
        assert free(got) and abs(sum(s[2] for s in got) - max(sum(x[2] for x in s) for s in sets)) < 1e-9


def test_spans_beyond_a_window_are_put_together():
    sure = lambda n, x: np.full(n, x, np.float32)
    pieces = [(5, 64, "email", sure(59, 0.9), False, True), (32, 96, "email", sure(64, 0.8), True, True), (64, 100, "email", sure(36, 1.0), True, False),
              (40, 64, "card", sure(24, 1.0), False, True), (70, 80, "card", sure(10, 1.0), True, False)]
    [(a, z, kind, values)] = pii.stitched(pieces)  # the parts of the card do not touch
    assert (a, z, kind, len(values)) == (5, 100, "email", 95)
    assert abs(values.sum() - (59 * 0.9 + 36)) < 1e-3
    assert pii.stitched([(32, 60, "ip", sure(28, 1.0), True, False)]) == []


def test_long_spaced_addresses(tagger):
    rng, found = np.random.default_rng(9), {}
    for names in (4, 8):  # within a window, and mostly beyond one, where the small tagger of these tests finds few
        for _ in range(30):
            address = ".".join(pii._name(rng) for _ in range(names)) + " @ " + pii._name(rng) + ".com"
            (base, added), = pii.all_spans(tagger, [f"the onat erea of {address} and thing is"])
            found[names] = found.get(names, 0) + (("email", 17, 17 + len(address)) in added)
    assert found[4] >= 20 and found[8] >= 1, found


def test_query_rows(spark, tagger, monkeypatch):
    rows = [(1, "mail a.b@c-d.example.com now 10.0.0.1", 0), (2, None, 0), (3, "", 0), (None, "card 4111 1111 1111 1111.", 0), (1, "mail a.b@c-d.example.com now 10.0.0.1", 0),
            (4, "x " * 100_000 + "+1 (743) 555-3824 é 4111111111111111", 0), (5, "call (743) 555-3824 for that onat", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    got = pii.find_personal_data(docs, tagger).collect()
    assert len(got) == len(rows)
    texts = {i: t or "" for i, t, _ in rows}
    for r in got:
        base = slow_spans(texts[r.doc_id])
        line = ",".join(f"{k}:{a}:{z}" for k, a, z in base)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in ("email", "ip", "card", "phone")]
        assert set(line.split(",")) - {""} <= set(r.spans.split(","))
    assert pii.find_personal_data(spark.createDataFrame([], "doc_id long, text string"), tagger).count() == 0
    monkeypatch.setattr(pii, "EXAMPLES", 64)
    weights = [pii.train(docs, sample_rows=3).w["o"] for _ in range(2)]
    assert np.array_equal(*weights)
    assert pii.train(spark.createDataFrame([], "doc_id long, text string"), sample_rows=3).w


def test_ids_are_code_points():
    assert char_ids("aé😀\n").tolist() == [97, 128, 128, 10]
