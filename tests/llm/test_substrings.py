import hashlib
import random
import re

import numpy as np

from framelark.llm import substrings


def slow(rows, k):
    docs = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in docs:
        for p in range(len(w) - k + 1):
            if i is not None:
                key = tuple(w[p : p + k])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in docs:
        gone = set()
        for p in range(len(w) - k + 1):
            if i is not None and first[tuple(w[p : p + k])] < i:
                gone |= set(range(p, p + k))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def corpus(n, k, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" for i in range(40)]
    passages = [rng.choices(vocabulary, k=rng.choice([k - 1, k, k + 1, 3 * k])) for _ in range(6)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(6)):
            words += rng.choice(passages) if rng.random() < 0.5 else rng.choices(vocabulary, k=rng.randrange(k))
        rows.append((i * 3 - 20, rng.choice([" ", "\n", "  "]).join(words)))
    rows += [(5000, "a " * 200), (5001, "a " * 60), (None, rows[3][1]), (None, "b " * 80), (5002, None), (5003, ""), (5004, "b " * 80), (rows[7][0], rows[7][1])]
    rng.shuffle(rows)
    return rows


def test_matches_brute_force(spark):
    for k, seed in ((50, 1), (4, 2), (12, 3)):
        rows = corpus(60, k, seed)
        docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, pos int, anchors string")
        got = substrings.remove_repeated(docs, k).collect()
        key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
        assert sorted(map(lambda r: tuple(r)[:4], got), key=key) == sorted(slow(rows, k), key=key)
        assert any(r.n_removed for r in got)
        assert k == 50 or sorted(map(tuple, substrings.remove_repeated(docs, k, hub_rows=3).collect()), key=repr) == sorted(map(tuple, got), key=repr)
        for r in got:
            assert sum(s.end - s.start for s in r.removed) == r.n_removed
            assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256


def test_rows_repeating_an_id(spark):
    long = " ".join(f"x{i}" for i in range(60))
    rows = [(1, long), (1, long), (1, long + " y"), (2, "z " + long), (2, "none")]
    got = substrings.remove_repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in got) == [(1, 60, 0), (1, 60, 0), (1, 61, 0), (2, 1, 0), (2, 61, 60)]


def test_windows_of_a_text_are_one_row():
    rng = np.random.default_rng(1)
    h, g, pos = rng.integers(0, 4, 300), rng.integers(0, 3, 300), rng.permutation(300)
    a, b, sizes, places = substrings._grouped(h, g, pos)
    assert len(set(zip(a, b, strict=True))) == len(a) and sizes.sum() == 300
    for x, y, part in zip(a, b, np.split(places, np.cumsum(sizes)[:-1]), strict=True):
        assert part.tolist() == sorted(pos[(h == x) & (g == y)])


def test_empty_table(spark):
    assert substrings.remove_repeated(spark.createDataFrame([], "doc_id long, text string")).count() == 0
