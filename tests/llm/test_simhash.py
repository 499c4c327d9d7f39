import random
import re

import numpy as np
import pytest
import xxhash

from framelark.llm import simhash
from framelark.llm.components import components

WORDS = [f"w{i}" for i in range(300)]


def slow_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(rows):
    """Smallest id by id, comparing every pair."""
    best = {i: i for i, _ in rows}
    changed = True
    while changed:
        changed = False
        for i, a in rows:
            for j, b in rows:
                if (a ^ b).bit_count() <= 2 and best[j] < best[i]:
                    best[i], changed = best[j], True
    return best


def corpus(n, seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        if texts and rng.random() < 0.6:
            words = rng.choice(texts).split(" ")
            if rng.random() < 0.7:
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            texts.append(" ".join(words))
        else:
            texts.append(" ".join(rng.choices(WORDS, k=rng.choice([1, 2, 40, 150, 300]))))
    return texts


def test_matches_all_pairs(spark):
    texts = [*corpus(120, 1), None, "", " \n\t", "Ab cD", "AB CD", "é " * 9]
    rows = [(i * 7 + 3, t, "x", "y") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, root string")
    want_fp = {i: slow_fingerprint(t) for i, t, *_ in rows}
    want = classes(list(want_fp.items()))
    got = simhash.near_duplicates(docs).collect()
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{f:016x}" for i, f in want_fp.items()}
    assert {r.doc_id: r.component_id for r in got} == want
    assert len(got) == len(rows) and len(set(want.values())) < len(rows)


@pytest.mark.parametrize("cell_rows", [2, 5, 4096])
def test_links_of_dense_fingerprints(spark, cell_rows):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(4)]
    values = {b for b in base}
    for b in base:
        for _ in range(60):
            v = b
            for bit in rng.sample(range(64), rng.choice([1, 2, 3, 4])):
                v ^= 1 << bit
            values.add(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = {r.node: r.root for r in components(simhash.links(frame, cell_rows=cell_rows)).collect()}
    want = classes([(v, v & (2**64 - 1)) for v in signed])
    assert {v: roots.get(v, v) for v in signed} == want


def test_manhattan_is_a_lower_bound():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**64, 5000, dtype=np.uint64)
    b = a ^ (np.uint64(1) << rng.integers(0, 64, 5000, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 5000, dtype=np.uint64))
    got = simhash.manhattan(simhash._packed_counts(a), simhash._packed_counts(b))
    count = lambda x: [sum(((int(v) >> (2 * s)) & 3).bit_count() for _ in (0,)) for v in x for s in range(32)]
    want = np.abs(np.array(count(a)) - np.array(count(b))).reshape(5000, 32).sum(axis=1)
    assert (got == want).all() and (got <= np.bitwise_count(a ^ b)).all()


def test_empty_null_and_repeated(spark):
    schema = "doc_id long, text string"
    assert simhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b c d"), (None, "a b c d"), (5, "q r s"), (5, "q r s"), (9, None)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.component_id) for r in got if r.doc_id is not None) == [(False, 5, 5), (False, 5, 5), (False, 9, 9)]
    assert [r.component_id for r in got if r.doc_id is None] == [None, None]


@pytest.mark.parametrize("hub_rows", [3, 100_000])
def test_components_with_hubs(spark, hub_rows):
    rng = random.Random(6)
    links = [(0, i) for i in range(1, 80)] + [(200 + i, 300) for i in range(40)] + [(400 + i, 401 + i) for i in range(30)] + [(5, 5), (7, None), (300, 199)]
    links += [(rng.randrange(500, 540), rng.randrange(500, 540)) for _ in range(25)]
    root = {n: n for link in links if None not in link for n in link}
    for _ in root:
        for a, b in links:
            if b is not None:
                root[a] = root[b] = min(root[a], root[b])
    got = components(spark.createDataFrame(links, "a long, b long"), hub_rows)
    assert {r["node"]: r["root"] for r in got.collect()} == {n: r for n, r in root.items() if n != r}
