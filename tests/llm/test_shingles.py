import random

import corpus_pipeline
import numpy as np
import pytest
from test_simhash import slow_fingerprint

from framelark.llm import shingles as s


def slow_set(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def slow_jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def slow_kept(rows):
    """Ids that stay: the smallest of each component over pairs of similarity 0.8 or more."""
    sets, root = [slow_set(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if slow_jaccard(sets[i], sets[j]) >= 0.8 and root[i] != root[j]:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    return sorted(rows[i][0] for i in {min(range(len(rows)), key=lambda k: (root[k] != r, rows[k][0])) for r in root})


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = [rng.choices(vocabulary, k=rng.randrange(50, 300)) for _ in range(30)]
    for k in range(150):  # edited copies, also of copies, about the limit
        t = list(texts[0 if k < 60 else rng.randrange(len(texts))])
        for _ in range(rng.randrange(1, 6)):
            t[rng.randrange(len(t))] = rng.choice(vocabulary)
        texts.append(t)
    texts += [[], ["one"], ["one"], ["one", "two", "three"], []]
    rng.shuffle(texts)
    return [(i, " ".join(t).title() if i % 3 else " ".join(t)) for i, t in enumerate(texts)]


def test_matches_all_pairs(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = slow_kept(rows)
    assert 20 < len(want) < 150
    assert sorted(r.doc_id for r in s.keep_one(docs).collect()) == want
    assert sorted(r.doc_id for r in s.keep_one(docs, group_shingles=900).collect()) == want  # groups in parts


def test_links_equal_those_of_all_pairs(rows):
    sets = [s.shingles(t.encode()) for _, t in rows]
    assert len(set(s.linked(sets).tolist())) == len(slow_kept(rows))
    assert all(len(x) == len(slow_set(t)) for x, (_, t) in zip(sets, rows, strict=True))


def test_bands_meet_as_often_as_they_should():
    rng = np.random.default_rng(1)
    met = []
    for _ in range(400):
        x = rng.integers(0, 1 << 63, 180, dtype=np.uint64)
        met.append((s.bands(np.unique(x[:150])) == s.bands(np.unique(x[30:]))).mean())  # 120 of 180
    assert abs(np.mean(met) - (120 / 180) ** s.ROWS) < 0.02


def test_stage_drops_edited_copies(spark):
    """A pair of similarity 0.8 or more whose fingerprints lie more than two bits apart."""
    rng = random.Random(2)
    a = [f"w{rng.randrange(2000)}" for _ in range(120)]
    b = [*a[:50], "edited", *a[51:90], "again", *a[91:]]
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(a[:60] + b[::-1][:60]))]
    assert slow_jaccard(slow_set(rows[0][1]), slow_set(rows[1][1])) >= 0.8
    assert bin((slow_fingerprint(rows[0][1]) ^ slow_fingerprint(rows[1][1])) & (1 << 64) - 1).count("1") > 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, None).collect()) == [1, 3]


def test_odd_rows(spark):
    rows = [(None, "a b c d e", 1), (None, "a b c d e", 2), (4, "p q r s", 3), (4, "p q r s", 4), (4, "other words altogether", 5), (5, None, 6), (6, "", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, root long")
    got = s.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in got.collect()) == [(0, "a b c d e"), (4, "other words altogether"), (4, "p q r s"), (5, "")]
    assert s.keep_one(docs.filter("false")).count() == 0


def test_near_fingerprints_meet_without_a_common_band(spark):
    """Fingerprints within two bits make candidates through the grids, also over a third and where texts share one."""
    marked = spark.createDataFrame([(n, [100 + n]) for n in range(1, 8)], "node long, bands array<bigint>")
    prints = spark.createDataFrame([(1, 0), (2, 3), (3, 15), (4, 1 << 40), (5, 1 << 40), (6, -1), (7, 0x7777 << 20)], "node long, fp long")
    got = sorted((r.root, r.node) for r in s._candidates(marked, prints).collect())
    assert got == [(1, 1), (1, 2), (1, 3), (1, 4), (1, 5)]


def test_fingerprints_of_the_stage_are_those_of_simhash(spark, rows):
    docs = spark.createDataFrame(rows, "id long, text string")
    got = {r.id: r.fp for r in docs.mapInArrow(s._signatures, "id long, node bigint, fp bigint, bands array<bigint>").collect()}
    assert all(got[i] % (1 << 64) == slow_fingerprint(t) % (1 << 64) for i, t in rows)
