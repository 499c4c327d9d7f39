import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from framelark.llm import contamination as c


def slow_score(p, q):
    h = np.zeros((len(q) + 1, len(p) + 1), int)
    for i in range(1, len(q) + 1):
        for j in range(1, len(p) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if p[j - 1] == q[i - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return h.max() / (2 * len(q)) if len(q) else 0.0


def test_alignment_matches_the_table():
    rng = random.Random(0)
    for _ in range(400):
        p, q = rng.choices(range(5), k=rng.randrange(20)), rng.choices(range(5), k=rng.randrange(1, 12))
        score, s, e = c.align(p, q)
        assert abs(score - slow_score(p, q)) < 1e-9
        assert abs(slow_score(p[s:e], q) - score) < 1e-9


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(8)
    vocabulary = ["the", "of", "é"] * 20 + [f"v{i}" for i in range(500)]
    say = lambda n: rng.choices(vocabulary, k=n)
    items = [(i, say(rng.choice([3, 12, 25, 60]))) for i in range(25)]
    rows, truth = [], set()
    for i in range(200):
        words = say(rng.randrange(20, 200))
        if i % 4 == 0:
            item, text = items[rng.randrange(25)]
            copy = list(text)
            if i % 8 == 0 and len(copy) > 10:
                for _ in range(len(copy) // 10):
                    copy[rng.randrange(len(copy))] = "edited"
            at = rng.randrange(len(words))
            words[at:at] = copy
        rows.append((i, ", ".join(words).upper() if i % 3 else " ".join(words)))
    for d, t in rows:
        w = c.words_of(t.encode())
        for i, q in items:
            if slow_quick(w, [x.encode() for x in q]) >= c.MIN_SCORE:
                truth.add((d, i))
    return rows, [(i, " ".join(q)) for i, q in items], truth


def slow_quick(words, item):
    number = {w: k for k, w in enumerate(dict.fromkeys(item))}
    return c.align([number.get(w, -1) for w in words], [number[w] for w in item])[0]


def test_matches_every_document_against_every_item(spark, tables, monkeypatch):
    rows, items, truth = tables
    docs = spark.createDataFrame([(*r, "x", 0.1) for r in [*rows, (500, None), (501, ""), rows[4], (None, rows[4][1])]], "doc_id long, text string, item_id string, score double")
    bench = spark.createDataFrame([(*i, 5) for i in [*items, (90, None), (91, ""), items[0]]], "item_id long, text string, doc_id int")
    got = c.contaminated(docs, bench).collect()
    found = {(r.doc_id, r.item_id) for r in got if r.doc_id is not None}
    assert found == truth and len(found) > 40
    assert len(got) - sum(r.doc_id is None for r in got) == len(found)
    assert {r.item_id for r in got if r.doc_id is None} == {i for d, i in found if d == 4}
    kept = c.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({d for d, _ in [*rows, (500, 0), (501, 0)]} - {d for d, _ in found})
    monkeypatch.setattr(c, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(c, "PLACES", 7)
    assert {(r.doc_id, r.item_id) for r in c.contaminated(docs, bench).collect()} == {(r.doc_id, r.item_id) for r in got}


def test_empty_tables(spark, tables):
    none, rows = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame(tables[0], "doc_id long, text string")
    bench, empty = spark.createDataFrame(tables[1], "item_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert c.contaminated(none, bench).count() == 0 and c.contaminated(rows, empty).count() == 0
    assert c.drop_contaminated(rows, empty).count() == len(tables[0])


def test_a_shared_start_is_found_however_many_documents_hold_it(spark):
    item = [f"w{i}" for i in range(20)]
    rows = [(0, " ".join(item)), *((i, f"before{i} " + " ".join(item[:11]) + f" after{i}") for i in range(1, 31))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = c.contaminated(docs, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.score) for r in got) == [(0, 1.0), *((i, 0.55) for i in range(1, 31))]


def test_copies_without_a_run_of_four_words_are_found(spark):
    item = [f"w{i}" for i in range(24)]
    added = [w for i, x in enumerate(item) for w in ([x, f"new{i}"] if i % 3 == 2 else [x])]
    replaced = [f"new{i}" if i % 4 == 3 else x for i, x in enumerate(item)]
    left_out = [x for i, x in enumerate(item) if i % 3 != 2]
    spread = [w for i, x in enumerate(item) for w in (x, f"new{i}")]  # every second word: 0.5 and a little
    rows = [(i, " ".join(["at", "first", *t, "at", "last"])) for i, t in enumerate([added, replaced, left_out, spread])]
    items = [(1, " ".join(item)), (2, "two words")]
    docs = spark.createDataFrame([*rows, (9, "other words altogether")], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in c.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {(d, i): round(s, 6) for d, t in [*rows, (9, "other words altogether")] for i, q in items if (s := slow_score(t.split(), q.split())) >= c.MIN_SCORE}
    assert got == want and {d for d, _ in got} == {0, 1, 2, 3, 9}


def test_a_common_pair_costs_no_row(spark):
    """Items that all hold one pair, and a document that repeats it: seeds are rarer pairs, so nothing is joined."""
    items = spark.createDataFrame([(i, f"a{i} b{i} c{i} of the d{i} e{i} f{i}") for i in range(300)], "item_id long, text string").withColumn("item", F.xxhash64("item_id", "text"))
    docs = spark.createDataFrame([(1, "of the " * 3000), (2, "x a7 b7 c7 of the d7 y")], "doc_id long, text string")
    seeds, singles = c._seeds(items, docs, c.MIN_SCORE)
    common_pair = int(c._pairs(c.common.word_hashes([b"of", b"the"]))[0].view("int64")[0])
    assert not singles and seeds.filter(F.col("key") == common_pair).isEmpty() and seeds.select("item").distinct().count() == 300
    assert [(r.doc_id, r.item_id) for r in c.contaminated(docs, items).collect()] == [(2, 7)]


def test_seeds_are_enough(spark):
    """Every alignment of score enough has a seed in it: all items against edited copies, at several scores."""
    rng = random.Random(12)
    for score in (0.3, 0.5, 0.8, 1.0):
        items = [(i, rng.choices("a b c d e f g h the of".split(), k=rng.choice([1, 2, 3, 5, 9, 20]))) for i in range(30)]
        rows = []
        for i in range(60):
            t = list(rng.choice(items)[1])
            for _ in range(rng.randrange(4)):
                t.insert(rng.randrange(len(t) + 1), rng.choice("a b x y z".split()))
            rows.append((i, ["q"] * rng.randrange(3) + t))
        want = {(d, i) for d, w in rows for i, q in items if slow_score(w, q) >= score}
        docs = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
        bench = spark.createDataFrame([(i, " ".join(q)) for i, q in items], "item_id long, text string")
        assert {(r.doc_id, r.item_id) for r in c.contaminated(docs, bench, min_score=score).collect()} == want
