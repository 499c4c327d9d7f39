import random
import re

import numpy as np
import pytest

from framelark.llm import boosting, quality


def slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(again)


def sentences(rng, n, junk):
    vocabulary = ["onat", "thé", "ereing", "of", "a", "ndwh", "ouier", "x1"] + [f"w{i}" for i in range(400)]
    if junk:
        vocabulary = ["buy###", "NOW$$$", "win%%%", "|"]
    return rng.choice([" ", "\n", "  "]).join(rng.choices(vocabulary, k=n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    rows = [(i, sentences(rng, rng.randrange(120, 300), i % 5 == 0)) for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, "\n \n"), (1003, "one two\none two\none two"), (1004, "a b c " * 30), (None, "no id here"), (1005, "ab " * 100_000), (3, rows[3][1])]
    return rows


def test_counts_and_verdicts(spark, corpus):
    docs = spark.createDataFrame([(*r, "x", True) for r in corpus], "doc_id long, text string, quality string, kept boolean")
    labels = spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(400)] + [(None, 1, 0), (5, None, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    got = quality.quality_rules(docs, model).collect()
    assert len(got) == len(corpus)
    texts = dict(corpus)
    for r in got:
        want = slow(texts[r.doc_id]) if r.doc_id != 1005 else (100_000, 200_000, 0, 0, 100_000)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.base_failed and r.kept)
    assert {r.doc_id for r in got if r.kept} == {i for i in range(400) if i % 5}
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.kept)
    again = quality.train(docs.repartition(5), labels.repartition(3))
    assert np.array_equal(model.forest.value, again.forest.value) and model.limit == again.limit


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, quality int")
    model = quality.train(docs, labels)
    assert quality.quality_rules(docs, model).count() == 0
    rows = quality.quality_rules(spark.createDataFrame([(1, "w " * 60)], "doc_id long, text string"), model).collect()
    assert rows[0].base_failed and rows[0].score == 0.5


def test_scores_are_monotone_and_learn():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = (x[:, 0] + 0.3 * np.sin(12 * x[:, 1]) + 0.2 * rng.standard_normal(3000) > 0.6).astype(int)
    f = boosting.fit(x[:2000], y[:2000], (1, 0, -1))
    assert ((f.probability(x[2000:]) > 0.5) == y[2000:]).mean() > 0.8
    for k, sign in ((0, 1), (2, -1)):
        grid = np.repeat(rng.random((50, 3)), 40, axis=0)
        grid[:, k] = np.tile(np.linspace(0, 1, 40), 50)
        assert (sign * np.diff(f.raw(grid).reshape(50, 40), axis=1) >= -1e-12).all()


def test_flat_arrays_score_like_a_walk():
    rng = np.random.default_rng(1)
    x = rng.random((500, 4))
    f = boosting.fit(x, (x[:, 0] > x[:, 1]).astype(int), trees=7, depth=3, least=5)
    for row, got in zip(x[:60], f.raw(x[:60]), strict=True):
        total = f.start
        for t in range(7):
            node = 0
            while f.feature[t, node] >= 0:
                node = f.left[t, node] + int(row[f.feature[t, node]] > f.threshold[t, node])
            total += f.value[t, node]
        assert abs(total - got) < 1e-9
