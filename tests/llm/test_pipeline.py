import random
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from test_contamination import slow_quick
from test_quality import slow as counts
from test_shingles import slow_kept
from tokenizers import Tokenizer

from framelark.llm import contamination, quality, simhash


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    out = str(tmp_path_factory.mktemp("corpus"))
    vocabulary = [f"w{i}" for i in range(900)] + ["the", "of"] * 60
    items = [" ".join(rng.choices(vocabulary, k=30)) for _ in range(6)]
    rows = []
    for i in range(260):
        words = rng.choices(vocabulary, k=rng.randrange(60, 220))
        if i % 9 == 0:
            words = rng.choices(["buy###", "now$$$", "|"], k=120)
        elif i % 11 == 0:
            words[20:20] = rng.choice(items).split()
        text = " ".join(words)
        if rows and i % 7 == 0:
            text = rows[rng.randrange(len(rows))][1] + rng.choice(["", " tail"])
        rows.append((i, text, "en", rng.choice(["a", "a", "a", "b", "c", None]), len(text)))
    rows += [(900, None, "en", "a", 0), (901, "", "en", "b", 0), (None, rows[1][1] + " other words at the end of it all", "en", "a", 5), rows[2], (2, rows[2][1], "de", "a", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(r[0], int("#" not in (r[1] or "#")), 0) for r in rows[:200]], "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return out


def test_each_stage_on_its_own_input(spark, folder):
    docs = corpus_pipeline.documents(spark, folder)
    columns, model = docs.columns, quality.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text or "", r.lang)
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = corpus_pipeline.cut(stage(spark, docs, folder))
        after = docs.collect()
        seen[name] = before, after
        if name != "tokens":
            assert docs.columns == columns
    before, after = seen["quality"]
    want = [r for r in before if counts(r.text)[0] >= 50 and 100 * counts(r.text)[4] <= 50 * counts(r.text)[0] and quality.judge([r.text.encode()], model)[3][0]]
    assert sorted(after, key=key) == sorted(want, key=key) and all("#" not in r.text for r in after) and len(after) > 200
    before, after = seen["near_dedup"]
    rows = sorted(before, key=lambda r: (r.doc_id is None, r.doc_id or 0))
    kept = slow_kept([(k, r.text) for k, r in enumerate(rows)])
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in after) == sorted(rows[k].doc_id if rows[k].doc_id is not None else -1 for k in kept)
    assert len(after) < len(before) and {tuple(r) for r in after} <= {tuple(r) for r in before}
    before, after = seen["decontaminate"]
    items = [contamination.words_of(r.text.encode()) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    clean = [r for r in before if all(slow_quick(contamination.words_of(r.text.encode()), q) < contamination.MIN_SCORE for q in items)]
    assert sorted(after, key=key) == sorted(clean, key=key) and len(clean) < len(before)
    before, after = seen["mix"]
    size = lambda rows: sum(len(r.text.split()) for r in rows)
    assert abs(size(after) - 1.5 * size(before)) < 0.02 * size(before) and max(after.count(r) for r in after) == 2
    before, after = seen["tokens"]
    tok, at = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    ids = lambda t: [*tok.encode(t, add_special_tokens=False).ids, 0]
    want = sorted((r.doc_id is None, r.doc_id or 0, zlib.crc32(np.array(ids(r.text), "<u4").tobytes())) for r in before)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.ids_crc32) for r in after) == want
    for r in sorted(after, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens


def test_run(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() > 100


def test_keep_one_of_odd_rows(spark):
    rows = [(None, "a b c d e", 1), (None, "a b c d e", 2), (4, "p q r s", 3), (4, "p q r s", 4), (4, "other words altogether", 5), (5, None, 6), (6, "", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, root long")
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in got.collect()) == [(0, "a b c d e"), (4, "other words altogether"), (4, "p q r s"), (5, "")]
    assert simhash.keep_one(docs.filter("false")).count() == 0
