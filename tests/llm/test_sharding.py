import hashlib
import random
from collections import Counter

import duckdb
import pandas as pd

from framelark.llm import sharding


def slow(rows, limit, bits=52):
    """Split buckets one by one."""
    h = lambda r: int(hashlib.md5((str(r[0]) if r[0] is not None else "?" + (r[1] or "")).encode()).hexdigest()[:13], 16)  # noqa: E731, S324
    size = lambda r: len((r[1] or "").encode())
    out, todo = {}, [("", rows)]
    while todo:
        prefix, part = todo.pop()
        total = sum(map(size, part))
        if total <= limit or len(prefix) == bits:
            out[prefix] = (total, Counter(r[0] for r in part))
        else:
            todo += [(prefix + b, [r for r in part if f"{h(r):052b}"[len(prefix)] == b]) for b in "01"]
    return {k: v for k, v in out.items() if v[1]}


def corpus(n, seed):
    rng = random.Random(seed)
    rows = [(i, "é" * rng.choice([0, 1, 10, 100, 900])) for i in range(n)]
    return [*rows, (n, None), (None, "no id"), (None, "no id 2"), (5, rows[5][1])]


def check(got, limit):
    per = {}
    for r in got:
        per.setdefault(r.shard, []).append(r)
    for part in per.values():
        assert {r.shard_bytes for r in part} == {sum(r.bytes for r in part)}
        assert part[0].shard_bytes <= limit or len(part) == 1
    return per


def test_matches_splitting_one_by_one(spark):
    rows = corpus(300, 1)
    docs = spark.createDataFrame([(*r, 3, "x") for r in rows], "doc_id long, text string, depth int, shard string")
    for limit in (2000, 10_000, 10**9):
        got = sharding.shards(docs, limit).collect()
        assert len(got) == len(rows)
        per = check(got, limit)
        assert {k: (v[0].shard_bytes, Counter(r.doc_id for r in v)) for k, v in per.items()} == slow(rows, limit)


def test_deep_and_indivisible_buckets(spark):
    rows = [(1, "a" * 40)] * 500 + [(1, "b" * 5000), (2, "c" * 3000), (3, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shards(docs, 1000).collect()
    assert len(got) == len(rows)
    check(got, 1000)
    assert sum(r.bytes for r in got) == sum(len(t) for _, t in rows)


def test_oracle(spark):
    rows = [r for r in corpus(400, 4) if r[0] is not None][:-1]
    documents = pd.DataFrame(rows, columns=["doc_id", "text"])  # noqa: F841
    want = sorted(duckdb.sql(sharding.oracle(5000)).fetchall())
    assert sorted(map(tuple, sharding.shards(spark.createDataFrame(rows, "doc_id long, text string"), 5000).collect())) == want


def test_empty_table(spark):
    assert sharding.shards(spark.createDataFrame([], "doc_id long, text string")).count() == 0
