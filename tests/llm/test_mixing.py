import random

import duckdb
import pandas as pd
import pytest

from framelark.llm import mixing


def fill(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets by plain repeated sharing."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    full, out = set(), {}
    while True:
        left = share * sum(sizes.values()) - sum(most * sizes[s] for s in full)
        total = sum(weight[s] for s in names if s not in full)
        out = {s: most * sizes[s] if s in full else left * weight[s] / total for s in names}
        over = {s for s in names if s not in full and out[s] > most * sizes[s] + 1e-9}
        if not over:
            return out
        full |= over


def corpus(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["a", "a", "a", "a", "b", "B", "é", None, "ab"])
        rows.append((i, rng.choice([" ", "\n"]).join(["w"] * rng.choice([0, 1, 3, 20, 70, 300])), source))
    return [*rows, (n, None, "a"), (n + 1, "", "only empty"), (None, "x y z", "b"), (None, "p q", "b"), (0, rows[0][1], rows[0][2])]


@pytest.mark.parametrize("power", [0.5, 0.9])
def test_mix(spark, monkeypatch, power):
    monkeypatch.setattr(mixing, "SLICE_POWER", power)
    rows = corpus(600, 2)
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, text string, source string, size int, copies string")
    got = mixing.mix_report(docs).toPandas()
    assert len(got) == len(rows)
    assert sorted(got["size"]) == sorted(len((t or "").split()) for _, t, _ in rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = fill(sizes)
    for source, part in got.groupby("source", dropna=False):
        source = None if pd.isna(source) else source
        assert (part.source_size == sizes[source]).all() and abs(part.target - want[source]).max() < 1e-6
        assert abs(part.taken.sum() - want[source]) <= max(35, 0.02 * want[source])
    assert (got.taken <= 2 * got["size"]).all()
    again = mixing.mix_report(docs.repartition(5)).toPandas()
    order = ["doc_id", "size", "taken"]
    assert got.sort_values(order)[order].reset_index(drop=True).equals(again.sort_values(order)[order].reset_index(drop=True))
    rowsout = mixing.mixed(docs)
    assert rowsout.columns == docs.columns
    assert rowsout.count() == int(got.copies.sum())


def test_oracle_and_slices_agree(spark, monkeypatch):
    rows = [*corpus(500, 5), *[(7, "same words here", "a")] * 40, *[(None, "no id at all", "b")] * 60]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    documents = pd.DataFrame(rows, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"})  # noqa: F841
    order = ["doc_id", "source", "size", "taken"]
    want = duckdb.sql(mixing.ORACLE).df().sort_values(order).reset_index(drop=True)
    for power in (0.0, 0.5, 0.9):
        monkeypatch.setattr(mixing, "SLICE_POWER", power)
        got = mixing.mix_report(docs).toPandas().sort_values(order).reset_index(drop=True)
        assert got.taken.tolist() == want.taken.tolist() and got.target.tolist() == want.target.tolist()


def test_longer_documents_are_likelier(spark):
    rows = [(i, "w " * (4 if i % 2 else 200), "s") for i in range(3000)]
    got = mixing.mix_report(spark.createDataFrame(rows, "doc_id long, text string, source string"), share=0.5).toPandas()
    share = got.assign(hit=got.copies > 0).groupby("size").hit.mean()
    assert share[200] > 1.5 * share[4] > 0
    assert abs(got.taken.sum() - 0.5 * got["size"].sum()) <= 200


@pytest.mark.parametrize("limit", [None, "50"])
def test_a_source_of_copies_meets_its_target(spark, limit):
    rows = [(None, "one text of five words", "copies")] * 2000 + [(7, "w " * 10, "repeated id")] * 500 + [(i, "w " * 20, "others") for i in range(1000, 2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    if limit:
        spark.conf.set("framelark.windowRows", limit)
    try:
        got = mixing.mix_report(docs).toPandas()
        taken = mixing.mixed(docs).groupBy("source").count().collect()
    finally:
        spark.conf.unset("framelark.windowRows")
    for source, part in got.groupby("source"):
        assert abs(part.taken.sum() - part.target.iloc[0]) <= 20, source
    assert {r["source"]: r["count"] for r in taken} == got.groupby("source").copies.sum().to_dict()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix_report(docs).count() == 0 and mixing.mixed(docs).count() == 0
