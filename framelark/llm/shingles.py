"""Near duplicates by the shares of their word shingles: exact Jaccard similarity of five-word shingles.

Texts with the same set of shingles are one row throughout. Candidates meet in two ways. Fingerprints within
two bits meet for certain in the grids of their segment counts (`simhash.links`). Those farther apart meet by
MinHash: `BANDS` bands of `ROWS` minima each, so a pair of similarity s shares no band with probability
(1 - s**ROWS)**BANDS, which is 1.3e-7 at 0.8 and less above. Texts that meet, directly or over others, form a
candidate group; only members of candidate groups have their shingles moved. Within a group the exact similarity decides: members
are compared with all others until those outside the largest linked part have had their turn, which finds the
same components as all pairs would. A group with more than `group_shingles` is dealt into parts by hash, and
every two parts meet in a task of their own.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.llm import common
from framelark.llm.components import components
from framelark.llm.simhash import fingerprint, first_rows, keyed, links

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 40, 5
GROUP_SHINGLES = 1_000_000  # of a part of a candidate group; a task holds two parts at a time
_SLICE = 1024
_rng = np.random.default_rng(5)
_XOR = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_MULTIPLY = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)


def shingles(text: bytes, k=WORDS) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; a shorter text is one shingle, one without words none."""
    words = text.lower().split()
    h = common.word_hashes(words)
    return np.unique(common.window_hashes(h, min(k, len(h)))) if len(h) else np.zeros(0, np.uint64)


def set_hash(s: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(s.tobytes(), len(s))).view(np.int64))


def bands(s: np.ndarray) -> np.ndarray:
    """A signed hash for each band of minima."""
    low = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    h = (s >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(h), _SLICE):
        low = np.minimum(low, ((h[at : at + _SLICE, None] ^ _XOR) * _MULTIPLY).min(axis=0))
    out = np.arange(BANDS, dtype=np.uint64)
    for x in low.reshape(BANDS, ROWS).T.astype(np.uint64):
        out = common.mixed(out * common.ODD + x)
    return out.view(np.int64)


def _signatures(batches):
    for b in common.blocks(batches):
        texts = common.raw(b.column("text"))
        sets = [shingles(t) for t in texts]
        nodes = pa.array([set_hash(s) for s in sets], pa.int64())
        prints = pa.array([fingerprint(t) for t in texts], pa.int64())
        marks = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32()), pa.array(np.concatenate([bands(s) for s in sets]), pa.int64()))
        yield pa.RecordBatch.from_arrays([b.column("id"), nodes, prints, marks], ["id", "node", "fp", "bands"])


def _sets(batches):
    for b in common.blocks(batches):
        sets = [shingles(t) for t in common.raw(b.column("text"))]
        yield pa.RecordBatch.from_arrays([b.column("node"), b.column("root"), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "root", "n", "shingles"])


def linked(sets: list, similarity=SIMILARITY) -> np.ndarray:
    """For each set the smallest place in its component over links of at least the similarity."""
    sizes, root = np.array([len(s) for s in sets]), np.arange(len(sets))
    if not sizes.all():  # sets without shingles equal each other only
        none = np.flatnonzero(sizes == 0)
        root[none] = none[0]
        some = np.flatnonzero(sizes)
        if len(some):
            root[some] = some[linked([sets[i] for i in some], similarity)]
        return root
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    starts, seen, mark = ends - sizes, np.zeros(len(sets), bool), np.zeros(column.max() + 1, bool)
    while True:
        outside = np.flatnonzero(~seen & (root != np.bincount(root).argmax()))
        if not len(outside):
            return root
        i = outside[0]
        seen[i] = True
        own = column[starts[i] : ends[i]]
        mark[own] = True
        shared = np.add.reduceat(mark[column], starts, dtype=np.int64)
        mark[own] = False
        near = np.unique(root[shared >= similarity * (sizes + sizes[i] - shared) - 1e-9])
        if len(near) > 1:
            root[np.isin(root, near)] = near[0]


def _links(similarity):
    """Arrow function over rows (root, low, high, node, shingles) sorted by the first three."""

    def emit(nodes, sets):
        order = np.argsort(nodes, kind="stable")
        root = order[linked([sets[i] for i in order], similarity)]
        away = np.flatnonzero(root != order)
        return np.array(nodes)[root[away]], np.array(nodes)[order[away]]

    def run(batches):
        group, nodes, sets = None, [], []
        for b in batches:
            a, z = [], []
            keys = zip(*(b.column(c).to_pylist() for c in ("root", "low", "high")), strict=True)
            for key, node, s in zip(keys, b.column("node").to_pylist(), b.column("shingles").to_pylist(), strict=True):
                if key != group:
                    if len(nodes) > 1:
                        x, y = emit(nodes, sets)
                        a.append(x)
                        z.append(y)
                    group, nodes, sets = key, [], []
                nodes.append(node)
                sets.append(np.frombuffer(s, np.uint64))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a), pa.int64()), pa.array(np.concatenate(z), pa.int64())], ["a", "b"])
        if len(nodes) > 1:
            x, y = emit(nodes, sets)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])

    return run


def _near_prints(prints: DataFrame) -> DataFrame:
    """Links (a, b) among the nodes of (node, fp) whose fingerprints are equal or within two bits."""
    least = common.cut(prints.groupBy("fp").agg(F.min("node").alias("least")))
    equal = common.spread_join(prints, least, "fp").select(F.col("least").alias("a"), F.col("node").alias("b"))
    near = links(least.select("fp"))
    ends = [least.select(F.col("fp").alias(c), F.col("least").alias(f"node_{c}")) for c in ("a", "b")]
    near = near.join(ends[0], "a").join(ends[1], "b").select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    return equal.unionByName(near).filter("a <> b")


def _candidates(marked: DataFrame, prints: DataFrame) -> DataFrame:
    """(node, root) of the texts that share bands or near fingerprints with others, directly or over others."""
    cells = marked.select("node", F.explode("bands").alias("band"))
    least = cells.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least < most")
    banded = cells.join(least.select("band", "least"), "band").filter("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    roots = components(banded.unionByName(_near_prints(prints)))
    return common.cut(roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()))


def near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text", similarity=SIMILARITY, group_shingles=GROUP_SHINGLES) -> DataFrame:
    """One row per row of `docs`: doc_id, and component_id, the smallest doc_id that links reach.

    Texts without words, nulls among them, are one component.
    """
    rows = common.columns(docs, id=id_col, text=text_col)
    kind = rows.schema["id"].dataType.simpleString()
    marks = common.cut(rows.mapInArrow(_signatures, f"id {kind}, node bigint, fp bigint, bands array<bigint>"))
    distinct = common.cut(marks.groupBy("node").agg(F.min("id").alias("id"), F.first("bands").alias("bands")))
    groups = _candidates(distinct, marks.select("node", "fp").distinct())
    wanted = groups.join(distinct.select("node", "id"), "node")
    texts = rows.join(wanted, "id").select("node", "root", "text")
    sets = common.cut(texts.mapInArrow(_sets, "node bigint, root bigint, n bigint, shingles binary").dropDuplicates(["node"]))
    parts = sets.groupBy("root").agg(F.ceil(F.sum("n") / F.lit(group_shingles)).cast("int").alias("parts"))
    dealt = sets.join(parts, "root").withColumn("part", F.pmod(F.xxhash64("node"), F.greatest("parts", F.lit(1))).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.greatest("parts", F.lit(1)) - 1)))
    met = met.select("root", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "node", "shingles")
    met = met.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high")
    named = components(met.mapInArrow(_links(similarity), "a bigint, b bigint"))
    named = distinct.select("node", "id").join(named, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = common.cut(named)
    first = named.groupBy("root").agg(F.min("id").alias("component_id"))
    by_node = named.select("node", "root").join(first, "root")
    return marks.select("id", "node").join(by_node, "node").select(F.col("id").alias("doc_id"), "component_id")


def keep_one(docs: DataFrame, id_col="doc_id", text_col="text", similarity=SIMILARITY, group_shingles=GROUP_SHINGLES) -> DataFrame:
    """The rows of `docs` without near duplicates, as simhash.keep_one keeps them, by shared shingles."""
    return first_rows(docs, near_duplicates(keyed(docs, id_col, text_col), "key", "text", similarity, group_shingles), id_col, text_col)
