"""Near duplicates by SimHash fingerprints at a Hamming distance of two or fewer.

A fingerprint has 64 bits over three-word shingles. Its embedding is the vector of bit counts of its 32
two-bit segments; the Manhattan distance of two embeddings never exceeds the Hamming distance of the
fingerprints. Within distance two at most two segments differ, so of six blocks of segments four agree in
full: each fingerprint enters the 15 grids made of four blocks, and only rows of one cell are compared, by
Manhattan distance first and by differing bits then.

Equal fingerprints are one row throughout. A cell with more than `cell_rows` fingerprints is not compared
pairwise: its members are keyed by the fingerprint with two bit positions cleared, for all 2016 choices,
which again finds every pair within two bits, at a cost linear in the members. Cells emit a spanning set of
links, not all pairs.
"""

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.llm import common
from framelark.llm.components import components

SEED = 42
CELL_ROWS = 4096  # fingerprints of a cell compared pairwise; beyond, cleared bits cost less
_ODD_BITS = 0x5555555555555555
_SIZES = (6, 6, 5, 5, 5, 5)  # segments per block


def fingerprint(text: bytes) -> int:
    """Signed 64-bit SimHash of the text's three-word shingles; no words: zero."""
    words = text.lower().split()
    n = len(words)
    if n < 3:
        if not n:
            return 0
        h = np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    else:
        shingles = map(b" ".join, zip(words, words[1:], words[2:], strict=False))
        h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n - 2)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 65_536):
        part = h[at : at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    bits = np.packbits(ones * 2 > len(h), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, fp): one row per row of `docs`; a null text counts as empty."""
    rows = common.columns(docs, doc_id=id_col, text=text_col)

    def run(batches):
        for b in batches:
            fp = pa.array([fingerprint(t) for t in common.raw(b.column("text"))], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), fp], ["doc_id", "fp"])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, fp bigint")


def _grid_masks() -> list:
    """Bits of four of the six blocks of segments, for each choice, as signed longs."""
    edges = np.cumsum((0, *_SIZES)) * 2
    block = [sum(1 << b for b in range(a, z)) for a, z in zip(edges, edges[1:], strict=False)]
    masks = [sum(block[i] for i in four) for four in combinations(range(6), 4)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _signed(value: int):
    return F.lit(value - (1 << 64) if value >> 63 else value).cast("bigint")


def embedding(fp):
    """Bit counts of the 32 two-bit segments, two bits each, packed in a long."""
    odd = _signed(_ODD_BITS)
    low, high = fp.bitwiseAND(odd), F.shiftrightunsigned(fp, 1).bitwiseAND(odd)
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _packed_counts(x: np.ndarray) -> np.ndarray:
    odd = np.uint64(_ODD_BITS)
    return (x & odd) + ((x >> np.uint64(1)) & odd)


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Manhattan distance of packed embeddings.

    Counts are 0, 1 or 2, so two of them differ by 1 where the low bits differ, by 2 where only the high do.
    """
    odd = np.uint64(_ODD_BITS)
    x = a ^ b
    low, high = x & odd, (x >> np.uint64(1)) & odd
    return np.bitwise_count(low) + 2 * np.bitwise_count(high & ~low)


def _links_in_runs(start: np.ndarray, fp: np.ndarray, bits: int):
    """Spanning links (a, b) among values of the same run that differ in at most `bits` bits.

    start: index where the run of each position begins; runs are contiguous.
    """
    n, vector = len(fp), _packed_counts(fp)
    left, right = [], []
    active = np.arange(n)
    for d in range(1, n):
        active = active[active + d < n]
        active = active[start[active + d] == start[active]]
        if not len(active):
            break
        near = active[manhattan(vector[active], vector[active + d]) <= bits]
        near = near[np.bitwise_count(fp[near] ^ fp[near + d]) <= bits]
        left.append(near)
        right.append(near + d)
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate(left), np.concatenate(right)
    root = np.arange(n)
    while True:
        old = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        root = root[root]
        if np.array_equal(old, root):
            break
    away = np.flatnonzero(root != np.arange(n))
    return root[away], away


def _compare(bits: int, cell_rows: int):
    """Arrow function over rows (grid, key, fp) sorted by grid and key: links, or members of oversized cells."""

    def emit(cells, fps):
        change = np.r_[True, (cells[1:] != cells[:-1]).any(axis=1)]
        starts = np.flatnonzero(change)
        of = np.cumsum(change) - 1
        sizes = np.diff(np.r_[starts, len(fps)])
        big = sizes[of] > cell_rows
        a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        keep = np.flatnonzero((sizes[of] > 1) & ~big)
        if len(keep):
            sub = of[keep]
            first = np.flatnonzero(np.r_[True, sub[1:] != sub[:-1]])
            begin = np.repeat(first, np.diff(np.r_[first, len(sub)]))
            a, b = _links_in_runs(begin, fps[keep].view(np.uint64), bits)
            a, b = fps[keep][a], fps[keep][b]
        return a, b, fps[big]

    def batch(a, b, over):
        both = pa.array(np.r_[a, over], pa.int64())
        other = pa.array(np.r_[b, np.zeros(len(over), np.int64)], pa.int64(), mask=np.r_[np.zeros(len(a), bool), np.ones(len(over), bool)])
        return pa.RecordBatch.from_arrays([both, other], ["a", "b"])

    def run(batches):
        cells, fps, spilling = np.zeros((0, 2), np.int64), np.zeros(0, np.int64), False
        for rb in batches:
            if not rb.num_rows:
                continue
            new = np.stack([rb.column("grid").to_numpy(), rb.column("key").to_numpy()], axis=1)
            cells, fps = np.r_[cells, new], np.r_[fps, rb.column("fp").to_numpy()]
            last = int(np.argmax((cells == cells[-1]).all(axis=1)))  # where the open run begins
            if last:
                head, spilled = slice(0, last), 0
                if spilling:  # the first run here continues one that was given out as oversized
                    spilled = int(np.argmin((cells == cells[0]).all(axis=1)))
                    yield batch(fps[:0], fps[:0], fps[:spilled])
                    head, spilling = slice(spilled, last), False
                if head.stop > head.start:
                    yield batch(*emit(cells[head], fps[head]))
                cells, fps = cells[last:], fps[last:]
            if spilling or len(fps) > cell_rows:
                # The open run is oversized: give its members out, keep one row to know the run by.
                yield batch(fps[:0], fps[:0], fps[1:] if spilling else fps)
                cells, fps, spilling = cells[:1], fps[:1], True
        if len(fps) and not spilling:
            yield batch(*emit(cells, fps))

    return run


def links(values: DataFrame, bits=2, cell_rows=CELL_ROWS) -> DataFrame:
    """Links (a, b), a spanning set of all pairs of distinct `fp` within two bits of each other."""
    if bits > 2:
        raise ValueError("four of six blocks agree only up to two differing bits")
    vector = embedding(F.col("fp"))
    grids = F.array(*[F.struct(F.lit(g).cast("bigint").alias("grid"), vector.bitwiseAND(F.lit(m).cast("bigint")).alias("key"))
                      for g, m in enumerate(_grid_masks())])
    cells = values.select("fp", F.explode(grids).alias("c")).select("c.grid", "c.key", "fp")
    cells = cells.repartition("grid", "key").sortWithinPartitions("grid", "key", "fp")
    found = common.cut(cells.mapInArrow(_compare(bits, cell_rows), "a bigint, b bigint"))
    pairs = found.filter("b is not null")
    crowded = found.filter("b is null").select(F.col("a").alias("fp"))
    if crowded.isEmpty():
        return pairs
    return pairs.unionByName(_by_cleared_bits(crowded.distinct()))


def _by_cleared_bits(values: DataFrame) -> DataFrame:
    """Links among values that agree once two bit positions are cleared; at most four values share a key."""
    masks = [~((1 << i) | (1 << j)) for i, j in combinations(range(64), 2)]
    masks = F.array(*[F.lit(((m + (1 << 63)) % (1 << 64)) - (1 << 63)).cast("bigint") for m in masks])
    keyed = values.select("fp", F.posexplode(masks).alias("pair", "mask"))
    keyed = keyed.groupBy("pair", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    sets = keyed.agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    return sets.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a <> b").distinct()


def near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text", bits=2, cell_rows=CELL_ROWS) -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint, component_id, and `root`, which names the component.

    component_id is the smallest doc_id reachable over links, the document itself included. Null and empty
    texts have fingerprint zero and link like any other. A row without doc_id takes part; a component in
    which no row has one has a null component_id (its root tells it apart). Rows that repeat a doc_id each
    keep their own fingerprint.
    """
    prints = common.cut(fingerprints(docs, id_col, text_col))
    distinct = common.cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(distinct, bits, cell_rows))
    named = distinct.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left")
    named = named.withColumn("root", F.coalesce("root", "fp"))
    linked = common.cut(named)
    first = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = linked.select("fp", "root").join(first, "root")
    out = prints.join(by_print, "fp")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "root")


def keep_one(docs: DataFrame, id_col="doc_id", text_col="text", bits=2, cell_rows=CELL_ROWS) -> DataFrame:
    """The rows of `docs` without near duplicates, columns as they are: of each component one row stays.

    It is that with the smallest doc_id (rows without one come last), then the smallest hash of the text; of
    rows that agree in both any one.
    """
    return first_rows(docs, near_duplicates(keyed(docs, id_col, text_col), "key", "text", bits, cell_rows), id_col, text_col)


def keyed(docs: DataFrame, id_col, text_col) -> DataFrame:
    """(key, text): keys order rows by id, those without one last, then by the hash of the text."""
    key, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    return docs.select(F.struct(key.isNull().alias("none"), key.alias("id"), F.xxhash64(text).alias("version")).alias("key"), text.alias("text"))


def first_rows(docs: DataFrame, found: DataFrame, id_col, text_col) -> DataFrame:
    """One row of `docs` for each component. found: doc_id and component_id, both keys of keyed()."""
    found = common.cut(found.select("doc_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("stays")))
    gone = found.filter("not stays").select(F.col("doc_id.id").alias("_gone_id"), F.col("doc_id.version").alias("_gone_version")).distinct()
    left = docs.join(gone, docs[id_col].eqNullSafe(gone["_gone_id"]) & (F.xxhash64(docs[text_col]) == gone["_gone_version"]), "left_anti")
    twice = common.cut(found.filter("stays").groupBy("doc_id").count().filter("count > 1"))
    twice = twice.select(F.col("doc_id.id").alias("_twice_id"), F.col("doc_id.version").alias("_twice_version"))
    if twice.isEmpty():
        return left
    same = left[id_col].eqNullSafe(twice["_twice_id"]) & (F.xxhash64(left[text_col]) == twice["_twice_version"])
    return left.join(twice, same, "left_anti").unionByName(left.join(twice, same, "left_semi").dropDuplicates([id_col, text_col]))
