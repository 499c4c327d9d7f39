"""Removal of passages that an earlier document already has, by rolling hashes of word windows.

A window is `k` consecutive words. Its Rabin-Karp hash is a polynomial over 64-bit word hashes, taken in
two bases, of which 96 bits decide equality. Windows are counted in Spark, but only those that can repeat: each
window has an anchor, the smallest hash of its `GRAM`-word grams, and equal windows have equal anchors.
Anchors change every sixteen words or so; those found in one document only are dropped by a first, much
smaller count, and with them most windows, before any window is shuffled.
"""

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.llm import common

WORDS = 50
GRAM = 20
HUB_ROWS = 5_000  # documents that hold one window and may meet in a task


def _anchors(h: np.ndarray, k: int) -> np.ndarray:
    """Anchor of every window of k words (all of them short of GRAM words use whole windows)."""
    gram = min(GRAM, k)
    return common.minimum_of(common.window_hashes(h, gram), k - gram + 1)


def _anchor_rows(k):
    def run(batches):
        for b in common.blocks(batches):
            rows, values = [], []
            for i, text in enumerate(common.raw(b.column("text"))):
                words = text.split()
                if len(words) >= k:
                    a = np.unique(_anchors(common.word_hashes(words), k))
                    rows.append(np.full(len(a), i))
                    values.append(a.view(np.int64))
            if rows:
                at = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(at), b.column("version").take(at), pa.array(np.concatenate(values))],
                    ["doc_id", "version", "anchor"])

    return run


def _pack(batches):
    """Texts compressed."""
    squeeze = zstandard.ZstdCompressor(level=1, write_content_size=True).compress
    for b in common.blocks(batches):
        packed = pa.array([squeeze(t) for t in common.raw(b.column("text"))], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("version"), packed], ["doc_id", "version", "packed"])


def _unpacked(batches):
    """The batches in blocks, with the texts as bytes."""
    spread = zstandard.ZstdDecompressor().decompress
    for b in common.blocks(batches, "packed", common.BLOCK_BYTES // 3):
        yield b, [spread(t) for t in common.raw(b.column("packed"))]


def _grouped(h: np.ndarray, g: np.ndarray, pos: np.ndarray):
    """(h, g, sizes, positions) of the distinct windows: both hashes, how many places each has, and the places in turn."""
    order = np.lexsort((pos, g, h))
    h, g, pos = h[order], g[order], pos[order]
    edge = np.flatnonzero(np.r_[True, (np.diff(h) != 0) | (np.diff(g) != 0)])
    return h[edge], g[edge], np.diff(np.r_[edge, len(h)]), pos


def _window_rows(k):
    """Windows whose anchor is in the row's list, once a text, with both hashes and their positions."""

    def run(batches):
        for b, texts in _unpacked(batches):
            at, hashes, other, sizes, pos = [], [], [], [], []
            lists = b.column("anchors")
            flat, edges = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64), lists.offsets.to_numpy()
            edges = edges - edges[0]
            for i, text in enumerate(texts):
                h = common.word_hashes(text.split())
                where = np.flatnonzero(np.isin(_anchors(h, k), flat[edges[i] : edges[i + 1]]))
                if len(where):
                    first = common.window_hashes(h, k)[where].view(np.int64)
                    second = (common.window_hashes(h, k, common.ODD2)[where] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                    for out, values in zip((hashes, other, sizes, pos), _grouped(first, second, where.astype(np.int32)), strict=True):
                        out.append(values)
                    at.append(np.full(len(sizes[-1]), i))
            if at:
                rows = pa.array(np.concatenate(at))
                places = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.concatenate(sizes))], pa.int32()), pa.array(np.concatenate(pos)))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(rows), b.column("version").take(rows), pa.array(np.concatenate(hashes)), pa.array(np.concatenate(other)), places],
                    ["doc_id", "version", "h", "g", "pos"])

    return run


def intervals(starts: np.ndarray, k: int) -> list:
    """Maximal [from, to) word intervals covered by windows of k words at the sorted `starts`."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > k) + 1
    return list(zip(starts[np.r_[0, cut]].tolist(), (starts[np.r_[cut - 1, len(starts) - 1]] + k).tolist(), strict=True))


def _apply(k, with_texts):
    def run(batches):
        for b, texts in _unpacked(batches):
            sizes, gone, kept, spans = [], [], [], []
            for text, starts, copy in zip(texts, b.column("starts").to_pylist(), b.column("copy").to_pylist(), strict=True):
                words = text.split()
                sizes.append(len(words))
                found = [(0, len(words))] if copy and len(words) >= k else intervals(np.array(sorted(starts or ()), np.int64), k)
                spans.append([{"start": a, "end": z} for a, z in found])
                gone.append(sum(z - a for a, z in found))
                for a, z in reversed(found):
                    del words[a:z]
                kept.append(b" ".join(words))
            whole = [t.decode("utf-8", "replace") for t in kept] if with_texts else [None] * len(kept)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array([hashlib.sha256(t).hexdigest() for t in kept]), pa.array(spans, _SPANS), pa.array(whole, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "removed", "kept_text"])

    return run


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def remove_repeated(docs: DataFrame, k=WORDS, id_col="doc_id", text_col="text", texts=True, hub_rows=HUB_ROWS) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_removed, kept_sha256, removed, kept_text.

    A word goes if it lies in a window of k words whose word sequence also starts in a document with a
    smaller doc_id. `removed` lists the maximal intervals of such words; kept_text is null
    unless `texts`. Windows are judged on the input.
    Null and empty texts have no words. A row without doc_id is neither earlier nor later than any other:
    nothing is removed from it and nothing because of it. Rows that repeat a doc_id are one document: they
    do not remove each other's words.
    """
    kind = dict(docs.select(F.col(f"`{id_col}`").alias("doc_id")).dtypes)["doc_id"]
    # Rows that repeat an id are told apart by their text.
    rows = common.columns(docs, doc_id=id_col, text=text_col).withColumn("version", F.xxhash64("text"))
    keyed = rows.filter("doc_id is not null")
    packed = rows.mapInArrow(_pack, f"doc_id {kind}, version bigint, packed binary")
    copies = _copies(keyed)
    anchors = common.cut(keyed.mapInArrow(_anchor_rows(k), f"doc_id {kind}, version bigint, anchor bigint"))
    shared = anchors.groupBy("anchor").agg(F.min("version").alias("a"), F.max("version").alias("z")).filter("a <> z")
    marked = anchors.join(shared.select("anchor"), "anchor").join(copies, ["doc_id", "version"], "left_anti")
    marked = marked.groupBy("doc_id", "version").agg(F.collect_set("anchor").alias("anchors"))
    windows = packed.join(marked, ["doc_id", "version"]).select("doc_id", "version", "packed", "anchors")
    windows = common.cut(windows.mapInArrow(_window_rows(k), f"doc_id {kind}, version bigint, h bigint, g int, pos array<int>"))
    window = F.struct("h", "g").alias("window")
    first = windows.groupBy("h", "g").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z"), F.count("*").alias("count")).filter("a <> z")
    first = common.cut(first.select(window, "a", "count"))
    # A passage that many documents share has a row for each of them; such windows meet their first document in slices.
    late = windows.select(window, "doc_id", "version", "pos")
    late = common.spread_join(late, first.select("window", "a"), "window", hub_rows, counts=first.select("window", "count")).filter("doc_id > a")
    starts = late.groupBy("doc_id", "version").agg(F.array_distinct(F.flatten(F.collect_list("pos"))).alias("starts"))
    found = starts.join(copies.withColumn("copy", F.lit(True)), ["doc_id", "version"], "full_outer")
    found = found.select(F.col("doc_id").alias("_id"), F.col("version").alias("_version"), "starts", "copy")
    out = packed.join(found, (F.col("doc_id") == F.col("_id")) & (F.col("version") == F.col("_version")), "left")
    schema = f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string, removed array<struct<start: bigint, end: bigint>>, kept_text string"
    return out.select("doc_id", "packed", "starts", "copy").mapInArrow(_apply(k, texts), schema)


def _copies(keyed: DataFrame) -> DataFrame:
    """(doc_id, version) of the rows whose whole text an earlier document has."""
    same = common.cut(keyed.select("doc_id", "version", F.unhex(F.md5("text")).alias("same")))
    first = same.groupBy("same").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).filter("a <> z")
    return common.cut(same.join(first, "same").filter("doc_id > a").select("doc_id", "version").distinct())
