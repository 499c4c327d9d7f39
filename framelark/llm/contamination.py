"""Benchmark items in training documents: rare word pairs as seeds of a join, then Smith-Waterman alignment.

Words are runs of letters and digits in lower case. In an alignment of score s or more with an item of L words, m
matches cost at most 2m - 2sL in words that were replaced, added or left out. So it spans at most (3 - 2s)L words,
m is sL or more, and of the m - 1 steps from match to match at least sL - 1 have one such word at most: both sides
go on by one word or two. An item is therefore looked for by the pairs of words one and two places apart: as sL - 1
of its L - 1 starts of pairs must be hit, SEED_HITS of the rarest L - sL - 1 + SEED_HITS starts must be, which are
its seeds. Rarity is counted over all documents. No alignment is lost by that, whatever the frequency of a pair.

Two passes over the documents count the items' pairs and emit the places of seeds, through bitmaps of bounded size;
seeds join the items in Spark, so a common pair costs nothing where rarer ones decide. The stretches around the places
of a document are then aligned with the item if they hold enough of all its pairs and words. Rarity decides the
work alone: the result for a document depends on no other document.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framelark.llm import common

MIN_SCORE = 0.5  # of the alignment of an item with itself
SEED_HITS = 3  # starts of seeds that a document must hit, or half of what the score needs of an item
PLACES = 256  # places of a document that count as one block in the join
BITMAP_BITS = 27  # the bitmap of seeds has at most 2**27 bits, 16 MB
BROADCAST_BYTES = 32 << 20  # of candidates (places and item texts) that may be broadcast
MATCH, OTHER, GAP = 2, -1, -1
_SLACK = 1e-9  # of products with the score
_TO_SPACE = bytes(c if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256)).lower()


def words_of(text: bytes) -> list:
    return text.translate(_TO_SPACE).split()


def align(passage, item):
    """(score, start, end) of the best local alignment of two sequences of word numbers.

    The score is a share of the item's score with itself; [start, end) are places of the passage.
    """
    if not len(passage) or not len(item):
        return 0.0, 0, 0

    def best_end(p, q):
        steps, row, top, end = np.arange(len(p) + 1), np.zeros(len(p) + 1, np.int64), 0, 0
        for w in q:
            t = np.maximum(row + GAP, 0)
            t[1:] = np.maximum(t[1:], row[:-1] + np.where(p == w, MATCH, OTHER))
            row = np.maximum.accumulate(t - GAP * steps) + GAP * steps
            j = int(row.argmax())
            if row[j] > top:
                top, end = int(row[j]), j
        return top, end

    p, q = np.asarray(passage), np.asarray(item)
    top, end = best_end(p, q)
    if not top:
        return 0.0, 0, 0
    back, size = best_end(p[:end][::-1], q[::-1])
    return top / (MATCH * len(q)), end - size, end


def _pairs(h):
    """Hashes of the words one and two places apart, at the place of the first."""
    return [common.mixed(h[:-d] * common.ODD + h[d:]) if len(h) > d else h[:0] for d in (1, 2)]


class _Item:
    """What an alignment of score enough must hold of an item."""

    def __init__(self, text: bytes, min_score):
        self.words = words_of(text)
        self.hashes = common.word_hashes(self.words)
        size, share = len(self.words), min_score * len(self.words)
        self.single = share - 1 <= _SLACK  # so short that words are looked for, not pairs
        self.least = max(int(np.ceil(share - _SLACK)), 1)  # matches
        self.need = self.least if self.single else int(np.ceil(share - 1 - _SLACK))  # starts of pairs, or words
        self.span = int(np.floor((3 - 2 * min_score) * size + _SLACK))
        self.keys = np.unique(np.concatenate(self.parts(self.hashes)))
        self.number = {}
        self.numbers = [self.number.setdefault(w, len(self.number)) for w in self.words]
        self.often = np.bincount(self.numbers) if size else np.zeros(0, int)

    def parts(self, h):
        return [h] if self.single else _pairs(h)

    def starts(self):
        """(place, key) of every start, how many of the rarest places are seeds, and how many of those must be hit."""
        parts = self.parts(self.hashes)
        place = np.concatenate([np.arange(len(p)) for p in parts])
        many, hits = len(self.words) - (not self.single), max(1, min(SEED_HITS, self.need // 2))
        return place, np.concatenate(parts), many - self.need + hits, hits

    def stretches(self, h):
        """[start, end) of the parts of a document that hold every alignment of score enough."""
        hit = np.zeros(len(h), bool)
        for p in self.parts(h):
            hit[: len(p)] |= np.isin(p, self.keys)
        at = np.flatnonzero(hit)
        last = np.arange(len(at)) + self.need - 1
        ok = last < len(at)
        ok[ok] = at[last[ok]] - at[ok] <= self.span
        low, high = at[last[ok]] - self.span, at[ok] + self.span + 1
        if not len(low):
            return
        new = np.flatnonzero(np.r_[True, low[1:] > high[:-1]])
        for a, z in zip(new, np.r_[new[1:], len(low)], strict=True):
            yield max(0, int(low[a])), min(len(h), int(high[z - 1]))

    def best(self, words, min_score):
        """(score, start, end) of the best alignment with a stretch of a document, or None."""
        found = None
        for start, end in self.stretches(common.word_hashes(words)):
            p = np.array([self.number.get(w, -1) for w in words[start:end]])
            # No alignment matches more words than both sides share.
            if np.minimum(np.bincount(p + 1, minlength=len(self.often) + 1)[1:], self.often).sum() < self.least:
                continue
            score, s, e = align(p, self.numbers)
            if score >= min_score and (found is None or (score, -start - s) > (found[0], -found[1])):
                found = score, start + s, start + e
        return found


def _starts(min_score):
    def run(batches):
        for b in common.blocks(batches):
            columns = [[] for _ in range(6)]
            for i, text in enumerate(common.raw(b.column("text"))):
                item = _Item(text, min_score)
                if item.words:
                    place, key, enough, hits = item.starts()
                    for column, value in zip(columns, (i, place, key.view(np.int64), enough, hits, int(item.single)), strict=True):
                        column.append(np.broadcast_to(value, len(key)))
            if columns[0]:
                of, *rest = (np.concatenate(c).astype(np.int64) for c in columns)
                yield pa.RecordBatch.from_arrays([b.column("item").take(pa.array(of)), *map(pa.array, rest)], ["item", "place", "key", "enough", "hits", "single"])

    return run


def _bitmap(keys: DataFrame) -> np.ndarray:
    """A bit for each hash that a key may have; its size follows the number of keys, up to the bound."""
    bits = min(BITMAP_BITS, max(16, (64 * max(1, keys.count())).bit_length()))
    slot = F.col("key").bitwiseAND(F.lit((1 << bits) - 1))
    words = keys.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words.column("at").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def _lookup(bitmap, singles, texts):
    """(text, place, key) of the pairs, or words, of a block of texts that have a bit."""
    known, mask = bitmap, np.uint64(len(bitmap) * 64 - 1)
    words = [words_of(t) for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    h = common.word_hashes([w for ws in words for w in ws])
    of = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(h)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    found = []
    for d, g in [*zip((1, 2), _pairs(h)), *[(0, h)] * singles]:
        slot = g & mask
        at = np.flatnonzero(known[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1))
        at = at[of[at] == of[at + d]]  # a pair does not reach into the next text
        found.append((of[at], place[at], g[at].view(np.int64)))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _counts(bitmap, singles):
    """(key, n): how often the pairs occur, a row per key and block of texts."""

    def run(batches):
        for b in common.blocks(batches):
            key, n = np.unique(_lookup(bitmap.value, singles, common.raw(b.column("text")))[2], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "n"])

    return run


def _places(bitmap, singles):
    """(doc_id, version, key, block) of the places of a document that may be seeds; repeats in a row are one."""

    def run(batches):
        for b in common.blocks(batches):
            of, place, key = _lookup(bitmap.value, singles, common.raw(b.column("text")))
            block = place // PLACES
            order = np.lexsort((key, block, of))
            of, block, key = of[order], block[order], key[order]
            new = np.r_[True, (of[1:] != of[:-1]) | (block[1:] != block[:-1]) | (key[1:] != key[:-1])] if len(of) else np.zeros(0, bool)
            rows = pa.array(of[new])
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(rows), b.column("version").take(rows), pa.array(key[new]), pa.array(block[new])], ["doc_id", "version", "key", "block"])

    return run


def _seeds(items: DataFrame, rows: DataFrame, min_score):
    """((item, key, place, hits): the keys of the rarest starts of each item; whether single words are among them)."""
    starts = common.cut(items.select("item", "text").mapInArrow(_starts(min_score), "item bigint, place bigint, key bigint, enough bigint, hits bigint, single bigint"))
    singles = int(not starts.filter("single = 1").isEmpty())
    bitmap = items.sparkSession.sparkContext.broadcast(_bitmap(starts.select("key").distinct()))
    often = rows.select("text").mapInArrow(_counts(bitmap, singles), "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    rare = starts.join(often, "key", "left").groupBy("item", "place", "enough", "hits").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"), F.collect_set("key").alias("keys"))
    turn = F.row_number().over(Window.partitionBy("item").orderBy("n", "place"))
    kept = rare.withColumn("turn", turn).filter("turn <= enough")
    return common.cut(kept.select("item", "place", "hits", F.explode("keys").alias("key")).distinct()), singles


def _aligned(min_score):
    """Rows (doc_id, version, text, item_id, item_text, blocks) to (doc_id, version, item_id, score, first_word, end_word)."""

    def run(batches):
        last, words, items = None, [], {}
        for b in common.blocks(batches):
            rows, found = [], []
            texts, of, lists = common.raw(b.column("text")), common.raw(b.column("item_text")), b.column("blocks").to_pylist()
            for i, (text, item_text, blocks) in enumerate(zip(texts, of, lists, strict=True)):
                if text != last:
                    last, words = text, words_of(text)
                if item_text not in items:
                    if len(items) >= 1000:
                        items.clear()
                    items[item_text] = _Item(item_text, min_score)
                item = items[item_text]
                # Stretches around the blocks, merged where they meet.
                best, low, high = None, None, None
                for k in [*sorted(blocks), None]:
                    start = None if k is None else max(0, k * PLACES - item.span)
                    if high is not None and (k is None or start > high):
                        hit = item.best(words[low:high], min_score)
                        if hit and (best is None or hit[0] > best[0]):
                            best = hit[0], low + hit[1], low + hit[2]
                        low = high = None
                    if k is not None:
                        low, high = start if low is None else low, (k + 1) * PLACES + item.span + 2
                if best:
                    rows.append(i)
                    found.append(best)
            at = pa.array(rows, pa.int64())
            score, start, end = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(at), b.column("version").take(at), b.column("item_id").take(at), pa.array(score, pa.float64()), pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                ["doc_id", "version", "item_id", "score", "first_word", "end_word"])

    return run


def _found(docs, items, id_col, text_col, min_score) -> DataFrame:
    rows = common.columns(docs, doc_id=id_col, text=text_col).filter("text is not null").withColumn("version", F.xxhash64("text"))
    kind = dict(rows.dtypes)["doc_id"]
    items = common.columns(items, item_id="item_id", text="text").filter("text is not null")
    item_kind = dict(items.dtypes)["item_id"]
    # An item is known by its id and text, so ids may repeat or be null.
    items = common.cut(items.withColumn("item", F.xxhash64("item_id", "text")).dropDuplicates(["item"]))
    seeds, singles = _seeds(items, rows, min_score)
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(seeds.select("key").distinct()))
    hits = rows.mapInArrow(_places(bitmap, singles), f"doc_id {kind}, version bigint, key bigint, block bigint")
    met = hits.join(seeds, "key").groupBy("doc_id", "version", "item").agg(F.collect_set("block").alias("blocks"), F.size(F.collect_set("place")).alias("starts"), F.max("hits").alias("hits"))
    met = met.filter("starts >= hits").drop("starts", "hits")
    pairs = common.cut(met.join(items.select("item", "item_id", F.col("text").alias("item_text")), "item").withColumnsRenamed({"doc_id": "_doc", "version": "_version"}).drop("item"))
    size = pairs.agg(F.sum(F.octet_length("item_text") + 8 * F.size("blocks") + 32).alias("n")).first()["n"] or 0
    pairs = F.broadcast(pairs) if size <= BROADCAST_BYTES else pairs
    same = rows["doc_id"].eqNullSafe(F.col("_doc")) & (rows["version"] == F.col("_version"))
    wanted = rows.join(pairs, same).select("doc_id", "version", "text", "item_id", "item_text", "blocks")
    out = wanted.mapInArrow(_aligned(min_score), f"doc_id {kind}, version bigint, item_id {item_kind}, score double, first_word bigint, end_word bigint")
    best = out.groupBy("doc_id", "version", "item_id").agg(F.max(F.struct("score", (-F.col("first_word")).alias("back"), "end_word")).alias("b"))
    return best.select("doc_id", "version", "item_id", F.round("b.score", 6).alias("score"), (-F.col("b.back")).alias("first_word"), (F.col("b.end_word") - 1).alias("last_word"))


def contaminated(docs: DataFrame, items: DataFrame, id_col="doc_id", text_col="text", min_score=MIN_SCORE) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word) of documents that hold an item, whole or edited.

    items: columns item_id and text. The score is that of the best local alignment, as a share of the score
    of the item with itself; rows under `min_score` are left out. Null and empty texts, and items without a
    word, match nothing. A row without doc_id is reported with a null doc_id; rows that repeat a doc_id
    with the same text are one, with another text they are reported apart. Empty tables give an empty one.
    """
    return _found(docs, items, id_col, text_col, min_score).drop("version")


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col="doc_id", text_col="text", min_score=MIN_SCORE) -> DataFrame:
    """The rows of `docs` that hold no item, columns as they are."""
    found = _found(docs, items, id_col, text_col, min_score)
    found = found.select(F.col("doc_id").alias("_held_id"), F.col("version").alias("_held_version")).distinct()
    same = docs[id_col].eqNullSafe(found["_held_id"]) & (F.xxhash64(docs[text_col]) == found["_held_version"])
    return docs.join(found, same, "left_anti")
