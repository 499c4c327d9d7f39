"""Token ids of documents in binary shards, with Elias-Fano coded document boundaries.

Documents are dealt by ranges of doc_id. Each task streams its range into one shard: `<name>.ids` is the
plain array of ids (two little-endian bytes each while the vocabulary allows it, else four), `<name>.idx`
holds the number of rows without doc_id, the doc_ids and the ends of the documents, both as Elias-Fano
sequences. The manifest, a table with a row per shard, names the files of the tasks that succeeded; files
of lost or repeated attempts are not in it.
"""

import functools
import itertools
import os
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framelark.llm import common
from framelark.llm.elias_fano import EliasFano

END_ID = 0
CACHED = 400_000  # pieces a Python worker remembers from task to task; it holds them through later steps
LONGEST = 64  # bytes of a piece that is remembered
JOINED = 200  # pieces encoded as one text
BLOCK_BYTES = 4_000_000  # text bytes whose equal pieces are looked up once
READ_BYTES = 8_000_000
_HEAD = "<4sBxxxQ"
_MAGIC = b"TOK1"


def _bytes(*ranges):
    """Which of the 256 bytes lie in one of the ranges, ends included."""
    found = np.zeros(256, bool)
    for a, z in ranges:
        found[a : z + 1] = True
    return found


_SPACE = _bytes((9, 10), (13, 13), (32, 32))  # a piece may begin with these
_SIGN = _bytes((33, 38), (40, 47), (58, 64), (91, 96), (123, 126))  # or with these, but not with the apostrophe of 's
_ALNUM = _bytes((48, 57), (65, 90), (97, 122))
_LETTERS = _bytes((0xC3, 0xC8), (0xD0, 0xD1))  # first bytes of two; but for U+00D7 and U+00F7 only letters begin so
_UNSURE = _bytes((0, 32), (127, 127))  # white space or not, by whom one asks
_CUTS = _SPACE | _SIGN


def _odd_end(data, at):
    """Whether the characters of several bytes that end before the places `at` may be white space."""
    a, b, c = data[at - 3], data[at - 2], data[at - 1]
    two = (b == 0xC2) & ((c == 0x85) | (c == 0xA0))
    return two | ((a == 0xE1) & ((b == 0x9A) | (b == 0xA0))) | ((a == 0xE2) & ((b == 0x80) | (b == 0x81))) | ((a == 0xE3) & (b == 0x80))


def _starts(data, ends):
    """Places at which texts may be cut without a change of ids: bytes `data`, of which a text ends at each of `ends`.

    A piece begins where white space follows a character that is none, and where a sign of ASCII follows a letter or digit.
    """
    at = np.flatnonzero(_CUTS[data])
    at = at[at > 0]
    before = data[at - 1]
    space = _SPACE[data[at]]
    cut = np.where(space, ~_UNSURE[before], _ALNUM[before])
    wide = np.flatnonzero(before >= 0x80)
    if len(wide):
        p = at[wide]
        lead, last = data[p - 2], before[wide]
        letter = _LETTERS[lead] & ~((lead == 0xC3) & ((last == 0x97) | (last == 0xB7)))
        cut[wide] = np.where(space[wide], ~_odd_end(data, p), letter)
    begins = np.zeros(len(data) + 1, bool)
    begins[at[cut]] = True
    begins[0] = True
    begins[ends] = True
    begins[-1] = False
    return np.flatnonzero(begins[:-1])


def _parts(array):
    """Offsets and bytes of a large binary array that is no slice."""
    _, offsets, data = array.buffers()
    return np.frombuffer(offsets, np.int64, len(array) + 1), data.to_pybytes()


def _values(array):
    """The values as bytes; to_pylist takes several times as long."""
    at, data = _parts(array)
    return [data[a:z] for a, z in itertools.pairwise(at.tolist())]


class Encoder:
    """Ids of whole texts by a byte-level BPE tokenizer, remembered by piece.

    Byte-level BPE cuts a text by a pattern before it merges, and no match of the pattern of GPT-2 goes on over the places
    of `_starts`. So a text may be cut there, and the ids of a piece are the same wherever it stands. A text with an added
    token, and every text of a tokenizer with another pattern, is encoded as it is. New pieces that begin with a space or
    line feed are encoded many to a text: only the first token of such a piece begins so.
    """

    def __init__(self, path):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        added = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.added = [t for t in added if t]
        form = self.tokenizer.pre_tokenizer
        self.known = isinstance(form, ByteLevel) and form.use_regex and not form.add_prefix_space and self.tokenizer.normalizer is None
        vocabulary = self.tokenizer.get_vocab()
        self.dtype = np.dtype("<u2" if len(vocabulary) <= 1 << 16 else "<u4")
        self.leading = np.zeros(max(vocabulary.values()) + 1, bool)
        self.leading[[i for t, i in vocabulary.items() if t[0] in "\u0120\u010a" and t not in added]] = True
        self.words = {}

    def encode(self, texts) -> list:
        """The ids of each text, as bytes of `dtype`."""
        texts = list(texts)
        out = [b""] * len(texts)
        whole = [i for i, t in enumerate(texts) if not self.known or any(a in t for a in self.added)]
        for i, ids in zip(whole, self._plain([texts[i] for i in whole]), strict=True):
            out[i] = ids
        skip = set(whole)
        cut = [i for i, t in enumerate(texts) if t and i not in skip]
        for i, ids in zip(cut, self._by_piece([texts[i].encode() for i in cut]) if cut else [], strict=True):
            out[i] = ids
        return out

    def _by_piece(self, texts):
        """The ids of texts that are not empty. Equal pieces are looked up once."""
        joined = b"".join(texts)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        starts = _starts(np.frombuffer(joined, np.uint8), ends)
        places = pa.py_buffer(np.append(starts, len(joined)))
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, places, pa.py_buffer(joined)]).dictionary_encode()
        ids = pa.array(self._ids_of(_values(pieces.dictionary)), pa.large_binary()).take(pieces.indices)
        at, data = _parts(ids)
        stops = at[np.append(np.searchsorted(starts, ends[:-1]), len(starts))].tolist()
        return [data[a:z] for a, z in itertools.pairwise([0, *stops])]

    def _ids_of(self, pieces):
        """The ids of pieces, no two of them equal."""
        ids = list(map(self.words.get, pieces))
        fresh = [i for i, x in enumerate(ids) if x is None]
        if fresh:
            new = [pieces[i] for i in fresh]
            learnt = self._learn(new)
            for i, x in zip(fresh, learnt, strict=True):
                ids[i] = x
            self._remember(pieces, new, learnt)
        return ids

    def _remember(self, pieces, new, learnt):
        kept = [(w, x) for w, x in zip(new, learnt, strict=True) if len(w) <= LONGEST]
        if len(self.words) + len(kept) > CACHED:
            # Frequent pieces come early, so the half learnt first stays, with the pieces of these texts.
            now = set(pieces)
            self.words = {w: x for i, (w, x) in enumerate(self.words.items()) if i < CACHED // 2 or w in now}
        self.words.update(kept[: max(0, CACHED - len(self.words))])

    def _run(self, texts):
        run = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        return run(texts, add_special_tokens=False) if texts else []

    def _plain(self, texts):
        return [np.array(e.ids, self.dtype).tobytes() for e in self._run(texts)]

    def _learn(self, pieces):
        texts = [w.decode() for w in pieces]
        plain = [i for i, t in enumerate(texts) if t[0] in " \n" and len(x := t.split()) == 1 and len(x[0]) == len(t) - 1]
        out = [None] * len(texts)
        joined = ["".join(texts[i] for i in plain[a : a + JOINED]) for a in range(0, len(plain), JOINED)]
        ids = np.array(list(itertools.chain.from_iterable(e.ids for e in self._run(joined))), np.int64)
        at = (np.flatnonzero(self.leading[ids]) * self.dtype.itemsize).tolist()
        if len(at) == len(plain):  # else white space of a kind the tokenizer sees otherwise
            data = ids.astype(self.dtype).tobytes()
            for i, a, z in zip(plain, at, [*at[1:], len(data)] if at else [], strict=True):
                out[i] = data[a:z]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(rest, self._plain([texts[i] for i in rest]), strict=True):
            out[i] = x
        return out


@functools.lru_cache(maxsize=1)
def encoder_of(path) -> Encoder:
    """The worker's encoder; Spark reuses workers, and with them what they have learnt."""
    return Encoder(path)


def _filesystem(path):
    """(file system, path on it) of a URI or an absolute local path."""
    return pafs.FileSystem.from_uri(path)


def _write_shard(folder, tokenizer_path):
    def run(batches):
        encoder = None
        for b in common.blocks(batches, limit=BLOCK_BYTES):
            if encoder is None:
                encoder = encoder_of(tokenizer_path)
                end = np.array([END_ID], encoder.dtype).tobytes()
                shard = TaskContext.get().partitionId()
                name = f"{shard:06d}-{uuid.uuid4().hex}"
                fs, base = _filesystem(folder)
                fs.create_dir(base, recursive=True)
                stream = fs.open_output_stream(f"{base}/{name}.ids")
                sizes, ids, nulls = [], [], 0
            for tokens in encoder.encode(common.strings(b.column("text"))):
                stream.write(tokens + end)
                sizes.append(len(tokens) // encoder.dtype.itemsize + 1)
            nulls += b.column("doc_id").null_count
            ids.append(b.column("doc_id").drop_null().to_numpy(zero_copy_only=False).astype(np.int64))
        if encoder is None:
            return
        stream.close()
        ends = np.cumsum(np.array(sizes, np.int64))
        with fs.open_output_stream(f"{base}/{name}.idx") as index:
            index.write(struct.pack(_HEAD, _MAGIC, encoder.dtype.itemsize, nulls))
            index.write(EliasFano.encode(np.concatenate(ids)).to_bytes())
            index.write(EliasFano.encode(ends).to_bytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int64()), pa.array([name]), pa.array([len(sizes)], pa.int64()), pa.array([int(ends[-1])], pa.int64())],
            ["shard", "name", "n_docs", "n_tokens"])

    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, id_col="doc_id", text_col="text") -> DataFrame:
    """Write the shards to `folder` (a URI every executor can reach); return the manifest.

    The manifest has a row per shard: shard, name, n_docs, n_tokens, start (ids in the shards before it).
    Documents stand in ascending doc_id order, rows without doc_id first, rows that repeat one in the order
    of a hash of their text. A null or empty text gives the end id alone. doc_id must be an integer column.
    An empty table gives an empty manifest.
    """
    rows = common.columns(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    shards = common.cut(dealt.mapInArrow(_write_shard(folder, tokenizer_path), "shard bigint, name string, n_docs bigint, n_tokens bigint"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    return shards.withColumn("start", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0).cast("bigint")))


class Shard:
    """Random access to one shard: documents by position."""

    def __init__(self, folder, name):
        self.fs, base = _filesystem(folder)
        self.path = f"{base}/{name}.ids"
        with self.fs.open_input_stream(f"{base}/{name}.idx") as f:
            data = f.read()
        magic, width, self.nulls = struct.unpack_from(_HEAD, data)
        if magic != _MAGIC:
            raise ValueError(f"{name} is not a token shard")
        self.dtype = np.dtype(f"<u{width}")
        self.ids, rest = EliasFano.from_bytes(data[struct.calcsize(_HEAD) :])
        self.ends, _ = EliasFano.from_bytes(rest)

    def __len__(self):
        return self.ends.count

    def doc_ids(self, a, z) -> list:
        known = self.ids.select(np.arange(max(a - self.nulls, 0), max(z - self.nulls, 0))).tolist()
        return [None] * (z - a - len(known)) + known

    def bounds(self, a, z) -> np.ndarray:
        """Start of document a, then the end of each document in [a, z)."""
        at = np.arange(a - 1, z)
        return np.r_[0, self.ends.select(at[1:])] if a == 0 else self.ends.select(at)

    def read(self, start, stop) -> np.ndarray:
        with self.fs.open_input_file(self.path) as f:
            return np.frombuffer(f.read_at((stop - start) * self.dtype.itemsize, start * self.dtype.itemsize), self.dtype)


def _read_shards(folder, with_ids):
    def run(batches):
        for b in batches:
            for name, first in zip(b.column("name").to_pylist(), b.column("start").to_pylist(), strict=True):
                shard = Shard(folder, name)
                at = 0
                while at < len(shard):
                    bounds = shard.bounds(at, min(at + 4096, len(shard)))
                    limit = bounds[0] + READ_BYTES // shard.dtype.itemsize
                    many = max(1, int(np.searchsorted(bounds, limit, side="right")) - 1)
                    bounds = bounds[: many + 1]
                    ids = shard.read(bounds[0], bounds[-1])
                    docs = [ids[s:e] for s, e in zip(bounds - bounds[0], bounds[1:] - bounds[0], strict=False)]
                    crc = [zlib.crc32(d.astype("<u4").tobytes()) for d in docs]
                    kept = [d.astype(np.int32) if with_ids else None for d in docs]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard.doc_ids(at, at + many), pa.int64()), pa.array(bounds[:-1] + first, pa.int64()), pa.array(np.diff(bounds), pa.int64()),
                         pa.array(crc, pa.int64()), pa.array(kept, pa.list_(pa.int32()))],
                        ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])
                    at += many

    return run


def read_tokens(manifest: DataFrame, folder: str, with_ids=True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and ids of every document, from the files; a task per shard.

    The number of tasks is given, as the manifest is too small for Spark to keep it apart by itself.
    """
    shards = manifest.select("shard", "name", "start")
    shards = shards.repartitionByRange(max(1, shards.count()), "shard")
    return shards.mapInArrow(_read_shards(folder, with_ids), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids array<int>")
