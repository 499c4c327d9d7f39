"""Quality rules: fixed limits, and boosted trees over statistics of a document."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.llm import boosting, common

SAMPLE_ROWS = 20_000  # labelled documents the trees are fitted on, at most
KEEP_RATE = 0.998  # share of the good labelled documents that the verdict must keep
FEATURES = ("n_words", "word_length", "symbol_rate", "dup_line_rate", "repeat_rate", "distinct_rate", "top_word_rate", "upper_rate", "digit_rate", "mark_rate", "line_words")
# More symbols, repeated lines, repeated words or one dominant word never raise the score.
MONOTONE = (0, 0, -1, -1, -1, 0, -1, 0, 0, 0, 0)

_SYMBOLS = b"#*$%&|<>"
_CLASS = np.zeros(256, np.uint8)  # 1 white space, 2 continuation of a character, 4 upper case, 8 digit, 16 ! and ?
_CLASS[[9, 10, 11, 12, 13, 32]] = 1
_CLASS[0x80:0xC0] = 2
_CLASS[65:91] = 4
_CLASS[48:58] = 8
_CLASS[[33, 63]] = 16


def statistics(text: bytes) -> tuple:
    """(counts n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; features) of one UTF-8 text."""
    words = text.split()
    n = len(words)
    kinds = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=32)
    chars = len(text) - int(kinds[1]) - int(kinds[2])
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeats = len(lines) - len(set(lines))
    h = common.word_hashes(words)
    _, counts = np.unique(h, return_counts=True)
    in_repeats = 0
    if n >= 3:
        w = common.window_hashes(h, 3)
        _, which, often = np.unique(w, return_inverse=True, return_counts=True)
        again = np.zeros(n, bool)
        at = np.flatnonzero(often[which] > 1)
        for k in range(3):
            again[at + k] = True
        in_repeats = int(again.sum())
    m = max(n, 1)
    top = int(counts.max()) if n else 0
    features = (n, chars / m, symbols / m, repeats / max(len(lines), 1), in_repeats / m, len(counts) / m, top / m, kinds[4] / max(chars, 1), kinds[8] / max(chars, 1), kinds[16] / m, n / max(len(lines), 1))
    return (n, chars, symbols, repeats, in_repeats), features


def _statistics_rows(batches):
    for b in common.blocks(batches):
        rows = [statistics(t)[1] for t in common.raw(b.column("text"))]
        yield pa.RecordBatch.from_arrays([b.column("quality"), pa.array(rows, pa.list_(pa.float64()))], ["quality", "features"])


class Model:
    def __init__(self, forest, limit):
        self.forest, self.limit = forest, limit


def train(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", sample_rows=SAMPLE_ROWS) -> Model:
    """Trees fitted on at most `sample_rows` labelled documents, chosen by a hash of their id.

    labels: columns doc_id and quality (1 good, 0 bad; rows with a null in either do not count, and of labels that
    disagree the worse does). The limit
    of the verdict keeps KEEP_RATE of the good ones, and is one half at most.
    """
    chosen = labels.select(F.col("doc_id").alias("_id"), "quality").filter("_id is not null and quality in (0, 1)")
    chosen = chosen.groupBy("_id").agg(F.min("quality").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)
    rows = common.columns(docs, doc_id=id_col, text=text_col).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    table = rows.select("text", F.col("quality").cast("int").alias("quality")).mapInArrow(_statistics_rows, "quality int, features array<double>").toArrow()
    y = table.column("quality").to_numpy()
    x = np.array(table.column("features").to_pylist(), np.float64).reshape(len(y), len(FEATURES))
    order = np.lexsort((*x.T, y))  # rows arrive in any order
    x, y = x[order], y[order]
    forest = boosting.fit(x, y, MONOTONE)
    good = forest.probability(x[y == 1])
    return Model(forest, min(0.5, float(np.quantile(good, 1 - KEEP_RATE, method="lower"))) if len(good) else 0.0)


def judge(texts, model: Model):
    """(counts, base_failed, score, kept) arrays of UTF-8 texts."""
    both = [statistics(t) for t in texts]
    counts = np.array([c for c, _ in both], np.int64).reshape(-1, 5)
    x = np.array([f for _, f in both], np.float64).reshape(-1, len(FEATURES))
    failed = (counts[:, 0] < 50) | (100 * counts[:, 4] > 50 * counts[:, 0])
    score = model.forest.probability(x)
    return counts, failed, score, ~failed & (score >= model.limit)


def _judge_rows(model):
    def run(batches):
        for b in common.blocks(batches):
            counts, failed, score, kept = judge(common.raw(b.column("text")), model)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(c) for c in counts.T), pa.array(failed), pa.array(kept), pa.array(score)],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"])

    return run


def quality_rules(docs: DataFrame, model: Model, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per row of `docs`: doc_id, the counts, base_failed, kept, score.

    base_failed: fewer than 50 words, or more than half of them in repeated three-word windows; kept is
    false for these, else the verdict of the trees. Null and empty texts have no words and fail.
    """
    rows = common.columns(docs, doc_id=id_col, text=text_col)
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, score double"
    return rows.mapInArrow(_judge_rows(model), schema)


def keep_good(docs: DataFrame, model: Model, text_col="text") -> DataFrame:
    """The rows of `docs` that the rules keep, columns as they are; no shuffle."""

    def run(batches):
        for b in common.blocks(batches, text_col):
            yield b.filter(pa.array(judge(common.raw(b.column(text_col)), model)[3]))

    return docs.mapInArrow(run, docs.schema)
