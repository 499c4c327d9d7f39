"""Corpus pipeline: stages over `documents`, each written as Parquet and read again by the next.

A stage takes (spark, docs, sf_dir) and works on all rows of docs. The first four return rows with the
columns of documents; the last writes token shards and returns what a reader finds in them.
"""

import public_tokenizers

from framelark.llm import contamination, mixing, quality, shingles, tokens
from framelark.llm.common import cut, documents
from framelark.operators.scale import scratch_path


def quality_rules(spark, docs, sf_dir):
    """Drops what the fixed limits or the trees, fitted on the labels of these documents, reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.train(docs, labels))


def near_dedup(spark, docs, sf_dir):
    """Keeps one document of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return shingles.keep_one(docs)


def decontaminate(spark, docs, sf_dir):
    """Drops documents that hold a benchmark item."""
    return contamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark, docs, sf_dir):
    """Repeats or leaves out documents until the sources reach their targets."""
    return mixing.mixed(docs)


def token_ids(spark, docs, sf_dir):
    """Writes the shards and returns doc_id, start, n_tokens and ids_crc32 of every document in them."""
    out = scratch_path(spark, "corpus")
    manifest = tokens.write_tokens(docs, out, public_tokenizers.path("byte_bpe_50k.json"))
    return tokens.read_tokens(manifest, out, with_ids=False).drop("ids")


STAGES = [("quality", quality_rules), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("tokens", token_ids)]
ORACLE_SQL = None  # trees, alignments and token ids are beyond SQL


def run(spark, sf_dir):
    """The stages in order over the documents of the folder."""
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs)
    return docs
