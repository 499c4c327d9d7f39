"""The queries opN_<name>: each operator with production parameters over its whole table."""

import public_tokenizers

from framelark.llm import chat, contamination, licenses, mixing, pages, pii, quality, repair, sharding, simhash, substrings, tokens, whitening
from framelark.llm.common import documents
from framelark.operators.scale import scratch_path


def op1_personal_data(spark, folder):
    docs = documents(spark, folder)
    return pii.find_personal_data(docs, pii.train(docs)).drop("added")


def op2_licenses(spark, folder):
    return licenses.scan_licenses(documents(spark, folder))


def op3_simhash(spark, folder):
    return simhash.near_duplicates(documents(spark, folder)).drop("root")


def op4_contamination(spark, folder):
    return contamination.contaminated(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def op5_quality(spark, folder):
    docs = documents(spark, folder)
    return quality.quality_rules(docs, quality.train(docs, spark.read.parquet(f"{folder}/labels.parquet")))


SHARD_BYTES = 1 << 20


def op6_sharding(spark, folder):
    return sharding.shards(documents(spark, folder), SHARD_BYTES)


def op7_tokens(spark, folder):
    out = scratch_path(spark, "tokens")
    manifest = tokens.write_tokens(documents(spark, folder), out, public_tokenizers.path("byte_bpe_50k.json"))
    return tokens.read_tokens(manifest, out, with_ids=False).drop("ids")


def op8_main_text(spark, folder):
    return pages.host_text(spark.read.parquet(f"{folder}/pages.parquet"))


def op9_substrings(spark, folder):
    return substrings.remove_repeated(documents(spark, folder), texts=False).drop("removed", "kept_text")


def op10_mixing(spark, folder):
    return mixing.mix_report(documents(spark, folder))


def op11_repair(spark, folder):
    return repair.report(spark.read.parquet(f"{folder}/conversations.parquet"))


def op12_whitening(spark, folder):
    return whitening.report(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op13_chat(spark, folder):
    return chat.report(spark.read.parquet(f"{folder}/conversations.parquet"))


_ALL = (op1_personal_data, op2_licenses, op3_simhash, op4_contamination, op5_quality, op6_sharding, op7_tokens, op8_main_text, op9_substrings, op10_mixing, op11_repair, op12_whitening, op13_chat)
QUERIES = {f.__name__: f for f in _ALL}
ORACLES = {"op6_sharding": sharding.oracle(SHARD_BYTES), "op10_mixing": mixing.ORACLE, "op13_chat": chat.ORACLE}
