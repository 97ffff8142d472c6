"""The queries opN_<name> over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import bpe, chat, fingerprints, hosts, lines, merkle, neardup, neighbours, oracles, packing, resampling, rules, sharding, toxicity
from tideline.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES = {
    "op5_line_dedup": oracles.OP5,
    "op6_chat_formatting": oracles.op6(),
    "op9_url_filters": oracles.op9(),
    "op11_resampling": oracles.op11(),
    "op12_merkle_manifest": oracles.op12(),
}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_components(table(spark, sf_dir, "documents"))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.verdicts(table(spark, sf_dir, "documents"))


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    decoded = bpe.decode(encoded, ranks, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.deduped(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query
def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", says), (-7, 1, "assistant", says)], turns.schema)
    return chat.digests(chat.format_conversations(turns.unionByName(added)))


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.train(documents, table(spark, sf_dir, "labels")))


@query
def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = hosts.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


@query
def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    manifest = merkle.build(documents, claimed=merkle.leaf(text=merkle.without_line_ends(documents)))
    proved = merkle.prove(manifest, manifest.leaves)
    return proved.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))
