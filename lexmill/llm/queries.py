"""The registered queries ``opN_<name>``: each applies its operator to the whole of ``documents``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import exact_dedup, line_quality, lm_scoring, mixing, ngram_join, oracle, packing, pii, repair, sharding, toxicity


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.mix(_documents(spark, sf_dir), mixing.label_weights(labels)).drop("text_hash")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"), with_ids=False)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.read(repair.write(_documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json")))


def op4_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.sanitise(_documents(spark, sf_dir), with_text=False)


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return lm_scoring.score(docs, lm_scoring.train(docs, order=3))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked_documents(_documents(spark, sf_dir))


def op7_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.judge(_documents(spark, sf_dir)).drop("clean_text")


def op8_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(_documents(spark, sf_dir))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.dedup(_documents(spark, sf_dir))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_source_mix": op1_source_mix,
    "op2_packing": op2_packing,
    "op3_token_files": op3_token_files,
    "op4_sanitise": op4_sanitise,
    "op5_lm_score": op5_lm_score,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_line_quality": op7_line_quality,
    "op8_histogram_sort": op8_histogram_sort,
    "op9_toxicity": op9_toxicity,
    "op10_exact_dedup": op10_exact_dedup,
}

SQL: dict[str, str] = {
    "op1_source_mix": oracle.OP1,
    "op7_line_quality": oracle.OP7.replace("@END@", line_quality.END.replace("'", r"\x27")).replace("@BOILER@", line_quality.BOILERPLATE),
    "op6_ngram_jaccard": oracle.OP6, "op10_exact_dedup": oracle.OP10,
}
