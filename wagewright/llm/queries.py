"""The queries of this subpackage, with the SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagewright.llm import brown, conversation_trie, cross_polytope, decontaminate, license_scan, line_dedup, merkle, packing, pii, quality, simhash, toxicity, url_filter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score_documents(table(spark, sf_dir, "documents"))


def op6_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op1_boosted_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_attention_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op7_blocked_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.rules_frame(spark))


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), "surrogate key of the registered query")


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_log_template_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_signature_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op12_family_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"), tampered=merkle.every_seventh(F.col("doc_id")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_boosted_trees": op1_boosted_trees,
        "op2_attention_mil": op2_attention_mil,
        "op3_simhash": op3_simhash,
        "op4_cross_polytope": op4_cross_polytope,
        "op5_brown_classes": op5_brown_classes,
        "op6_bin_completion": op6_bin_completion,
        "op7_blocked_bloom": op7_blocked_bloom,
        "op8_surrogates": op8_surrogates,
        "op9_winnowing": op9_winnowing,
        "op10_log_template_tree": op10_log_template_tree,
        "op11_signature_rules": op11_signature_rules,
        "op12_family_trie": op12_family_trie,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


def oracle_sql() -> dict[str, str]:
    return {"op7_blocked_bloom": url_filter.ORACLE_SQL, "op9_winnowing": decontaminate.ORACLE_SQL, "op11_signature_rules": license_scan.ORACLE_SQL, "op12_family_trie": conversation_trie.ORACLE_SQL, "op13_merkle_manifest": merkle.ORACLE_SQL}
