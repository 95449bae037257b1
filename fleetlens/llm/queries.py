"""The operators as named queries over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import (
    alignment, byte_gru, chat, decontaminate, hard_negatives, html_text, language_model, licenses, minhash, nb_svm, packing, quality_trees, url_trie,
)
from fleetlens.llm.common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), minhash.Rule(words=3, percent=85))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return nb_svm.classify(docs, nb_svm.fit_classifier(docs, table(spark, sf_dir, "labels")))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_trie.judge(table(spark, sf_dir, "pages"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(table(spark, sf_dir, "documents"))


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one more, whose texts hold the template's own control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id bigint, turn bigint, role string, text string")
    return chat.digests(chat.segments(turns.unionByName(more)))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_trees.quality_rules(docs, quality_trees.fit_quality(docs, table(spark, sf_dir, "labels")))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), ids=False)


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return byte_gru.identify(docs, byte_gru.fit_languages(docs))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row has the next label; every hundredth is an anchor."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), F.col("embedding").alias("vec"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


QUERIES = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_url_filters": op3_url_filters,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_license_scans": op5_license_scans,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_decontamination": op7_decontamination,
    "op8_html_extraction": op8_html_extraction,
    "op9_quality_rules": op9_quality_rules,
    "op10_packing": op10_packing,
    "op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment,
    "op12_language_id": op12_language_id,
    "op13_hard_negatives": op13_hard_negatives,
}
