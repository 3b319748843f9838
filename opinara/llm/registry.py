"""The queries of this folder: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm.shipping import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opinara.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("byte_bpe_50k.tiktoken"))


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opinara.llm.topk import top_k

    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opinara.llm.brown import scores

    return scores(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opinara.llm.chaining import repeated_passages

    return repeated_passages(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opinara.llm.secrets import secret_scan

    return secret_scan(table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opinara.llm.partenum import similar_groups

    return similar_groups(table(spark, sf_dir, "documents"), shingle=3, percent=90).select("doc_id", "n_shingles", "component_id")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opinara.llm.rules import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opinara.llm.ranking import quality_scores

    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opinara.llm.suffixes import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opinara.llm.pieces import encode_and_check

    return encode_and_check(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opinara.llm.variants import spelling_variants

    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opinara.llm.prefixes import rebuilt_trie

    return rebuilt_trie(table(spark, sf_dir, "conversations"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opinara.llm.langid import languages

    return languages(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing, op2_exact_top_k, op3_lm_scoring, op4_substring_dedup, op5_secret_scan, op6_jaccard_join,
        op7_quality_rules, op8_quality_classifier, op9_suffix_dedup, op10_sentencepiece, op11_spelling_variants, op12_conversation_trie, op13_language_id,
    )
}
