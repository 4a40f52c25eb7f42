"""One query per corpus operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import bucket_dedup, decontaminate, hard_negatives, html_extract, line_rules, lsh_forest, merkle, mixing, packing, pii, ppm, quality_knn, range_coder
from sluice.llm.common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the tokenizer file lies on this machine; every executor has the same package."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_coder.token_index(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extracted(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op3_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judged(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its best benchmark item, if any; ``kept`` where there is none."""
    docs = table(spark, sf_dir, "documents")
    hits = decontaminate.contaminations(docs, table(spark, sf_dir, "benchmark"))
    both = docs.select("doc_id").join(hits, F.col("doc_id") == F.col("id"), "left")
    return both.select("doc_id", "item_id", "common", "answer", F.coalesce("n_passages", F.lit(0)).alias("n_passages"), F.col("item_id").isNull().alias("kept"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op6_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.language_scores(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_knn.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op10_byte_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bucket_dedup.without_repeats(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id").drop("n_segments")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"), F.col("embedding").alias("vector")
    )
    return hard_negatives.mined(rows, F.col("vec_id") % 100 == 0)


def op13_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_path()).withColumnRenamed("id", "doc_id")


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_html_main_text": op2_html_main_text,
    "op3_line_frequency": op3_line_frequency,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_source_mix": op5_source_mix,
    "op6_ppm_scores": op6_ppm_scores,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_personal_data": op9_personal_data,
    "op10_byte_repeats": op10_byte_repeats,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_vector_packing": op13_vector_packing,
}
