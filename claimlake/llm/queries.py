"""The registered queries of the training-data operators (contract columns)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.llm.common import read_table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlake.llm.exact_dedup import mark_copies

    return mark_copies(read_table(spark, sf_dir, "documents"))


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlake.llm.topk_search import top_k

    return top_k(read_table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlake.llm.sharding import balanced_shards

    return balanced_shards(read_table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from claimlake.llm.bpe import encode

    docs = encode(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), ["doc_id"], decoded="decoded")
    return docs.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlake.llm.near_dedup import near_groups

    return near_groups(read_table(spark, sf_dir, "documents"), width=3, threshold=0.85)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlake.llm.mixing import mixed_sizes

    return mixed_sizes(read_table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlake.llm.line_dedup import drop_boilerplate

    cleaned = drop_boilerplate(read_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", F.col("__lines").alias("n_lines"), F.col("__removed").alias("n_removed"),
                          F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlake.llm.license_scan import find_licenses

    return find_licenses(read_table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlake.llm.substring_dedup import drop_repeats

    cleaned = drop_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", F.size("removed").alias("n_removed"), "removed",
                          F.sha2(F.coalesce("cleaned", F.lit("")).cast("binary"), 256).alias("cleaned_sha256"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlake.llm.quality import quality_scores

    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlake.llm.source_divergence import source_divergence

    return source_divergence(read_table(spark, sf_dir, "documents"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlake.llm.decontamination import contamination

    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimlake.llm.filter_audit import audit_filters

    return audit_filters(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_topk_search": op2_topk_search,
    "op3_sharding": op3_sharding,
    "op4_bpe": op4_bpe,
    "op5_near_dedup": op5_near_dedup,
    "op6_mixing": op6_mixing,
    "op7_line_dedup": op7_line_dedup,
    "op8_license_scan": op8_license_scan,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_quality": op10_quality,
    "op11_source_divergence": op11_source_divergence,
    "op12_decontamination": op12_decontamination,
    "op13_filter_audit": op13_filter_audit,
}
