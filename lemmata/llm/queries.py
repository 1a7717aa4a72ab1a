"""Queries of the training-data operators, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate
from .common import read


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_audio_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of recordings rendered from every row of embeddings, searched for by every hundredth of them."""
    from pyspark.sql import functions as F

    from .audio import answers, fingerprints, rendered
    from .common import materialize

    key = F.sha2(F.array_join(F.col("codes").cast("array<string>"), ",").cast("binary"), 256)
    codes = fingerprints(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", rendered).withColumn("key", key)
    codes = materialize(codes, "fingerprints")
    # equal fingerprints have equal answers: one of each takes part in the search
    asks = F.col("id") % 100 == 0
    classes = codes.groupBy("key").agg(
        F.first("codes").alias("codes"), F.min("id").alias("id"), F.count_if(asks).alias("n_queries"), F.min(F.when(asks, F.col("id"))).alias("query_id")
    )
    classes = materialize(classes, "classes")
    asked = classes.where("n_queries > 0").select(F.col("query_id").alias("id"), "codes", F.col("n_queries").alias("weight"))
    found = answers(asked, classes.select("id", "codes"))
    best = F.struct("bit_error", F.col("query").alias("query_id"), "offset").alias("best")
    answered = classes.select("key", "id").join(found.select("id", "n_matches", best), "id").drop("id")
    return codes.join(answered, "key", "left").select(
        F.col("id").alias("vec_id"),
        F.size("codes").cast("long").alias("n_codes"),
        F.col("key").alias("codes_sha256"),
        F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"),
        F.col("best.query_id").alias("best_query"),
        F.col("best.offset").alias("best_offset"),
        F.col("best.bit_error").alias("best_bit_error"),
    )


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html import extract_main_text

    return extract_main_text(read(spark, sf_dir, "pages"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .tokens import count_tokens

    return count_tokens(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score_toxicity

    return score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contamination

    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .huffman import token_files

    return token_files(read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import repeat_report

    return repeat_report(read(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import bpe_digests

    return bpe_digests(read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import scan_secrets

    return scan_secrets(read(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import jaccard_components

    return jaccard_components(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


QUERIES = {
    "op1_audio_fingerprints": op1_audio_fingerprints,
    "op2_main_text": op2_main_text,
    "op3_token_counts": op3_token_counts,
    "op4_toxicity": op4_toxicity,
    "op5_decontaminate": op5_decontaminate,
    "op6_token_files": op6_token_files,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_bpe": op8_bpe,
    "op9_secrets": op9_secrets,
    "op10_jaccard_join": op10_jaccard_join,
}
SQL: dict[str, str] = {"op5_decontaminate": decontaminate.SQL}
