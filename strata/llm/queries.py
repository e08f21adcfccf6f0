"""The operators as registered queries over the driver's tables, with DuckDB SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm import (byte_bpe, centroids, decontaminate, interpolation, language_profiles, license_scan, near_dedup,
                        personal_data, perspectives, repetition, secret_scan, spelling, url_filter)

#: The rules that op2 judges by.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]
LM_FOLDS, LM_TEST, LM_HELD = 7, 2, 3
BPE_FILE = "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("hits")


def op2_url_filter(spark, sf_dir):
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op3_lm_score(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(LM_FOLDS))
    scores = interpolation.score(docs, fold != LM_TEST, fold == LM_HELD)
    held_out = language_profiles.is_held_out(F.col("doc_id"), LM_FOLDS, LM_TEST)
    return scores.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score",
                         "score")


def op4_language_id(spark, sf_dir):
    return language_profiles.identify(table(spark, sf_dir, "documents"))


def op5_perspectives(spark, sf_dir):
    return perspectives.rendered(table(spark, sf_dir, "conversations")).select(
        "conv_id", "perspective", "position", "turn", "rendered", "mask", "start", "end", "mask_start", "mask_end")


def tokenizer(spark):
    import public_tokenizers
    return byte_bpe.codec(spark, public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN)


def op6_byte_bpe(spark, sf_dir):
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer(spark))


def op7_near_dedup(spark, sf_dir):
    return near_dedup.classes(table(spark, sf_dir, "documents"), n=4, percent=80)


def op8_license_scan(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("spans")


def op9_secret_scan(spark, sf_dir):
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op10_repetition(spark, sf_dir):
    return repetition.repetition(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_personal_data(spark, sf_dir):
    return personal_data.scan(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_centroids(spark, sf_dir):
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


SPARK = {f.__name__: f for f in (op1_decontamination, op2_url_filter, op3_lm_score, op4_language_id, op5_perspectives,
                                 op6_byte_bpe, op7_near_dedup, op8_license_scan, op9_secret_scan, op10_repetition,
                                 op11_personal_data, op12_spelling_variants, op13_centroids)}
SQL: dict[str, str] = {"op1_decontamination": decontaminate.sql(), "op5_perspectives": perspectives.sql(),
                       "op13_centroids": centroids.sql()}
