"""A training corpus from raw documents: five stages of the operators in ``strata.llm``.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; ``run``
writes every stage's result and reads it back before the next one, so a lost
executor repeats one stage at most.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm import byte_bpe, decontaminate, language_profiles, near_dedup, queries, secret_scan
from strata.llm.store import saved, spare_names


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, or farther from the nearest language than its own documents of that length.

    Nothing is held out: languages and limits are learned from all labelled
    documents.  Without a labelled document nothing tells languages apart, and
    every document with a letter stays.
    """
    profiles = saved(language_profiles.learn(docs), "pipeline-profiles")
    if profiles.isEmpty():
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    name = spare_names(docs, "guess", "lang", "length", "least")
    least = language_profiles.limits(docs, profiles).select(
        F.col("lang").alias(name["lang"]), F.col("length").alias(name["length"]), F.col("least").alias(name["least"]))
    predict = language_profiles.predictor(spark, profiles)
    guessed = docs.withColumn(name["guess"], predict(F.col("text")))
    near = guessed.join(F.broadcast(least), (F.col(f"{name['guess']}.lang") == F.col(name["lang"]))
                        & (language_profiles.length_class(F.col("text")) == F.col(name["length"])))
    return near.where(F.col(f"{name['guess']}.score") >= F.col(name["least"])).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: five-word shingles, similarity 0.8 or more."""
    return near_dedup.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of ten words of a benchmark item."""
    return decontaminate.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret in the texts; no document goes."""
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("bigint")))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every text, with a mark whether they decode to its bytes."""
    shared = queries.tokenizer(spark)
    coded = byte_bpe.encode(docs.select("doc_id", "lang", "source", "text"), shared)
    same = byte_bpe.decode(F.col("ids"), shared) == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), same.alias("round_trip"), "ids")


STAGES = [("language ID", language), ("near-duplicates", near_duplicates), ("decontamination", decontamination),
          ("secret scan", secrets), ("encoding", encoding)]
#: Profiles, sketches and byte pairs are beyond SQL; the stages are tested against plain Python on a small table.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
