"""Stages of the pipeline on odd tables: clashing names, no labels, rows that share an id; op9 on many matches."""

import random
import re
import time

from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import byte_bpe, language_profiles, near_dedup, queries, secret_scan
from strata.llm.store import spare_names
from tests.conftest import SF_SMALL


def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def test_language_stage_with_clashing_names_keeps_the_same_documents(spark):
    docs = documents(spark)
    wide = docs
    for name in ("length", "least", "strata_lang", "strata_guess", "Strata_Least", "score"):
        wide = wide.withColumn(name, F.lit("x"))
    kept = corpus_pipeline.language(spark, wide, SF_SMALL)
    assert kept.columns == wide.columns
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    assert ids(kept) == ids(corpus_pipeline.language(spark, docs, SF_SMALL))


def test_language_stage_without_labels_keeps_what_has_a_letter(spark):
    docs = spark.createDataFrame([(1, "hello there", None), (2, "123 !!", None), (3, None, "en"), (4, "", None), (5, "ü", None)],
                                 "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in corpus_pipeline.language(spark, docs, "").collect()) == [1, 5]


def test_one_row_of_each_group_stays_whatever_the_ids(spark):
    a, b = "one two three four five six seven eight nine ten eleven", "other words here that are not like the rest at all"
    rows = [(1, a), (1, a), (None, a), (None, a), (7, a), (8, b), (None, None), (None, ""), (9, b), (9, "words of nine alone make this text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("strata_id", F.lit(1)).withColumn("strata_row", F.lit(2))
    kept = near_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == sorted(
        [("7", a), ("8", b), ("None", "None"), ("None", ""), ("9", "words of nine alone make this text")])
    copies = spark.createDataFrame([(None, a)] * 5, "doc_id long, text string")
    assert near_dedup.deduplicate(copies).count() == 1
    assert near_dedup.deduplicate(copies.limit(0)).count() == 0


def test_profiles_come_from_a_partial_limit(spark):
    plan = language_profiles.learn(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"WindowGroupLimit.*Partial", plan)


def test_a_released_encoder_works_again(spark):
    shared = queries.tokenizer(spark).value
    before = shared.encode("Hello, world")
    shared.release()
    assert not hasattr(shared, "bpe") and shared.encode("Hello, world") == before
    assert shared.decode(before) == b"Hello, world"
    assert isinstance(shared, byte_bpe.Codec)


def test_spare_names_ignore_case(spark):
    df = spark.createDataFrame([(1, 2)], "STRATA_id int, strata_id_ int")
    assert spare_names(df, "id", "row") == {"id": "strata_id__", "row": "strata_row"}


def base_counts(text):
    kinds = {"assign": (secret_scan.ASSIGN.replace("(?i:", "(?i:"), 2, 12), "access": ("AKIA[A-Z0-9]+", 0, 18), "hex": ("[0-9a-f]+", 0, 16)}
    return tuple(sum(len(m.group(g)) >= least for m in re.finditer(p, text)) for p, g, least in kinds.values())


def test_base_secrets_of_random_texts_equal_plain_python(spark):
    rng = random.Random(2)
    pieces = ["password", "Secret", "api_key", "token", "=", ": ", '"', "'", " ", "AKIA", "ABCD1234", "deadbeef", "0123456789abcdef", "x", "é", "𝒳"]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randrange(30)))) for i in range(300)]
    for r in secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert (r.n_assign, r.n_access, r.n_hex) == base_counts(rows[r.doc_id][1]), rows[r.doc_id]


def test_many_matches_in_one_text_take_time_in_proportion(spark):
    rng = random.Random(1)
    took = {}
    for n in (2000, 2000, 8000):
        text = " ".join("".join(rng.choice("0123456789abcdef") for _ in range(20)) for _ in range(n))
        start = time.time()
        (r,) = secret_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
        took[n] = time.time() - start
        assert r.n_hex == n and r.spans.startswith("hex:0:20")
    assert took[8000] < 8 * took[2000]
