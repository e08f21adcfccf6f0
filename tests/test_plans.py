"""Physical-plan properties the design depends on (checked on the executed plan)."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators.dedup import latest_per_key
from strata.operators.effective_join import resolve
from strata.operators.surrogate import number_scan
from strata.session import fresh_dir


def plan_of(df) -> str:
    df.write.format("noop").mode("overwrite").save()        # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def facts_and_dim(spark):
    path = fresh_dir(spark, "plan")
    spark.range(2000).select((F.col("id") % 40).alias("k"), F.col("id").alias("seq"),
                             F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 20).cast("int")).alias("d")) \
         .write.parquet(path)
    facts = spark.read.parquet(path)
    dim = spark.createDataFrame([(i + 1, i, dt.datetime(2023, 12, 1), None) for i in range(40)],
                                "sk long, k long, s timestamp, e timestamp")
    return facts, dim


def test_partial_top1_before_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("t"))
    lines = latest_per_key(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString().splitlines()
    # the Partial limit sits below (after, in the text) the first Exchange
    ex = next(i for i, l in enumerate(lines) if "Exchange" in l)
    assert any("WindowGroupLimit" in l and "Partial" in l for l in lines[ex:])


def test_small_dimension_is_broadcast_and_facts_do_not_shuffle(spark):
    facts, dim = facts_and_dim(spark)
    p = plan_of(resolve(facts, dim, "k", "d", sk="sk", start="s", end="e"))
    assert "BroadcastHashJoin" in p and "LeftOuter" in p and "SortMergeJoin" not in p


def test_salted_join_shuffles_on_key_and_salt(spark):
    facts, dim = facts_and_dim(spark)
    hot = facts.withColumn("k", F.when(F.col("seq") % 2 == 0, F.lit(3)).otherwise(F.col("k")))
    p = plan_of(resolve(hot, dim, "k", "d", sk="sk", start="s", end="e", strategy="salted", hot_factor=2))
    assert "_salt" in p and ("SortMergeJoin" in p or "ShuffledHashJoin" in p)


def test_number_scan_adds_no_exchange_on_the_rows(spark):
    facts, _ = facts_and_dim(spark)
    lines = number_scan(facts, "sk")._jdf.queryExecution().executedPlan().toString().splitlines()
    # the only exchanges are in the offsets subtree (counts), under the broadcast
    join = next(i for i, l in enumerate(lines) if "BroadcastHashJoin" in l)
    stream_side = lines[join + 1]
    assert "Exchange" not in stream_side
