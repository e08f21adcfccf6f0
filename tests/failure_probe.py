"""Run in its own process: tasks fail on their first attempt; keys must survive.

Usage: python tests/failure_probe.py  -> prints one JSON line with results.
"""

import json
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType


def flaky_first_attempt(_):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() == 0:
        raise RuntimeError("injected task failure")
    return True


def main():
    spark = (SparkSession.builder.master("local[2,3]")        # 3 attempts per task
             .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    from strata.operators.surrogate import assign_surrogate, number_scan
    from strata.session import fresh_dir, scratch_root
    scratch_root(spark)
    flaky = F.udf(flaky_first_attempt, BooleanType())
    out = {}

    src = (spark.range(20_000).repartition(5, F.col("id") % 3)
                .select((F.col("id") % 101).alias("a"), F.col("id").alias("b")))
    # failure upstream of the range exchange (map side) and downstream of the checkpoint
    keyed = assign_surrogate(src.where(flaky(F.col("b"))), ["a", "b"], "sk", num_partitions=4)
    sks = [r.sk for r in keyed.where(flaky(F.col("sk"))).orderBy("a", "b").select("sk").collect()]
    out["assign_surrogate"] = sks == list(range(1, 20_001))

    path = fresh_dir(spark, "probe")
    spark.range(0, 10_000, 1, 6).write.parquet(path)
    numbered = number_scan(spark.read.parquet(path), "sk")
    got = sorted(r.sk for r in numbered.where(flaky(F.col("sk"))).collect())
    out["number_scan"] = got == list(range(1, 10_001))

    # A whole SCD2 next state: the retried final stage must equal a clean run.
    from strata.operators.scd import empty_scd2, scd2
    from pyspark.sql.types import TimestampType
    ts = TimestampType()
    first = spark.range(3000).select((F.col("id") % 500).alias("k"), (F.col("id") % 7).cast("string").alias("a"),
                                     F.lit(None).cast("timestamp").alias("m")).dropDuplicates(["k"])
    second = first.withColumn("a", F.when(F.col("k") % 3 == 0, F.lit("changed")).otherwise(F.col("a")))
    d1 = scd2(empty_scd2(first, ["k"], ["a"], "sk", ts), first, ["k"], ["a"], "m", "sk",
              "2024-01-01 00:00:00", ts_type=ts).checkpoint()
    d2 = scd2(d1, second, ["k"], ["a"], "m", "sk", "2024-01-02 00:00:00", ts_type=ts)
    clean = sorted(tuple(r) for r in d2.collect())
    retried = sorted(tuple(r) for r in d2.where(flaky(F.col("sk"))).collect())
    out["scd2"] = clean == retried and len(clean) == 500 + 500 // 3 + 1
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
