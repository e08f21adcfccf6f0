"""As-of join by sorting and carrying forward: equal to the interval join, linear on keys with many versions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import effective_join
from strata.operators.effective_join import most_versions, resolve
from strata.session import written

DIM = "sk long, k string, s timestamp, e timestamp"
T0 = dt.datetime(2024, 1, 1)


def at(hours):
    return None if hours is None else T0 + dt.timedelta(hours=hours)


def dimension(spark, seed):
    """Keys with gaps, zero-length versions, an open and a closed end, a NULL key and a NULL start."""
    rng, rows = random.Random(seed), [(900, None, at(1), None), (901, "z", None, None)]
    for k in "abc":
        t = rng.randrange(5)
        for _ in range(rng.randrange(1, 30)):
            end = t + rng.choice([0, 1, 2, 5])
            rows.append((len(rows) + 1, k, at(t), at(end)))
            t = end + rng.choice([0, 0, 0, 3])
        if rng.random() < 0.7:
            rows.append((len(rows) + 1, k, at(t), None))
    return spark.createDataFrame(rows, DIM)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("event", ["t", "d"])
def test_equals_the_interval_join(spark, seed, event):
    rng = random.Random(100 + seed)
    facts = spark.createDataFrame(
        [(i, rng.choice(["a", "a", "a", "b", "c", "nobody", None]), at(rng.choice([None, *range(0, 90)])))
         for i in range(300)], "id long, k string, t timestamp").withColumn("d", F.to_date("t"))
    dim = dimension(spark, seed)
    plain = resolve(facts, dim, "k", event, sk="sk", start="s", end="e", strategy="shuffle")
    for partitions in (1, 40):
        got = resolve(facts, dim, "k", event, sk="sk", start="s", end="e", strategy="asof", hot_factor=1, partitions=partitions)
        assert got.columns == plain.columns
        key = lambda r: r.id
        assert sorted(got.collect(), key=key) == sorted(plain.collect(), key=key)


def test_ten_thousand_versions_meet_ten_thousand_facts_in_linear_work(spark):
    n = 10_000
    v = spark.range(n).select((F.col("id") + 1).alias("sk"), F.lit("x").alias("k"),
                              (F.lit(T0) + F.make_interval(secs=F.col("id") * 60)).alias("s"))
    v = written(v.withColumn("e", F.when(F.col("sk") < n, F.col("s") + F.expr("INTERVAL 1 MINUTE"))), "versions")
    f = written(spark.range(n).select("id", F.lit("x").alias("k"), (F.lit(T0) + F.make_interval(secs=F.col("id") * 60 + 30)).alias("t")), "facts")
    assert most_versions(v, "k") == n > effective_join.MANY_VERSIONS
    got = resolve(f, v, "k", "t", sk="sk", start="s", end="e")          # auto takes asof
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and "Expand" not in plan
    assert got.where(F.col("sk") == F.col("id") + 1).count() == n


def test_versions_without_an_end_hold_until_the_next(spark):
    v = spark.createDataFrame([(1, "x", at(1)), (2, "x", at(5)), (3, "x", at(5))], "sk long, k string, s timestamp")
    f = spark.createDataFrame([("x", at(h)) for h in (0, 1, 4, 5, 9)], "k string, t timestamp")
    got = resolve(f, v, "k", "t", sk="sk", start="s", end=None).orderBy("t").collect()
    assert [r.sk for r in got] == [None, 1, 1, 3, 3]
    with pytest.raises(ValueError, match="asof"):
        resolve(f, v, "k", "t", sk="sk", start="s", end=None, strategy="shuffle")


def test_empty_sides(spark):
    v, f = spark.createDataFrame([], DIM), spark.createDataFrame([("x", at(1)), (None, at(1))], "k string, t timestamp")
    assert [r.sk for r in resolve(f, v, "k", "t", sk="sk", start="s", end="e", strategy="asof").collect()] == [None, None]
    assert resolve(f.limit(0), v, "k", "t", sk="sk", start="s", end="e", strategy="asof").count() == 0


@pytest.mark.parametrize("event", ["t", "d"])
def test_ranges_of_time_equal_the_interval_join(spark, event):
    """One frequent key: many facts at one time, NULL times, facts before the first version and long after the last."""
    hours = [None] * 40 + [7] * 300 + [0, 1, 2] * 5 + list(range(300)) + [10**5] * 40
    facts = spark.createDataFrame([(i, "a" if i % 9 else "b", at(h)) for i, h in enumerate(hours)],
                                  "id long, k string, t timestamp").withColumn("d", F.to_date("t"))
    dim = spark.createDataFrame([(h + 1, "a", at(h), at(h + (0 if h % 7 == 0 else 2 if h % 5 else 1))) for h in range(2, 250, 2)]
                                + [(900, "a", at(260), None), (901, "b", at(5), None)], DIM)
    plain = resolve(facts, dim, "k", event, sk="sk", start="s", end="e", strategy="shuffle")
    for how in ({"partitions": 40}, {"partitions": 10**4}, {"salt_buckets": 3}, {"salt_buckets": 1}):
        got = resolve(facts, dim, "k", event, sk="sk", start="s", end="e", strategy="asof", hot_factor=1, salt_cols=["id"], **how)
        assert sorted(got.collect(), key=lambda r: r.id) == sorted(plain.collect(), key=lambda r: r.id)


def test_versions_of_a_hot_key_are_not_repeated_in_every_range(spark, monkeypatch):
    n, seen = 2_000, []
    inner = effective_join._timeline
    monkeypatch.setattr(effective_join, "_timeline", lambda *a: seen.append(inner(*a)) or seen[-1])
    v = spark.range(n).select((F.col("id") + 1).alias("sk"), F.lit("x").alias("k"),
                              (F.lit(T0) + F.make_interval(secs=F.col("id") * 60)).alias("s"))
    f = spark.range(n).select("id", F.lit("x").alias("k"), (F.lit(T0) + F.make_interval(secs=F.col("id") * 60 + 30)).alias("t"))
    got = resolve(f, v, "k", "t", sk="sk", start="s", end=None, strategy="asof", hot_factor=1, partitions=200)
    assert got.where(F.col("sk") == F.col("id") + 1).count() == n
    sizes = [r["count"] for r in seen[0].groupBy("_k", "_s").count().collect()]
    assert len(sizes) == 200 and sum(sizes) == 2 * n + 199 and max(sizes) < 3 * 2 * n / 200
