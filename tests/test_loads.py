"""Loads over changing sources: new columns, lossy types, odd folders, empty facts, checks before publishing."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from strata.operators import checks
from strata.operators.scd import changes, scd2
from strata.plans import bronze, dimensions, facts, runner, silver
from strata.sources import landing, tables
from strata.workloads import event_entities

T = dt.datetime(2024, 7, 8, 9)
ROW = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string, event_date date"


def rows(spark, *users, ts=T, kind="a"):
    return spark.createDataFrame([(u, ts, u, kind, 1.0, None, ts.date()) for u in users], ROW)


def deliver(spark, layout, spec, df, date):
    landing.write_landing(df, layout.landing_dir(spec), F.lit(date).cast("date"))


@pytest.fixture
def specs(spark, layout):
    found = event_entities()
    runner.declare(spark, layout, found)
    return found


def test_new_and_underscored_columns_reach_silver(spark, layout, specs):
    user = specs[0]
    for date, df in (("2024-07-08", rows(spark, 1)), ("2024-07-09", rows(spark, 2).withColumn("_note", F.lit("n")))):
        deliver(spark, layout, user, df, date)
        bronze.load(spark, user, layout)
        silver.load(spark, user, layout, "2024-07-10")
    got = {r.user_id: r["_note"] for r in spark.table(layout.silver(user)).collect()}
    assert got == {1: None, 2: "N"}


def test_lossy_type_and_odd_folders_are_reported(spark, layout, specs):
    user = specs[0]
    deliver(spark, layout, user, rows(spark, 1).withColumn("event_date", F.col("ts")), "2024-07-08")
    with pytest.raises(ValueError, match="event_date"):
        bronze.load(spark, user, layout)
    landing.write_landing(rows(spark, 2), layout.landing_dir(user), F.lit(None).cast("date"))
    assert landing.skipped_folders(spark, layout.landing_dir(user)) == ["ingest_date=__HIVE_DEFAULT_PARTITION__"]
    with pytest.raises(ValueError, match="no dates"):
        bronze.load(spark, user, layout, skipped="fail")


def test_emptied_date_stays_empty_after_reattach(spark, layout, specs):
    user = specs[0]
    deliver(spark, layout, user, rows(spark, 1), "2024-07-08")
    bronze.load(spark, user, layout)
    tables.replace_partitions(spark, layout.bronze(user), spark.createDataFrame([], user.bronze_schema()),
                              silver.BRONZE_DATE, ["2024-07-08"])
    spark.sql(f"DROP TABLE {layout.bronze(user)}")
    runner.declare(spark, layout, specs)
    assert spark.table(layout.bronze(user)).count() == 0


def test_empty_fact_unchanged_dimension_and_failed_check(spark, layout, specs):
    user, event = specs
    deliver(spark, layout, user, rows(spark, 1, 2), "2024-07-08")
    bronze.load(spark, user, layout)
    silver.load(spark, user, layout, "2024-07-10")
    dimensions.load(spark, user, layout, "2024-07-10")
    where = tables.location(spark, layout.gold(user))
    again = dimensions.load(spark, user, layout, "2024-07-11")
    assert (again["inserted"], again["updated"], again["unchanged"]) == (0, 0, 2)
    assert tables.location(spark, layout.gold(user)) == where
    assert facts.load(spark, event, user, layout, "2024-07-10") == {"rows": 0, "orphans": 0}
    # an older change time would let the new version start before the old one: nothing is published
    deliver(spark, layout, user, rows(spark, 1, kind="b"), "2024-07-09")
    bronze.load(spark, user, layout)
    silver.load(spark, user, layout, "2024-07-12")
    state = spark.table(layout.silver(user)).withColumn("ts", F.col("ts") - F.expr("interval 9 days"))
    tables.replace(spark, layout.silver(user), state)
    with pytest.raises(checks.ContractError):
        dimensions.load(spark, user, layout, "2024-07-12")
    spark.sql(f"DROP TABLE {layout.gold(user)}")
    runner.declare(spark, layout, specs)
    assert {r.record_version for r in spark.table(layout.gold(user)).collect()} == {1}


def test_ambiguous_keys_stop_silver_when_limited(spark, layout, specs):
    user = specs[0]
    deliver(spark, layout, user, rows(spark, 1).union(rows(spark, 1, kind="b")), "2024-07-08")
    bronze.load(spark, user, layout)
    assert silver.load(spark, user, layout, "2024-07-10")["ambiguous"] == 1
    with pytest.raises(checks.ContractError):
        silver.load(spark, replace(user, max_ambiguous=0), layout, "2024-07-10")


def test_rows_without_fingerprint_survive(spark):
    old = spark.createDataFrame([(7, "x", "1", None, T, None, True, 1, T)],
                                "sk long, k string, a string, hash_diff string, start_effective_date timestamp_ntz, "
                                "end_effective_date timestamp_ntz, is_active boolean, record_version int, gold_load_ts timestamp_ntz")
    none = spark.createDataFrame([], "k string, a string, t timestamp_ntz")
    assert [r.sk for r in scd2(old, none, ["k"], ["a"], "t", "sk", "2024-07-09").collect()] == [7]
    new = spark.createDataFrame([("x", "2", dt.datetime(2024, 7, 9))], "k string, a string, t timestamp_ntz")
    assert [r["_status"] for r in changes(old, new, ["k"], ["a"], "sk").collect()] == ["update"]
    got = sorted((r.sk, r.a, r.is_active) for r in scd2(old, new, ["k"], ["a"], "t", "sk", "2024-07-09").collect())
    assert got == [(7, "1", False), (8, "2", True)]
