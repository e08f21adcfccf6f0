"""SCD2 dimensions stored in two parts: what a load writes, what it leaves alone, what it checks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from strata.operators import checks
from strata.operators.scd import ACTIVE, changes, empty_scd2, scd2, scd2_parts
from strata.plans import dimensions, runner
from strata.session import fresh_dir, written
from strata.sources import tables
from strata.workloads import event_entities

NTZ = TimestampNTZType()
ROW = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string, event_date date"


def silver(spark, layout, spec, users, changed=(), day=8):
    ts = dt.datetime(2024, 7, day, 9)
    rows = [(u, ts, u, "b" if u in changed else "a", 1.0, None, ts.date()) for u in users]
    tables.replace(spark, layout.silver(spec), spark.createDataFrame(rows, ROW))


def files(spark, path):
    jpath, fs = tables._fs(spark, path)
    return {(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(jpath)}


@pytest.fixture
def user(spark, layout):
    specs = event_entities()
    runner.declare(spark, layout, specs)
    return specs[0]


def test_a_load_writes_active_rows_and_only_the_rows_it_closes(spark, layout, user):
    gold = layout.gold(user)
    silver(spark, layout, user, range(50))
    dimensions.load(spark, user, layout, "2024-07-08 12:00:00")
    silver(spark, layout, user, range(50), changed={3, 4}, day=9)
    out = dimensions.load(spark, user, layout, "2024-07-09 12:00:00")
    assert out == {"inserted": 0, "updated": 2, "rows": 52, "unchanged": 48, "active": 50}
    closed, active = (tables.part_location(spark, gold, ACTIVE, v) for v in (False, True))
    old = files(spark, closed)
    silver(spark, layout, user, range(50), changed={3, 4, 5}, day=10)
    out = dimensions.load(spark, user, layout, "2024-07-10 12:00:00")
    assert (out["updated"], out["rows"], out["active"]) == (1, 53, 50)
    assert tables.part_location(spark, gold, ACTIVE, False) == closed
    assert tables.part_location(spark, gold, ACTIVE, True) != active
    new = files(spark, closed)
    assert old < new and len(new - old) == 1          # older closed files are untouched, one is added
    added = spark.read.parquet(f"{closed}/{next(iter(new - old))[0]}")
    assert [r.user_id for r in added.collect()] == [5]
    assert checks.enforce(checks.history(spark.table(gold), user.keys), "gold")["total_rows"] == 53


def test_interrupted_publication_is_finished_by_the_next_declaration(spark, layout, user, monkeypatch):
    gold = layout.gold(user)
    silver(spark, layout, user, range(5))
    dimensions.load(spark, user, layout, "2024-07-08 12:00:00")
    silver(spark, layout, user, range(5), changed={1}, day=9)

    def lost(*args):
        raise OSError("lost")
    with monkeypatch.context() as m:
        first = iter([tables.settle])                 # the load settles once before it writes
        m.setattr(tables, "settle", lambda *a: next(first, lost)(*a))
        with pytest.raises(OSError):
            dimensions.load(spark, user, layout, "2024-07-09 12:00:00")
    assert spark.table(gold).count() == 5             # nothing is visible of the state that was not published
    spark.sql(f"DROP TABLE {gold}")
    runner.declare(spark, layout, event_entities())
    for _ in range(2):
        tables.settle(spark, gold, ACTIVE)            # repeating it changes nothing
        state = spark.table(gold)
        assert (state.count(), state.where(ACTIVE).count()) == (6, 5)
    assert dimensions.load(spark, user, layout, "2024-07-10 12:00:00")["updated"] == 0


def test_check_reads_versions_of_touched_keys_alone(spark):
    diff = spark.createDataFrame([(1, "update"), (2, "insert"), (3, "retained")], "user_id long, _status string")
    part = spark.createDataFrame([(k, None, None, True, 1) for k in range(9)], "user_id long, start_effective_date "
                                 "timestamp, end_effective_date timestamp, is_active boolean, record_version int")
    user = event_entities()[0]
    assert {r.user_id for r in dimensions.touched_versions(user, diff, [part, part]).collect()} == {1, 2}


@pytest.mark.parametrize("rows,broken", [
    ([("x", 1, 8, 9, False), ("x", 2, 9, None, True)], None),
    ([("x", 1, 8, None, True), ("x", 2, 9, None, True), ("x", 3, 10, None, True)], "keys_with_many_active"),
    ([("x", 1, 9, 8, False)], "backward_versions"),
    ([("x", 1, 8, 10, False), ("x", 2, 9, None, True)], "overlapping_versions")])
def test_history_check_finds_what_the_single_checks_find(spark, rows, broken):
    day = lambda d: None if d is None else dt.datetime(2024, 7, d)
    df = spark.createDataFrame([(k, v, day(a), day(b), on) for k, v, a, b, on in rows],
                               "k string, record_version int, start_effective_date timestamp, end_effective_date timestamp, is_active boolean")
    row = checks.history(df, ["k"]).first().asDict()
    one, two = checks.intervals(df, ["k"]).first(), checks.active_unique(df, ["k"]).first()
    assert row["ok"] == (broken is None) == (one.ok and two.ok)
    assert (row["backward_versions"], row["overlapping_versions"], row["keys_with_many_active"]) == (
        one.backward_versions, one.overlapping_versions, two.keys_with_many_active)
    assert broken is None or row[broken] > 0


def test_few_changed_keys_shuffle_no_stored_attribute(spark):
    """The plan that writes the active rows has no exchange over the stored rows."""
    rows = spark.range(5000).select(F.col("id").alias("k"), F.repeat(F.lit("attribute"), 20).alias("a"),
                                    F.lit(dt.datetime(2024, 7, 1)).alias("m"))
    dim = written(scd2(empty_scd2(rows, ["k"], ["a"], "sk", NTZ), rows, ["k"], ["a"], "m", "sk", "2024-07-02 00:00:00"), "t")
    inc = written(rows.withColumn("a", F.when(F.col("k") == 7, F.lit("new")).otherwise(F.col("a"))), "t")
    diff = changes(dim, inc, ["k"], ["a"], "sk", change_time="m")
    active, closed = scd2_parts(dim, inc, ["k"], ["a"], "m", "sk", "2024-07-03 00:00:00", diff=diff)
    assert closed.count() == 1 and active.count() == 5000
    active.write.parquet(fresh_dir(spark, "plan"))
    plan = active._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and plan.count("BroadcastHashJoin") >= 2


def test_chained_loads_neither_multiply_partitions_nor_estimates(spark):
    dim = None
    for i in range(6):
        batch = spark.range(20).select(F.col("id").alias("k"), F.lit(f"v{i}").alias("a"), F.lit(dt.datetime(2024, 7, 1 + i)).alias("m"))
        dim = empty_scd2(batch, ["k"], ["a"], "sk", NTZ) if dim is None else dim
        dim = scd2(dim, batch, ["k"], ["a"], "m", "sk", f"2024-07-0{i + 2} 00:00:00").checkpoint()
    assert dim.rdd.getNumPartitions() <= 40
    assert len(str(dim._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 40
    kept = written(dim, "state")
    assert int(str(kept._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 1_000_000


def test_a_whole_history_can_be_replaced_and_is_found_again(spark, layout, user):
    gold = layout.gold(user)
    for day, changed in ((8, ()), (9, {1})):
        silver(spark, layout, user, range(4), changed=changed, day=day)
        dimensions.load(spark, user, layout, f"2024-07-{day:02d} 12:00:00")
    whole = spark.table(gold)
    tables.replace(spark, gold, whole.where(F.col("user_id") != 2))
    assert (spark.table(gold).count(), spark.table(gold).where(ACTIVE).count()) == (4, 3)
    silver(spark, layout, user, range(4), changed={1, 3}, day=10)
    out = dimensions.load(spark, user, layout, "2024-07-10 12:00:00")
    assert (out["inserted"], out["updated"], out["rows"], out["active"]) == (1, 1, 6, 4)
    rows = sorted(map(str, spark.table(gold).collect()))
    spark.sql(f"DROP TABLE {gold}")
    runner.declare(spark, layout, event_entities())
    assert sorted(map(str, spark.table(gold).collect())) == rows and len(rows) == 6
