"""One-pass silver, files delivered late, outcomes per entity, the typed fingerprint."""

import datetime as dt
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from strata.functions.fingerprint import hash_diff
from strata.functions.text import cleanse, cleanse_sql
from strata.operators import checks
from strata.operators.dedup import N_ROWS, TIED, latest_per_key, newest_per_key
from strata.plans import bronze, runner, silver
from strata.sources import landing, tables
from strata.workloads import event_entities

ROW = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string, event_date date"
T = dt.datetime(2024, 7, 8, 9)


def rows(spark, *users, kind="a", ts=T):
    return spark.createDataFrame([(u, ts, u, kind, 1.0, None, ts.date()) for u in users], ROW)


def deliver(spark, layout, spec, df, date):
    landing.write_landing(df, layout.landing_dir(spec), F.lit(date).cast("date"))


@pytest.fixture
def specs(spark, layout):
    found = event_entities()
    runner.declare(spark, layout, found)
    return found


# ------------------------------------------------------------------- silver

@pytest.mark.parametrize("seed", range(3))
def test_newest_row_equals_the_window_and_ties_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    data = [(rng.choice([None, 1, 2, 3, 4]), rng.choice([None, 1, 2]), rng.choice([None, 1]), rng.choice("ab"), rng.choice([None, 1.0]))
            for _ in range(60)]
    df = spark.createDataFrame(data, "k int, t int, d int, a string, x double")
    got = newest_per_key(df, ["k"], ["t", "d"])
    assert sorted(map(str, got.drop(N_ROWS, TIED).collect())) == sorted(map(str, latest_per_key(df, ["k"], ["t", "d"]).collect()))
    low = lambda v: (v is not None, v or 0)
    for r in got.collect():
        own = [x for x in data if x[0] == r.k]
        top = max((low(x[1]), low(x[2])) for x in own)
        assert r[N_ROWS] == len(own)
        assert r[TIED] == (len({x for x in own if (low(x[1]), low(x[2])) == top}) > 1)


def test_superseded_ties_do_not_count_and_bronze_is_read_once(spark, layout, specs):
    user = replace(specs[0], max_ambiguous=0)
    deliver(spark, layout, user, rows(spark, 1, 2).union(rows(spark, 1, kind="b")), "2024-07-08")
    bronze.load(spark, user, layout)
    with pytest.raises(checks.ContractError):
        silver.load(spark, user, layout, "2024-07-10")
    assert spark.table(layout.silver(user)).count() == 0
    deliver(spark, layout, user, rows(spark, 1, kind="c", ts=T + dt.timedelta(days=1)), "2024-07-09")
    bronze.load(spark, user, layout)
    assert silver.load(spark, user, layout, "2024-07-11") == {"rows": 2, "rejected": 0}
    plan = silver.grouped(spark.table(layout.bronze(user)), user.keys, user.change_time)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_null_keys_and_maps(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 1, map('a', 1)), (1, 1, map('a', 2)), (2, 1, map('a', 1)), (NULL, 1, map('b', 1)), "
                   "(NULL, 2, map('b', 1)) AS t(k, t, m)")
    found = {r.k: r for r in newest_per_key(df, ["k"], ["t"]).collect()}
    assert (found[1][TIED], found[2][TIED], found[None][N_ROWS]) == (True, False, 2)
    assert newest_per_key(df.limit(0), ["k"], ["t"]).count() == 0
    out = newest_per_key(df, ["k"], ["t"]).agg(*silver.measures(["k"])).first()
    assert (out.rows, out.rejected, out.ambiguous) == (2, 2, 1)


def test_cleansing_as_sql_text_is_the_same_rule(spark):
    df = spark.createDataFrame([(" a ",), ("   ",), ("",), (None,), ("\t",), (" x",), ("ß",)], "s string")
    assert [r.a for r in df.select(cleanse("s").alias("a")).collect()] == [r.a for r in df.selectExpr(f"{cleanse_sql('s')} AS a").collect()]


# ------------------------------------------------------------------- late files

def test_added_changed_and_removed_files_are_listed_and_reloaded(spark, layout, specs):
    user = specs[0]
    for date, df in (("2024-07-08", rows(spark, 1)), ("2024-07-09", rows(spark, 2))):
        deliver(spark, layout, user, df, date)
    assert bronze.load(spark, user, layout, late="report") == {"dates": ["2024-07-08", "2024-07-09"], "rows": 2}
    assert bronze.late_files(spark, user, layout).count() == 0
    deliver(spark, layout, user, rows(spark, 3), "2024-07-08")
    assert bronze.load(spark, user, layout) == {"dates": [], "rows": 0}
    assert bronze.load(spark, user, layout, late="report") == {"dates": [], "rows": 0, "late": ["2024-07-08"]}
    assert [r.change for r in bronze.late_files(spark, user, layout).collect()] == ["added"]
    assert bronze.load(spark, user, layout, late="reload") == {"dates": ["2024-07-08"], "rows": 2, "late": ["2024-07-08"]}
    assert bronze.late_files(spark, user, layout).count() == 0
    assert spark.table(layout.bronze(user)).count() == 3
    landing.write_landing(rows(spark, 4, 5), layout.landing_dir(user), F.lit("2024-07-09").cast("date"), overwrite_dates=True)
    changes = {r.change for r in bronze.late_files(spark, user, layout).collect()}
    assert "removed" in changes and "added" in changes
    bronze.load(spark, user, layout, late="reload")
    assert spark.table(layout.bronze(user)).count() == 4
    with pytest.raises(ValueError, match="late"):
        bronze.load(spark, user, layout, late="maybe")
    # a date whose files are all gone is late as well
    jpath, fs = tables._fs(spark, f"{layout.landing_dir(user)}/ingest_date=2024-07-09")
    for st in fs.listStatus(jpath):
        fs.delete(st.getPath(), False)
    assert {(str(r[0]), r.change) for r in bronze.late_files(spark, user, layout).collect()} == {("2024-07-09", "removed")}


# ------------------------------------------------------------------- outcomes

def test_a_failing_entity_leaves_the_others_and_the_report(spark, layout):
    user, event = event_entities()
    bad = replace(user, name="bad", gold_table="dim_bad", sk="bad_sk", change_time=None, max_ambiguous=0, landing_name="bad")
    child = replace(event, name="child", gold_table="fact_child", sk="child_sk", dimension="bad")
    specs = [bad, user, event, child]
    runner.declare(spark, layout, specs)
    deliver(spark, layout, user, rows(spark, 1, 2), "2024-07-08")
    deliver(spark, layout, bad, rows(spark, 1).union(rows(spark, 1, kind="b")), "2024-07-08")
    with pytest.raises(runner.LoadsFailed, match="bad: silver: ContractError") as failed:
        runner.run(spark, layout, specs, "2024-07-10")
    report = {r.entity: r for r in failed.value.report.collect()}
    assert {n: r.status for n, r in report.items()} == {"bad": "failed", "user": "ok", "event": "ok", "child": "skipped"}
    assert (report["user"].gold_rows, report["event"].gold_rows, report["bad"].gold_rows) == (2, 2, None)
    assert report["bad"].bronze_rows_loaded == 2 and "bad" in report["child"].error
    again = {r.entity: r.status for r in runner.run(spark, layout, specs, "2024-07-11", on_error="report").collect()}
    assert again == {"bad": "failed", "user": "ok", "event": "ok", "child": "skipped"}


# ------------------------------------------------------------------- fingerprint

def test_typed_fingerprint_tells_rows_apart(spark):
    values = [("1|2", 3, None), ("1", 2, 3), (None, 3, "#"), ("#", 3, None), (None, None, None), ("", None, ""), ("1:1", None, "1"),
              ("2:ab", 1, "x"), ("2", 1, "ab|x")]
    df = spark.createDataFrame(values, "a string, n int, b string")
    assert df.select(hash_diff(["a", "n", "b"], "typed", df.schema).alias("h")).distinct().count() == len(values)
    with pytest.raises(ValueError, match="schema"):
        hash_diff(["a"], "typed")
