import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from strata.functions.fingerprint import hash_diff
from strata.operators import checks
from strata.operators.scd import ACTION, empty_scd1, empty_scd2, scd1, scd2, scd2_replay

KEYS, ATTRS = ["k"], ["a", "b"]
T1, T2, T3 = "2024-07-08 00:00:00", "2024-07-09 00:00:00", "2024-07-10 00:00:00"
TS = TimestampType()


def inc(spark, rows):
    return spark.createDataFrame(rows, "k string, a string, b int, m timestamp")


def rows_by_key(df):
    return {r["k"]: r.asDict() for r in df.collect()}


# ---------------------------------------------------------------- SCD type 1

def test_e15_scd1_insert_update_unchanged(spark):
    first = inc(spark, [("x", "1", 1, None), ("y", "1", 1, None)])
    d0 = empty_scd1(first, KEYS, ATTRS, "sk", TS)
    d1 = scd1(d0, first, KEYS, ATTRS, "sk", T1, ts_type=TS)
    second = inc(spark, [("x", "1", 1, None), ("y", "2", 1, None), ("z", "1", 1, None)])
    d2 = scd1(d1, second, KEYS, ATTRS, "sk", T2, ts_type=TS, with_action=True)
    got = rows_by_key(d2)
    assert got["x"][ACTION] == "unchanged" and got["x"]["gold_load_ts"] == dt.datetime(2024, 7, 8)
    assert got["y"][ACTION] == "update" and got["y"]["a"] == "2"
    assert got["y"]["gold_load_ts"] == dt.datetime(2024, 7, 9)
    assert got["z"][ACTION] == "insert"
    assert {got["x"]["sk"], got["y"]["sk"]} == {1, 2} and got["z"]["sk"] == 3


def test_e16_scd1_same_batch_twice_is_noop(spark):
    b = inc(spark, [("x", "1", 1, None), ("y", None, 2, None)])
    d1 = scd1(empty_scd1(b, KEYS, ATTRS, "sk", TS), b, KEYS, ATTRS, "sk", T1, ts_type=TS)
    d1 = d1.checkpoint()
    d2 = scd1(d1, b, KEYS, ATTRS, "sk", T2, ts_type=TS)
    assert sorted(d1.collect()) == sorted(d2.collect())


def test_scd1_retains_absent_keys(spark):
    b = inc(spark, [("x", "1", 1, None), ("y", "1", 1, None)])
    d1 = scd1(empty_scd1(b, KEYS, ATTRS, "sk", TS), b, KEYS, ATTRS, "sk", T1, ts_type=TS)
    d2 = scd1(d1, inc(spark, [("x", "1", 1, None)]), KEYS, ATTRS, "sk", T2, ts_type=TS, with_action=True)
    assert rows_by_key(d2)["y"][ACTION] == "retained"


# ---------------------------------------------------------------- SCD type 2

def load2(dim, batch, ts):
    return scd2(dim, batch, KEYS, ATTRS, "m", "sk", ts, ts_type=TS).checkpoint()


def test_e17_first_load(spark):
    b = inc(spark, [("x", "1", 1, dt.datetime(2024, 7, 1, 9))])
    d = load2(empty_scd2(b, KEYS, ATTRS, "sk", TS), b, T1)
    (r,) = d.collect()
    assert (r.record_version, r.is_active, r.end_effective_date) == (1, True, None)
    assert r.start_effective_date == dt.datetime(2024, 7, 1, 9) and r.sk == 1


def test_e18_changed_key_new_version(spark):
    b1 = inc(spark, [("x", "1", 1, dt.datetime(2024, 7, 1))])
    b2 = inc(spark, [("x", "2", 1, dt.datetime(2024, 7, 5))])
    d = load2(load2(empty_scd2(b1, KEYS, ATTRS, "sk", TS), b1, T1), b2, T2)
    rows = sorted(d.collect(), key=lambda r: r.record_version)
    assert [r.record_version for r in rows] == [1, 2]
    assert rows[0].is_active is False and rows[0].end_effective_date == dt.datetime(2024, 7, 5)
    assert rows[1].is_active is True and rows[1].start_effective_date == dt.datetime(2024, 7, 5)
    assert [r.sk for r in rows] == [1, 2]


def test_e19_only_change_time_changed(spark):
    b1 = inc(spark, [("x", "1", 1, dt.datetime(2024, 7, 1))])
    b2 = inc(spark, [("x", "1", 1, dt.datetime(2024, 7, 5))])
    d = load2(load2(empty_scd2(b1, KEYS, ATTRS, "sk", TS), b1, T1), b2, T2)
    assert d.count() == 1


def test_e20_null_change_time_uses_load_ts(spark):
    b1 = inc(spark, [("x", "1", 1, None)])
    b2 = inc(spark, [("x", "2", 1, None)])
    d = load2(load2(empty_scd2(b1, KEYS, ATTRS, "sk", TS), b1, T1), b2, T2)
    rows = sorted(d.collect(), key=lambda r: r.record_version)
    assert rows[0].start_effective_date == dt.datetime(2024, 7, 8)
    assert rows[0].end_effective_date == rows[1].start_effective_date == dt.datetime(2024, 7, 9)


def test_e21_a_b_a_gives_three_versions(spark):
    bs = [inc(spark, [("x", v, 1, dt.datetime(2024, 7, i + 1))]) for i, v in enumerate("ABA")]
    d = empty_scd2(bs[0], KEYS, ATTRS, "sk", TS)
    for b, t in zip(bs, (T1, T2, T3)):
        d = load2(d, b, t)
    assert sorted(r.record_version for r in d.collect()) == [1, 2, 3]
    assert checks.enforce(checks.active_unique(d, KEYS), "dim")["active_rows"] == 1


def test_e22_missing_key_stays_active(spark):
    b1 = inc(spark, [("x", "1", 1, None), ("y", "1", 1, None)])
    b2 = inc(spark, [("x", "2", 1, None)])
    d = load2(load2(empty_scd2(b1, KEYS, ATTRS, "sk", TS), b1, T1), b2, T2)
    y = [r for r in d.collect() if r.k == "y"]
    assert len(y) == 1 and y[0].is_active


def test_e23_same_batch_twice_is_noop(spark):
    b = inc(spark, [("x", "1", 1, dt.datetime(2024, 7, 1)), ("y", None, None, None)])
    d1 = load2(empty_scd2(b, KEYS, ATTRS, "sk", TS), b, T1)
    d2 = load2(d1, b, T2)
    assert sorted(d1.collect()) == sorted(d2.collect())


# ------------------------------------------------------------ fingerprint

def test_e24_fingerprint_encodings(spark):
    df = spark.createDataFrame([("a||b", "c"), ("a", "b||c"), ("~", None), (None, "~")], "p string, q string")
    lp = [r[0] for r in df.select(hash_diff(["p", "q"])).collect()]
    plain = [r[0] for r in df.select(hash_diff(["p", "q"], "plain")).collect()]
    assert len(set(lp)) == 4
    assert plain[0] == plain[1] and plain[2] == plain[3]
    with pytest.raises(ValueError):
        hash_diff(["p"], "base64")


# ------------------------------------------------------------ checks, config

def test_e29_two_active_rows_fail(spark):
    d = spark.createDataFrame([("x", True), ("x", True), ("y", True)], "k string, is_active boolean")
    with pytest.raises(checks.ContractError):
        checks.enforce(checks.active_unique(d, ["k"]), "dim")


def test_e30_unknown_scd_type_rejected(spark):
    from strata.plans.entities import EntitySpec
    schema = inc(spark, []).schema
    with pytest.raises(ValueError):
        EntitySpec(name="x", keys=("k",), schema=schema, kind="dimension", scd_type=3, sk="x_sk",
                   gold_table="dim_x")
    with pytest.raises(ValueError):
        EntitySpec(name="x", keys=("nope",), schema=schema, kind="dimension", scd_type=1, sk="x_sk",
                   gold_table="dim_x")
    with pytest.raises(ValueError, match="change_time"):
        EntitySpec(name="x", keys=("k",), schema=schema, kind="dimension", scd_type=1, sk="x_sk",
                   gold_table="dim_x", change_time="MODIFIED")


# ------------------------------------------------------------ fold == replay

def test_fold_equals_replay_on_events(spark):
    """30 daily SCD2 loads through ``scd2`` equal one ``scd2_replay``."""
    from tests.conftest import SF_SMALL
    from strata.operators.dedup import latest_per_key
    from strata.plans import silver
    from pyspark.sql.types import TimestampNTZType
    ntz = TimestampNTZType()
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn(silver.BRONZE_DATE, F.to_date("ts"))
    days = sorted(r[0] for r in ev.select(silver.BRONZE_DATE).distinct().collect())
    keys, attrs = ["user_id"], ["event_type"]
    dim = empty_scd2(ev, keys, attrs, "user_sk", ntz)
    for d in days:
        state, _ = silver.current_state(ev.where(F.col(silver.BRONZE_DATE) <= F.lit(d)), keys, "ts")
        load_ts = dt.datetime.combine(d + dt.timedelta(days=1), dt.time())
        dim = scd2(dim, state, keys, attrs, "ts", "user_sk", load_ts, ts_type=ntz).checkpoint()
    from strata.operators.cleanse import cleanse_strings
    states = latest_per_key(cleanse_strings(ev), ["user_id", silver.BRONZE_DATE], ["ts"])
    states = states.withColumn("_lts", F.date_add(silver.BRONZE_DATE, 1).cast("timestamp_ntz"))
    replay = scd2_replay(states, keys, attrs, "ts", silver.BRONZE_DATE, "_lts", "user_sk")
    a, b = sorted(dim.collect()), sorted(replay.select(*dim.columns).collect())
    assert len(a) == 314
    assert a == b


def test_null_key_matches_itself(spark):
    b = inc(spark, [(None, "1", 1, None), ("x", "1", 1, None)])
    d1 = scd1(empty_scd1(b, KEYS, ATTRS, "sk", TS), b, KEYS, ATTRS, "sk", T1, ts_type=TS).checkpoint()
    d2 = scd1(d1, b, KEYS, ATTRS, "sk", T2, ts_type=TS)
    assert d2.count() == 2
    e1 = load2(empty_scd2(b, KEYS, ATTRS, "sk", TS), b, T1)
    e2 = load2(e1, inc(spark, [(None, "2", 1, None), ("x", "1", 1, None)]), T2)
    assert checks.active_unique(e2, KEYS).first().ok and e2.count() == 3


def test_duplicate_incoming_keys_fail_the_load(spark, layout):
    from strata.plans import dimensions, runner
    from strata.plans.entities import EntitySpec
    from strata.sources import tables
    spec = EntitySpec(name="d", keys=("k",), schema=inc(spark, []).schema, kind="dimension", scd_type=1,
                      sk="d_sk", gold_table="dim_d", change_time="m")
    runner.declare(spark, layout, [spec])
    dup = inc(spark, [("x", "1", 1, None), ("x", "2", 1, None)]).withColumn("silver_load_ts", F.lit(None).cast("timestamp"))
    tables.replace(spark, layout.silver(spec), dup)
    with pytest.raises(checks.ContractError):
        dimensions.load(spark, spec, layout, T1)


def test_column_added_to_gold_is_carried_next_load(spark, layout):
    """Target-driven projection: ALTER the gold table, the next load fills it."""
    from strata.plans import dimensions, runner
    from strata.plans.entities import EntitySpec
    from strata.sources import tables
    schema = inc(spark, []).schema
    spec = EntitySpec(name="t", keys=("k",), schema=schema, kind="dimension", scd_type=1, sk="t_sk",
                      gold_table="dim_t", change_time="m", carried=("k", "a"))
    runner.declare(spark, layout, [spec])
    rows = inc(spark, [("x", "1", 7, None)]).withColumn("silver_load_ts", F.lit(None).cast("timestamp"))
    tables.replace(spark, layout.silver(spec), rows)
    dimensions.load(spark, spec, layout, T1)
    assert "b" not in spark.table(layout.gold(spec)).columns
    spark.sql(f"ALTER TABLE {layout.gold(spec)} ADD COLUMNS (b int)")
    dimensions.load(spark, spec, layout, T2)
    (r,) = spark.table(layout.gold(spec)).collect()
    assert r.b == 7 and r.t_sk == 1
