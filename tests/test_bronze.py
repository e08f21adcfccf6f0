import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.plans import bronze, runner
from strata.plans.entities import EntitySpec
from strata.plans.silver import BRONZE_DATE
from strata.sources import landing, tables

SCHEMA = "id int, v string"


def spec(spark):
    return EntitySpec(name="thing", keys=("id",), schema=StructType.fromDDL(SCHEMA), kind="dimension",
                      scd_type=1, sk="thing_sk", gold_table="dim_thing", change_time=None)


def deliver(spark, layout, s, day, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    landing.write_landing(df, layout.landing_dir(s), F.lit(day).cast("date"), overwrite_dates=True)


def setup(spark, layout):
    s = spec(spark)
    runner.declare(spark, layout, [s])
    return s


def per_day(spark, layout, s):
    b = spark.table(layout.bronze(s))
    return {str(r[0]): r[1] for r in b.groupBy(BRONZE_DATE).agg(F.sort_array(F.collect_list("v"))).collect()}


def test_e9_loads_only_missing_dates(spark, layout):
    s = setup(spark, layout)
    for d in ("2024-07-08", "2024-07-09", "2024-07-10"):
        deliver(spark, layout, s, d, [(1, d)])
    bronze.load(spark, s, layout, dates=["2024-07-08", "2024-07-10"])
    rep = bronze.load(spark, s, layout)
    assert rep == {"dates": ["2024-07-09"], "rows": 1}
    assert sorted(per_day(spark, layout, s)) == ["2024-07-08", "2024-07-09", "2024-07-10"]


def test_e10_nothing_pending(spark, layout):
    s = setup(spark, layout)
    deliver(spark, layout, s, "2024-07-08", [(1, "a")])
    bronze.load(spark, s, layout)
    assert bronze.load(spark, s, layout) == {"dates": [], "rows": 0}


def test_e11_reload_replaces_only_that_date(spark, layout):
    s = setup(spark, layout)
    for d in ("2024-07-08", "2024-07-09", "2024-07-10"):
        deliver(spark, layout, s, d, [(1, "old")])
    bronze.load(spark, s, layout)
    deliver(spark, layout, s, "2024-07-09", [(1, "new"), (2, "new")])
    bronze.load(spark, s, layout, dates=["2024-07-09"])
    assert per_day(spark, layout, s) == {"2024-07-08": ["old"], "2024-07-09": ["new", "new"],
                                         "2024-07-10": ["old"]}


def test_e12_new_column_in_one_date(spark, layout):
    s = setup(spark, layout)
    deliver(spark, layout, s, "2024-07-08", [(1, "a")])
    deliver(spark, layout, s, "2024-07-09", [(2, "b", "extra")], SCHEMA + ", w string")
    bronze.load(spark, s, layout)
    rows = {r.id: r.w for r in spark.table(layout.bronze(s)).collect()}
    assert rows == {1: None, 2: "extra"}


def test_e13_malformed_directory_ignored(spark, layout):
    s = setup(spark, layout)
    deliver(spark, layout, s, "2024-07-08", [(1, "a")])
    spark.createDataFrame([(9, "junk")], SCHEMA).write.parquet(f"{layout.landing_dir(s)}/ingest_date=bad")
    assert landing.landing_dates(spark, layout.landing_dir(s)) == ["2024-07-08"]
    bronze.load(spark, s, layout)
    b = spark.table(layout.bronze(s))
    assert dict(b.dtypes)[BRONZE_DATE] == "date" and b.count() == 1


def test_e14_forced_reload_with_zero_rows_empties_date(spark, layout):
    s = setup(spark, layout)
    deliver(spark, layout, s, "2024-07-08", [(1, "a")])
    deliver(spark, layout, s, "2024-07-09", [(2, "b")])
    bronze.load(spark, s, layout)
    # The source re-delivers 9 July as an empty file (a second landing root,
    # since landing files are never deleted here).
    import dataclasses
    s2 = dataclasses.replace(s, landing_name="thing_redelivered")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{layout.landing_dir(s2)}/ingest_date=2024-07-09")
    rep = bronze.load(spark, s2, layout, dates=["2024-07-09"])
    assert rep["rows"] == 0
    assert per_day(spark, layout, s) == {"2024-07-08": ["a"]}


def test_pending_dates_operator(spark):
    f = landing.dates_frame(spark, ["2024-07-08", "2024-07-09", "2024-07-10"], BRONZE_DATE)
    l = landing.dates_frame(spark, ["2024-07-08", "2024-07-10"], BRONZE_DATE).union(
        spark.createDataFrame([(None,)], f"{BRONZE_DATE} date"))
    assert [r[0] for r in bronze.pending_dates(f, l).collect()] == [dt.date(2024, 7, 9)]


def test_replace_keeps_table_external_and_old_files(spark, layout):
    s = setup(spark, layout)
    name = layout.silver(s)
    before = tables.location(spark, name)
    df = spark.createDataFrame([(1, "a", None)], "id int, v string, silver_load_ts timestamp")
    tables.replace(spark, name, df)
    assert tables.location(spark, name) != before
    assert tables.describe(spark, name)["Type"] == "EXTERNAL"
    assert spark.table(name).count() == 1


def test_tables_reattach_after_catalog_loss(spark, layout):
    """A new session on an in-memory catalog re-declares the tables: silver
    points at its newest committed state again, bronze recovers its dates."""
    s = setup(spark, layout)
    deliver(spark, layout, s, "2024-07-08", [(1, "a")])
    deliver(spark, layout, s, "2024-07-09", [(2, "b")])
    bronze.load(spark, s, layout)
    df = spark.createDataFrame([(1, "first", None)], "id int, v string, silver_load_ts timestamp")
    tables.replace(spark, layout.silver(s), df)
    tables.replace(spark, layout.silver(s), df.withColumn("v", F.lit("second")))
    for t in (layout.bronze(s), layout.silver(s)):
        spark.sql(f"DROP TABLE {t}")          # external: files stay
    runner.declare(spark, layout, [s])
    assert [r.v for r in spark.table(layout.silver(s)).collect()] == ["second"]
    assert sorted(per_day(spark, layout, s)) == ["2024-07-08", "2024-07-09"]
    assert bronze.load(spark, s, layout) == {"dates": [], "rows": 0}


def test_delivery_order_does_not_change_silver(spark):
    """Same three days loaded one by one in a scrambled order, or at once:
    silver is identical."""
    import dataclasses
    from strata.plans import silver
    from strata.workloads import _layout
    days = {"2024-07-08": [(1, "a"), (2, "a")], "2024-07-09": [(1, "b")], "2024-07-10": [(2, "c"), (3, "c")]}
    states = []
    for order in (["2024-07-10", "2024-07-08", "2024-07-09"], None):
        lay = _layout(spark, "order")
        s = setup(spark, lay)
        for d, rows in days.items():
            deliver(spark, lay, s, d, rows)
        if order:
            for d in order:
                bronze.load(spark, s, lay, dates=[d])
        else:
            bronze.load(spark, s, lay)
        silver.load(spark, s, lay, "2024-07-11 00:00:00")
        states.append(sorted(tuple(r) for r in spark.table(lay.silver(s)).drop("silver_load_ts").collect()))
    assert states[0] == states[1] == [(1, "B"), (2, "C"), (3, "C")]


def test_rows_without_key_are_quarantined_not_lost(spark, layout):
    from strata.plans import silver
    s = setup(spark, layout)
    deliver(spark, layout, s, "2024-07-08", [(1, "a"), (None, "lost?"), (2, "b")])
    bronze.load(spark, s, layout)
    rep = silver.load(spark, s, layout, "2024-07-09 00:00:00")
    assert rep == {"rows": 2, "rejected": 1}
    q = spark.table(silver.rejected_table(layout, s)).collect()
    assert [(r.id, r.v, str(r.bronze_ingest_date)) for r in q] == [(None, "LOST?", "2024-07-08")]


def test_column_names_match_like_spark_resolves_them(spark, layout):
    s = setup(spark, layout)
    deliver(spark, layout, s, "2024-07-08", [(1, "a")], "ID int, V string")
    bronze.load(spark, s, layout)
    b = spark.table(layout.bronze(s))
    assert b.columns == ["id", "v", "bronze_ingest_date"] and [(r.id, r.v) for r in b.collect()] == [(1, "a")]


def test_impossible_calendar_date_is_ignored(spark, layout):
    s = setup(spark, layout)
    deliver(spark, layout, s, "2024-02-28", [(1, "a")])
    spark.createDataFrame([(9, "x")], SCHEMA).write.parquet(f"{layout.landing_dir(s)}/ingest_date=2024-02-30")
    assert landing.landing_dates(spark, layout.landing_dir(s)) == ["2024-02-28"]
