"""The ten clinical entities, loaded twice through the runner on generated rows."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegerType, StringType, TimestampType

from strata.operators import checks
from strata.plans import runner
from strata.plans.clinical import clinical_entities
from strata.sources import landing, tables

N_SUBJECTS, N_ROWS = 12, 40


def generate(spark, spec, day: str, variant: int):
    n = N_SUBJECTS if spec.name == "dm" else N_ROWS
    i = F.col("id")
    cols = []
    for f in spec.schema.fields:
        name, t = f.name, f.dataType
        if name == "USUBJID":
            c = F.concat(F.lit(" subj-"), (i % N_SUBJECTS).cast("string"))
        elif name == "STUDYID":
            c = F.lit("study-1 ")
        elif name == "DOMAIN":
            c = F.lit(spec.name)
        elif name == "MODIFIED_TS":
            base = "2023-12-01 08:00:00" if variant == 0 else "2024-01-05 08:00:00"
            c = F.lit(base).cast("timestamp") + F.make_interval(secs=i.cast("int"))
        elif name in spec.keys and isinstance(t, StringType):
            c = F.concat(F.lit(name.lower()[:2]), i.cast("string"))
        elif name in spec.keys:
            c = i.cast(t)
        elif isinstance(t, DateType):
            c = F.date_add(F.lit("2024-01-10").cast("date"), -(i % 10).cast("int"))
        elif isinstance(t, DecimalType):
            c = (i % 100 / 10).cast(t)
        elif isinstance(t, IntegerType):
            c = (i % 7).cast("int")
        elif isinstance(t, TimestampType):
            c = F.lit(day).cast("timestamp")
        else:
            # The second delivery changes DM attributes of every other subject.
            bump = F.when(F.lit(variant == 1) & (i % 2 == 0), F.lit("x")).otherwise(F.lit(""))
            c = F.concat(F.lit(" v"), (i % 5).cast("string"), bump, F.lit(" "))
        cols.append(c.cast(t).alias(name))
    return spark.range(n).select(*cols)


def test_clinical_model_two_cycles(spark, layout):
    specs = list(clinical_entities().values())
    runner.declare(spark, layout, specs)
    runner.declare(spark, layout, specs)  # idempotent
    for s in specs:
        landing.write_landing(generate(spark, s, "2024-01-01", 0), layout.landing_dir(s),
                              F.lit("2024-01-01").cast("date"))
    r1 = {r.entity: r for r in runner.run(spark, layout, specs, dt.datetime(2024, 1, 1, 12)).collect()}
    assert r1["dm"].gold_rows == N_SUBJECTS and r1["dm"].inserted == N_SUBJECTS
    assert all(r1[n].orphans == 0 and r1[n].gold_rows == N_ROWS for n in r1 if r1[n].kind == "fact")

    dm = clinical_entities()["dm"]
    landing.write_landing(generate(spark, dm, "2024-01-06", 1), layout.landing_dir(dm),
                          F.lit("2024-01-06").cast("date"))
    r2 = {r.entity: r for r in runner.run(spark, layout, specs, dt.datetime(2024, 1, 6, 12)).collect()}
    changed = N_SUBJECTS // 2
    assert r2["dm"].bronze_dates_loaded == 1 and r2["ta"].bronze_dates_loaded == 0
    assert (r2["dm"].updated, r2["dm"].gold_rows, r2["dm"].gold_active) == (
        changed, N_SUBJECTS + changed, N_SUBJECTS)
    assert r2["ta"].unchanged == N_ROWS and r2["ta"].updated == 0

    gold = layout.gold_db
    subj = spark.table(f"{gold}.dim_subject")
    checks.enforce(checks.active_unique(subj, ["USUBJID"]), "dim_subject")
    assert subj.columns[:3] == ["subject_sk", "USUBJID", "STUDYID"]
    # Cleansed on the way: keys trimmed and upper-cased.
    assert subj.where(F.col("USUBJID") == "SUBJ-0").count() == 2

    lab = spark.table(f"{gold}.fact_lab_result")
    assert lab.columns[:2] == ["lab_sk", "subject_sk"]
    assert sorted(r.lab_sk for r in lab.collect()) == list(range(1, N_ROWS + 1))
    v = subj.select("subject_sk", "USUBJID", "record_version")
    joined = lab.join(v, ["subject_sk", "USUBJID"])
    # Changed subjects: labs on or after 6 Jan (change 5 Jan 08:00) use version 2.
    bad = joined.where((F.col("LBDTC") >= F.lit("2024-01-06").cast("date")) & (F.col("record_version") == 1)
                       & F.col("USUBJID").isin([f"SUBJ-{k}" for k in range(0, N_SUBJECTS, 2)]))
    assert joined.count() == N_ROWS and bad.count() == 0

    inv = tables.inventory(spark, [layout.bronze_db, layout.silver_db, layout.gold_db]).collect()
    assert len(inv) == 30 and {r.table_type for r in inv} == {"EXTERNAL"}

    # A cycle with nothing new changes nothing: same versions, keys and load times.
    before = {n: sorted(spark.table(layout.gold(s)).drop("gold_load_ts" if s.kind == "fact" else "_").collect())
              for n, s in ((s.name, s) for s in specs)}
    r3 = {r.entity: r for r in runner.run(spark, layout, specs, dt.datetime(2024, 1, 7, 12)).collect()}
    assert all(r.bronze_dates_loaded == 0 for r in r3.values())
    assert (r3["dm"].inserted, r3["dm"].updated) == (0, 0)
    after = {n: sorted(spark.table(layout.gold(s)).drop("gold_load_ts" if s.kind == "fact" else "_").collect())
             for n, s in ((s.name, s) for s in specs)}
    assert before == after
