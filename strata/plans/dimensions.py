"""Silver -> gold dimensions (SCD type 1 or 2).

Keys and fingerprints are compared first.  If nothing is new or changed the
table is left alone.

Type 1: the next state is written to a fresh directory and made the table's.

Type 2: active and closed versions are stored apart.  A load writes the active
rows anew and adds the versions it closes to the closed ones, which are
neither read nor written.  Before they are published, the versions of the keys
that changed are checked (one active version, no overlapping validity); those of
all other keys are what an earlier load checked.  ``full_check`` goes over the whole
history.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import checks
from strata.operators.scd import (ACTION, ACTIVE, END, SCD1_MANAGED, SCD2_MANAGED, START, VERSION, changes, scd1,
                                  scd2_parts)
from strata.plans.entities import EntitySpec, Layout, target_carried
from strata.sources import tables


def _compared(spark: SparkSession, spec: EntitySpec, layout: Layout):
    """(current rows, incoming rows, attributes, what differs)."""
    current, incoming = spark.table(layout.gold(spec)), spark.table(layout.silver(spec))
    managed = SCD1_MANAGED if spec.scd_type == 1 else SCD2_MANAGED
    attrs = [c for c in target_carried(spark, layout.gold(spec), (spec.sk, *managed)) if c not in spec.keys]
    change_time = spec.change_time if spec.scd_type == 2 else None
    return current, incoming, attrs, changes(current, incoming, spec.keys, attrs, spec.sk, spec.encoding, change_time)


def touched_versions(spec: EntitySpec, diff: DataFrame, parts: Sequence[DataFrame]) -> DataFrame:
    """All versions, in any of the parts, of the keys that a load inserts or updates: keys and managed columns only.

    The changed keys are broadcast when they are few, so history is read in
    these columns and only rows of changed keys go further.
    """
    keys = diff.where(F.col("_status").isin("insert", "update")).select(*spec.keys)
    match = reduce(and_, [F.col(f"v.{k}").eqNullSafe(F.col(f"t.{k}")) for k in spec.keys])
    versions = reduce(DataFrame.unionByName, [p.select(*spec.keys, START, END, ACTIVE, VERSION) for p in parts])
    return versions.alias("v").join(keys.alias("t"), match, "left_semi")


def full_check(spark: SparkSession, spec: EntitySpec, layout: Layout) -> dict:
    """Both contracts over the whole history; raises if one is broken."""
    return checks.enforce(checks.history(spark.table(layout.gold(spec)), spec.keys), f"gold {spec.name}")


def load(spark: SparkSession, spec: EntitySpec, layout: Layout, load_ts, verify: bool = True,
         verify_incoming: bool = True) -> dict:
    """``verify``: the versions of changed keys before they are published (SCD2).
    ``verify_incoming``: one silver row per key first (skip only when the
    silver table was just checked, as ``runner.run`` does)."""
    if spec.kind != "dimension":
        raise ValueError(f"{spec.name} is not a dimension")
    if verify_incoming:
        # A duplicated incoming key would multiply rows in the join: fail first.
        checks.enforce(checks.grain(spark.table(layout.silver(spec)), spec.keys), f"incoming {spec.name}")
    if spec.scd_type == 2:
        tables.settle(spark, layout.gold(spec), ACTIVE)
    current, incoming, attrs, diff = _compared(spark, spec, layout)
    found = {r["_status"]: r["n"] for r in diff.groupBy("_status").agg(F.count(F.lit(1)).alias("n")).collect()}
    inserted, updated = found.get("insert", 0), found.get("update", 0)
    out = {"inserted": inserted, "updated": updated}
    if not inserted + updated:
        active = F.count_if(F.col(ACTIVE)) if spec.scd_type == 2 else F.count(F.lit(1))
        same = current.agg(F.count(F.lit(1)).alias("rows"), active.alias("active")).first()
        return {**out, "rows": same["rows"], "unchanged": same["active"], "active": same["active"]}
    if spec.scd_type == 1:
        state = scd1(current, incoming, spec.keys, attrs, spec.sk, load_ts, spec.encoding, spec.ts_type, diff=diff)
        rows = int(tables.replace(spark, layout.gold(spec), state, observe=[F.count(F.lit(1)).alias("rows")])["rows"])
        return {**out, "rows": rows, "unchanged": rows - inserted - updated, "active": rows}
    active, closed = scd2_parts(current, incoming, spec.keys, attrs, spec.change_time, spec.sk, load_ts,
                                spec.encoding, spec.ts_type, diff)
    before = current.where(~F.col(ACTIVE))
    old = before.count()

    def check(written: list[DataFrame]) -> None:
        if verify:
            versions = touched_versions(spec, diff, [*written, *([before] if old else [])])
            checks.enforce(checks.history(versions, spec.keys), f"gold {spec.name}")
    rows = int(tables.replace_history(spark, layout.gold(spec), active, closed if updated else None, ACTIVE,
                                      helpers=[ACTION], check=check, observe=[F.count(F.lit(1)).alias("rows")])["rows"])
    return {**out, "rows": rows + old + updated, "unchanged": rows - inserted - updated, "active": rows}
