"""Silver -> gold facts: resolve the dimension version valid on the event date.

A fact is current-state and rebuilt in full each run (deterministic, so
re-runnable).  The fact's own key is numbered in scan order of the silver
table; the dimension key comes from the effective-dated join.  Orphans are
counted and reported, not dropped.

Grain (one row per business key).  Silver holds one row per key and a left
join never drops a row, so the facts keep the grain exactly when as many rows
were written as silver holds: a fact can only be doubled by two overlapping
versions.  Both are counted in stored files (Parquet row counts, no column is
read), so a repeated task cannot change them, and before the new state is
published.  ``verify="full"`` also groups the new state by business key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.operators import checks
from strata.operators.effective_join import resolve
from strata.operators.scd import LOAD_TS, ts_literal
from strata.operators.surrogate import number_scan
from strata.plans.entities import EntitySpec, Layout, target_carried
from strata.sources import tables


def load(spark: SparkSession, spec: EntitySpec, dim: EntitySpec, layout: Layout, load_ts,
         strategy: str = "auto", verify: str | bool = "counts") -> dict:
    if spec.kind != "fact" or dim.kind != "dimension" or dim.scd_type != 2:
        raise ValueError(f"{spec.name}: facts resolve against an SCD2 dimension")
    carried = target_carried(spark, layout.gold(spec), (spec.sk, dim.sk, LOAD_TS))
    silver = spark.table(layout.silver(spec))
    link = spec.link_key or dim.keys[0]
    out = resolve(number_scan(silver.select(*carried), spec.sk), spark.table(layout.gold(dim)), link, spec.event_date,
                  sk=dim.sk, dim_key=link, strategy=strategy, salt_cols=list(spec.keys), key_rows=silver.select(link, spec.event_date))
    out = out.withColumn(LOAD_TS, ts_literal(load_ts, spec.ts_type))
    counts: dict = {}

    def check(state: DataFrame) -> None:
        found = checks.orphans(state, dim.sk).first()
        counts.update(rows=found["total_rows"], orphans=found["orphan_rows"])
        more = counts["rows"] - silver.count() if verify else 0
        if more:
            raise checks.ContractError(
                f"gold {spec.name}: {more} fact rows matched more than one "
                f"version of {dim.name} (overlapping validity intervals); grain broken")
        if verify == "full":
            checks.enforce(checks.grain(state, spec.keys), f"gold {spec.name}")
    tables.replace(spark, layout.gold(spec), out, check=check)
    return counts
