"""Command line: the same loads, parameterised per run (for spark-submit).

    python -m strata declare --root s3://lake/clinical
    python -m strata run     --root s3://lake/clinical --load-ts "2026-07-11 06:00:00"
    python -m strata load silver --entity dm --root s3://lake/clinical --load-ts "..."
    python -m strata report  --root s3://lake/clinical

Entities come from ``--registry module:function`` (a callable returning
``EntitySpec`` objects); the default is the ten clinical domains.  The
session is whatever ``spark-submit`` configures; only the time zone is
pinned to UTC when unset.
"""

from __future__ import annotations

import argparse
import importlib
import json
import sys

from pyspark.sql import SparkSession


def _entities(registry: str | None):
    if not registry:
        from strata.plans.clinical import clinical_entities
        return list(clinical_entities().values())
    mod, _, fn = registry.partition(":")
    out = getattr(importlib.import_module(mod), fn or "entities")()
    return list(out.values()) if isinstance(out, dict) else list(out)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="strata")
    p.add_argument("command", choices=["declare", "run", "load", "report"])
    p.add_argument("layer", nargs="?", choices=["bronze", "silver", "gold"])
    p.add_argument("--root", required=True)
    p.add_argument("--bronze-db", default="bronze")
    p.add_argument("--silver-db", default="silver")
    p.add_argument("--gold-db", default="gold")
    p.add_argument("--registry")
    p.add_argument("--entity", action="append", help="restrict to these entity names")
    p.add_argument("--load-ts")
    p.add_argument("--dates", help="bronze: comma-separated dates to (re)load")
    p.add_argument("--parallel", type=int, default=4)
    a = p.parse_args(argv)

    from strata.operators import checks
    from strata.plans import bronze, dimensions, facts, runner, silver
    from strata.plans.entities import Layout
    from strata.sources import tables

    spark = SparkSession.builder.appName(f"strata-{a.command}").getOrCreate()
    if not spark.conf.get("spark.sql.session.timeZone", None):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    layout = Layout(a.root, a.bronze_db, a.silver_db, a.gold_db)
    specs = _entities(a.registry)
    by_name = {s.name: s for s in specs}
    chosen = [by_name[n] for n in a.entity] if a.entity else specs
    runner.declare(spark, layout, specs)

    if a.command == "declare":
        tables.inventory(spark, [a.bronze_db, a.silver_db, a.gold_db]).show(100, truncate=False)
    elif a.command == "run":
        if not a.load_ts:
            p.error("run needs --load-ts")
        report = runner.run(spark, layout, chosen, a.load_ts, parallel=a.parallel, on_error="report")
        report.show(100, truncate=False)
        return 1 if report.where("status = 'failed'").count() else 0
    elif a.command == "load":
        if not a.layer or (a.layer != "bronze" and not a.load_ts):
            p.error("load needs a layer, and --load-ts for silver and gold")
        for s in chosen:
            if a.layer == "bronze":
                dates = a.dates.split(",") if a.dates else None
                out = bronze.load(spark, s, layout, dates)
            elif a.layer == "silver":
                out = silver.load(spark, s, layout, a.load_ts)
            elif s.kind == "dimension":
                out = dimensions.load(spark, s, layout, a.load_ts)
            else:
                out = facts.load(spark, s, by_name[s.dimension], layout, a.load_ts)
            print(json.dumps({"entity": s.name, "layer": a.layer, **out}))
    else:  # report: contracts on the current gold tables
        for s in chosen:
            g = spark.table(layout.gold(s))
            if s.kind == "dimension" and s.scd_type == 2:
                row = dimensions.full_check(spark, s, layout)
            elif s.kind == "fact":
                row = {**checks.grain(g, s.keys).first().asDict(),
                       "orphan_rows": checks.orphans(g, by_name[s.dimension].sk).first()["orphan_rows"]}
            else:
                row = checks.grain(g, s.keys).first().asDict()
            print(json.dumps({"entity": s.name, "table": layout.gold(s), **row}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
