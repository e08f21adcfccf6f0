"""Registry-driven load: the same jobs for every entity, dimensions first.

``declare`` creates the three databases and three tables per entity
(idempotent).  ``run`` loads landing -> bronze -> silver -> gold for a list of
entities and returns one report row per entity, also for those that failed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from strata.operators.scd import ACTIVE
from strata.plans import bronze, dimensions, facts, silver
from strata.plans.entities import EntitySpec, Layout
from strata.plans.silver import BRONZE_DATE
from strata.sources import tables

REPORT_SCHEMA = ("entity string, kind string, bronze_dates_loaded int, bronze_rows_loaded long, bronze_folders_skipped int, "
                 "silver_rows long, silver_rejected long, gold_rows long, gold_active long, "
                 "inserted long, updated long, unchanged long, orphans long, status string, error string")
#: Characters of an error that the report keeps (a Spark error can carry a whole plan).
ERROR_CHARS = 1000

LAYER_COMMENTS = {
    "bronze": "Every delivered row as it came, by ingest date.",
    "silver": "The newest cleansed row of each business key.",
    "gold": "Dimensions with their history, and the facts that refer to them.",
}


def declare(spark: SparkSession, layout: Layout, specs: Sequence[EntitySpec]) -> None:
    by_name = {s.name: s for s in specs}
    for layer, db in (("bronze", layout.bronze_db), ("silver", layout.silver_db), ("gold", layout.gold_db)):
        tables.declare_database(spark, db, f"{layout.root.rstrip('/')}/{layer}/_db", LAYER_COMMENTS[layer])
    for s in specs:
        tables.declare_table(spark, layout.bronze(s), s.bronze_schema(),
                             layout.storage("bronze", s.name), partition_by=[BRONZE_DATE],
                             comment=f"Raw history of {s.name}, one partition per ingest date")
        tables.declare_table(spark, layout.silver(s), s.silver_schema(), layout.storage("silver", s.name),
                             comment=f"Current state of {s.name}, one row per {', '.join(s.keys)}")
        fk = by_name[s.dimension].sk if s.kind == "fact" and s.dimension in by_name else None
        what = f"SCD type {s.scd_type} dimension" if s.kind == "dimension" else f"fact, grain {', '.join(s.keys)}"
        gold, root, comment = layout.gold(s), layout.storage("gold", s.gold_table), f"{what} from {s.name}"
        if s.scd_type == 2:
            tables.declare_history(spark, gold, s.gold_schema(fk), root, ACTIVE, comment)
        else:
            tables.declare_table(spark, gold, s.gold_schema(fk), root, comment=comment)


def _order(specs: Sequence[EntitySpec]) -> list[EntitySpec]:
    return [s for s in specs if s.kind == "dimension"] + [s for s in specs if s.kind == "fact"]


class LoadsFailed(RuntimeError):
    """Some entities failed; ``report`` has a row for every entity, those that were loaded too."""

    def __init__(self, message: str, report: DataFrame):
        super().__init__(message)
        self.report = report


@dataclass
class _Outcome:
    """How far one entity came: the results of its steps, and why it stopped if it did."""

    status: str = "ok"
    error: str | None = None
    steps: dict[str, dict] = field(default_factory=dict)


def _step(name: str, fn: Callable[[EntitySpec], dict], specs: Sequence[EntitySpec], outcomes: dict[str, _Outcome],
          workers: int) -> None:
    """Run one load step for independent entities as concurrent Spark jobs; an error stops its own entity alone."""
    def one(s: EntitySpec) -> None:
        out = outcomes[s.name]
        if out.status != "ok":
            return
        try:
            out.steps[name] = fn(s)
        except Exception as e:  # whatever a job raises is this entity's outcome
            text = f"{name}: {type(e).__name__}: {e}"
            out.status, out.error = "failed", text[:ERROR_CHARS]
    if workers <= 1 or len(specs) <= 1:
        for s in specs:
            one(s)
        return
    with ThreadPoolExecutor(max_workers=min(workers, len(specs))) as pool:
        list(pool.map(one, specs))


def _report_row(s: EntitySpec, out: _Outcome) -> tuple:
    """Counts of the steps that were done; the rest is NULL."""
    bronze_, silver_, gold_ = (out.steps.get(name, {}) for name in ("bronze", "silver", "gold"))
    dates, skipped = bronze_.get("dates"), len(bronze_.get("skipped", [])) if bronze_ else None
    return (s.name, s.kind, None if dates is None else len(dates), bronze_.get("rows"), skipped,
            silver_.get("rows"), silver_.get("rejected"), gold_.get("rows"),
            *[gold_.get(c) if s.kind == "dimension" else None for c in ("active", "inserted", "updated", "unchanged")],
            gold_.get("orphans"), out.status, out.error)


def run(spark: SparkSession, layout: Layout, specs: Sequence[EntitySpec], load_ts,
        dates: dict[str, Sequence[str]] | None = None, join_strategy: str = "auto",
        parallel: int = 4, on_error: str = "raise") -> DataFrame:
    """One load cycle; facts need their SCD2 dimension in ``specs``.

    Stages run in order (bronze, silver, dimensions, facts); inside a stage
    the entities are independent and up to ``parallel`` of them load at once,
    so small entities do not leave the cluster idle.

    An entity that fails stops alone, the others go on; facts of a dimension that
    failed are skipped, as they would refer to an old state of it.  The report has
    a status (ok, failed, skipped) and an error for each entity.  At the end
    ``LoadsFailed`` is raised if any failed, with the report; ``on_error="report"``
    returns it instead.
    """
    if on_error not in ("raise", "report"):
        raise ValueError(f"on_error must be raise or report, got {on_error!r}")
    by_name = {s.name: s for s in specs}
    for s in specs:
        if s.kind == "fact" and s.dimension not in by_name:
            raise ValueError(f"{s.name}: dimension {s.dimension!r} is not part of this run")
    ordered = _order(specs)
    dims = [s for s in ordered if s.kind == "dimension"]
    fcts = [s for s in ordered if s.kind == "fact"]
    outcomes = {s.name: _Outcome() for s in ordered}
    _step("bronze", lambda s: bronze.load(spark, s, layout, (dates or {}).get(s.name)), ordered, outcomes, parallel)
    _step("silver", lambda s: silver.load(spark, s, layout, load_ts), ordered, outcomes, parallel)
    # silver keeps one row per key by its top-1, so the dimension load
    # need not check its incoming side again.
    _step("gold", lambda s: dimensions.load(spark, s, layout, load_ts, verify_incoming=False), dims, outcomes, parallel)
    for s in fcts:
        if outcomes[s.name].status == "ok" and outcomes[s.dimension].status != "ok":
            outcomes[s.name].status = "skipped"
            outcomes[s.name].error = f"gold: dimension {s.dimension} {outcomes[s.dimension].status}"
    _step("gold", lambda s: facts.load(spark, s, by_name[s.dimension], layout, load_ts, strategy=join_strategy),
          fcts, outcomes, parallel)
    report = spark.createDataFrame([_report_row(s, outcomes[s.name]) for s in ordered], REPORT_SCHEMA)
    failed = {n: o.error for n, o in outcomes.items() if o.status == "failed"}
    if failed and on_error == "raise":
        raise LoadsFailed("; ".join(f"{n}: {e}" for n, e in failed.items()), report)
    return report
