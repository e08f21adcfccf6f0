"""Landing -> bronze: bring in every delivered date that the table lacks.

The dates to load are a set difference taken anew on each run: folders present
in landing, less partitions present in the table.  Nothing is remembered
between runs, so a skipped day is found by the next one.  Loading a date again
overwrites that date alone.  Columns that the source has gained are added to
the table.

What a date was loaded from is kept beside the table: path, size and time of
each file, one folder per date.  ``late_files`` compares it with what landing
holds now, so a file added to a date after it was loaded (or replaced, or
removed) is found; ``late="reload"`` loads such dates again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.plans.entities import EntitySpec, Layout
from strata.plans.silver import BRONZE_DATE
from strata.session import written
from strata.sources import landing, tables


def pending_dates(landing_dates: DataFrame, loaded_dates: DataFrame, col: str = BRONZE_DATE) -> DataFrame:
    """Set difference of two date frames (NULL loaded dates ignored), sorted."""
    loaded = loaded_dates.select(F.col(col)).where(F.col(col).isNotNull())
    return landing_dates.select(col).distinct().join(loaded, col, "left_anti").orderBy(col)


def loaded_dates(spark: SparkSession, table: str, col: str = BRONZE_DATE) -> DataFrame:
    """Dates present in bronze, from the catalog's partition list (no data scan)."""
    return landing.dates_frame(spark, tables.partitions(spark, table), col)


def files_root(spec: EntitySpec, layout: Layout) -> str:
    return layout.storage("bronze", f"_files/{spec.name}")


def note_files(spark: SparkSession, spec: EntitySpec, layout: Layout, files: DataFrame, dates: Sequence[str]) -> None:
    """Replace what is kept for the given dates; a date without a file keeps one row without a path."""
    each = landing.dates_frame(spark, dates, BRONZE_DATE).join(files, BRONZE_DATE, "left")
    (each.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BRONZE_DATE).parquet(files_root(spec, layout)))


def noted_files(spark: SparkSession, spec: EntitySpec, layout: Layout) -> DataFrame:
    """What is kept: (date, path, size, modified) of the files that the loaded dates came from."""
    root = files_root(spec, layout)
    schema = StructType.fromDDL(f"path string, size bigint, modified timestamp, {BRONZE_DATE} date")
    noted = landing.landing_dates(spark, root, BRONZE_DATE)
    if not noted:
        return spark.createDataFrame([], schema)
    kept = spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/{BRONZE_DATE}={d}" for d in noted])
    return kept.where("path is not null")


def late_files(spark: SparkSession, spec: EntitySpec, layout: Layout) -> DataFrame:
    """(date, path, change): files of loaded dates that differ from those the dates were loaded from.

    ``change`` is added, changed (another size or time) or removed.  A date that
    was loaded without such notes shows all its files as added.
    """
    root = layout.landing_dir(spec)
    loaded = set(tables.partitions(spark, layout.bronze(spec)))
    there = [d for d in landing.landing_dates(spark, root) if d in loaded]
    now = landing.delivered_files(spark, root, there, BRONZE_DATE)
    held = noted_files(spark, spec, layout).where(F.col(BRONZE_DATE).cast("string").isin(sorted(loaded)))
    j = now.alias("n").join(held.alias("h"), [BRONZE_DATE, "path"], "full_outer")
    change = (F.when(F.col("h.size").isNull(), "added").when(F.col("n.size").isNull(), "removed")
              .when((F.col("n.size") != F.col("h.size")) | (F.col("n.modified") != F.col("h.modified")), "changed"))
    return j.select(BRONZE_DATE, "path", change.alias("change")).where(F.col("change").isNotNull())


def load(spark: SparkSession, spec: EntitySpec, layout: Layout,
         dates: Sequence[str] | None = None, skipped: str = "report", late: str = "ignore") -> dict:
    """Load pending (or the given) dates; returns {dates, rows}, and {skipped}, {late} if any.

    ``skipped`` lists landing folders whose value is no date; with
    ``skipped="fail"`` they stop the load.  ``late`` lists loaded dates whose
    files have changed since: not looked for with ``"ignore"``, named with
    ``"report"``, named and loaded again with ``"reload"``.
    """
    if late not in ("ignore", "report", "reload"):
        raise ValueError(f"late must be ignore, report or reload, got {late!r}")
    table, root = layout.bronze(spec), layout.landing_dir(spec)
    odd = landing.skipped_folders(spark, root)
    if odd and skipped == "fail":
        raise ValueError(f"{spec.name}: landing folders that are no dates: {odd}")
    noted = {"skipped": odd} if odd else {}
    if late != "ignore":
        found = late_files(spark, spec, layout).select(F.col(BRONZE_DATE).cast("string")).distinct()
        if changed := sorted(r[0] for r in found.collect()):
            noted["late"] = changed
    again = noted.get("late", []) if late == "reload" else []
    if dates is None:
        found = landing.dates_frame(spark, landing.landing_dates(spark, root), BRONZE_DATE)
        todo = [str(r[0]) for r in pending_dates(found, loaded_dates(spark, table)).collect()]
    else:
        todo = [str(d) for d in dates]
    todo = sorted({*todo, *again})
    if not todo:
        return {"dates": [], "rows": 0, **noted}
    present = set(landing.landing_dates(spark, root))
    readable = [d for d in todo if d in present]
    # noted before the rows are read: a file that arrives in between shows as late, never as loaded
    files = landing.delivered_files(spark, root, readable, BRONZE_DATE)
    files = written(files, "files")
    if readable:
        df = landing.read_landing(spark, root, readable, BRONZE_DATE)
    else:
        df = spark.createDataFrame([], spec.bronze_schema())
    rows = tables.replace_partitions(spark, table, df, BRONZE_DATE, todo)
    note_files(spark, spec, layout, files, todo)
    return {"dates": todo, "rows": rows, **noted}
