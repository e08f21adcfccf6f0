"""Load contracts, each evaluated in one pass and returned as a one-row frame.

Every check has an ``ok`` column; ``enforce`` turns a failed row into an
exception on the driver (the frame holds a handful of numbers).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.dedup import TIED, newest_per_key


class ContractError(AssertionError):
    pass


def grain(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows versus distinct business keys (NULL keys count as a key value).

    Partial aggregation per key first, so the shuffle carries one row per key
    and map task; a hot key costs nothing extra.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("_n") > 1).alias("duplicated_keys"),
    ).withColumn("ok", F.col("total_rows") == F.col("distinct_keys"))


def ambiguous(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keys whose newest rows differ in content, so that none of them is the newest.

    Ties that a newer row has superseded do not count.  One row per key leaves
    each map task.
    """
    return newest_per_key(rows, keys, order).agg(F.count_if(TIED).alias("ambiguous_keys"))


def intervals(dim: DataFrame, keys: Sequence[str], start: str = "start_effective_date",
              end: str = "end_effective_date") -> DataFrame:
    """SCD2: no version ends before it starts, and none starts before the one before it ends."""
    order = Window.partitionBy(*keys).orderBy("record_version")
    before = F.lag(F.struct(F.col(end).alias("end"))).over(order)
    late = before.isNotNull() & (before["end"].isNull() | (F.col(start) < before["end"]))
    return dim.select((F.col(end) < F.col(start)).alias("_b"), late.alias("_l")).agg(
        F.count_if("_b").alias("backward_versions"), F.count_if("_l").alias("overlapping_versions"),
    ).withColumn("ok", (F.col("backward_versions") == 0) & (F.col("overlapping_versions") == 0))


def active_unique(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SCD2: at most one active version per key, plus active / total counts."""
    per_key = dim.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("is_active")).alias("_a"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("total_rows"),
        F.coalesce(F.sum("_a"), F.lit(0)).cast("long").alias("active_rows"),
        F.count_if(F.col("_a") > 1).alias("keys_with_many_active"),
    ).withColumn("ok", F.col("keys_with_many_active") == 0)


def history(versions: DataFrame, keys: Sequence[str], start: str = "start_effective_date",
            end: str = "end_effective_date") -> DataFrame:
    """``intervals`` and ``active_unique`` of SCD2 versions in one pass with one shuffle by key."""
    order = Window.partitionBy(*keys).orderBy("record_version")
    before = F.lag(F.struct(F.col(end).alias("end"))).over(order)
    late = before.isNotNull() & (before["end"].isNull() | (F.col(start) < before["end"]))
    active = F.coalesce(F.col("is_active"), F.lit(False))
    # counted at the second active row of a key alone
    again = active & (F.sum(active.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)) == 2)
    return versions.select(active.alias("_a"), again.alias("_m"), (F.col(end) < F.col(start)).alias("_b"), late.alias("_l")).agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if("_a").alias("active_rows"),
        F.count_if("_m").alias("keys_with_many_active"), F.count_if("_b").alias("backward_versions"),
        F.count_if("_l").alias("overlapping_versions"),
    ).withColumn("ok", (F.col("keys_with_many_active") + F.col("backward_versions") + F.col("overlapping_versions")) == 0)


def orphans(fact: DataFrame, fk: str = "subject_sk") -> DataFrame:
    """Fact rows whose dimension key did not resolve (a warning, not a failure)."""
    return fact.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(fk).isNull()).alias("orphan_rows"),
    ).withColumn("ok", F.lit(True))


def enforce(report: DataFrame, what: str) -> dict:
    row = report.first().asDict()
    if not row.get("ok", True):
        raise ContractError(f"{what}: contract broken: {row}")
    return row
