"""Dense surrogate keys assigned on a cluster, never through one task.

A global ``row_number()`` without ``partitionBy`` sorts everything in a
single partition.  Instead:

1. range-partition by the ordering columns and sort inside each partition;
2. tag rows with ``monotonically_increasing_id`` (partition index in the high
   bits, position in the low 33 bits) and write that once to shared storage.
   This must come *after* the range exchange: the range partitioner seeds its
   sample with the RDD id, so two evaluations of the same exchange may choose
   different bounds.  From the written rows every pass, and every retry after
   an executor loss, reads the same tags;
3. count rows per partition (one tiny row per partition) and prefix-sum;
4. key = start + offset of the partition + position + 1.

The offsets table has exactly one row per range partition, so broadcasting
it is bounded by the partition count, not the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import written

_POS_BITS = 33
#: Rows that one task may number; beyond it, ranges are numbered in parallel.
ONE_TASK_ROWS = 100_000


def _with_offsets(tagged: DataFrame, name: str, start) -> DataFrame:
    pid = F.shiftright("_sk_mid", _POS_BITS)
    counts = tagged.groupBy(pid.alias("_sk_pid")).agg(F.count(F.lit(1)).alias("_sk_n"))
    before = Window.orderBy("_sk_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_sk_pid", F.coalesce(F.sum("_sk_n").over(before), F.lit(0)).alias("_sk_off"))
    pos = F.col("_sk_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    base = start if isinstance(start, Column) else F.lit(start)
    out = (tagged.join(F.broadcast(offsets), pid == F.col("_sk_pid"))
                 .withColumn(name, (base.cast("long") + F.col("_sk_off") + pos + 1).cast("long")))
    return out.drop("_sk_mid", "_sk_pid", "_sk_off")


def assign_surrogate(df: DataFrame, order: Sequence[str], name: str,
                     start: int | Column = 0, num_partitions: int | None = None,
                     rows: int | None = None) -> DataFrame:
    """Add ``name`` = start + 1, start + 2, ... in ``order`` (dense, unique).

    ``rows``, if given, is the measured number of rows: at most
    ``ONE_TASK_ROWS`` of them are numbered by one task, in the plan that uses
    them, instead of being written first.  The keys are the same.
    Without ``num_partitions`` the range exchange uses the session's shuffle
    partitions and AQE may coalesce them, so a small change set does not
    become hundreds of tiny tasks and files.  Positions are taken
    after the shuffle read, so coalescing cannot break the numbering.
    """
    if rows is not None and rows <= ONE_TASK_ROWS:
        return df.withColumn(name, (F.lit(start) + F.row_number().over(Window.orderBy(*order))).cast("long"))
    ranged = (df.repartitionByRange(num_partitions, *order) if num_partitions
              else df.repartitionByRange(*order))
    tagged = (ranged.sortWithinPartitions(*order)
                .withColumn("_sk_mid", F.monotonically_increasing_id()))
    return _with_offsets(written(tagged, "numbered"), name, start)


def max_key(df: DataFrame, name: str) -> int:
    """Largest existing key (0 for an empty table): one scalar to the driver."""
    v = df.agg(F.max(name)).first()[0]
    return int(v or 0)


def number_scan(df: DataFrame, name: str, start: int = 0) -> DataFrame:
    """Dense unique keys in scan order, without a shuffle or a checkpoint.

    Precondition: ``df`` is a file scan followed only by narrow operators
    (filter, project), so each partition holds the same rows in the same
    order every time it is computed: one pass counts rows per partition,
    the second numbers them.  Use it for large tables that are rebuilt in
    full (facts); the keys follow storage order, not key order.
    """
    return _with_offsets(df.withColumn("_sk_mid", F.monotonically_increasing_id()), name, start)
