"""Newest row per business key (silver current state)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from strata.functions.keys import any_null


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is complete, and rows with any NULL key column.

    A NULL key cannot identify an entity: deduplicating such rows would fold
    unrelated records into one.  They are returned separately so the caller
    can report or park them; nothing is dropped silently.
    """
    bad = any_null(keys)
    return df.where(~bad), df.where(bad)


def _orderable(t) -> bool:
    if isinstance(t, MapType):
        return False
    if isinstance(t, ArrayType):
        return _orderable(t.elementType)
    if isinstance(t, StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    return True


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per key: the greatest by ``order`` (each DESC NULLS LAST).

    ``tiebreak`` (default: every other orderable column, in schema order, also
    DESC NULLS LAST; maps are skipped) makes the winner independent of file
    order and partitioning when the ordering columns tie.  Comparisons only
    reach those columns on a tie.

    Plan: ``row_number() = 1`` lets Catalyst insert a partial WindowGroupLimit
    before the shuffle, so each map task forwards at most one row per key: a
    key holding a third of the data still shuffles only one row per task.
    """
    keys, order = list(keys), list(order)
    if tiebreak is None:
        tiebreak = [f.name for f in df.schema.fields
                    if f.name not in keys and f.name not in order and _orderable(f.dataType)]
    w = Window.partitionBy(*keys).orderBy(
        *[F.col(c).desc_nulls_last() for c in [*order, *tiebreak]])
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1)
              .drop("_rn"))


#: Helper columns of ``newest_per_key``: rows of the key, and whether its newest rows differ.
N_ROWS, TIED = "_n_rows", "_tied"


def content_hash(df: DataFrame) -> Column:
    """64 bits over all columns of a row (a map or variant through its text)."""
    return F.xxhash64(*[F.col(f.name).cast("string") if f.dataType.typeName() in ("map", "variant") else F.col(f.name)
                        for f in df.schema.fields])


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``latest_per_key`` with two helper columns: ``_n_rows`` and ``_tied``.

    A key is tied if rows with its greatest order columns differ in content, so
    that none of them is the newest; rows that a newer one has superseded do not
    count.  One aggregate finds all of it: the greatest row, and the least and the
    greatest content hash *at the greatest order* (the greatest of (order, hash)
    and of (order, inverted hash)).  A map task sends one row for each key, whatever
    the number of ties.  A NULL key is a group like any other.
    """
    keys, order = list(keys), list(order)
    rest = [f.name for f in df.schema.fields if f.name not in keys and f.name not in order]
    sortable = [c for c in rest if _orderable(df.schema[c].dataType)]
    hashed = df.withColumn("_hash", content_hash(df))
    by = [F.col(c) for c in order]
    row = F.struct(*by, *[F.col(c) for c in sortable])
    newest = F.max(row) if len(sortable) == len(rest) else F.max_by(F.struct(*by, *[F.col(c) for c in rest]), row)
    best = hashed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(N_ROWS), newest.alias("_row"),
        F.max(F.struct(*by, F.col("_hash").alias("_h")))["_h"].alias("_high"),
        F.bitwise_not(F.max(F.struct(*by, F.bitwise_not("_hash").alias("_h")))["_h"]).alias("_low"))
    columns = [F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    return best.select(*columns, N_ROWS, (F.col("_low") != F.col("_high")).alias(TIED))
