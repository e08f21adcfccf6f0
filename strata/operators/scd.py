"""Slowly changing dimensions as pure next-state functions.

``scd1`` and ``scd2`` take the current dimension and the incoming silver
snapshot and return the *whole next state*: the stored state is never mutated
in place, so a task retry or a second action reads the same input and yields
the same result.  ``scd2_parts`` returns what a load has to write when active
and closed versions are stored apart.  All start from ``changes``, a join of keys
and fingerprints that is made once per load and stored; what follows only looks
the changed keys up.

``scd2_replay`` is the same SCD2 rule applied to a sequence of loads at once
(backfill / bulk rebuild): instead of N chained joins it needs one shuffle by
business key, and the rows per key are bounded by the number of loads.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType

from strata.functions.fingerprint import hash_diff
from strata.operators.surrogate import ONE_TASK_ROWS, assign_surrogate, max_key
from strata.session import written

# Managed column names of the dimensional model.
HASH_DIFF = "hash_diff"
START = "start_effective_date"
END = "end_effective_date"
ACTIVE = "is_active"
VERSION = "record_version"
LOAD_TS = "gold_load_ts"
SCD1_MANAGED = (HASH_DIFF, LOAD_TS)
SCD2_MANAGED = (HASH_DIFF, START, END, ACTIVE, VERSION, LOAD_TS)
ACTION = "_action"


def ts_literal(value, dtype: DataType = TimestampNTZType()) -> Column:
    """A load timestamp as a typed literal (one value per run, no wall clock)."""
    if isinstance(value, Column):
        return value.cast(dtype)
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast(dtype)


def _carried(keys: Sequence[str], attrs: Sequence[str]) -> list[str]:
    return [*keys, *[a for a in attrs if a not in keys]]


def _key_cond(keys: Sequence[str]) -> Column:
    """Null-safe key equality: a NULL key matches itself, so a NULL-key row is
    updated in place instead of being inserted again on every run.  Spark
    still plans ``<=>`` as an equi-join key."""
    cond = None
    for k in keys:
        c = F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}"))
        cond = c if cond is None else cond & c
    return cond


def empty_scd1(incoming: DataFrame, keys, attrs, sk: str, ts_type: DataType = TimestampNTZType()) -> DataFrame:
    cols = _carried(keys, attrs)
    return incoming.select(F.lit(None).cast("long").alias(sk), *cols,
                           F.lit(None).cast("string").alias(HASH_DIFF),
                           F.lit(None).cast(ts_type).alias(LOAD_TS)).limit(0)


def empty_scd2(incoming: DataFrame, keys, attrs, sk: str, ts_type: DataType = TimestampNTZType()) -> DataFrame:
    cols = _carried(keys, attrs)
    return incoming.select(F.lit(None).cast("long").alias(sk), *cols,
                           F.lit(None).cast("string").alias(HASH_DIFF),
                           F.lit(None).cast(ts_type).alias(START),
                           F.lit(None).cast(ts_type).alias(END),
                           F.lit(None).cast("boolean").alias(ACTIVE),
                           F.lit(None).cast("int").alias(VERSION),
                           F.lit(None).cast(ts_type).alias(LOAD_TS)).limit(0)


def changes(current: DataFrame, incoming: DataFrame, keys: Sequence[str], attrs: Sequence[str], sk: str,
            encoding: str = "length_prefixed", change_time: str | None = None) -> DataFrame:
    """What differs between stored and incoming rows: keys, status, stored ``sk`` and version, incoming change time.

    The only full join of a load, and it carries keys and fingerprints alone.
    ``status`` is insert, update or retained (stored, not delivered); unchanged
    keys have no row.  A row counts as stored or delivered because it is there,
    whatever its fingerprint, and a missing fingerprint differs from any other.
    The result is written once: the plans that use it never repeat the join, and
    their joins with it are planned by its size on disk.
    """
    stored = current.where(ACTIVE) if ACTIVE in current.columns else current
    version = F.col(VERSION) if VERSION in current.columns else F.lit(None).cast("int")
    t = stored.select(*keys, F.col(sk).alias("_sk"), version.alias("_version"), F.col(HASH_DIFF).alias("_hash"),
                      F.lit(True).alias("_here"))
    changed = F.col(change_time) if change_time else F.lit(None).cast("timestamp")
    s = incoming.select(*keys, hash_diff(attrs, encoding, incoming.schema).alias("_hash"), changed.alias("_changed"), F.lit(True).alias("_here"))
    j = t.alias("t").join(s.alias("s"), _key_cond(keys), "full_outer")
    status = (F.when(F.col("t._here").isNull(), "insert").when(F.col("s._here").isNull(), "retained")
               .when(~F.col("t._hash").eqNullSafe(F.col("s._hash")), "update"))
    found = j.select(*[F.when(F.col("s._here"), F.col(f"s.{k}")).otherwise(F.col(f"t.{k}")).alias(k) for k in keys],
                     status.alias("_status"), F.col("t._sk").alias("_sk"), F.col("t._version").alias("_version"),
                     F.col("s._changed").alias("_changed"))
    return written(found.where(F.col("_status").isNotNull()), "changes")


def _marked(rows: DataFrame, diff: DataFrame, keys: Sequence[str], is_active: Column | None = None) -> DataFrame:
    """Stored rows with their status (update, retained or unchanged) and the change time of an update.

    One pass over the rows.  ``is_active`` says which rows stand for their key;
    the others are ``history``.
    """
    known = diff.where(F.col("_status").isin("update", "retained"))
    here = F.lit(True) if is_active is None else is_active
    j = rows.withColumn("_stands", here).alias("s").join(
        known.alias("t"), F.col("s._stands") & _key_cond(keys), "left_outer")
    return j.select(*[F.col(f"s.{c}").alias(c) for c in rows.columns],
                    F.when(~F.col("s._stands"), "history").otherwise(F.coalesce("t._status", F.lit("unchanged"))).alias(ACTION),
                    F.col("t._changed").alias("_changed"))


def _delivered(incoming: DataFrame, todo: DataFrame, keys: Sequence[str], attrs: Sequence[str], encoding: str,
               names: Sequence[str]) -> DataFrame:
    """Incoming rows of the keys in ``todo``, with its columns ``names`` and their fingerprint."""
    j = incoming.alias("s").join(todo.alias("t"), _key_cond(keys))
    rows = j.select(*[F.col(f"s.{c}").alias(c) for c in _carried(keys, attrs)], *[F.col(f"t.{n}").alias(n) for n in names])
    return rows.withColumn(HASH_DIFF, hash_diff(attrs, encoding, rows.schema))


def scd1(current: DataFrame, incoming: DataFrame, keys: Sequence[str], attrs: Sequence[str],
         sk: str, load_ts, encoding: str = "length_prefixed",
         ts_type: DataType = TimestampNTZType(), with_action: bool = False,
         diff: DataFrame | None = None) -> DataFrame:
    """Upsert: insert new keys, overwrite changed ones, leave the rest as they are.

    ``incoming`` must hold one row per key (``checks.grain``); the loads in
    ``strata.plans.dimensions`` assert it first.

    Unchanged and absent keys keep their row *and* their old ``gold_load_ts``;
    inserted keys get fresh dense surrogate keys above the current maximum.
    With ``with_action`` the result carries ``_action`` in
    {insert, update, unchanged, retained}.  ``diff`` = ``changes(...)`` of the
    same arguments, if it is at hand.
    """
    keys, cols = list(keys), _carried(keys, attrs)
    diff = changes(current, incoming, keys, attrs, sk, encoding) if diff is None else diff
    inserts = diff.where(F.col("_status") == "insert").select(*keys, F.col("_status").alias(ACTION))
    todo = (diff.where(F.col("_status") == "update").select(*keys, F.col("_sk").alias(sk), F.col("_status").alias(ACTION))
            .unionByName(_with_new_keys(inserts, current, keys, sk)))
    new = _delivered(incoming, todo, keys, attrs, encoding, [sk, ACTION]).withColumn(LOAD_TS, ts_literal(load_ts, ts_type))
    order = [sk, *cols, HASH_DIFF, LOAD_TS, ACTION]
    kept = _marked(current, diff, keys).where(F.col(ACTION) != "update")
    out = kept.select(*order).unionByName(new.select(*order))
    return out if with_action else out.drop(ACTION)


def _scd2_new(current: DataFrame, incoming: DataFrame, diff: DataFrame, keys: Sequence[str], attrs: Sequence[str], sk: str,
              now: Column, encoding: str, ts_type: DataType) -> DataFrame:
    """The versions that a load opens."""
    todo = diff.where(F.col("_status").isin("insert", "update")).select(
        *keys, F.coalesce(F.col("_changed").cast(ts_type), now).alias(START),
        (F.coalesce("_version", F.lit(0)) + 1).cast("int").alias(VERSION), F.col("_status").alias(ACTION))
    todo = _with_new_keys(todo, current, keys, sk)
    return (_delivered(incoming, todo, keys, attrs, encoding, [sk, START, VERSION, ACTION])
            .withColumn(END, F.lit(None).cast(ts_type)).withColumn(ACTIVE, F.lit(True)).withColumn(LOAD_TS, now))


def _scd2_stored(rows: DataFrame, diff: DataFrame, keys: Sequence[str], now: Column, ts_type: DataType) -> DataFrame:
    """Stored rows as they are after a load: the active row of a changed key is expired, all others stay."""
    marked = _marked(rows, diff, keys, F.coalesce(F.col(ACTIVE), F.lit(False)))
    expires = F.col(ACTION) == "update"
    return (marked.withColumn(END, F.when(expires, F.coalesce(F.col("_changed").cast(ts_type), now)).otherwise(F.col(END)))
            .withColumn(ACTIVE, F.when(expires, False).otherwise(F.col(ACTIVE)))
            .withColumn(ACTION, F.when(expires, "expire").otherwise(F.col(ACTION))))


def scd2_parts(current: DataFrame, incoming: DataFrame, keys: Sequence[str], attrs: Sequence[str],
               change_time: str | None, sk: str, load_ts, encoding: str = "length_prefixed",
               ts_type: DataType = TimestampNTZType(), diff: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(active rows of the next state, versions that this load closes), each with ``_action``.

    Only stored rows that are active are read: history is no part of the
    result.  Unchanged rows pass through a join with the changed keys, which are
    broadcast when they are few, so that no stored attribute is shuffled.
    """
    keys, cols = list(keys), _carried(keys, attrs)
    diff = changes(current, incoming, keys, attrs, sk, encoding, change_time) if diff is None else diff
    now = ts_literal(load_ts, ts_type)
    order = [sk, *cols, HASH_DIFF, START, END, ACTIVE, VERSION, LOAD_TS, ACTION]
    stored = _scd2_stored(current.where(F.coalesce(F.col(ACTIVE), F.lit(False))), diff, keys, now, ts_type).select(*order)
    new = _scd2_new(current, incoming, diff, keys, attrs, sk, now, encoding, ts_type)
    return stored.where(F.col(ACTION) != "expire").unionByName(new.select(*order)), stored.where(F.col(ACTION) == "expire")


def scd2(current: DataFrame, incoming: DataFrame, keys: Sequence[str], attrs: Sequence[str],
         change_time: str | None, sk: str, load_ts, encoding: str = "length_prefixed",
         ts_type: DataType = TimestampNTZType(), with_action: bool = False,
         diff: DataFrame | None = None) -> DataFrame:
    """History: expire the active row of each changed key, add its next version.

    ``incoming`` must hold one row per key, like ``scd1``; ``diff`` = ``changes``
    with ``change_time``.

    A changed key keeps its old row, expired, and gets a new one.  New version
    = old + 1, start = the row's change time, else the run's ``load_ts``; the
    expired row ends exactly there.  All stored rows pass in one scan, so a chain of
    loads adds the partitions of its new rows and no more; a load that stores
    closed versions apart (``scd2_parts``) does not even read them.
    """
    keys, cols = list(keys), _carried(keys, attrs)
    diff = changes(current, incoming, keys, attrs, sk, encoding, change_time) if diff is None else diff
    now = ts_literal(load_ts, ts_type)
    order = [sk, *cols, HASH_DIFF, START, END, ACTIVE, VERSION, LOAD_TS, ACTION]
    new = _scd2_new(current, incoming, diff, keys, attrs, sk, now, encoding, ts_type)
    out = _scd2_stored(current, diff, keys, now, ts_type).select(*order).unionByName(new.select(*order))
    return out if with_action else out.drop(ACTION)


def _with_new_keys(rows: DataFrame, current: DataFrame, keys: Sequence[str], sk: str) -> DataFrame:
    """Give the rows dense keys above the current maximum."""
    n = rows.count()
    keyed = assign_surrogate(rows, keys, sk, start=max_key(current, sk) if n else 0, rows=n)
    return keyed if n <= ONE_TASK_ROWS else written(keyed, "keyed")


def scd2_replay(states: DataFrame, keys: Sequence[str], attrs: Sequence[str],
                change_time: str | None, load_col: str, load_ts_col: str, sk: str,
                encoding: str = "length_prefixed", ts_type: DataType = TimestampNTZType(),
                start_key: int = 0) -> DataFrame:
    """SCD2 history of a whole sequence of loads, equal to folding ``scd2``.

    ``states`` holds, per load (``load_col``, ordered), the incoming rows of
    that load and its run timestamp in ``load_ts_col``.  A version is opened
    whenever the fingerprint differs from the key's previous load; it ends
    where the next version starts.  Surrogate keys follow (load, key) order,
    which is the order the fold hands them out in.  ``states`` must hold one
    row per (key, load), as a silver snapshot does.

    The window is partitioned by the business key, but each key has at most
    one row per load, so a key's partition is bounded by the number of loads,
    however hot the key is in the underlying data.
    """
    keys, cols = list(keys), _carried(keys, attrs)
    ct = F.col(change_time).cast(ts_type) if change_time else F.lit(None).cast(ts_type)
    s = states.select(*cols, F.col(load_col).alias("_load"),
                      F.col(load_ts_col).cast(ts_type).alias("_load_ts"), ct.alias("_change_ts"))
    s = s.withColumn(HASH_DIFF, hash_diff(attrs, encoding, s.schema))
    w = Window.partitionBy(*keys).orderBy("_load")
    v = (s.withColumn("_prev", F.lag(HASH_DIFF).over(w))
          .where(F.col("_prev").isNull() | (F.col("_prev") != F.col(HASH_DIFF)))
          .withColumn(START, F.coalesce(F.col("_change_ts"), F.col("_load_ts"))))
    v = (v.withColumn(VERSION, F.row_number().over(w).cast("int"))
          .withColumn(END, F.lead(START).over(w))
          .withColumn(ACTIVE, F.lead("_load").over(w).isNull())
          .withColumn(LOAD_TS, F.col("_load_ts")))
    v = assign_surrogate(v, ["_load", *keys], sk, start=start_key)
    return v.select(sk, *cols, HASH_DIFF, START, END, ACTIVE, VERSION, LOAD_TS)
