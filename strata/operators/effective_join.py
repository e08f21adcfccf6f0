"""Effective-dated (interval) left join: each fact to the version valid then.

    fact.k = dim.k AND fact.d >= dim.start AND (fact.d < dim.end OR dim.end IS NULL)

Unmatched facts are kept with a NULL key.  The equality on the business key
bounds the work; the interval is a residual condition.  Strategy:

* the dimension is first narrowed to (key, start, end, surrogate key);
* if its measured size is under ``broadcast_limit`` it is broadcast and the
  facts never shuffle;
* ``asof``: versions and facts of a key are sorted by time together and the last
  version is carried forward, so a key costs its versions *plus* its facts and
  never their product.  ``auto`` takes it for a dimension beyond the limit, and for
  a small one if some key has more than ``MANY_VERSIONS`` of them;
* ``salted``: both sides shuffle on the key.  A key is *hot* when it alone
  holds more than ``hot_factor`` times the average rows of a shuffle
  partition; fewer than ``partitions / hot_factor`` keys can qualify, so the
  hot list is bounded by the partition count, not the data.  A hot key with
  ``c`` rows gets ``ceil(c / average)`` salt buckets: its fact rows get a
  deterministic salt in that range and its (few) dimension versions are
  replicated once per bucket, so no task receives more than about one average
  partition of it.  Every fact row still meets every version of its key
  exactly once, so the result equals the unsalted join.  NULL keys never
  match and skip the shuffle.  AQE's skew-join split stays on as a second
  line of defence.

``asof`` cuts the rows of a hot key into ranges of time instead: at approximate
quantiles of all times of the key, so ranges hold about as many rows, and at most
``MAX_RANGES`` of them.  Every fact and every version is in one range, and each
range also begins with one row more, the last version of the ranges before it.
Facts at one and the same time, however many, are dealt by the salt columns over
the ranges that end there.  It gives at most one version: validity must not overlap, as
``checks.history`` asserts for every dimension load.  Versions that end where they
start are never valid.  ``end=None`` means that a version is valid until the
next one of its key starts; of versions that start together the one with the
greatest ``sk`` is valid.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import written

DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024
#: Versions of one key up to which every fact of the key may be compared with each of them.
MANY_VERSIONS = 64
#: Ranges of time that the rows of one hot key are cut into at most.
MAX_RANGES = 256
_ROW_OVERHEAD = 32
# Bytes per value of fixed-width types (Spark's in-memory sizes).
_WIDTH = {"long": 8, "integer": 4, "short": 2, "byte": 1, "double": 8, "float": 4, "boolean": 1,
          "date": 4, "timestamp": 8, "timestamp_ntz": 8, "decimal": 16}


def measure(dim: DataFrame, key: str) -> tuple[int, int]:
    """(rows, estimated bytes) of a narrowed dimension, in one aggregate pass.

    Fixed-width columns count their width, string-like ones their measured
    length, plus a per-row overhead.
    """
    var = [f.name for f in dim.schema.fields if f.name == key or f.dataType.typeName() in ("string", "binary")]
    fixed = sum(_WIDTH.get(f.dataType.typeName(), 16) for f in dim.schema.fields if f.name not in var)
    r = dim.agg(F.count(F.lit(1)).alias("n"),
                *[F.coalesce(F.sum(F.octet_length(F.col(c).cast("string"))), F.lit(0)).alias(f"v{i}")
                  for i, c in enumerate(var)]).first()
    n = int(r["n"])
    return n, n * (fixed + _ROW_OVERHEAD) + sum(int(r[f"v{i}"]) for i in range(len(var)))


def most_versions(dim: DataFrame, key: str) -> int:
    """The number of versions of the key that has most."""
    counts = dim.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return int(counts.agg(F.coalesce(F.max("_n"), F.lit(0))).first()[0])


def hot_keys(facts: DataFrame, key: str, hot_factor: float = 4.0, partitions: int | None = None) -> DataFrame:
    """(_h_key, _h_n): keys with more than ``hot_factor`` shuffle partitions' worth of rows, and their salt buckets.

    One pass over the key column; the counts are kept once and also give the
    total.  NULL is such a key when it is frequent.  There are fewer than
    ``partitions / hot_factor`` hot keys, and ``hot_factor`` is at least 1, so
    the result may be broadcast; it never reaches the driver.
    """
    if hot_factor < 1:
        raise ValueError("hot_factor below 1 would make more keys hot than there are partitions")
    p = partitions or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = facts.groupBy(F.col(key).alias("_h_key")).agg(F.count(F.lit(1)).alias("_n"))
    counts = written(counts, "key-counts")
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    avg = max(1.0, total / p)
    buckets = F.greatest(F.lit(2), F.least(F.lit(p), F.ceil(F.col("_n") / avg))).cast("int")
    return counts.where(F.col("_n") > F.lit(hot_factor * avg)).select("_h_key", buckets.alias("_h_n"))


def resolve(facts: DataFrame, dim: DataFrame, key: str, event_col: str,
            sk: str = "subject_sk", start: str = "start_effective_date",
            end: str | None = "end_effective_date", dim_key: str | None = None,
            strategy: str = "auto", broadcast_limit: int = DEFAULT_BROADCAST_LIMIT,
            hot_factor: float = 4.0, partitions: int | None = None, salt_buckets: int | None = None,
            dim_cols: list[str] | dict[str, str] | None = None,
            salt_cols: list[str] | None = None, key_rows: DataFrame | None = None) -> DataFrame:
    """Facts with ``sk`` of the dimension version valid at ``event_col``.

    ``dim_cols`` brings further version attributes along (a dict renames
    them); they are NULL for orphan facts.  ``salt_cols`` (default: every
    fact column) feed the hot-key salt; the fact's grain key is enough.
    ``partitions`` is the number of partitions that hot keys are measured by
    (default: the session's shuffle partitions); ``salt_buckets`` fixes the
    bucket count of every hot key.  ``key_rows`` (default: the facts) is what hot
    keys are counted in: give the bare table if the facts are the result of more
    work on it (with ``event_col``, or ``asof`` takes the times from the facts).

    ``strategy``: ``auto`` (measure, then broadcast or asof), ``broadcast`` (an
    error beyond ``broadcast_limit``), ``shuffle`` (plain shuffle join), ``salted``
    (shuffle with hot-key split) or ``asof`` (sort and carry forward).
    """
    dim_key = dim_key or key
    extra = dict(dim_cols) if isinstance(dim_cols, dict) else {c: c for c in (dim_cols or [])}
    d = dim.select(F.col(sk).alias("_d_sk"), F.col(dim_key).alias("_d_key"),
                   F.col(start).alias("_d_start"), (F.col(end) if end else F.lit(None).cast("timestamp")).alias("_d_end"),
                   *[F.col(c).alias(f"_d_x{i}") for i, c in enumerate(extra)])
    if end is None and strategy not in ("auto", "asof"):
        raise ValueError("versions without an end need the strategy asof")
    if strategy == "auto" and end is None:
        strategy = "asof"
    if strategy in ("auto", "broadcast"):
        _, size = measure(d, "_d_key")
        if strategy == "broadcast" and size > broadcast_limit:
            raise ValueError(f"the versions take {size} bytes, more than {broadcast_limit}; use another strategy")
        if strategy == "auto" and (size > broadcast_limit or most_versions(d, "_d_key") > MANY_VERSIONS):
            strategy = "asof"
        else:
            strategy = "broadcast"
    ev = F.col(event_col)
    in_range = (ev >= F.col("_d_start")) & (F.col("_d_end").isNull() | (ev < F.col("_d_end")))
    cols = facts.columns
    out_cols = [*[F.col(c) for c in cols], F.col("_d_sk").alias(sk),
                *[F.col(f"_d_x{i}").alias(a) for i, a in enumerate(extra.values())]]
    match = F.col(key) == F.col("_d_key")
    if strategy == "broadcast":
        j = facts.join(F.broadcast(d), match & in_range, "left")
    elif strategy == "shuffle":
        j = facts.join(d.hint("shuffle_hash"), match & in_range, "left")
    elif strategy in ("salted", "asof"):
        hot = hot_keys(facts if key_rows is None else key_rows, key, hot_factor, partitions)
        if salt_buckets:
            hot = hot.withColumn("_h_n", F.lit(salt_buckets).cast("int"))
        b = F.broadcast(hot)
        if strategy == "asof":
            cuts, ranges = None, hot.agg(F.max("_h_n")).first()[0] or 1
            if ranges > 1:
                d = written(d, "versions")
                seen = key_rows if key_rows is not None and {key, event_col} <= set(key_rows.columns) else facts
                cuts = _cuts(seen.select(F.col(key).alias("_k"), ev.alias("_t")).union(d.select("_d_key", "_d_start")), hot, ranges)
            return _carried_forward(facts, d, key, ev, bool(end), cuts, list(salt_cols or cols)).select(*out_cols)
        salted_by = [F.col(c) for c in (salt_cols or cols)]
        # a NULL key meets no version, but its rows are spread like those of any other frequent key
        f2 = (facts.join(b, F.col(key).eqNullSafe(F.col("_h_key")), "left")
              .withColumn("_salt", F.when(F.col("_h_n").isNull(), F.lit(0))
                          .otherwise(F.pmod(F.xxhash64(*salted_by), F.col("_h_n"))).cast("int"))
              .drop("_h_key", "_h_n"))
        d2 = (d.join(b, F.col("_d_key") == F.col("_h_key"), "left")
              .withColumn("_d_salt", F.explode(F.when(F.col("_h_n").isNull(), F.array(F.lit(0)))
                                               .otherwise(F.sequence(F.lit(0), F.col("_h_n") - 1))))
              .drop("_h_key", "_h_n"))
        j = f2.join(d2, match & (F.col("_salt") == F.col("_d_salt")) & in_range, "left")
    else:
        raise ValueError(f"unknown join strategy {strategy!r}")
    return j.select(*out_cols)


def _cuts(times: DataFrame, hot: DataFrame, ranges: int) -> DataFrame:
    """(_h_key, _h_cuts): the sorted times at which the rows (_k, _t) of each hot key are cut into ``_h_n`` ranges."""
    n = min(ranges, MAX_RANGES)
    own = F.least(F.col("_h_n"), F.lit(n))
    chosen = F.transform(F.sequence(F.lit(1), own - 1), lambda i: F.get("_all", F.floor(i * n / own).cast("int") - 1))
    found = (times.where("_t IS NOT NULL").join(F.broadcast(hot), F.col("_k") == F.col("_h_key")).groupBy("_h_key", "_h_n")
             .agg(F.percentile_approx("_t", [i / n for i in range(1, n)], 10_000).alias("_all")))
    return written(found.select("_h_key", chosen.alias("_h_cuts")), "time-cuts")


def _passed(cuts, time, at: bool):
    """How many of the sorted ``cuts`` lie before ``time``, or ``at`` it too: by halving; 0 for a NULL."""
    def one(n, step):
        cut = F.get(cuts, n + step - 1)
        return F.when(cut <= time if at else cut < time, n + step).otherwise(n)
    return F.aggregate(F.array(*[F.lit(1 << i) for i in reversed(range((MAX_RANGES - 1).bit_length()))]), F.lit(0), one)


def _timeline(facts: DataFrame, versions: DataFrame, key: str, event, ends: bool,
              cuts: DataFrame | None, salt_cols: list[str]) -> DataFrame:
    """(_k, _s, _t, _side, _v, _f): versions (side 0) and facts (1) by key, range and time.

    With ``cuts``, a version is in the range that its start first fits, and a fact in any
    range that its time fits: no version that starts later is before it, and all
    others are in its range or an earlier one, whose last version begins its range.
    """
    held = [c for c in versions.columns if c != "_d_key"]
    usable = F.col("_d_key").isNotNull() & F.col("_d_start").isNotNull()
    if ends:
        usable = usable & (F.col("_d_end").isNull() | (F.col("_d_end") > F.col("_d_start")))
    fact, version = F.struct(*[F.col(c) for c in facts.columns]), F.struct(*held)
    no_fact = F.lit(None).cast(facts.select(fact.alias("f")).schema[0].dataType).alias("_f")
    no_version = F.lit(None).cast(versions.select(version.alias("v")).schema[0].dataType).alias("_v")
    v = versions.where(usable).select(F.col("_d_key").alias("_k"), F.col("_d_start").alias("_t"), version.alias("_v"))
    f = facts.where(F.col(key).isNotNull()).select(F.col(key).alias("_k"), event.alias("_t"), fact.alias("_f"))
    if cuts is None:
        v, f = v.withColumn("_s", F.lit(0)), f.withColumn("_s", F.lit(0))
    else:
        cut = lambda rows: rows.join(F.broadcast(cuts), F.col("_k") == F.col("_h_key"), "left")
        v = cut(v).withColumn("_s", _passed(F.col("_h_cuts"), F.col("_t"), False))
        first, last = _passed(F.col("_h_cuts"), F.col("_t"), False), _passed(F.col("_h_cuts"), F.col("_t"), True)
        # a NULL time meets no version in any range
        last = F.when(F.col("_t").isNull(), F.coalesce(F.size("_h_cuts"), F.lit(0))).otherwise(last)
        f = cut(f).withColumn("_s", first).withColumn("_s", (F.col("_s") + F.pmod(
            F.xxhash64(*[F.col("_f")[c] for c in salt_cols]), last - F.col("_s") + 1)).cast("int"))
        newest = F.max_by(F.struct("_t", "_v"), F.struct("_t", F.col("_v._d_end").isNull(), "_v._d_end", "_v._d_sk"))
        of_range = v.where("_h_key IS NOT NULL").groupBy("_k", "_s").agg(newest.alias("_last"))
        earlier = Window.partitionBy("_k").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
        begin = (cuts.select(F.col("_h_key").alias("_k"), F.explode(F.sequence(F.lit(0), F.size("_h_cuts"))).alias("_s"))
                 .join(of_range, ["_k", "_s"], "left")
                 .select("_k", "_s", F.last("_last", ignorenulls=True).over(earlier).alias("_last")).where("_last IS NOT NULL"))
        v = v.select("_k", "_t", "_v", "_s").union(begin.select("_k", "_last._t", "_last._v", "_s"))
    return (v.select("_k", "_s", "_t", F.lit(0).alias("_side"), "_v", no_fact)
            .union(f.select("_k", "_s", "_t", F.lit(1), no_version, "_f")))


def _carried_forward(facts: DataFrame, versions: DataFrame, key: str, event, ends: bool,
                     cuts: DataFrame | None, salt_cols: list[str]) -> DataFrame:
    """Facts and the version columns ``_d_*`` valid at ``event``: one sort by (key, range, time).

    Facts whose key is NULL, and versions that can never be valid, do not enter
    the sort; the former are added again at the end.
    """
    held = [c for c in versions.columns if c != "_d_key"]
    none = [F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in held]
    rows = _timeline(facts, versions, key, event, ends, cuts, salt_cols)
    # versions come before facts of the same time; of versions that start together the last to end, then the greatest
    along = Window.partitionBy("_k", "_s").orderBy(
        F.col("_t"), "_side", F.col("_v._d_end").asc_nulls_last(), F.col("_v._d_sk")).rowsBetween(Window.unboundedPreceding, 0)
    last = rows.select("_side", "_t", "_f", F.last("_v", ignorenulls=True).over(along).alias("_v")).where("_side = 1")
    valid = F.col("_v").isNotNull() & (F.col("_v._d_end").isNull() | (F.col("_t") < F.col("_v._d_end")))
    found = last.select("_f.*", *[F.when(valid, F.col(f"_v.{c}")).alias(c) for c in held])
    return found.unionByName(facts.where(F.col(key).isNull()).select("*", *none))
