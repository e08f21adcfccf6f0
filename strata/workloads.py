"""The load operators run over the driver's test tables.

Each workload pairs a Spark callable ``(spark, sf_dir) -> DataFrame`` with an
independent DuckDB SQL statement computing the same rows from the raw
tables.  Every workload reads whole tables; the only values derived by rule
(``% 3``, ``% 5`` ...) stage *changes* between two loads, never filter rows
out.  Load timestamps are fixed literals, so results are reproducible and can
be compared including ``gold_load_ts``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType, TimestampNTZType

from strata.functions.fingerprint import hash_diff
from strata.operators import checks
from strata.operators.cleanse import cleanse_strings
from strata.operators.dedup import latest_per_key
from strata.operators.effective_join import resolve
from strata.operators.scd import ACTION, empty_scd1, empty_scd2, scd1, scd2, scd2_replay
from strata.operators.surrogate import assign_surrogate
from strata.plans import bronze, runner, silver
from strata.plans.entities import EntitySpec, Layout
from strata.session import fresh_dir, written
from strata.sources import landing, tables

SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def workload(name: str, sql: str | None):
    def deco(fn):
        SPARK[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------
# SQL fragments shared by the oracles (DuckDB dialect).

def _clean(c: str) -> str:
    return f"nullif(upper(trim({c})), '')"


def _lp(cols: list[str]) -> str:
    """Length-prefixed fingerprint text, the oracle twin of ``hash_diff``."""
    pieces = [f"CASE WHEN CAST({c} AS VARCHAR) IS NULL THEN '#' ELSE "
              f"CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR) END"
              for c in cols]
    return f"sha256(concat_ws('|', {', '.join(pieces)}))"


def _typed_text(cols: list[str], strings: set[str]) -> str:
    """The ``typed`` fingerprint: the length stands before strings alone."""
    pieces = [f"coalesce(CAST(length({c}) AS VARCHAR) || ':' || {c}, '#')" if c in strings
              else f"coalesce(CAST({c} AS VARCHAR), '#')" for c in cols]
    return f"sha256(concat_ws('|', {', '.join(pieces)}))"


def _plain(cols: list[str]) -> str:
    pieces = [f"coalesce(CAST({c} AS VARCHAR), '~')" for c in cols]
    return f"sha256(concat_ws('||', {', '.join(pieces)}))"


_EVENTS_CLEAN = f"""
  SELECT event_id, ts, user_id, {_clean('event_type')} AS event_type, value, {_clean('props')} AS props
  FROM events WHERE user_id IS NOT NULL"""
_EVENTS_ORDER = ("ts DESC NULLS LAST, event_id DESC NULLS LAST, event_type DESC NULLS LAST, "
                 "value DESC NULLS LAST, props DESC NULLS LAST")


# --------------------------------------------------------------------------
# Silver: cleanse + newest row per key.

LINEITEM_KEY = ["l_orderkey", "l_linenumber"]


def _silver_lineitem(spark, sf):
    out, _ = silver.current_state(table(spark, sf, "lineitem"), LINEITEM_KEY, "l_shipdate")
    return out


@workload("silver_latest_lineitem", f"""
WITH c AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
         {_clean('l_returnflag')} AS l_returnflag, {_clean('l_linestatus')} AS l_linestatus, l_shipdate
  FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL)
SELECT * FROM c
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
  l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
  l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST,
  l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) = 1
""")
def silver_latest_lineitem(spark, sf):
    return _silver_lineitem(spark, sf)


def _bronze_events(spark, sf):
    """Events as bronze rows: the ingest date is the day the row landed."""
    ev = table(spark, sf, "events")
    return ev.withColumn(silver.BRONZE_DATE, F.to_date("ts"))


@workload("silver_latest_events", f"""
SELECT * FROM ({_EVENTS_CLEAN})
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY {_EVENTS_ORDER}) = 1
""")
def silver_latest_events(spark, sf):
    out, _ = silver.current_state(_bronze_events(spark, sf), ["user_id"], "ts")
    return out


def _dirty_part(df: DataFrame) -> DataFrame:
    """Pad, lower-case and blank some strings of ``part`` (every row kept)."""
    k = F.col("p_partkey")
    return df.select(
        "p_partkey",
        F.when(k % 7 == 0, F.lit("   ")).when(k % 7 == 1, F.lit(""))
         .otherwise(F.concat(F.lit("  "), F.lower("p_name"), F.lit(" "))).alias("p_name"),
        F.when(k % 13 == 0, F.concat(F.lit("\t"), F.lower("p_brand")))
         .otherwise(F.concat(F.lit(" "), F.lower("p_brand"))).alias("p_brand"),
        F.when(k % 11 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lower("p_type"), F.lit("  "))).alias("p_type"),
        "p_size", "p_retailprice")


@workload("silver_cleanse_part", f"""
WITH d AS (
  SELECT p_partkey,
    CASE WHEN p_partkey % 7 = 0 THEN '   ' WHEN p_partkey % 7 = 1 THEN ''
         ELSE '  ' || lower(p_name) || ' ' END AS p_name,
    CASE WHEN p_partkey % 13 = 0 THEN chr(9) || lower(p_brand) ELSE ' ' || lower(p_brand) END AS p_brand,
    CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE lower(p_type) || '  ' END AS p_type,
    p_size, p_retailprice
  FROM part)
SELECT p_partkey, {_clean('p_name')} AS p_name, {_clean('p_brand')} AS p_brand,
       {_clean('p_type')} AS p_type, p_size, p_retailprice FROM d
""")
def silver_cleanse_part(spark, sf):
    return cleanse_strings(_dirty_part(table(spark, sf, "part")))


# --------------------------------------------------------------------------
# Contracts.

_GRAIN_SQL = """
WITH k AS (SELECT {keys}, count(*) AS n FROM {src} GROUP BY ALL)
SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys,
       count(*) FILTER (WHERE n > 1) AS duplicated_keys, sum(n) = count(*) AS ok FROM k
"""


@workload("check_grain_lineitem", _GRAIN_SQL.format(keys="l_orderkey, l_linenumber", src="lineitem"))
def check_grain_lineitem(spark, sf):
    return checks.grain(table(spark, sf, "lineitem"), LINEITEM_KEY)


@workload("check_grain_silver_lineitem", _GRAIN_SQL.format(
    keys="l_orderkey, l_linenumber",
    src="(SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem "
        "WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL)"))
def check_grain_silver_lineitem(spark, sf):
    return checks.grain(_silver_lineitem(spark, sf), LINEITEM_KEY)


# --------------------------------------------------------------------------
# Fingerprints and surrogate keys.

CUSTOMER_ATTRS = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _typed_customer(spark, sf):
    # Money is DECIMAL in the model, never DOUBLE.
    return table(spark, sf, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast(DecimalType(12, 2)))


@workload("hash_diff_customer", f"""
WITH t AS (SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal, c_mktsegment
           FROM customer)
SELECT c_custkey, {_plain(CUSTOMER_ATTRS)} AS hash_plain, {_lp(CUSTOMER_ATTRS)} AS hash_diff FROM t
""")
def hash_diff_customer(spark, sf):
    t = _typed_customer(spark, sf)
    return t.select("c_custkey", hash_diff(CUSTOMER_ATTRS, "plain").alias("hash_plain"),
                    hash_diff(CUSTOMER_ATTRS).alias("hash_diff"))


LINEITEM_ATTRS = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                  "l_returnflag", "l_linestatus", "l_shipdate"]
_LINEITEM_MONEY = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _typed_lineitem(spark, sf):
    t = table(spark, sf, "lineitem")
    return t.select(*[F.col(c).cast(DecimalType(18, 2)).alias(c) if c in _LINEITEM_MONEY
                      else F.col(c).cast("date").alias(c) if c == "l_shipdate" else F.col(c)
                      for c in t.columns])


@workload("hash_diff_lineitem", f"""
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                  {', '.join(f'CAST({c} AS DECIMAL(18,2)) AS {c}' for c in _LINEITEM_MONEY)},
                  l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem)
SELECT l_orderkey, l_linenumber, {_lp(LINEITEM_ATTRS)} AS hash_diff FROM t
""")
def hash_diff_lineitem(spark, sf):
    """Fingerprint of every non-key attribute of the largest table."""
    t = _typed_lineitem(spark, sf)
    return t.select(*LINEITEM_KEY, hash_diff(LINEITEM_ATTRS).alias("hash_diff"))


@workload("hash_diff_lineitem_typed", f"""
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                  {', '.join(f'CAST({c} AS DECIMAL(18,2)) AS {c}' for c in _LINEITEM_MONEY)},
                  l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem)
SELECT l_orderkey, l_linenumber, {_typed_text(LINEITEM_ATTRS, {"l_returnflag", "l_linestatus"})} AS hash_diff FROM t
""")
def hash_diff_lineitem_typed(spark, sf):
    """The same attributes with the encoding that writes lengths for strings alone."""
    t = _typed_lineitem(spark, sf)
    return t.select(*LINEITEM_KEY, hash_diff(LINEITEM_ATTRS, "typed", t.schema).alias("hash_diff"))


@workload("surrogate_key_customer", """
SELECT *, row_number() OVER (ORDER BY c_custkey) AS customer_sk FROM customer
""")
def surrogate_key_customer(spark, sf):
    return assign_surrogate(table(spark, sf, "customer"), ["c_custkey"], "customer_sk")


# --------------------------------------------------------------------------
# SCD type 1 on part: the previous load lacks every fifth key and carried an
# older price for every third key; the new load is the whole table.

PART_KEY = ["p_partkey"]
PART_ATTRS = ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
T_PREV, T_NEXT = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def _typed_part(spark, sf):
    return table(spark, sf, "part").withColumn("p_retailprice", F.col("p_retailprice").cast(DecimalType(12, 2)))


def _scd1_part(spark, sf, with_action=False):
    typed = _typed_part(spark, sf)
    k = F.col("p_partkey")
    prev = (typed.where(k % 5 != 0)
                 .withColumn("p_retailprice", F.when(k % 3 == 0, F.col("p_retailprice") + 1)
                             .otherwise(F.col("p_retailprice")).cast(DecimalType(12, 2))))
    dim0 = empty_scd1(typed, PART_KEY, PART_ATTRS, "part_sk")
    # The first load's state is written, as a load writes its table.
    dim1 = written(scd1(dim0, prev, PART_KEY, PART_ATTRS, "part_sk", T_PREV), "state")
    return scd1(dim1, typed, PART_KEY, PART_ATTRS, "part_sk", T_NEXT, with_action=with_action)


_SCD1_PART_CTE = f"""
WITH typed AS (SELECT p_partkey, p_name, p_brand, p_type, p_size,
                      CAST(p_retailprice AS DECIMAL(12,2)) AS p_retailprice FROM part),
prev AS (SELECT p_partkey, p_name, p_brand, p_type, p_size,
                CAST(CASE WHEN p_partkey % 3 = 0 THEN p_retailprice + 1 ELSE p_retailprice END
                     AS DECIMAL(12,2)) AS p_retailprice
         FROM typed WHERE p_partkey % 5 <> 0),
cur AS (SELECT row_number() OVER (ORDER BY p_partkey) AS part_sk, *,
               {_lp(PART_ATTRS)} AS hash_diff, TIMESTAMP '{T_PREV}' AS gold_load_ts FROM prev),
inc AS (SELECT *, {_lp(PART_ATTRS)} AS hash_diff FROM typed)"""


@workload("scd1_upsert_part", _SCD1_PART_CTE + f"""
SELECT c.part_sk, i.p_partkey, i.p_name, i.p_brand, i.p_type, i.p_size, i.p_retailprice, i.hash_diff,
       CASE WHEN c.hash_diff = i.hash_diff THEN c.gold_load_ts ELSE TIMESTAMP '{T_NEXT}' END AS gold_load_ts
FROM cur c JOIN inc i USING (p_partkey)
UNION ALL
SELECT c.part_sk, c.p_partkey, c.p_name, c.p_brand, c.p_type, c.p_size, c.p_retailprice, c.hash_diff, c.gold_load_ts
FROM cur c ANTI JOIN inc i USING (p_partkey)
UNION ALL
SELECT (SELECT coalesce(max(part_sk), 0) FROM cur) + row_number() OVER (ORDER BY i.p_partkey) AS part_sk,
       i.p_partkey, i.p_name, i.p_brand, i.p_type, i.p_size, i.p_retailprice, i.hash_diff,
       TIMESTAMP '{T_NEXT}' AS gold_load_ts
FROM inc i ANTI JOIN cur c USING (p_partkey)
""")
def scd1_upsert_part(spark, sf):
    return _scd1_part(spark, sf)


@workload("scd1_actions_part", _SCD1_PART_CTE + """
SELECT CASE WHEN c.p_partkey IS NULL THEN 'insert' WHEN i.p_partkey IS NULL THEN 'retained'
            WHEN c.hash_diff <> i.hash_diff THEN 'update' ELSE 'unchanged' END AS action,
       count(*) AS n
FROM cur c FULL JOIN inc i ON c.p_partkey = i.p_partkey GROUP BY 1
""")
def scd1_actions_part(spark, sf):
    out = _scd1_part(spark, sf, with_action=True)
    return out.groupBy(F.col(ACTION).alias("action")).agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------
# SCD type 2 on users: three loads of the newest event per user as of the
# 10th, 20th and 30th of January; the attribute is the event type.

USER_KEY = ["user_id"]
USER_ATTRS = ["event_type"]
CUTS = [("2024-01-10", "2024-01-11 00:00:00"), ("2024-01-20", "2024-01-21 00:00:00"),
        ("9999-12-31", "2024-01-31 00:00:00")]       # the last load takes all that is left


def _user_state(bronze: DataFrame, cut: str) -> DataFrame:
    out, _ = silver.current_state(bronze.where(F.col(silver.BRONZE_DATE) <= F.lit(cut).cast("date")),
                                  USER_KEY, "ts")
    return out


def _scd2_users(spark, sf):
    bronze = _bronze_events(spark, sf)
    dim = empty_scd2(bronze, USER_KEY, USER_ATTRS, "user_sk")
    for cut, load_ts in CUTS:
        dim = written(scd2(dim, _user_state(bronze, cut), USER_KEY, USER_ATTRS, "ts", "user_sk", load_ts), "state")
    return dim


_SCD2_USERS_CTE = f"""
WITH cut(n, d, lts) AS (VALUES {', '.join(f"({i + 1}, DATE '{d}', TIMESTAMP '{t}')" for i, (d, t) in enumerate(CUTS))}),
e AS ({_EVENTS_CLEAN}),
st AS (SELECT cut.n, cut.lts, e.* FROM e JOIN cut ON CAST(e.ts AS DATE) <= cut.d
       QUALIFY row_number() OVER (PARTITION BY cut.n, e.user_id ORDER BY {_EVENTS_ORDER}) = 1),
h AS (SELECT *, {_lp(USER_ATTRS)} AS hash_diff FROM st),
ch AS (SELECT *, lag(hash_diff) OVER (PARTITION BY user_id ORDER BY n) AS p FROM h),
v AS (SELECT *, coalesce(ts, lts) AS s FROM ch WHERE p IS NULL OR p <> hash_diff),
k AS (SELECT row_number() OVER (ORDER BY n, user_id) AS user_sk, user_id, event_type, hash_diff,
             s AS start_effective_date,
             lead(s) OVER (PARTITION BY user_id ORDER BY n) AS end_effective_date,
             lead(n) OVER (PARTITION BY user_id ORDER BY n) IS NULL AS is_active,
             CAST(row_number() OVER (PARTITION BY user_id ORDER BY n) AS INTEGER) AS record_version,
             lts AS gold_load_ts
      FROM v)"""


@workload("scd2_history_users", _SCD2_USERS_CTE + "\nSELECT * FROM k")
def scd2_history_users(spark, sf):
    return _scd2_users(spark, sf)


@workload("scd2_active_users", _SCD2_USERS_CTE + "\nSELECT * FROM k WHERE is_active")
def scd2_active_users(spark, sf):
    return _scd2_users(spark, sf).where(F.col("is_active"))


@workload("check_active_unique", _SCD2_USERS_CTE + """,
per AS (SELECT user_id, count(*) AS n, count(*) FILTER (WHERE is_active) AS a FROM k GROUP BY user_id)
SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(a) AS BIGINT) AS active_rows,
       count(*) FILTER (WHERE a > 1) AS keys_with_many_active,
       count(*) FILTER (WHERE a > 1) = 0 AS ok FROM per
""")
def check_active_unique(spark, sf):
    return checks.active_unique(_scd2_users(spark, sf), USER_KEY)


# --------------------------------------------------------------------------
# Facts: every event resolved to the user version valid on the event's date.
# The user dimension is the SCD2 history of one load per day (30 loads),
# rebuilt in one pass by ``scd2_replay``.

def _daily_user_dim(spark, sf):
    bronze = _bronze_events(spark, sf)
    d = silver.BRONZE_DATE
    cleansed = cleanse_strings(bronze).where(F.col("user_id").isNotNull())
    # State of day d for the users seen that day = their newest row so far.
    states = latest_per_key(cleansed, ["user_id", d], ["ts"])
    states = states.withColumn("_load_ts", F.date_add(F.col(d), 1).cast("timestamp_ntz"))
    return scd2_replay(states, USER_KEY, USER_ATTRS, "ts", d, "_load_ts", "user_sk")


def _event_facts(spark, sf):
    facts, _ = silver.current_state(_bronze_events(spark, sf), ["event_id"], "ts")
    return facts.withColumn("event_date", F.to_date("ts"))


def _resolved_events(spark, sf, extra=None, **join):
    dim = _daily_user_dim(spark, sf)
    return resolve(_event_facts(spark, sf), dim, "user_id", "event_date", sk="user_sk",
                   dim_cols=extra, **join)


_DAILY_DIM_CTE = f"""
WITH e AS ({_EVENTS_CLEAN}),
st AS (SELECT CAST(ts AS DATE) AS n, e.* FROM e
       QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY {_EVENTS_ORDER}) = 1),
h AS (SELECT *, {_lp(USER_ATTRS)} AS hash_diff FROM st),
ch AS (SELECT *, lag(hash_diff) OVER (PARTITION BY user_id ORDER BY n) AS p FROM h),
v AS (SELECT *, coalesce(ts, CAST(n + 1 AS TIMESTAMP)) AS s FROM ch WHERE p IS NULL OR p <> hash_diff),
k AS (SELECT row_number() OVER (ORDER BY n, user_id) AS user_sk, user_id, event_type AS user_state,
             s AS start_effective_date, lead(s) OVER (PARTITION BY user_id ORDER BY n) AS end_effective_date,
             CAST(row_number() OVER (PARTITION BY user_id ORDER BY n) AS INTEGER) AS record_version
      FROM v),
f AS (SELECT e.*, CAST(e.ts AS DATE) AS event_date FROM ({_EVENTS_CLEAN.replace('WHERE user_id IS NOT NULL', '')}) e),
r AS (SELECT f.*, k.user_sk, k.user_state, k.record_version FROM f LEFT JOIN k
      ON f.user_id = k.user_id AND f.event_date >= k.start_effective_date
     AND (f.event_date < k.end_effective_date OR k.end_effective_date IS NULL))"""


@workload("scd2_daily_users", f"""
WITH e AS ({_EVENTS_CLEAN}),
st AS (SELECT CAST(ts AS DATE) AS n, e.* FROM e
       QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY {_EVENTS_ORDER}) = 1),
h AS (SELECT *, {_lp(USER_ATTRS)} AS hash_diff FROM st),
ch AS (SELECT *, lag(hash_diff) OVER (PARTITION BY user_id ORDER BY n) AS p FROM h),
v AS (SELECT *, coalesce(ts, CAST(n + 1 AS TIMESTAMP)) AS s FROM ch WHERE p IS NULL OR p <> hash_diff)
SELECT row_number() OVER (ORDER BY n, user_id) AS user_sk, user_id, event_type, hash_diff,
       s AS start_effective_date, lead(s) OVER (PARTITION BY user_id ORDER BY n) AS end_effective_date,
       lead(n) OVER (PARTITION BY user_id ORDER BY n) IS NULL AS is_active,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY n) AS INTEGER) AS record_version,
       CAST(n + 1 AS TIMESTAMP) AS gold_load_ts
FROM v
""")
def scd2_daily_users(spark, sf):
    """The user dimension after one SCD2 load per day (30 loads), in one pass."""
    return _daily_user_dim(spark, sf)


@workload("fact_asof_events", _DAILY_DIM_CTE + """
SELECT event_id, user_id, event_date, event_type, user_sk, record_version FROM r
""")
def fact_asof_events(spark, sf):
    out = _resolved_events(spark, sf, extra=["record_version"])
    return out.select("event_id", "user_id", "event_date", "event_type", "user_sk", "record_version")


@workload("fact_asof_events_salted", _DAILY_DIM_CTE + """
SELECT event_id, user_id, event_date, event_type, user_sk, record_version FROM r
""")
def fact_asof_events_salted(spark, sf):
    """The same facts through the skew path: shuffle join on (key, salt), with
    partitions taken so small (100 rows) that the busiest users are hot."""
    out = _resolved_events(spark, sf, extra=["record_version"], strategy="salted",
                           hot_factor=1, partitions=_table_rows(spark, sf, "events") // 100 + 1, salt_cols=["event_id"])
    return out.select("event_id", "user_id", "event_date", "event_type", "user_sk", "record_version")


@workload("fact_orphans_events", _DAILY_DIM_CTE + """
SELECT count(*) AS total_rows, count(*) FILTER (WHERE user_sk IS NULL) AS orphan_rows, TRUE AS ok FROM r
""")
def fact_orphans_events(spark, sf):
    return checks.orphans(_resolved_events(spark, sf), "user_sk")


FLAGSHIP_SQL = _DAILY_DIM_CTE + """
SELECT user_state, event_type, count(*) AS n_events, count(DISTINCT user_id) AS n_users,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total_value
FROM r GROUP BY user_state, event_type
"""


def flagship(spark, sf):
    """Events rolled up by the user's state *as it was on the event date*."""
    r = _resolved_events(spark, sf, extra={"event_type": "user_state"})
    return (r.groupBy("user_state", "event_type")
             .agg(F.count(F.lit(1)).alias("n_events"),
                  F.count_distinct("user_id").alias("n_users"),
                  F.sum(F.col("value").cast(DecimalType(18, 2))).cast(DecimalType(28, 2)).alias("total_value")))


workload("flagship", FLAGSHIP_SQL)(flagship)


# --------------------------------------------------------------------------
# Files and tables: the landing -> bronze -> silver -> gold loads themselves,
# run over a landing zone staged from ``events`` under the shared scratch
# folder (a new folder per call).

def event_entities():
    """Two entities fed by the ``events`` landing: a user dimension, an event fact."""
    schema = StructType.fromDDL("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
                                "value DOUBLE, props STRING, event_date DATE")
    user = EntitySpec(name="user", keys=("user_id",), schema=schema, kind="dimension", scd_type=2,
                      sk="user_sk", gold_table="dim_user", change_time="ts",
                      carried=("user_id", "event_type"), landing_name="events", ts_type=TimestampNTZType())
    event = EntitySpec(name="event", keys=("event_id",), schema=schema, kind="fact", sk="event_sk",
                       gold_table="fact_event", change_time="ts", event_date="event_date",
                       dimension="user", link_key="user_id", gold_drop=(), landing_name="events",
                       ts_type=TimestampNTZType())
    return [user, event]


def _stage_events(spark, sf, layout, upto: str | None = None, after: str | None = None):
    ev = table(spark, sf, "events").withColumn("event_date", F.to_date("ts"))
    if upto:
        ev = ev.where(F.col("event_date") <= F.lit(upto).cast("date"))
    if after:
        ev = ev.where(F.col("event_date") > F.lit(after).cast("date"))
    landing.write_landing(ev, f"{layout.landing}/events", "event_date")


def _table_rows(spark, sf, name: str) -> int:
    return table(spark, sf, name).count()


def _layout(spark, tag: str):
    u = uuid.uuid4().hex[:8]
    return Layout(root=fresh_dir(spark, tag), bronze_db=f"bronze_{u}", silver_db=f"silver_{u}",
                  gold_db=f"gold_{u}")


def _three_cycles(spark, sf):
    layout = _layout(spark, "cycles")
    specs = event_entities()
    runner.declare(spark, layout, specs)
    prev = None
    report = None
    for cut, load_ts in CUTS:
        _stage_events(spark, sf, layout, upto=cut, after=prev)
        report = runner.run(spark, layout, specs, load_ts)
        prev = cut
    return layout, specs, report


_LAST_CUT_PREV = CUTS[-2][0]

@workload("load_report", _SCD2_USERS_CTE + f""",
facts AS (SELECT e.event_id, e.user_id, CAST(e.ts AS DATE) AS d FROM events e
          WHERE CAST(e.ts AS DATE) <= DATE '{CUTS[-1][0]}'),
orph AS (SELECT count(*) AS o FROM facts f LEFT JOIN k ON f.user_id = k.user_id
         AND f.d >= k.start_effective_date AND (f.d < k.end_effective_date OR k.end_effective_date IS NULL)
         WHERE k.user_sk IS NULL),
last AS (SELECT h.user_id, h.hash_diff, p.hash_diff AS prev_hash FROM h
         LEFT JOIN h p ON p.user_id = h.user_id AND p.n = h.n - 1 WHERE h.n = 3),
dates AS (SELECT count(DISTINCT CAST(ts AS DATE)) AS nd, count(*) AS nr FROM events
          WHERE CAST(ts AS DATE) > DATE '{_LAST_CUT_PREV}' AND CAST(ts AS DATE) <= DATE '{CUTS[-1][0]}')
SELECT 'user' AS entity, 'dimension' AS kind, CAST((SELECT nd FROM dates) AS INTEGER) AS bronze_dates_loaded,
       (SELECT nr FROM dates) AS bronze_rows_loaded, CAST(0 AS INTEGER) AS bronze_folders_skipped,
       (SELECT count(DISTINCT user_id) FROM e WHERE CAST(ts AS DATE) <= DATE '{CUTS[-1][0]}') AS silver_rows,
       CAST(0 AS BIGINT) AS silver_rejected,
       (SELECT count(*) FROM k) AS gold_rows, (SELECT count(*) FROM k WHERE is_active) AS gold_active,
       (SELECT count(*) FROM last WHERE prev_hash IS NULL) AS inserted,
       (SELECT count(*) FROM last WHERE prev_hash <> hash_diff) AS updated,
       (SELECT count(*) FROM k WHERE is_active) - (SELECT count(*) FROM last WHERE prev_hash IS NULL
          OR prev_hash <> hash_diff) AS unchanged,
       CAST(NULL AS BIGINT) AS orphans
UNION ALL
SELECT 'event', 'fact', CAST((SELECT nd FROM dates) AS INTEGER), (SELECT nr FROM dates),
       CAST(0 AS INTEGER), (SELECT count(*) FROM facts), CAST(0 AS BIGINT), (SELECT count(*) FROM facts), NULL, NULL, NULL, NULL,
       (SELECT o FROM orph)
""")
def load_report(spark, sf):
    _, _, report = _three_cycles(spark, sf)
    return report.drop("status", "error")


def _staged_bronze(spark, sf, tag):
    layout = _layout(spark, tag)
    specs = event_entities()
    fact = specs[1]
    runner.declare(spark, layout, [specs[0], fact])
    _stage_events(spark, sf, layout)
    return layout, fact


LOADED_UPTO = "2024-01-20"


@workload("bronze_pending_dates", f"""
SELECT DISTINCT CAST(ts AS DATE) AS bronze_ingest_date FROM events
EXCEPT
SELECT DISTINCT CAST(ts AS DATE) FROM events WHERE CAST(ts AS DATE) <= DATE '{LOADED_UPTO}'
""")
def bronze_pending_dates(spark, sf):
    layout, fact = _staged_bronze(spark, sf, "pending")
    root = layout.landing_dir(fact)
    first = [d for d in landing.landing_dates(spark, root) if d <= LOADED_UPTO]
    bronze.load(spark, fact, layout, dates=first)
    found = landing.dates_frame(spark, landing.landing_dates(spark, root), silver.BRONZE_DATE)
    return bronze.pending_dates(found, bronze.loaded_dates(spark, layout.bronze(fact)))


RELOAD_DAYS = ["2024-01-05", "2024-01-06"]


@workload("bronze_replace_dates", f"""
WITH b AS (
  SELECT CAST(ts AS DATE) AS bronze_ingest_date, user_id,
         CASE WHEN CAST(ts AS DATE) IN ({', '.join(f"DATE '{d}'" for d in RELOAD_DAYS)})
              THEN value * 2 ELSE value END AS value,
         CASE WHEN CAST(ts AS DATE) IN ({', '.join(f"DATE '{d}'" for d in RELOAD_DAYS)})
              THEN TRUE END AS corrected
  FROM events)
SELECT bronze_ingest_date, count(*) AS n_rows, count(DISTINCT user_id) AS n_users,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total_value,
       count(corrected) AS n_corrected
FROM b GROUP BY bronze_ingest_date
""")
def bronze_replace_dates(spark, sf):
    """Load every date, then re-deliver two days with corrected values and a
    new column, and reload just those two days."""
    layout, fact = _staged_bronze(spark, sf, "replace")
    bronze.load(spark, fact, layout)
    ev = table(spark, sf, "events").withColumn("event_date", F.to_date("ts"))
    fixed = (ev.where(F.col("event_date").isin([F.lit(d).cast("date") for d in RELOAD_DAYS]))
               .withColumn("value", F.col("value") * 2).withColumn("corrected", F.lit(True)))
    landing.write_landing(fixed, layout.landing_dir(fact), "event_date", overwrite_dates=True)
    bronze.load(spark, fact, layout, dates=RELOAD_DAYS)
    b = spark.table(layout.bronze(fact))
    return (b.groupBy(silver.BRONZE_DATE)
             .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("user_id").alias("n_users"),
                  F.sum(F.col("value").cast(DecimalType(18, 2))).cast(DecimalType(28, 2)).alias("total_value"),
                  F.count("corrected").alias("n_corrected")))


@workload("schema_drift_union", """
SELECT s_suppkey AS party_key, s_name AS party_name, s_nationkey AS nationkey,
       CAST(s_acctbal AS DECIMAL(12,2)) AS acctbal, CAST(NULL AS VARCHAR) AS segment,
       DATE '2024-01-01' AS bronze_ingest_date FROM supplier
UNION ALL BY NAME
SELECT c_custkey AS party_key, c_name AS party_name, c_nationkey AS nationkey,
       CAST(c_acctbal AS DECIMAL(12,2)) AS acctbal, c_mktsegment AS segment,
       DATE '2024-01-02' AS bronze_ingest_date FROM customer
""")
def schema_drift_union(spark, sf):
    """Day 1 delivers suppliers; day 2 customers with one more column.  Bronze
    absorbs the new column; day-1 rows read it as NULL."""
    layout = _layout(spark, "drift")
    sup = (table(spark, sf, "supplier")
           .select(F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("party_name"),
                   F.col("s_nationkey").alias("nationkey"),
                   F.col("s_acctbal").cast(DecimalType(12, 2)).alias("acctbal")))
    cus = (table(spark, sf, "customer")
           .select(F.col("c_custkey").alias("party_key"), F.col("c_name").alias("party_name"),
                   F.col("c_nationkey").alias("nationkey"),
                   F.col("c_acctbal").cast(DecimalType(12, 2)).alias("acctbal"),
                   F.col("c_mktsegment").alias("segment")))
    spec = EntitySpec(name="party", keys=("party_key",), schema=sup.schema, kind="dimension",
                      scd_type=1, sk="party_sk", gold_table="dim_party", change_time=None)
    tables.declare_database(spark, layout.bronze_db, f"{layout.root}/bronze/_db")
    tables.declare_table(spark, layout.bronze(spec), spec.bronze_schema(), layout.storage("bronze", "party"),
                         partition_by=[silver.BRONZE_DATE])
    root = layout.landing_dir(spec)
    landing.write_landing(sup, root, F.lit("2024-01-01").cast("date"))
    bronze.load(spark, spec, layout)
    landing.write_landing(cus, root, F.lit("2024-01-02").cast("date"))
    bronze.load(spark, spec, layout)
    return spark.table(layout.bronze(spec))


@workload("inventory", _SCD2_USERS_CTE + f"""
SELECT * FROM (VALUES
  ('bronze', 'event', 'EXTERNAL', 8, (SELECT count(*) FROM events WHERE CAST(ts AS DATE) <= DATE '{CUTS[-1][0]}')),
  ('bronze', 'user', 'EXTERNAL', 8, (SELECT count(*) FROM events WHERE CAST(ts AS DATE) <= DATE '{CUTS[-1][0]}')),
  ('silver', 'event', 'EXTERNAL', 8, (SELECT count(*) FROM events WHERE CAST(ts AS DATE) <= DATE '{CUTS[-1][0]}')),
  ('silver', 'user', 'EXTERNAL', 8, (SELECT count(DISTINCT user_id) FROM e WHERE CAST(ts AS DATE) <= DATE '{CUTS[-1][0]}')),
  ('gold', 'dim_user', 'EXTERNAL', 9, (SELECT count(*) FROM k)),
  ('gold', 'fact_event', 'EXTERNAL', 10, (SELECT count(*) FROM events WHERE CAST(ts AS DATE) <= DATE '{CUTS[-1][0]}'))
) AS t(layer, table_name, table_type, n_columns, n_rows)
""")
def inventory(spark, sf):
    """Declared tables of the three layers after the load cycles, with row counts."""
    layout, _, _ = _three_cycles(spark, sf)
    dbs = {layout.bronze_db: "bronze", layout.silver_db: "silver", layout.gold_db: "gold"}
    inv = tables.inventory(spark, list(dbs))
    counts = None
    for db in dbs:
        for t in spark.catalog.listTables(db):
            c = spark.table(f"{db}.{t.name}").agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(db).alias("database"), F.lit(t.name).alias("table_name"), "n_rows")
            counts = c if counts is None else counts.unionByName(c)
    layer = F.element_at(F.create_map(*[x for db, l in dbs.items() for x in (F.lit(db), F.lit(l))]),
                         F.col("database"))
    return (inv.join(counts, ["database", "table_name"])
               .select(layer.alias("layer"), "table_name", "table_type", "n_columns", "n_rows"))


# --------------------------------------------------------------------------
# As-of join on keys with very many versions: the versions are all events of a
# type (five keys hold every row), the facts are all events half an hour later.

_STREAM_CTE = """
WITH v AS (SELECT event_type, ts, max(event_id) AS version_id, max_by(value, event_id) AS value
           FROM events WHERE event_type IS NOT NULL AND ts IS NOT NULL GROUP BY event_type, ts),
f AS (SELECT event_id, event_type, ts + INTERVAL 30 MINUTE AS at FROM events)"""


def _stream(spark, sf):
    ev = table(spark, sf, "events")
    versions = (ev.where("event_type IS NOT NULL AND ts IS NOT NULL").groupBy("event_type", "ts")
                .agg(F.max("event_id").alias("version_id"), F.max_by("value", "event_id").alias("last_value")))
    facts = ev.select("event_id", "event_type", (F.col("ts") + F.expr("INTERVAL 30 MINUTES")).alias("at"))
    return facts, versions


@workload("fact_asof_many_versions", _STREAM_CTE + """
SELECT f.event_id, f.event_type, f.at, v.version_id, v.value AS last_value
FROM f ASOF LEFT JOIN v ON f.event_type = v.event_type AND f.at >= v.ts
""")
def fact_asof_many_versions(spark, sf):
    """Each event with the newest event of its type half an hour later; every key is hot and cut into ranges of time."""
    facts, versions = _stream(spark, sf)
    return resolve(facts, versions, "event_type", "at", sk="version_id", start="ts", end=None, dim_cols=["last_value"],
                   strategy="asof", hot_factor=1, partitions=_table_rows(spark, sf, "events") // 500 + 1, salt_cols=["event_id"])


# --------------------------------------------------------------------------
# Silver and gold contents after loads through the tables.

def _loaded(spark, sf, tag, **how):
    """The event entities after one load of everything; ``how`` goes to the runner."""
    layout, specs = _layout(spark, tag), event_entities()
    runner.declare(spark, layout, specs)
    _stage_events(spark, sf, layout)
    return layout, specs, runner.run(spark, layout, specs, T_NEXT, **how)


_TIES_SQL = f"""
WITH b AS (SELECT event_id, ts, user_id, {_clean('event_type')} AS event_type, value, {_clean('props')} AS props,
                  CAST(ts AS DATE) AS d FROM events),
dup AS (SELECT * FROM b UNION ALL
        SELECT event_id, ts, CASE WHEN event_id % 11 = 0 THEN NULL ELSE user_id END, event_type, value + 1, props, d FROM b WHERE event_id % 3 = 0),
k AS (SELECT user_id, ts, d, count(*) AS n, count(DISTINCT (event_id, event_type, value, props)) AS contents FROM dup
      GROUP BY user_id, ts, d QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, d DESC NULLS LAST) = 1),
tied AS (SELECT count(*) AS n FROM (SELECT user_id FROM dup WHERE user_id IS NOT NULL GROUP BY user_id, ts, d
         HAVING count(DISTINCT (event_id, event_type, value, props)) > 1))
SELECT (SELECT count(*) FROM k WHERE user_id IS NOT NULL) AS silver_rows,
       (SELECT count(*) FROM dup WHERE user_id IS NULL) AS silver_rejected,
       (SELECT count(*) FROM k WHERE user_id IS NOT NULL AND contents > 1) AS ambiguous_keys,
       (SELECT n FROM tied) AS tied_at_any_time
"""


@workload("silver_ties", _TIES_SQL)
def silver_ties(spark, sf):
    """Users whose newest row is tied, beside the ties that a newer row has superseded; NULL keys are rejected."""
    b = _bronze_events(spark, sf)
    again = b.where("event_id % 3 = 0").withColumn("value", F.col("value") + 1).withColumn(
        "user_id", F.when(F.col("event_id") % 11 == 0, F.lit(None)).otherwise(F.col("user_id")))
    both = b.unionByName(again)
    found = silver.grouped(both, USER_KEY, "ts").agg(*silver.measures(USER_KEY))
    each = cleanse_strings(both).where("user_id IS NOT NULL").groupBy("user_id", "ts", silver.BRONZE_DATE).agg(
        F.count_distinct(F.struct("event_id", "event_type", "value", "props")).alias("n"))
    ties = each.agg(F.count_if(F.col("n") > 1).alias("tied_at_any_time"))
    return found.crossJoin(ties).select(F.col("rows").alias("silver_rows"), F.col("rejected").cast("bigint").alias("silver_rejected"),
                                        F.col("ambiguous").alias("ambiguous_keys"), "tied_at_any_time")


LATE_DAY = "2024-01-05"


@workload("bronze_late_files", f"""
SELECT DATE '{LATE_DAY}' AS bronze_ingest_date, 'added' AS change, count(*) AS rows_before,
       2 * count(*) AS rows_after, CAST(0 AS BIGINT) AS late_after
FROM events WHERE CAST(ts AS DATE) = DATE '{LATE_DAY}' HAVING count(*) > 0
""")
def bronze_late_files(spark, sf):
    """A file is added to a date that is loaded already: it is listed, loaded on request, and then no longer listed."""
    layout, fact = _staged_bronze(spark, sf, "late")
    bronze.load(spark, fact, layout)
    rows = lambda: spark.table(layout.bronze(fact)).where(F.col(silver.BRONZE_DATE) == F.lit(LATE_DAY).cast("date")).count()
    before = rows()
    ev = table(spark, sf, "events").withColumn("event_date", F.to_date("ts"))
    landing.write_landing(ev.where(F.col("event_date") == F.lit(LATE_DAY).cast("date")), layout.landing_dir(fact), "event_date")
    late = written(bronze.late_files(spark, fact, layout).select(silver.BRONZE_DATE, "change").distinct(), "late")
    bronze.load(spark, fact, layout, late="reload")
    left = bronze.late_files(spark, fact, layout).count()
    return late.select(silver.BRONZE_DATE, "change", F.lit(before).cast("bigint").alias("rows_before"),
                       F.lit(rows()).cast("bigint").alias("rows_after"), F.lit(left).cast("bigint").alias("late_after"))


@workload("load_outcomes", """
WITH u AS (SELECT count(*) AS n, count(DISTINCT user_id) AS k FROM events)
SELECT 'bad' AS entity, 'failed' AS status, (SELECT n FROM u) AS bronze_rows_loaded, CAST(NULL AS BIGINT) AS silver_rows,
       CAST(NULL AS BIGINT) AS gold_rows, 'ContractError' AS reason
UNION ALL SELECT 'user', 'ok', (SELECT n FROM u), (SELECT k FROM u), (SELECT k FROM u), NULL
UNION ALL SELECT 'event', 'ok', (SELECT n FROM u), (SELECT n FROM u), (SELECT n FROM u), NULL
UNION ALL SELECT 'child', 'skipped', (SELECT n FROM u), (SELECT n FROM u), NULL, 'dimension bad failed'
""")
def load_outcomes(spark, sf):
    """One load cycle with an entity whose business key is too coarse: it fails alone, its facts are skipped."""
    layout = _layout(spark, "outcomes")
    user, event = event_entities()
    # no change time: all rows of a key and date tie, and no tie is allowed
    bad = replace(user, name="bad", gold_table="dim_bad", sk="bad_sk", change_time=None, max_ambiguous=0)
    child = replace(event, name="child", gold_table="fact_child", sk="child_sk", dimension="bad")
    specs = [bad, user, event, child]
    runner.declare(spark, layout, specs)
    _stage_events(spark, sf, layout)
    try:
        runner.run(spark, layout, specs, T_NEXT)
    except runner.LoadsFailed as failed:
        report = failed.report
    return report.select("entity", "status", "bronze_rows_loaded", "silver_rows", "gold_rows",
                         F.regexp_extract("error", "(ContractError|dimension bad failed)", 1).alias("reason"))


@workload("gold_dimension_contents", _SCD2_USERS_CTE + "\nSELECT * FROM k")
def gold_dimension_contents(spark, sf):
    """The SCD2 dimension as three loads through the tables left it: active and closed parts together."""
    layout, specs, _ = _three_cycles(spark, sf)
    return spark.table(layout.gold(specs[0]))


@workload("bronze_reload_empty", f"""
SELECT CAST(ts AS DATE) AS bronze_ingest_date, count(*) AS n_rows FROM events
WHERE CAST(ts AS DATE) <> DATE '{LATE_DAY}' GROUP BY ALL
""")
def bronze_reload_empty(spark, sf):
    """One date is loaded again without a row; the table is dropped and declared anew from what is on storage."""
    layout, fact = _staged_bronze(spark, sf, "empty")
    bronze.load(spark, fact, layout)
    name = layout.bronze(fact)
    tables.replace_partitions(spark, name, spark.createDataFrame([], fact.bronze_schema()), silver.BRONZE_DATE, [LATE_DAY])
    spark.sql(f"DROP TABLE {name}")
    runner.declare(spark, layout, event_entities())
    return spark.table(name).groupBy(silver.BRONZE_DATE).agg(F.count(F.lit(1)).alias("n_rows"))


@workload("bronze_pending_null_date", f"""
SELECT DISTINCT CAST(ts AS DATE) AS bronze_ingest_date FROM events WHERE CAST(ts AS DATE) > DATE '{LOADED_UPTO}'
""")
def bronze_pending_null_date(spark, sf):
    """Loaded dates hold a NULL, which must not hide any pending date."""
    found = table(spark, sf, "events").select(F.to_date("ts").alias(silver.BRONZE_DATE))
    loaded = found.where(F.col(silver.BRONZE_DATE) <= F.lit(LOADED_UPTO).cast("date")).unionByName(
        found.select(F.lit(None).cast("date").alias(silver.BRONZE_DATE)))
    return bronze.pending_dates(found, loaded)


_CLEAN_PART = ", ".join(f"{_clean(c)} AS {c}" for c in ("p_name", "p_brand", "p_type"))


@workload("gold_type1_contents", f"""
WITH typed AS (SELECT p_partkey, {_CLEAN_PART}, p_size, CAST(p_retailprice AS DECIMAL(12,2)) AS p_retailprice FROM part),
prev AS (SELECT * REPLACE (CAST(CASE WHEN p_partkey % 3 = 0 THEN p_retailprice + 1 ELSE p_retailprice END AS DECIMAL(12,2))
                           AS p_retailprice) FROM typed WHERE p_partkey % 5 <> 0),
cur AS (SELECT row_number() OVER (ORDER BY p_partkey) AS part_sk, *, {_lp(PART_ATTRS)} AS hash_diff FROM prev),
inc AS (SELECT *, {_lp(PART_ATTRS)} AS hash_diff FROM typed)
SELECT coalesce(c.part_sk, (SELECT max(part_sk) FROM cur) + row_number() OVER (PARTITION BY c.part_sk IS NULL ORDER BY i.p_partkey)) AS part_sk,
       i.*, CASE WHEN c.hash_diff = i.hash_diff THEN TIMESTAMP '{T_PREV}' ELSE TIMESTAMP '{T_NEXT}' END AS gold_load_ts
FROM inc i LEFT JOIN cur c USING (p_partkey)
""")
def gold_type1_contents(spark, sf):
    """A type-1 dimension as two loads through the tables left it; a row without a key stays out."""
    typed = _typed_part(spark, sf)
    spec = EntitySpec(name="part", keys=" p_partkey , ", schema=typed.schema, kind="dimension", scd_type=1, sk="part_sk",
                      gold_table="dim_part", change_time=None, ts_type=TimestampNTZType())
    layout, k = _layout(spark, "type1"), F.col("p_partkey")
    runner.declare(spark, layout, [spec])
    prev = typed.where(k % 5 != 0).withColumn("p_retailprice", F.when(k % 3 == 0, F.col("p_retailprice") + 1)
                                              .otherwise(F.col("p_retailprice")).cast(DecimalType(12, 2)))
    keyless = typed.where(k == 1).withColumn("p_partkey", F.lit(None).cast("bigint"))
    for load_ts, rows in ((T_PREV, prev), (T_NEXT, typed.unionByName(keyless))):
        landing.write_landing(rows, layout.landing_dir(spec), F.lit(load_ts).cast("timestamp").cast("date"))
        runner.run(spark, layout, [spec], load_ts)
    return spark.table(layout.gold(spec))


@workload("gold_fact_contents", f"""
WITH src AS (SELECT event_id, ts, CASE WHEN event_id % 50 = 0 THEN NULL ELSE user_id END AS user_id,
                    {_clean('event_type')} AS event_type, value, {_clean('props')} AS props FROM events),
last AS (SELECT * FROM src WHERE user_id IS NOT NULL
         QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY {_EVENTS_ORDER}) = 1),
dim AS (SELECT row_number() OVER (ORDER BY user_id) AS user_sk, user_id, ts AS start FROM last)
SELECT f.event_id, f.user_id, dim.user_sk, f.event_type, f.value, CAST(f.ts AS DATE) AS event_date,
       TIMESTAMP '{T_NEXT}' AS gold_load_ts, CAST(1 AS BIGINT) AS least_sk, (SELECT count(*) FROM events) AS greatest_sk,
       (SELECT count(*) FROM events) AS distinct_sk
FROM src f LEFT JOIN dim ON f.user_id = dim.user_id AND CAST(f.ts AS DATE) >= dim.start
""")
def gold_fact_contents(spark, sf):
    """Facts as a load left them: a NULL key is kept without a version, fact keys are dense."""
    layout, (user, event) = _layout(spark, "facts"), event_entities()
    event = replace(event, keys="event_id, ")
    runner.declare(spark, layout, [user, event])
    ev = table(spark, sf, "events").withColumn("event_date", F.to_date("ts")).withColumn(
        "user_id", F.when(F.col("event_id") % 50 != 0, F.col("user_id")))
    landing.write_landing(ev, layout.landing_dir(event), "event_date")
    runner.run(spark, layout, [user, event], T_NEXT)
    facts = spark.table(layout.gold(event))
    keys = facts.agg(F.min("event_sk").alias("least_sk"), F.max("event_sk").alias("greatest_sk"),
                     F.count_distinct("event_sk").alias("distinct_sk"))
    return facts.crossJoin(keys).select("event_id", "user_id", "user_sk", "event_type", "value", "event_date", "gold_load_ts",
                                        "least_sk", "greatest_sk", "distinct_sk")
