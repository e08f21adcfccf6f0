"""Catalog tables: declaration, reads, and the three write modes of the loads.

Spark's built-in Parquet tables refuse MERGE, IDENTITY and ``REPLACE WHERE``,
so the gold operators compute the next state and this module swaps it in.  The
write modes:

* ``replace_partitions`` (bronze): dynamic partition overwrite of the dates in
  the batch; every other date is untouched.  Requested dates that arrive
  empty are emptied on storage too and dropped from the table.
* ``replace`` (silver, gold): the new state goes to a *fresh* directory, is
  checked there, and only then marked as accepted and made the table's location
  (``ALTER TABLE ... SET LOCATION``).  A state that fails its check is never
  visible and never re-attached.  A plan that reads
  the table while computing its next state keeps reading the old files, the
  table stays EXTERNAL, and old directories are never deleted by a load.
* ``replace_history`` (SCD2 dimensions): the table is partitioned by its flag of
  active rows.  Active rows are a state as above; versions that a load closes are
  added as files to the one folder of closed versions, where older files are
  never read, written or moved by a load.
* ``evolve``: additive schema evolution (new columns are appended with
  ``ALTER TABLE ADD COLUMNS``; old files read them as NULL).

There is no multi-table transaction: a load is safe to re-run, not ACID.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import CharType, DataType, DecimalType, StructField, StructType, VarcharType

from strata.session import written

ROOT_PROPERTY = "strata.root"
ACCEPTED = "_ACCEPTED"
#: In a state that replaced a whole history: the closed versions, to which later loads add.
HISTORY = "history"


def _q(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ddl(fields: Iterable[StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def declare_database(spark: SparkSession, name: str, location: str | None = None,
                     comment: str | None = None) -> None:
    sql = f"CREATE DATABASE IF NOT EXISTS {_q(name)}"
    if comment:
        sql += f" COMMENT {_text(comment)}"
    if location:
        sql += f" LOCATION {_text(location)}"
    spark.sql(sql)


def _new_version(root: str) -> str:
    """A fresh state directory; names sort by creation time (UTC)."""
    stamp = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return f"{root.rstrip('/')}/v-{stamp}-{uuid.uuid4().hex[:8]}"


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(sc._jsc.hadoopConfiguration())


def latest_version(spark: SparkSession, root: str, holding: str = "") -> str | None:
    """Newest accepted state directory under ``root`` (one listing call), that has the folder ``holding``."""
    jpath, fs = _fs(spark, root)
    if not fs.exists(jpath):
        return None
    done = []
    for st in fs.listStatus(jpath):
        p = st.getPath()
        if st.isDirectory() and p.getName().startswith("v-"):
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
            if fs.exists(path(p, ACCEPTED)) and (not holding or fs.exists(path(p, holding))):
                done.append(p.toString())
    return max(done, key=lambda x: x.rsplit("/", 1)[1]) if done else None


def declare_table(spark: SparkSession, name: str, schema: StructType, root: str,
                  partition_by: Sequence[str] = (), comment: str | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS ... USING PARQUET ... LOCATION`` (idempotent).

    Partition columns go last, as Spark stores them.  A table missing from
    the catalog (a new session on an in-memory catalog, a dropped external
    table) re-attaches to what is on storage: the newest accepted state
    directory, or, for a partitioned table, its partition directories.
    """
    part = [schema[c] for c in partition_by]
    data = [f for f in schema.fields if f.name not in partition_by]
    sql = f"CREATE TABLE IF NOT EXISTS {_q(name)} ({_ddl([*data, *part])}) USING PARQUET"
    if partition_by:
        sql += f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})"
    if comment:
        sql += f" COMMENT {_text(comment)}"
    if exists(spark, name):
        return
    location = root if partition_by else (latest_version(spark, root) or _new_version(root))
    sql += f" LOCATION {_text(location)} TBLPROPERTIES ({_text(ROOT_PROPERTY)} = {_text(root)})"
    spark.sql(sql)
    if partition_by:
        jpath, fs = _fs(spark, root)
        if fs.exists(jpath):
            spark.sql(f"ALTER TABLE {_q(name)} RECOVER PARTITIONS")


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def describe(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_q(name)}").collect()
    return {r["col_name"]: r["data_type"] for r in rows if r["col_name"]}


def location(spark: SparkSession, name: str) -> str:
    return describe(spark, name)["Location"]


def _root(spark: SparkSession, name: str) -> str:
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_q(name)}").collect()}
    return props.get(ROOT_PROPERTY) or location(spark, name).rsplit("/v-", 1)[0]


def evolve(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """Add the batch's new columns to the table, then align the batch to it.

    Returns ``df`` projected to the table's column order (partition columns
    last), with NULLs for table columns the batch lacks.  A column whose type
    the table's cannot hold in full is an error (``align``).
    """
    table_schema = spark.table(name).schema
    norm = _normaliser(spark)
    have = {norm(f.name) for f in table_schema.fields}
    new = [f for f in df.schema.fields if norm(f.name) not in have]
    if new:
        spark.sql(f"ALTER TABLE {_q(name)} ADD COLUMNS ({_ddl(new)})")
        spark.catalog.refreshTable(name)
        table_schema = spark.table(name).schema
    return align(df, table_schema)


def _normaliser(spark: SparkSession):
    """Column-name comparison as Spark resolves names (case-insensitive by default)."""
    sensitive = str(spark.conf.get("spark.sql.caseSensitive", "false")).lower() == "true"
    return (lambda c: c) if sensitive else (lambda c: c.lower())


#: Whole-number types with the decimal digits of their largest value.
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def lossless(have: DataType, want: DataType) -> bool:
    """Whether every value of one type is kept by a cast to the other."""
    a, b = have.simpleString(), want.simpleString()
    if a in (b, "void"):
        return True
    if a in _DIGITS and b in _DIGITS:
        return _DIGITS[a] <= _DIGITS[b]
    if isinstance(want, DecimalType):
        if isinstance(have, DecimalType):
            return have.scale <= want.scale and have.precision - have.scale <= want.precision - want.scale
        return a in _DIGITS and _DIGITS[a] <= want.precision - want.scale
    if (a, b) in (("float", "double"), ("date", "timestamp"), ("date", "timestamp_ntz")):
        return True
    if b == "double":
        return a in ("tinyint", "smallint", "int")
    return b == "string" and (a in _DIGITS or a in ("date", "boolean") or isinstance(have, (DecimalType, VarcharType, CharType)))


def align(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: by name, NULL where absent; only casts that lose nothing."""
    norm = _normaliser(df.sparkSession)
    present = {norm(c): c for c in df.columns}
    lossy = [f"{f.name}: {df.schema[present[norm(f.name)]].dataType.simpleString()} into {f.dataType.simpleString()}"
             for f in schema.fields if norm(f.name) in present
             and not lossless(df.schema[present[norm(f.name)]].dataType, f.dataType)]
    if lossy:
        raise ValueError(f"columns that the table cannot hold without loss: {lossy}")
    return df.select(*[(F.col(present[norm(f.name)]) if norm(f.name) in present else F.lit(None))
                       .cast(f.dataType).alias(f.name) for f in schema.fields])


def replace_partitions(spark: SparkSession, name: str, df: DataFrame, part_col: str,
                       values: Sequence) -> int:
    """Replace the partitions ``values`` with the batch's rows; returns rows written.

    The rows go to the table's location with the writer's own
    ``partitionOverwriteMode=dynamic`` option, so only the dates present in the
    batch are rewritten and no session setting changes (loads may run
    concurrently).  New dates are then registered in the catalog; dates listed
    in ``values`` that receive no row are dropped from it.
    """
    batch = evolve(spark, name, df)
    obs = Observation(f"replace_{uuid.uuid4().hex[:8]}")
    batch = batch.observe(obs, F.count(F.lit(1)).alias("rows"),
                          F.collect_set(F.col(part_col).cast("string")).alias("parts"))
    (batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy(part_col).parquet(location(spark, name)))
    m = obs.get
    written = sorted(set(m["parts"] or []))
    if written:
        specs = " ".join(f"PARTITION (`{part_col}` = '{v}')" for v in written)
        spark.sql(f"ALTER TABLE {_q(name)} ADD IF NOT EXISTS {specs}")
    bare = StructType([f for f in batch.schema.fields if f.name != part_col])
    for v in values:
        if str(v) not in written:
            # no row of an earlier delivery may come back when the partitions are recovered
            spark.createDataFrame([], bare).coalesce(1).write.mode("overwrite").parquet(
                f"{location(spark, name).rstrip('/')}/{part_col}={v}")
            spark.sql(f"ALTER TABLE {_q(name)} DROP IF EXISTS PARTITION (`{part_col}` = '{v}')")
    spark.catalog.refreshTable(name)
    return int(m["rows"])


def replace(spark: SparkSession, name: str, df: DataFrame, observe=None, helpers: Sequence[str] = (),
            widen: bool = False, check: Callable[[DataFrame], None] | None = None) -> dict:
    """Write the whole new state to a fresh directory, check it there, then point the table at it.

    The table keeps its declared column order.  ``helpers`` names columns of
    the state that are observed but not stored.  Other columns the table lacks
    are added to it with ``widen``, else they are an error.  ``observe`` = list
    of aggregate columns measured while writing (no extra pass); their values
    are returned.  ``check`` gets the written state and raises if it must not
    be published: the table then still shows the old one.
    """
    norm = _normaliser(spark)
    schema = spark.table(name).schema
    have = {norm(c) for c in [*schema.fieldNames(), *helpers]}
    new = [f for f in df.schema.fields if norm(f.name) not in have]
    if new and not widen:
        raise ValueError(f"{name}: state has columns the table lacks: {[f.name for f in new]}")
    metrics: dict = {}
    obs = None
    if observe:
        obs = Observation(f"replace_{uuid.uuid4().hex[:8]}")
        df = df.observe(obs, *observe)
    schema = StructType([*schema.fields, *new])
    target, flag = _new_version(_root(spark, name)), history_flag(spark, name)
    state = align(df, schema)
    if flag is None:
        state.write.mode("errorifexists").parquet(target)
        stored = spark.read.schema(schema).parquet(target)
    else:  # both parts anew: what was closed before is no longer shown
        state = written(state, "history")
        is_on, bare = F.coalesce(F.col(flag), F.lit(False)), [f.name for f in schema.fields if f.name != flag]
        for part, rows in (("active", state.where(is_on)), (HISTORY, state.where(~is_on))):
            rows.select(*bare).write.parquet(f"{target}/{part}")
        stored = state
    if check is not None:
        check(stored)
    path, fs = _fs(spark, f"{target}/{ACCEPTED}")
    fs.create(path).close()
    if new:
        spark.sql(f"ALTER TABLE {_q(name)} ADD COLUMNS ({_ddl(new)})")
    if flag is None:
        spark.sql(f"ALTER TABLE {_q(name)} SET LOCATION {_text(target)}")
    else:
        settle(spark, name, flag)
    spark.catalog.refreshTable(name)
    if obs is not None:
        metrics = dict(obs.get)
    return metrics


def declare_history(spark: SparkSession, name: str, schema: StructType, root: str, flag: str,
                    comment: str | None = None) -> None:
    """``declare_table`` for a table of active and closed versions, partitioned by ``flag``."""
    if exists(spark, name):
        return
    data = [f for f in schema.fields if f.name != flag]
    sql = f"CREATE TABLE {_q(name)} ({_ddl([*data, schema[flag]])}) USING PARQUET PARTITIONED BY (`{flag}`)"
    if comment:
        sql += f" COMMENT {_text(comment)}"
    spark.sql(f"{sql} LOCATION {_text(root)} TBLPROPERTIES ({_text(ROOT_PROPERTY)} = {_text(root)})")
    settle(spark, name, flag)


def history_flag(spark: SparkSession, name: str) -> str | None:
    """The flag that a table of active and closed versions is partitioned by; None for any other table."""
    parts = [c for c in spark.catalog.listColumns(name) if c.isPartition]
    return parts[0].name if len(parts) == 1 and parts[0].dataType == "boolean" else None


def part_location(spark: SparkSession, name: str, flag: str, value: bool) -> str | None:
    """Where the active or the closed versions of a table are; None before the first load."""
    spec = f"`{flag}` = {str(value).lower()}"
    if not spark.sql(f"SHOW PARTITIONS {_q(name)} PARTITION ({spec})").head(1):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_q(name)} PARTITION ({spec})").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def settle(spark: SparkSession, name: str, flag: str) -> None:
    """Let the table show its newest accepted state, whatever an interrupted load left undone.

    A state is published in two steps: its active rows become the table's,
    then the versions it closed are moved among the closed ones, each file under
    a name of its own.  Both can be repeated, so the next load (or declaration)
    finishes what an interrupted one began.
    """
    root = _root(spark, name)
    state = latest_version(spark, root)
    if state is None:
        return
    whole = latest_version(spark, root, HISTORY)
    active, closed = f"{state}/active", f"{whole}/{HISTORY}" if whole else f"{root.rstrip('/')}/closed"
    if part_location(spark, name, flag, True) is None:
        spark.sql(f"ALTER TABLE {_q(name)} ADD PARTITION (`{flag}` = true) LOCATION {_text(active)}")
    else:
        spark.sql(f"ALTER TABLE {_q(name)} PARTITION (`{flag}` = true) SET LOCATION {_text(active)}")
    jstate, fs = _fs(spark, f"{state}/closed")
    jclosed, _ = _fs(spark, closed)
    fs.mkdirs(jclosed)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for st in fs.listStatus(jstate) if fs.exists(jstate) else []:
        file = st.getPath().getName()
        if file.startswith("part-"):
            # a unique name: the state's, so that a repeated move finds nothing left to do
            if not fs.rename(st.getPath(), path(jclosed, f"part-{state.rsplit('/', 1)[1]}-{file}")):
                raise OSError(f"{st.getPath().toString()} could not be moved to {closed}")
    now = part_location(spark, name, flag, False)
    if now is None:
        spark.sql(f"ALTER TABLE {_q(name)} ADD PARTITION (`{flag}` = false) LOCATION {_text(closed)}")
    elif not now.endswith(closed.split(":", 1)[-1]):
        spark.sql(f"ALTER TABLE {_q(name)} PARTITION (`{flag}` = false) SET LOCATION {_text(closed)}")
    spark.catalog.refreshTable(name)


def replace_history(spark: SparkSession, name: str, active: DataFrame, closed: DataFrame | None, flag: str,
                    helpers: Sequence[str] = (), observe=None,
                    check: Callable[[list[DataFrame]], None] | None = None) -> dict:
    """Write the whole of the active rows and the newly closed ones, check them, then publish both.

    ``closed`` holds only versions that this load closes (None: it closes none);
    they join those of earlier loads.  ``check`` gets the parts as written and
    raises if they must not be published.  ``observe`` is measured on the active
    rows.
    """
    schema = spark.table(name).schema
    norm = _normaliser(spark)
    have = {norm(c) for c in [*schema.fieldNames(), *helpers]}
    new = {"active": active, **({} if closed is None else {"closed": closed})}
    if odd := {c for df in new.values() for c in df.columns if norm(c) not in have}:
        raise ValueError(f"{name}: state has columns the table lacks: {sorted(odd)}")
    bare = StructType([f for f in schema.fields if f.name != flag])
    obs = None
    if observe:
        obs = Observation(f"history_{uuid.uuid4().hex[:8]}")
        new["active"] = active.observe(obs, *observe)
    target = _new_version(_root(spark, name))
    for part, df in new.items():
        rows = align(df, bare)
        # closed rows are few from many tasks: one shuffle of theirs, so that they make few files
        (rows if part == "active" else rows.repartition(F.col(bare.fields[0].name))).write.parquet(f"{target}/{part}")
    if check is not None:
        check([spark.read.schema(bare).parquet(f"{target}/{part}").withColumn(flag, F.lit(part == "active")) for part in new])
    path, fs = _fs(spark, f"{target}/{ACCEPTED}")
    fs.create(path).close()
    settle(spark, name, flag)
    return dict(obs.get) if obs is not None else {}


def partitions(spark: SparkSession, name: str) -> list[str]:
    """Values of the single partition column, from the catalog (no data scan)."""
    rows = spark.sql(f"SHOW PARTITIONS {_q(name)}").collect()
    return sorted(r[0].split("=", 1)[1] for r in rows)


def inventory(spark: SparkSession, databases: Sequence[str]) -> DataFrame:
    """One row per table of the given databases: type, provider, location, width."""
    rows = []
    for db in databases:
        for t in spark.catalog.listTables(db):
            full = f"{db}.{t.name}"
            d = describe(spark, full)
            n_cols = len(spark.table(full).columns)
            rows.append((db, t.name, d.get("Type"), d.get("Provider"), d.get("Location"), n_cols))
    schema = ("database string, table_name string, table_type string, provider string, "
              "location string, n_columns int")
    return spark.createDataFrame(rows, schema)
