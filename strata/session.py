"""Spark session defaults and the shared scratch area.

Everything that must survive an executor loss (checkpoints, swapped-in table
directories, landing copies built by the example workloads) lives under the
folder the cluster names in ``spark.checkpoint.dir``.  We only pick our own
folder when that setting is unset *and* Spark runs in local mode (tests, the
bench); on a cluster an unset value is an error, never a silent fallback to a
machine-local temporary directory.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the loads rely on.  UTC matters: a DATE compared with a TIMESTAMP is
# cast to midnight in the session time zone.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the call site of every Column call costs more than the call itself
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    """Session used by tests and the bench (never by library code)."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g"))
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def scratch_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a private one only in local mode."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is unset: point it at a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="strata-ckpt-"))
    return sc.getCheckpointDir()


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, never reused folder under the shared scratch root."""
    return f"{scratch_root(spark).rstrip('/')}/strata/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str = "rows") -> DataFrame:
    """The same rows, written once as Parquet under the scratch root and read back.

    Computed a single time, whatever reads them and whichever executor is lost;
    Spark takes their size from the files, so joins with them are planned by
    what was measured and not by a product of estimates.
    """
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
