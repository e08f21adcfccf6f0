"""Landing zone: one directory per domain, one ``ingest_date=YYYY-MM-DD`` per day.

Discovery lists one directory level through the Hadoop FileSystem of the
path (any scheme Spark can read), so it costs one listing call and returns
one name per date: bounded by the number of dates, never by the data.
Directories whose value is not a valid date are not read, so one stray
``ingest_date=bad`` cannot turn the column into STRING; ``skipped_folders``
names them and the bronze load reports them.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITION = "ingest_date"
_DATE = re.compile(r"^\d{4}-\d{2}-\d{2}$")


def _valid(v: str) -> bool:
    if not _DATE.match(v):
        return False
    try:
        dt.date.fromisoformat(v)
        return True
    except ValueError:
        return False


def _partition_values(spark: SparkSession, root: str, partition: str) -> list[str]:
    """Sorted values of the ``<partition>=<value>`` directories under root."""
    sc = spark.sparkContext
    jpath = sc._jvm.org.apache.hadoop.fs.Path(root)
    fs = jpath.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(jpath):
        return []
    prefix = f"{partition}="
    out = set()
    for st in fs.listStatus(jpath):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix):
            out.add(name[len(prefix):].rstrip("/"))
    return sorted(out)


def landing_dates(spark: SparkSession, root: str, partition: str = PARTITION) -> list[str]:
    """Sorted valid dates delivered under root."""
    return [v for v in _partition_values(spark, root, partition) if _valid(v)]


def skipped_folders(spark: SparkSession, root: str, partition: str = PARTITION) -> list[str]:
    """Delivered folders that no load reads, because their value is no date (a NULL date among them)."""
    return [f"{partition}={v}" for v in _partition_values(spark, root, partition) if not _valid(v)]


def dates_frame(spark: SparkSession, dates: Sequence[str], col: str) -> DataFrame:
    return spark.createDataFrame([(d,) for d in dates], f"{col} string").select(F.col(col).cast("date"))


def read_landing(spark: SparkSession, root: str, dates: Sequence[str], rename_to: str,
                 partition: str = PARTITION) -> DataFrame:
    """Rows of the chosen dates only, the date kept as a DATE column ``rename_to``.

    ``basePath`` keeps the partition column; ``mergeSchema`` reads a column
    that exists in only some dates (NULL elsewhere) instead of taking one
    file's schema.
    """
    bad = [d for d in dates if not _valid(str(d))]
    if bad:
        raise ValueError(f"not dates: {bad}")
    paths = [f"{root.rstrip('/')}/{partition}={d}" for d in dates]
    df = (spark.read.option("basePath", root).option("mergeSchema", "true").parquet(*paths))
    return df.withColumn(partition, F.col(partition).cast("date")).withColumnRenamed(partition, rename_to)


def delivered_files(spark: SparkSession, root: str, dates: Sequence[str], date_col: str,
                    partition: str = PARTITION) -> DataFrame:
    """(date, path, size, modified): the data files of the chosen dates, from the reader's listing.

    No file is opened: of a ``binaryFile`` scan only the file status is read.
    """
    schema = f"{date_col} date, path string, size bigint, modified timestamp"
    if not dates:
        return spark.createDataFrame([], schema)
    paths = [f"{root.rstrip('/')}/{partition}={d}" for d in dates]
    # the date is taken from the path: a folder without a file gives no partition column
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(paths))
    date = F.regexp_extract("path", f"/{partition}=([0-9-]+)/", 1).cast("date")
    return files.select(date.alias(date_col), "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def write_landing(df: DataFrame, root: str, date_col: Column | str, partition: str = PARTITION,
                  overwrite_dates: bool = False) -> None:
    """Lay rows out as a landing directory (used to stage driver tables)."""
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    out = df.withColumn(partition, F.date_format(c, "yyyy-MM-dd"))
    w = out.write.partitionBy(partition)
    if overwrite_dates:
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode("append")
    w.parquet(root)

