"""Written intermediate tables, in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from strata.session import fresh_dir


def saved(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once as Parquet and read back: later jobs never compute them again."""
    path = fresh_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spare_names(df: DataFrame, *wanted: str) -> dict[str, str]:
    """For each wanted name one that no column of ``df`` has, in any case."""
    taken = {c.lower() for c in df.columns}
    out = {}
    for name in wanted:
        free = f"strata_{name}"
        while free.lower() in taken:
            free += "_"
        taken.add(free.lower())
        out[name] = free
    return out
