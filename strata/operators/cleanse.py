"""Type-driven cleansing of every string column, as a single projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StringType

from strata.functions.text import cleanse


def cleanse_strings(df: DataFrame) -> DataFrame:
    """``cleanse`` every STRING column of a frame.

    Built as one ``select`` over the schema (one Project node), other types
    pass through untouched with their own types.
    """
    cols = [cleanse(f.name).alias(f.name) if isinstance(f.dataType, StringType)
            else df[f.name] for f in df.schema.fields]
    return df.select(*cols)
