"""String cleansing expressions (silver layer)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cleanse(col: Column | str) -> Column:
    """Without outer blanks, in upper case; NULL if nothing is left.

    Spark's ``trim`` strips U+0020 only, so tabs and no-break spaces survive,
    which is the documented behaviour.  NULL passes straight through:
    ``nullif(NULL, '')`` is NULL.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.nullif(F.upper(F.trim(c)), F.lit(""))


def cleanse_sql(name: str) -> str:
    """``cleanse`` of a (quoted) column as SQL text, for what must be stored as text: a view."""
    return f"nullif(upper(trim({name})), '')"
