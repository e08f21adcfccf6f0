"""Change fingerprint (``hash_diff``) over a row's non-key attributes.

Three encodings of the attribute list are offered:

* ``"plain"``: each value cast to text, NULL written as ``~``, joined with
  ``||``, then SHA-256.  This is the historical encoding.  It is ambiguous:
  ``("a||b", "c")`` and ``("a", "b||c")`` give the same text, and a real ``~``
  equals NULL, so a genuine change can be missed.
* ``"length_prefixed"`` (default): each value written as ``<chars>:<text>``,
  NULL as ``#``, joined with ``|``.  Every piece is self-delimiting, so two
  different attribute tuples never share a text.
* ``"typed"``: as before, but numbers, booleans, dates and timestamps are
  written without their length.  Their text never holds ``|`` or ``#``, and the
  place in the list tells which pieces have a length, so this text is unique
  too, shorter and cheaper.  It needs the schema.  A table keeps the encoding that
  it was filled with: another one makes every row look changed.

All are plain JVM expressions (``sha2`` over ``concat_ws``); no Python runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StructType, TimestampNTZType, TimestampType

# Fixed values of the plain encoding (must stay as they are for parity).
PLAIN_SEPARATOR = "||"
PLAIN_NULL = "~"

ENCODINGS = ("plain", "length_prefixed", "typed")
_UNPREFIXED = (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def _prefixed(c: str) -> Column:
    # concat() is NULL when its input is, so the caller's coalesce() marks NULL
    return F.concat(F.length(_text(c)).cast("string"), F.lit(":"), _text(c))


def hash_diff(attrs: Sequence[str], encoding: str = "length_prefixed", schema: StructType | None = None) -> Column:
    """SHA-256 of the attributes; ``schema`` (of the frame it is used on) is needed by ``typed`` alone."""
    if encoding not in ENCODINGS:
        raise ValueError(f"unknown fingerprint encoding {encoding!r}; use one of {ENCODINGS}")
    if encoding == "plain":
        pieces = [F.coalesce(_text(c), F.lit(PLAIN_NULL)) for c in attrs]
        return F.sha2(F.concat_ws(PLAIN_SEPARATOR, *pieces), 256)
    if encoding == "typed" and schema is None:
        raise ValueError("the typed fingerprint needs the schema")
    short = {f.name for f in schema.fields if isinstance(f.dataType, _UNPREFIXED)} if encoding == "typed" else set()
    pieces = [F.coalesce(_text(c) if c in short else _prefixed(c), F.lit("#")) for c in attrs]
    return F.sha2(F.concat_ws("|", *pieces), 256)
