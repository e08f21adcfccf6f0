"""Business-key helpers: parsing, NULL detection."""

from __future__ import annotations

from functools import reduce
from operator import or_
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_keys(spec: str | Sequence[str]) -> tuple[str, ...]:
    """``"USUBJID, VSSEQ "`` -> ``("USUBJID", "VSSEQ")``; empty names are dropped."""
    parts = spec.split(",") if isinstance(spec, str) else list(spec)
    keys = tuple(p.strip() for p in parts if p and p.strip())
    if not keys:
        raise ValueError(f"empty business key: {spec!r}")
    return keys


def any_null(keys: Iterable[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])
