"""Bronze -> silver: the newest cleansed row of every business key.

Silver is made anew from the whole of bronze each time.  There is no mark of
how far a run came: a repeated run gives the same rows, and a change to the
cleansing reaches old rows too.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampType

from strata.functions.keys import any_null
from strata.functions.text import cleanse_sql
from strata.operators import checks
from strata.operators.cleanse import cleanse_strings
from strata.operators.dedup import N_ROWS, TIED, latest_per_key, newest_per_key, split_null_keys
from strata.operators.scd import ts_literal
from strata.sources import tables

BRONZE_DATE = "bronze_ingest_date"
SILVER_LOAD_TS = "silver_load_ts"


def current_state(bronze: DataFrame, keys: Sequence[str], change_time: str | None,
                  ingest_col: str | None = BRONZE_DATE,
                  tiebreak: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(silver rows, rows rejected for a NULL business key).

    Newest first by change time, an unknown one last; then by ingest date, so
    that an old file delivered late does not win over newer data; then by all
    other columns, so that ties have one outcome.  The ingest date stays behind
    in bronze.
    """
    cleansed = cleanse_strings(bronze)
    keyed, rejected = split_null_keys(cleansed, keys)
    has_ingest = ingest_col is not None and ingest_col in bronze.columns
    order = [c for c in [change_time, ingest_col if has_ingest else None] if c]
    latest = latest_per_key(keyed, keys, order, tiebreak)
    if has_ingest:
        latest = latest.drop(ingest_col)
    return latest, rejected


def rejected_table(layout, spec) -> str:
    return f"{layout.silver(spec)}__rejected"


def rejected_view(spark, layout, spec) -> None:
    """A view of the bronze rows whose cleansed key is NULL, cleansed.

    A stored view is SQL text: ``text.cleanse_sql`` is the one other form of the
    cleansing rule, and a test holds both to the same results.
    """
    def q(name):
        return ".".join(f"`{p}`" for p in name.split("."))

    fields = spark.table(layout.bronze(spec)).schema.fields
    cols = ", ".join(f"{cleanse_sql(q(f.name))} AS {q(f.name)}" if isinstance(f.dataType, StringType) else q(f.name)
                     for f in fields)
    gone = " OR ".join(f"{q(k)} IS NULL" for k in spec.keys)
    spark.sql(f"CREATE OR REPLACE VIEW {q(rejected_table(layout, spec))} AS SELECT * FROM "
              f"(SELECT {cols} FROM {q(layout.bronze(spec))}) WHERE {gone}")


def stamp(df: DataFrame, load_ts) -> DataFrame:
    return df.withColumn(SILVER_LOAD_TS, ts_literal(load_ts, TimestampType()))


def grouped(bronze: DataFrame, keys: Sequence[str], change_time: str | None) -> DataFrame:
    """Every key's newest cleansed row with the number of its rows and whether it is tied; NULL keys are groups too."""
    order = [c for c in (change_time, BRONZE_DATE if BRONZE_DATE in bronze.columns else None) if c]
    return newest_per_key(cleanse_strings(bronze), keys, order)


def measures(keys: Sequence[str]) -> list[Column]:
    """Aggregates over ``grouped``: silver rows, rejected bronze rows, keys without a newest row."""
    null_key = any_null(keys)
    return [F.count_if(~null_key).alias("rows"),
            F.coalesce(F.sum(F.when(null_key, F.col(N_ROWS))), F.lit(0)).alias("rejected"),
            F.count_if(~null_key & F.col(TIED)).alias("ambiguous")]


def load(spark, spec, layout, load_ts, verify: bool = True, quarantine: bool = True) -> dict:
    """Silver from all of bronze; columns that bronze has gained are added to it.

    Returns {rows, rejected}, and {ambiguous} if any.  Rows whose business key is NULL or
    blank cannot enter silver; with ``quarantine`` they stay readable, cleansed,
    through the view ``<silver table>__rejected`` over bronze.  ``verify`` counts
    the keys whose newest rows (by change time and ingest date) differ in content:
    none of them is the newest, as happens when the business key is too coarse.
    More than ``spec.max_ambiguous`` such keys (if set) stop the load before
    anything is published.

    Bronze is read once: state, rejected rows and ties come from one aggregate,
    and are measured while the state is written.
    """
    bronze = spark.table(layout.bronze(spec))
    found = grouped(bronze, spec.keys, spec.change_time)
    seen = Observation(f"silver_{uuid.uuid4().hex[:8]}")
    kept = found.observe(seen, *measures(spec.keys)).where(~any_null(spec.keys))
    state = kept.drop(N_ROWS, TIED, BRONZE_DATE)

    def check(_: DataFrame) -> None:
        tied, limit = seen.get["ambiguous"], spec.max_ambiguous
        if verify and limit is not None and tied > limit:
            raise checks.ContractError(
                f"silver {spec.name}: {tied} keys have different rows of one change time and ingest "
                f"date (at most {limit} allowed); is {', '.join(spec.keys)} the whole business key?")
    tables.replace(spark, layout.silver(spec), stamp(state, load_ts), widen=True, check=check)
    out = {"rows": seen.get["rows"], "rejected": seen.get["rejected"]}
    if verify and seen.get["ambiguous"]:
        out["ambiguous"] = seen.get["ambiguous"]
    if quarantine and out["rejected"]:
        rejected_view(spark, layout, spec)
    return out
