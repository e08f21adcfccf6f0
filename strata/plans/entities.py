"""Entity descriptions: everything a load needs to know about one domain.

A load is driven by an ``EntitySpec`` (keys, change time, kind, SCD type,
event date, surrogate key name) plus a ``Layout`` naming the databases and
storage root.  Nothing else is configured per entity.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql.types import (BooleanType, DataType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampType)

from strata.functions.fingerprint import ENCODINGS
from strata.functions.keys import parse_keys
from strata.operators.scd import (ACTIVE, END, HASH_DIFF, LOAD_TS, START, VERSION)
from strata.plans.silver import BRONZE_DATE, SILVER_LOAD_TS

KINDS = ("dimension", "fact")
SCD_TYPES = (1, 2)


@dataclass(frozen=True)
class EntitySpec:
    name: str
    keys: tuple[str, ...]
    schema: StructType
    kind: str
    sk: str
    gold_table: str
    change_time: str | None = "MODIFIED_TS"
    scd_type: int | None = None
    event_date: str | None = None
    dimension: str | None = None          # facts: name of the SCD2 entity to resolve
    link_key: str | None = None           # facts: column shared with that dimension
    carried: tuple[str, ...] | None = None  # gold columns taken from silver
    gold_drop: tuple[str, ...] = ("DOMAIN", "MODIFIED_TS")
    gold_first: tuple[str, ...] = ()
    landing_name: str | None = None
    ts_type: DataType = field(default_factory=TimestampType)
    encoding: str = "length_prefixed"
    max_ambiguous: int | None = None      # most keys without a newest row that silver accepts

    def __post_init__(self):
        object.__setattr__(self, "keys", parse_keys(self.keys))
        if self.kind not in KINDS:
            raise ValueError(f"{self.name}: kind must be one of {KINDS}, got {self.kind!r}")
        if self.kind == "dimension" and self.scd_type not in SCD_TYPES:
            raise ValueError(f"{self.name}: scd_type must be 1 or 2, got {self.scd_type!r}")
        if self.kind == "fact" and (not self.event_date or not self.dimension):
            raise ValueError(f"{self.name}: a fact needs event_date and dimension")
        if self.encoding not in ENCODINGS:
            raise ValueError(f"{self.name}: unknown encoding {self.encoding!r}")
        names = set(self.schema.fieldNames())
        missing = [k for k in self.keys if k not in names]
        if missing:
            raise ValueError(f"{self.name}: key columns not in schema: {missing}")
        for what, col in (("change_time", self.change_time), ("event_date", self.event_date),
                          ("link_key", self.link_key)):
            if col is not None and col not in names:
                raise ValueError(f"{self.name}: {what} column {col!r} not in schema")
        if self.carried is not None:
            absent = [c for c in self.carried if c not in names]
            if absent:
                raise ValueError(f"{self.name}: carried columns not in schema: {absent}")

    # -- column sets -------------------------------------------------------
    @property
    def gold_carried(self) -> list[str]:
        if self.carried is not None:
            return list(self.carried)
        cols = [c for c in self.schema.fieldNames() if c not in self.gold_drop]
        return [*self.gold_first, *[c for c in cols if c not in self.gold_first]]

    @property
    def landing_dir(self) -> str:
        return self.landing_name or self.name

    # -- schemas per layer -------------------------------------------------
    def bronze_schema(self) -> StructType:
        return StructType([*self.schema.fields, StructField(BRONZE_DATE, _date())])

    def silver_schema(self) -> StructType:
        return StructType([*self.schema.fields, StructField(SILVER_LOAD_TS, TimestampType())])

    def gold_schema(self, fk: str | None = None) -> StructType:
        by_name = {f.name: f for f in self.schema.fields}
        carried = [StructField(c, by_name[c].dataType) for c in self.gold_carried]
        ts = self.ts_type
        if self.kind == "fact":
            return StructType([StructField(self.sk, LongType()), StructField(fk or "subject_sk", LongType()),
                               *carried, StructField(LOAD_TS, ts)])
        managed = [StructField(HASH_DIFF, StringType())]
        if self.scd_type == 2:
            managed += [StructField(START, ts), StructField(END, ts), StructField(ACTIVE, BooleanType()),
                        StructField(VERSION, IntegerType())]
        return StructType([StructField(self.sk, LongType()), *carried, *managed, StructField(LOAD_TS, ts)])


def _date():
    from pyspark.sql.types import DateType
    return DateType()


@dataclass(frozen=True)
class Layout:
    """Where the three layers live: database names and a storage root."""
    root: str
    bronze_db: str = "bronze"
    silver_db: str = "silver"
    gold_db: str = "gold"

    @property
    def landing(self) -> str:
        return f"{self.root.rstrip('/')}/landing"

    def landing_dir(self, spec: EntitySpec) -> str:
        return f"{self.landing}/{spec.landing_dir}"

    def bronze(self, spec: EntitySpec) -> str:
        return f"{self.bronze_db}.{spec.name}"

    def silver(self, spec: EntitySpec) -> str:
        return f"{self.silver_db}.{spec.name}"

    def gold(self, spec: EntitySpec) -> str:
        return f"{self.gold_db}.{spec.gold_table}"

    def storage(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"


def target_carried(spark, table: str, filled: Iterable[str]) -> list[str]:
    """What a load takes from silver for a gold table, in the table's order.

    ``filled`` names the columns that the load makes itself: its own key, a
    dimension's key, the managed columns.  The table is asked, not the
    description, so a column added to it by hand is filled from the next load on.
    """
    own = set(filled)
    return list(filter(lambda name: name not in own, spark.table(table).schema.fieldNames()))
