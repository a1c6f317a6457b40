"""A kept index of the attribute values that events are matched by.

The values are written once, bucketed by value, and new ones are appended. A run that is given the index doesn't read or
count the attribute values again, and its joins move the events to the buckets, never the values. Bucketed tables live in the
catalog; the files are a plain folder, which another session opens under a name of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebridge.config import TransferConfig
from casebridge.operators.link import attribute_lookup
from casebridge.operators.spread import Profile
from casebridge.operators.staging import Staged
from casebridge.sources.tables import Tables

COLUMNS = ("person_id", "attribute_uid", "value")


@dataclass(frozen=True)
class ValueIndex:
    """A bucketed table of (person_id, attribute_uid, value), by its name in the catalog."""

    spark: SparkSession
    name: str
    buckets: int

    def lookup(self) -> Staged:
        """The values as a run takes them, with the profiles of their key columns."""
        rows = self.spark.table(self.name)
        return Staged(rows, n := rows.count(), {c: Profile(n, (rows.select(c),)) for c in ("value", "person_id")})

    def add(self, values: DataFrame) -> None:
        """Append values that have come since (``COLUMNS``). They go to the buckets their value has."""
        _write(values, self.name, self.buckets)


def _write(values: DataFrame, name: str, buckets: int, **options: str) -> None:
    # A bucket may have several files, so the rows of a frequent value are written by several tasks.
    rows = values.select(*COLUMNS).where(F.col("value").isNotNull()).hint("rebalance", "value")
    rows.write.format("parquet").bucketBy(buckets, "value").sortBy("value").mode("append").options(**options).saveAsTable(name)


def new_values(t: Tables, cfg: TransferConfig, attribute_values: DataFrame) -> DataFrame:
    """``COLUMNS`` of rows that have come to the attribute value table."""
    return attribute_lookup(t.but(trackedentityattributevalue=attribute_values), cfg)


def build_index(t: Tables, cfg: TransferConfig, name: str, folder: str, buckets: int) -> ValueIndex:
    """Write the values of the match keys to ``folder``, as a new table ``name``."""
    if t.spark.catalog.tableExists(name):
        raise ValueError(f"{name} exists")
    _write(attribute_lookup(t, cfg), name, buckets, path=folder)
    return ValueIndex(t.spark, name, buckets)


def open_index(t: Tables, name: str, folder: str, buckets: int) -> ValueIndex:
    """An index that another session has written to ``folder``, with as many buckets as it has there."""
    kind = t.trackedentityattributevalue.schema["trackedentityinstanceid"].dataType.simpleString()
    place = folder.replace("\\", "\\\\").replace("'", "\\'")
    t.spark.sql(
        f"CREATE TABLE {name} (person_id {kind}, attribute_uid STRING, value STRING) USING parquet "
        f"CLUSTERED BY (value) SORTED BY (value) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    return ValueIndex(t.spark, name, buckets)
