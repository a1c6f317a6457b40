"""Apply change sets to tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebridge.functions.fields import set_value
from casebridge.sources.layout import plain


def apply_changes(base: DataFrame, changes: DataFrame, key: str | list[str], columns: dict[str, str]) -> DataFrame:
    """New snapshot of ``base``: ``columns`` maps a column to the change column that replaces it.

    ``changes`` has one row per key; NULL in a change column leaves the value as it is.
    """
    on = [key] if isinstance(key, str) else key
    joined = base.join(changes.select(*on, *columns.values()), on, "left")
    return joined.select(
        *[F.coalesce(columns[c], c).alias(c) if c in columns else F.col(c) for c in base.columns]
    )


def apply_event_changes(events: DataFrame, changes: DataFrame, status_field: str) -> DataFrame:
    """New snapshot of event rows from (event_id, new_status, new_transfer_status, new_document).

    A new document comes first, then the transfer status is set in it. Documents without a change stay
    the text they were. Columns derived from documents go.
    """
    events = plain(events)
    joined = events.withColumn("event_id", F.col("programstageinstanceid").cast("bigint")).join(
        changes, "event_id", "left"
    )
    document = F.coalesce("new_document", "eventdatavalues")
    flagged = set_value(document, status_field, F.col("new_transfer_status"))
    return joined.withColumns(
        {
            "status": F.coalesce("new_status", "status"),
            "eventdatavalues": F.when(F.col("new_transfer_status").isNotNull(), flagged).otherwise(document),
        }
    ).select(*events.columns)


def merge_into(table: str, changes: DataFrame, key: str, columns: dict[str, str]) -> None:
    """Apply a change set in place, for catalog tables whose format supports MERGE."""
    condition = F.expr(f"{table}.{key} = changes.{key}")
    assigned = {c: F.coalesce(F.col(f"changes.{n}"), F.col(f"{table}.{c}")) for c, n in columns.items()}
    changes.alias("changes").mergeInto(table, condition).whenMatched().update(assigned).merge()
