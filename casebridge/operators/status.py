"""Mark the events that were linked as transferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebridge.config import ACTIVE, COMPLETED, TRANSFERRED, TransferConfig
from casebridge.operators.copies import is_waiting_link


def _marked_links(links: DataFrame, cfg: TransferConfig) -> DataFrame:
    linked = links.where(is_waiting_link())
    return linked.where("in_program") if cfg.require_program else linked


def _has_lab() -> Column:
    """A blank result counts as missing here."""
    return F.coalesce(F.col("lab") != "", F.lit(False))


def mark_transferred(links: DataFrame, cfg: TransferConfig) -> DataFrame:
    """Change set (event_id, new_status, new_transfer_status): one row per waiting event with a link.

    Links of any program count, unless ``require_program``: the original job copies by program and
    marks without it.
    """
    events = _marked_links(links, cfg).select("event_id", _has_lab().alias("has_lab")).distinct()
    return events.select(
        "event_id",
        F.when(F.col("has_lab"), COMPLETED).otherwise(ACTIVE).alias("new_status"),
        F.lit(TRANSFERRED).alias("new_transfer_status"),
    )


def status_changes(links: DataFrame, lab: DataFrame, cfg: TransferConfig) -> DataFrame:
    """Marks and completed lab events in one change set; a completion overrides the mark's status."""
    marked = _marked_links(links, cfg).select("event_id", _has_lab().alias("complete"), F.lit(True).alias("mark"))
    completed = lab.select("event_id", F.lit(True).alias("complete"), F.lit(False).alias("mark"))
    events = marked.unionByName(completed).groupBy("event_id")
    return events.agg(F.max("complete").alias("complete"), F.max("mark").alias("mark")).select(
        "event_id",
        F.when(F.col("complete"), COMPLETED).otherwise(ACTIVE).alias("new_status"),
        F.when(F.col("mark"), TRANSFERRED).alias("new_transfer_status"),
    )
