"""How published events are laid out: the values jobs look for as columns of their own, files by stage and queue.

A job's queue holds few of all events. A laid-out table keeps the values of the configured document fields as text columns
(``value_<field>``), beside the document, so no job parses a document to find its events; and its files are dealt by stage
and by queue (waiting, transferred, other), so a scan reads the partitions of its queue only. The queue is one of three
words, never a status itself: statuses are free text, and a partition for each could be any number.

These columns follow from the document. Whatever edits documents drops them (``plain``), and publishing adds them anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebridge.config import TRANSFERRED, WAITING, TransferConfig
from casebridge.functions.fields import read_fields

QUEUE = "queuepart"
VALUE = "value_"
PARTITIONS = ("programstageid", QUEUE)


def document_fields(cfg: TransferConfig) -> list[str]:
    """Fields the jobs look at."""
    keys = [k.event_field for k in cfg.match_keys]
    return list(dict.fromkeys([*keys, cfg.request_field, cfg.status_field, cfg.lab_field, cfg.target_facility_field]))


def is_derived(column: str) -> bool:
    return column == QUEUE or column.startswith(VALUE)


def plain(events: DataFrame) -> DataFrame:
    """Events without the columns that follow from the document."""
    return events.drop(*[c for c in events.columns if is_derived(c)])


def has_values(events: DataFrame, fields: list[str]) -> bool:
    return {VALUE + f for f in fields} <= set(events.columns)


def is_laid_out(events: DataFrame) -> bool:
    return QUEUE in events.columns


def lay_out(events: DataFrame, cfg: TransferConfig) -> DataFrame:
    """Add the values of the document and the queue an event is in. Other columns keep their order."""
    rows = read_fields(plain(events), "eventdatavalues", {VALUE + f: f for f in document_fields(cfg)})
    status = F.col(VALUE + cfg.status_field)
    queue = F.when(status == WAITING, "waiting").when(status == TRANSFERRED, "transferred").otherwise("other")
    return rows.withColumn(QUEUE, queue)


def write_base(events: DataFrame, cfg: TransferConfig, path: str) -> None:
    """Write a whole event table by stage and queue. Rows of one partition go to few tasks, large ones are cut."""
    lay_out(events, cfg).hint("rebalance", *PARTITIONS).write.partitionBy(*PARTITIONS).parquet(path)


def read_base(like: DataFrame, path: str) -> DataFrame:
    """A table of ``write_base``; the stage has the type it has in ``like``."""
    rows = like.sparkSession.read.parquet(path)
    kind = like.schema["programstageid"].dataType
    return rows if rows.schema["programstageid"].dataType == kind else rows.withColumn("programstageid", F.col("programstageid").cast(kind))


def in_queues(events: DataFrame) -> DataFrame:
    """Events that wait or were transferred: a filter on partitions where there are any."""
    return events.where(F.col(QUEUE).isin("waiting", "transferred")) if is_laid_out(events) else events
