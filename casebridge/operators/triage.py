"""Sort waiting events that could not be linked into review classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebridge.config import CHECK_NAME, ID_NOT_FOUND, NO_MATCH, TransferConfig
from casebridge.operators.link import is_waiting
from casebridge.sources.tables import Tables


def triage(t: Tables, cfg: TransferConfig, matched: DataFrame) -> DataFrame:
    """Change set (event_id, new_transfer_status) from the match counts of the first two keys.

    The classes exclude each other, so one pass sets all three. Without both attributes in the
    catalogue nothing is flagged.
    """
    by_id, by_name = F.col("n_0") > 0, F.col("n_1") > 0
    flag = F.when(by_id & ~by_name, CHECK_NAME).when(~by_id & ~by_name, NO_MATCH).when(~by_id & by_name, ID_NOT_FOUND)
    waiting = matched.where(is_waiting(cfg))
    if cfg.source_stage_only:
        waiting = waiting.where("at_source")
    for key in cfg.match_keys[:2]:
        waiting = waiting.where(t.trackedentityattribute.where(F.col("uid") == key.attribute_uid).exists())
    return waiting.select("event_id", flag.alias("new_transfer_status")).where("new_transfer_status IS NOT NULL")
