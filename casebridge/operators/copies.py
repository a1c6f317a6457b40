"""Copy linked events into the person's treatment and lab records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebridge.config import COMPLETED, TRANSFERRED, Run, TransferConfig
from casebridge.functions.clock import run_clock
from casebridge.functions.fields import set_value
from casebridge.functions.ids import chunk, expand, number_rows, uid
from casebridge.operators.link import is_waiting, key_names, stage_id
from casebridge.operators.sift import sift
from casebridge.operators.spread import spread_join
from casebridge.operators.staging import Staged, stage
from casebridge.sources.tables import EVENT_COLUMNS, Tables

# Written only when lab results go to an event's own copy.
LINEAGE = "transferredfrom"


def stage_blocks(links: DataFrame, cfg: TransferConfig) -> Staged:
    """Waiting links of the program, numbered: a row stands for ``copies`` transfers from ``first_rank`` on."""
    rows = links.where(is_waiting_link() & F.col("in_program")).select(
        "event_id",
        "enrolment_id",
        "person_id",
        "facility_id",
        "enrolment_facility_id",
        *key_names(cfg),
        "copies",
    )
    return number_rows(
        chunk(rows, cfg.copy_chunk),
        ["event_id", "enrolment_id", "person_id", "piece"],
        size="copies",
        name="transfer_blocks",
        profile=("event_id",),
    )


def is_waiting_link() -> Column:
    return F.col("transfer_status") != TRANSFERRED


def transfer_rows(blocks: Staged) -> DataFrame:
    """One row per transfer."""
    return expand(blocks.df)


def _role(name: str, back: int, stage: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), F.lit(back).alias("back"), stage.alias("stage_id"))


def insert_rows(t: Tables, cfg: TransferConfig, run: Run, queue: Staged, blocks: Staged) -> DataFrame:
    """Two new events per transfer, ``rank`` and ``role`` in front of the event columns.

    Only the linked, narrow rows and the documents of linked events meet here, on the event id.
    Both copies come from one pass over them.
    """
    waiting = queue.df.where(F.col("at_source") & is_waiting(cfg)).select("event_id", "event.*")
    documents, _ = sift(waiting, blocks.df, "event_id")
    copied = spread_join(
        blocks.df.select("event_id", "enrolment_id", "first_rank", "copies"),
        documents,
        "event_id",
        # One block row is up to copy_chunk copies.
        hot_rows=max(1, cfg.hot_key_rows // cfg.copy_chunk),
        left_profile=blocks.profiles["event_id"],
        left_split=("first_rank",),
    )
    roles = F.explode(
        F.array(
            _role("treatment", 1, stage_id(t, cfg.treatment_stage_uid)),
            _role("lab", 0, stage_id(t, cfg.lab_stage_uid)),
        )
    )
    rows = expand(copied).withColumn("_role", roles)
    new_id = F.lit(run.event_base) + F.col("rank") * 2 - F.col("_role.back")
    document = F.col("eventdatavalues")
    if cfg.reset_status_on_copy:
        document = set_value(document, cfg.status_field, F.lit(TRANSFERRED))
    now = run_clock(run)
    changed = {
        "programstageinstanceid": new_id,
        "uid": uid("E", new_id),
        "programinstanceid": F.col("enrolment_id"),
        "programstageid": F.col("_role.stage_id"),
        "status": F.lit(COMPLETED),
        "created": now,
        "lastupdated": now,
        "deleted": F.lit(False),
        "storedby": F.lit("SCRIPT"),
        "eventdatavalues": document,
    }
    schema = t.programstageinstance.schema
    columns = [changed.get(c, F.col(c)).cast(schema[c].dataType).alias(c) for c in EVENT_COLUMNS]
    if cfg.lab_target == "own_copy":
        columns.append(F.col("event_id").alias(LINEAGE))
    return rows.select("rank", F.col("_role.name").alias("role"), *columns)


def stage_inserts(t: Tables, cfg: TransferConfig, run: Run, queue: Staged, blocks: Staged) -> Staged:
    return stage(insert_rows(t, cfg, run, queue, blocks), "inserts", (target_column(cfg),))


def target_column(cfg: TransferConfig) -> str:
    """What late lab results find their lab events by."""
    return LINEAGE if cfg.lab_target == "own_copy" else "programinstanceid"
