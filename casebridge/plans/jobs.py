"""The single jobs, each on tables as they stand.

``run_all`` shares work between them; a caller with only one thing to do takes it from here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebridge.config import TRANSFERRED, Run, TransferConfig
from casebridge.operators import lab, notify, ownership, status, triage
from casebridge.operators.staging import stage
from casebridge.plans.run import TransferRun
from casebridge.sources.tables import Tables


@dataclass(frozen=True)
class TransferResult:
    inserts: DataFrame
    notices: DataFrame


@dataclass(frozen=True)
class LabResult:
    completed: DataFrame
    merged: DataFrame
    notices: DataFrame


def link_events(t: Tables, cfg: TransferConfig, *, require_program: bool = False) -> DataFrame:
    """Waiting and late-result events with person and enrolment; ``copies`` counts the other keys' matches."""
    links = TransferRun(t, cfg).links.df
    return links.where("in_program") if require_program else links


def transfer_events(t: Tables, cfg: TransferConfig, run: Run) -> TransferResult:
    """Rows to append to the event table, and the notices to send."""
    steps = TransferRun(t, cfg, run)
    return TransferResult(steps.inserts.df.drop("rank", "role"), notify.transfer_notices(steps.blocks, cfg))


def mark_transferred(t: Tables, cfg: TransferConfig) -> DataFrame:
    """Change set (event_id, new_status, new_transfer_status). Copies must have been made before."""
    return status.mark_transferred(TransferRun(t, cfg).links.df, cfg)


def transfer_lab(t: Tables, cfg: TransferConfig) -> LabResult:
    """Change sets and notices for late results of events transferred earlier."""
    steps = TransferRun(t, cfg)
    links = steps.links.df.where(F.col("transfer_status") == TRANSFERRED)
    late = stage(lab.lab_events(links, cfg), "lab_events").df
    sources = lab.stage_sources(steps.queue, late, cfg)
    merged = lab.merge_into_table(lab.stage_targets(t, sources, cfg), sources, cfg)
    return LabResult(lab.complete_lab_events(late), merged, notify.lab_notices(late))


def update_ownership(t: Tables, cfg: TransferConfig) -> DataFrame:
    """Change set (person_id, program_id, new_facility_id)."""
    steps = TransferRun(t, cfg)
    return ownership.update_ownership(t, cfg, steps.matched, steps.owned, steps.lookup)


def triage_events(t: Tables, cfg: TransferConfig) -> DataFrame:
    """Change set (event_id, new_transfer_status)."""
    return triage.triage(t, cfg, TransferRun(t, cfg).matched.df)
