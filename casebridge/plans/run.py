"""A whole run: copy, mark, late lab results, ownership, triage, notices; each step on the one before.

Steps share one narrow view of the events and hand over change sets. The event table is read once for all
of them, and once more for its lab events. What is published are the rows that changed and the new ones
(``changes``), which the steps have read already; the table after the run is the old one with these in place of
its own. Every property is computed on first use, so a caller can stop at any step.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import cached_property
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebridge.config import PERMANENT, Run, TransferConfig
from casebridge.operators import copies, lab, link, notify, ownership, status, triage
from casebridge.operators.changelog import over_base
from casebridge.operators.changes import apply_changes, apply_event_changes
from casebridge.operators.sift import sift
from casebridge.operators.staging import Staged, stage
from casebridge.sources.layout import plain
from casebridge.sources.tables import Tables

if TYPE_CHECKING:
    from casebridge.sources.publish import Published
    from casebridge.sources.value_index import ValueIndex


@dataclass(frozen=True)
class Changes:
    """Whole rows that a run changed or added, one per event, and one per changed person and program."""

    programstageinstance: DataFrame
    trackedentityprogramowner: DataFrame


@dataclass(frozen=True)
class RunResult:
    """``tables`` are the tables after the run, ``changes`` what it changed in them, ``sent`` what its messages follow from."""

    tables: Tables
    messages: notify.Messages
    changes: Changes
    cfg: TransferConfig
    sent: notify.Sent | None = None


def start_run(
    t: Tables, run_id: str, run_ts: datetime, messages: notify.Messages | None = None, after: Published | None = None
) -> Run:
    """A run whose new ids follow the largest ones in the tables.

    ``messages`` are message tables that exist already. ``after`` is the published run that ``t`` comes from; its
    marker holds the numbers given out so far, so published messages need not be read again.
    """

    def last(df: DataFrame, column: str) -> int:
        return df.agg(F.coalesce(F.max(column), F.lit(0)).cast("bigint")).first()[0]

    event_base = last(t.programstageinstance, "programstageinstanceid")
    bases = [0, 0, 0] if after is None else [after.conversation_base, after.message_base, after.usermessage_base]
    if messages is not None:
        existing = (
            last(messages.messageconversation, "messageconversationid"),
            last(messages.message, "messageid"),
            last(messages.usermessage, "usermessageid"),
        )
        bases = [max(pair) for pair in zip(bases, existing, strict=True)]
    return Run(run_id, run_ts, event_base, *bases, parent=after and after.run_id)


class TransferRun:
    """``run`` is needed from the copies on; ``index``, if given, holds the attribute values of the tables."""

    def __init__(self, t: Tables, cfg: TransferConfig, run: Run | None = None, index: ValueIndex | None = None):
        self.t, self.cfg, self.run, self.index = t, cfg, run, index
        #: The events the queue is made from, where not all have to be looked at.
        self.pending: DataFrame | None = None

    # ---- linkage, shared by all steps ----

    @cached_property
    def lookup(self) -> Staged:
        return self.index.lookup() if self.index else link.stage_lookup(self.t, self.cfg)

    @cached_property
    def queue(self) -> Staged:
        return link.stage_queue(self.t, self.cfg, self.pending)

    @cached_property
    def matched(self) -> Staged:
        return link.stage_matched(self.queue, self.cfg, self.lookup)

    @cached_property
    def destinations(self) -> Staged:
        return link.stage_destinations(self.t, self.cfg, self.lookup)

    @cached_property
    def links(self) -> Staged:
        """Links of waiting events and of events with a late lab result."""
        wanted = link.is_waiting(self.cfg) | link.is_late_lab(self.cfg)
        return stage(link.link_rows(self.matched, self.destinations, self.cfg, wanted), "links")

    # ---- copies ----

    @cached_property
    def blocks(self) -> Staged:
        return copies.stage_blocks(self.links.df, self.cfg)

    @cached_property
    def inserts(self) -> Staged:
        return copies.stage_inserts(self.t, self.cfg, self.run, self.queue, self.blocks)

    # ---- marks and late lab results ----

    @cached_property
    def marks(self) -> DataFrame:
        return status.mark_transferred(self.links.df, self.cfg)

    @cached_property
    def lab(self) -> DataFrame:
        return stage(lab.lab_events(self.links.df, self.cfg), "lab_events").df

    @cached_property
    def status_changes(self) -> DataFrame:
        return status.status_changes(self.links.df, self.lab, self.cfg)

    @cached_property
    def lab_sources(self) -> Staged:
        return lab.stage_sources(self.queue, self.lab, self.cfg)

    @cached_property
    def lab_targets(self) -> Staged:
        return lab.stage_targets(self.t, self.lab_sources, self.cfg)

    @cached_property
    def merged_rows(self) -> DataFrame:
        """Merges into lab events of the table."""
        return stage(lab.merge_into_table(self.lab_targets, self.lab_sources, self.cfg), "merged_rows").df

    @cached_property
    def merged_copies(self) -> DataFrame:
        """Merges into this run's copies."""
        return stage(lab.merge_into_copies(self.inserts, self.lab_sources, self.cfg), "merged_copies").df

    @property
    def merged(self) -> DataFrame:
        return self.merged_rows.unionByName(self.merged_copies)

    def _rematched(self, edited: DataFrame, wanted: Column | None = None) -> DataFrame:
        """Edited events that some step may still link (those ``wanted``), with match counts for their new documents."""
        facts = (
            link.event_fields(edited, self.cfg)
            .withColumn("at_source", F.lit(False))
            .drop("eventdatavalues")
            .where(link.needs_match(self.cfg) if wanted is None else wanted)
        )
        return link.match_counts(stage(facts, "edited", link.key_names(self.cfg)), self.lookup.df, self.cfg)

    def _unmerged(self, merged: DataFrame) -> DataFrame:
        """Linkable events of the table without a merge, with marks and completions applied."""
        kept = self.matched.df.join(merged.select("event_id"), "event_id", "left_anti")
        names = {"status": "new_status", "transfer_status": "new_transfer_status"}
        return apply_changes(kept, self.status_changes, "event_id", names)

    @cached_property
    def rows_after_lab(self) -> DataFrame:
        """Linkable events of the table with marks, completions and merges applied."""
        changed = self._rematched(self.merged_rows.withColumnRenamed("new_document", "eventdatavalues"))
        return stage(self._unmerged(self.merged_rows).unionByName(changed), "rows_after_lab").df

    @cached_property
    def asking_sources(self) -> Staged:
        """Sources whose merges may ask for a new owner: a merged document has the request of its source."""
        sources, fields = self.lab_sources, self.cfg.merge_fields
        if fields is not None and self.cfg.request_field not in fields:
            return sources
        return Staged(sources.df.where(F.col("request") == PERMANENT), sources.rows)

    @cached_property
    def asking_copies(self) -> DataFrame:
        """Merges into this run's copies that may ask for a new owner. Only the copies these reach are made."""
        key = "event_id" if self.cfg.lab_target == "own_copy" else "enrolment_id"
        targets = self.asking_sources.df.select(F.col("target_key").alias(key))
        reached = stage(self.blocks.df.join(targets, key, "left_semi"), "asking_blocks", ("event_id",))
        made = copies.stage_inserts(self.t, self.cfg, self.run, self.queue, reached)
        return lab.merge_into_copies(made, self.asking_sources, self.cfg)

    @cached_property
    def after_lab(self) -> Staged:
        """Requests for ownership as they stand after the lab results, of the table and of copies with new documents.

        A whole run has all merges and looks through them; otherwise only those are made that may ask.
        """
        asking = link.is_ownership_request(self.cfg)
        if "rows_after_lab" in vars(self):
            rows, edited = self.rows_after_lab, self.merged_copies
        else:
            merged = lab.merge_into_table(self.lab_targets, self.lab_sources, self.cfg)
            changed = lab.merge_into_table(self.lab_targets, self.asking_sources, self.cfg)
            rows = self._unmerged(merged)
            edited = changed.unionByName(self.merged_copies if self.cfg.reset_status_on_copy else self.asking_copies)
        edited = edited.withColumnRenamed("new_document", "eventdatavalues")
        if self.cfg.reset_status_on_copy:
            # Copies that say "transferred" can ask for a new owner.
            others = self.inserts.df.select(
                F.col("programstageinstanceid").cast("bigint").alias("event_id"),
                "eventdatavalues",
                F.col("executiondate").alias("executed"),
                F.col("organisationunitid").alias("facility_id"),
                "status",
            ).join(self.merged_copies.select("event_id"), "event_id", "left_anti")
            edited = edited.unionByName(others)
        keys = (*link.key_names(self.cfg), "target_uid")
        found = rows.where(asking).unionByName(self._rematched(edited, asking))
        return stage(found.where(link.all_matched(self.cfg)), "after_lab", keys)

    # ---- ownership ----

    @cached_property
    def owned(self) -> Staged:
        return ownership.stage_owned(self.t, self.cfg, self.lookup)

    @cached_property
    def ownership_candidates(self) -> DataFrame:
        return ownership.ownership_candidates(self.t, self.cfg, self.after_lab, self.owned)

    @cached_property
    def ownership(self) -> DataFrame:
        return ownership.update_ownership(self.t, self.cfg, self.after_lab, self.owned, self.lookup)

    # ---- triage ----

    @cached_property
    def flags(self) -> DataFrame:
        """Looks at the table's own events: a copy has every key matched, merged or not, and is never flagged."""
        return triage.triage(self.t, self.cfg, self.rows_after_lab)

    # ---- notices ----

    @cached_property
    def notices(self) -> DataFrame:
        sent = notify.transfer_notices(self.blocks, self.cfg).unionByName(notify.lab_notices(self.lab))
        if self.cfg.static_notice:
            sent = sent.unionByName(notify.static_notice(self.t, self.cfg))
        return sent

    @cached_property
    def recipients(self) -> DataFrame:
        return notify.recipients(self.t, self.cfg)

    @cached_property
    def sent(self) -> notify.Sent:
        return notify.send(self.notices, self.recipients, self.cfg, self.run)

    @property
    def messages(self) -> notify.Messages:
        return self.sent.messages

    # ---- new tables ----

    @cached_property
    def event_changes(self) -> DataFrame:
        """(event_id, new_status, new_transfer_status, new_document), one row per changed event."""
        # Marked and completed events are no longer waiting, so none of them is flagged.
        narrow = self.status_changes.unionByName(self.flags, allowMissingColumns=True)
        changes = narrow.join(self.merged.select("event_id", "new_document"), "event_id", "full")
        return stage(changes, "event_changes").df

    @cached_property
    def changed_events(self) -> DataFrame:
        """Whole rows of changed events of the table and of new events. The event table is not read for them.

        The queue and the lab targets hold every event a step can change; where both hold one, the target's row is taken.
        """
        plain_columns = plain(self.t.programstageinstance).columns
        targets = self.lab_targets.df.join(self.merged_rows.select(F.col("event_id").alias("lab_event_id")), "lab_event_id", "left_semi")
        queued = self.queue.df.where("event is not null").join(self.merged_rows.select("event_id"), "event_id", "left_anti")
        rows = queued.select("event.*").unionByName(targets.select("event.*")).select(plain_columns)
        keyed = rows.withColumn("event_id", F.col("programstageinstanceid").cast("bigint"))
        maybe, _ = sift(keyed, self.event_changes, "event_id")
        touched = maybe.join(self.event_changes.select("event_id"), "event_id", "left_semi").drop("event_id")
        new = self.inserts.df.drop("rank", "role")
        new_keyed = new.withColumn("event_id", F.col("programstageinstanceid").cast("bigint"))
        edited, passed = sift(new_keyed, self.event_changes, "event_id")
        both = touched.unionByName(edited.drop("event_id"), allowMissingColumns=True)
        changed = apply_event_changes(both, self.event_changes, self.cfg.status_field)
        return changed.unionByName(passed.drop("event_id"), allowMissingColumns=True)

    @cached_property
    def events(self) -> DataFrame:
        """The event table after the run: its rows but for the changed ones, and those with the new ones."""
        changed = self.event_changes.select(F.col("event_id").alias("programstageinstanceid"))
        return over_base(plain(self.t.programstageinstance), self.changed_events, ["programstageinstanceid"], changed)

    @cached_property
    def owner_changes(self) -> DataFrame:
        """Changed rows of the owners: one per person and program."""
        base = self.t.trackedentityprogramowner
        kinds = base.schema
        return self.ownership.select(
            F.col("person_id").cast(kinds["trackedentityinstanceid"].dataType).alias("trackedentityinstanceid"),
            F.col("program_id").alias("programid"),
            F.col("new_facility_id").cast(kinds["organisationunitid"].dataType).alias("organisationunitid"),
        ).distinct()

    @cached_property
    def owners(self) -> DataFrame:
        return with_owner_changes(self.t.trackedentityprogramowner, self.owner_changes)

    @cached_property
    def result(self) -> RunResult:
        tables = self.t.but(programstageinstance=self.events, trackedentityprogramowner=self.owners)
        return RunResult(tables, self.messages, Changes(self.changed_events, self.owner_changes), self.cfg, self.sent)


def with_owner_changes(owners: DataFrame, changes: DataFrame) -> DataFrame:
    """Owners with new facilities; a person may have several rows of one program."""
    renamed = changes.withColumnRenamed("organisationunitid", "new_facility_id")
    return apply_changes(owners, renamed, ["trackedentityinstanceid", "programid"], {"organisationunitid": "new_facility_id"})


def run_all(t: Tables, cfg: TransferConfig, run: Run, index: ValueIndex | None = None) -> RunResult:
    return TransferRun(t, cfg, run, index).result


def end_state(t: Tables, cfg: TransferConfig) -> DataFrame:
    """Events per stage, transfer status and status: the end check of a run."""
    return (
        link.event_fields(t.programstageinstance, cfg)
        .groupBy(F.col("programstageid").alias("stage_id"), "transfer_status", "status")
        .agg(F.count(F.lit(1)).alias("events"))
    )
