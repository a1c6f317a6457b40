"""Bring late lab results to the lab events of the person."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebridge.config import ACTIVE, COMPLETED, TRANSFERRED, TransferConfig
from casebridge.functions.fields import merge, set_value
from casebridge.operators.copies import target_column
from casebridge.operators.link import has_result, key_names, stage_id
from casebridge.operators.sift import sift
from casebridge.operators.spread import Profile, spread_join
from casebridge.operators.staging import Staged, stage
from casebridge.sources.layout import is_laid_out, plain
from casebridge.sources.tables import Tables


def brings_result(cfg: TransferConfig) -> Column:
    """Read off the event as it was before marking."""
    just_marked = (F.col("transfer_status") != TRANSFERRED) & (F.col("lab") == "")
    before = (F.col("transfer_status") == TRANSFERRED) & (F.col("status") == ACTIVE)
    return has_result(cfg) & (before | just_marked)


def lab_events(links: DataFrame, cfg: TransferConfig) -> DataFrame:
    """Events whose result arrives now: already transferred and active with a result.

    Takes the state after marking: a waiting event with an empty result was just marked active, and an
    empty result counts as one unless ``blank_is_missing``. An event with several enrolments goes to
    the smallest.
    """
    late = links.where(brings_result(cfg))
    if cfg.require_program:
        late = late.where("in_program")
    # Everything grouped by belongs to the event.
    was_waiting = (F.col("transfer_status") != TRANSFERRED).alias("just_marked")
    per_event = late.groupBy("event_id", "executed", "facility_id", was_waiting, *key_names(cfg))
    return per_event.agg(F.min("enrolment_id").alias("enrolment_id"))


def complete_lab_events(lab: DataFrame) -> DataFrame:
    return lab.select("event_id", F.lit(COMPLETED).alias("new_status"))


def lab_sources(lab: DataFrame, cfg: TransferConfig) -> DataFrame:
    """The event that wins per target: latest date, then largest id.

    All lab events of an enrolment get the same source, so the pick is a plain aggregate per enrolment
    (per event where results go to the event's own copy) and hot enrolments shrink before the shuffle.
    """
    if cfg.lab_target == "own_copy":
        return lab.select(F.col("event_id").alias("target_key"), "event_id", "just_marked")
    best = F.max(F.struct("executed", "event_id", "just_marked")).alias("best")
    return (
        lab.groupBy(F.col("enrolment_id").alias("target_key"))
        .agg(best)
        .select("target_key", "best.event_id", "best.just_marked")
    )


def stage_sources(queue: Staged, lab: DataFrame, cfg: TransferConfig) -> Staged:
    """(target_key, source, request): the document that is merged into every lab event of a target, and its request."""
    documents = queue.df.where(brings_result(cfg)).select("event_id", F.col("event.eventdatavalues").alias("source"), "request")
    marked = set_value(F.col("source"), cfg.status_field, F.lit(TRANSFERRED))
    source = F.when(F.col("just_marked"), marked).otherwise(F.col("source")).alias("source")
    # An event goes to one enrolment and an enrolment has one source: no key repeats here.
    return stage(lab_sources(lab, cfg).join(documents, "event_id").select("target_key", source, "request"), "lab_sources")


def lab_targets(t: Tables, cfg: TransferConfig) -> DataFrame:
    """Lab-stage events of the table: (lab_event_id, target_key, document, ..), the whole one in ``event``."""
    events = t.programstageinstance
    at_lab = events.where(F.col("programstageid") == stage_id(t, cfg.lab_stage_uid))
    if is_laid_out(events):  # as literals, for the pruning of partitions; two at most, as the subquery allows one
        ids = t.programstage.where(F.col("uid") == cfg.lab_stage_uid).select("programstageid").limit(2).collect()
        at_lab = at_lab.where(F.col("programstageid").isin([r[0] for r in ids]))
    if cfg.skip_deleted_events:
        at_lab = at_lab.where(~F.coalesce("deleted", F.lit(False)))
    at_lab = plain(at_lab)
    return _targets(at_lab.withColumn("event", F.struct(*at_lab.columns)), cfg, "event")


def _targets(events: DataFrame, cfg: TransferConfig, *more: str) -> DataFrame:
    # A table no such run has written yet has no lineage.
    column = target_column(cfg)
    key = F.col(column) if column in events.columns else F.lit(None)
    return events.select(
        F.col("programstageinstanceid").cast("bigint").alias("lab_event_id"),
        key.cast("bigint").alias("target_key"),
        F.col("eventdatavalues").alias("document"),
        F.col("executiondate").alias("executed"),
        F.col("organisationunitid").alias("facility_id"),
        "status",
        *more,
    ).where("target_key IS NOT NULL")


def copied_targets(inserts: DataFrame, cfg: TransferConfig) -> DataFrame:
    """Lab copies that are not yet in the table, in the columns of ``lab_targets``."""
    return _targets(inserts.where("role = 'lab'"), cfg)


def merge_lab(targets: DataFrame, seen: Profile, sources: Staged, cfg: TransferConfig) -> DataFrame:
    """Change set (event_id, new_document, ...) for lab events. ``seen`` profiles the targets' keys."""
    pairs = spread_join(
        targets,
        sources.df,
        "target_key",
        hot_rows=cfg.hot_key_rows,
        left_profile=seen,
        left_split=("lab_event_id",),
    )
    return pairs.select(
        F.col("lab_event_id").alias("event_id"),
        merge(F.col("document"), F.col("source"), cfg.merge_fields).alias("new_document"),
        "executed",
        "facility_id",
        "status",
    )


def stage_targets(t: Tables, sources: Staged, cfg: TransferConfig) -> Staged:
    """The table's lab events that may have a source; no others leave the scan."""
    return stage(sift(lab_targets(t, cfg), sources.df, "target_key")[0], "lab_targets", ("target_key",))


def merge_into_table(reached: Staged, sources: Staged, cfg: TransferConfig) -> DataFrame:
    """Changes of the table's lab events."""
    return merge_lab(reached.df.drop("event"), reached.profiles["target_key"], sources, cfg)


def merge_into_copies(inserts: Staged, sources: Staged, cfg: TransferConfig) -> DataFrame:
    """Changes of the lab copies made in this run."""
    reached = sift(copied_targets(inserts.df, cfg), sources.df, "target_key")[0]
    return merge_lab(reached, inserts.profiles[target_column(cfg)], sources, cfg)
