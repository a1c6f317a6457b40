"""Link events to persons: exact match of document values with attribute values."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebridge.config import ACTIVE, COMPLETED, PERMANENT, TRANSFERRED, WAITING, TransferConfig
from casebridge.functions.fields import read_fields
from casebridge.operators.spread import profile, spread_join
from casebridge.operators.staging import Staged, stage
from casebridge.sources.layout import VALUE, has_values, in_queues, plain
from casebridge.sources.tables import Tables

# ---- the narrow view of an event ------------------------------------------------------------------


def key_names(cfg: TransferConfig) -> list[str]:
    return [f"key_{i}" for i in range(len(cfg.match_keys))]


def stage_id(t: Tables, uid: str) -> Column:
    """Scalar subquery: NULL when the stage is unknown, an error when it is not unique."""
    return t.programstage.where(F.col("uid") == uid).select("programstageid").scalar()


def field_names(cfg: TransferConfig) -> list[str]:
    return [*key_names(cfg), "request", "transfer_status", "lab", "target_uid"]


def program_id(t: Tables, cfg: TransferConfig) -> Column:
    return t.program.where(F.col("uid") == cfg.program_uid).select("programid").scalar()


def event_fields(events: DataFrame, cfg: TransferConfig, more: Mapping[str, str] | None = None) -> DataFrame:
    """Add the text values the jobs look at, from their own columns where the table is laid out so.

    ``more``: further columns and their fields, which no table has a column for. Documents are parsed once for all of them.
    """
    fields = {
        **{f"key_{i}": k.event_field for i, k in enumerate(cfg.match_keys)},
        "request": cfg.request_field,
        "transfer_status": cfg.status_field,
        "lab": cfg.lab_field,
        "target_uid": cfg.target_facility_field,
    }
    more = dict(more or {})
    if has_values(events, list(fields.values())):
        known = events.select("*", *[F.col(VALUE + f).alias(a) for a, f in fields.items()])
        return read_fields(known, "eventdatavalues", more) if more else known
    return read_fields(events, "eventdatavalues", {**fields, **more})


def event_facts(events: DataFrame, t: Tables, cfg: TransferConfig) -> DataFrame:
    """The columns every step works on, and the whole event in ``event``."""
    if cfg.skip_deleted_events:
        events = events.where(~F.coalesce("deleted", F.lit(False)))
    return event_fields(events, cfg).select(
        F.col("programstageinstanceid").cast("bigint").alias("event_id"),
        F.coalesce(F.col("programstageid") == stage_id(t, cfg.source_stage_uid), F.lit(False)).alias("at_source"),
        F.col("executiondate").alias("executed"),
        F.col("organisationunitid").alias("facility_id"),
        "status",
        *field_names(cfg),
        F.struct(*plain(events).columns).alias("event"),
    )


# ---- what a step looks for ------------------------------------------------------------------------


def valid_request(cfg: TransferConfig) -> Column:
    return F.col("request").isin(*cfg.request_values)


def is_waiting(cfg: TransferConfig) -> Column:
    return valid_request(cfg) & (F.col("transfer_status") == WAITING)


def has_result(cfg: TransferConfig) -> Column:
    given = F.col("lab").isNotNull()
    return given & (F.col("lab") != "") if cfg.blank_is_missing else given


def is_late_lab(cfg: TransferConfig) -> Column:
    return (
        F.col("at_source")
        & valid_request(cfg)
        & (F.col("transfer_status") == TRANSFERRED)
        & (F.col("status") == ACTIVE)
        & has_result(cfg)
    )


def is_ownership_request(cfg: TransferConfig) -> Column:
    asks = (
        (F.col("request") == PERMANENT) & (F.col("transfer_status") == TRANSFERRED) & (F.col("status") == COMPLETED)
    )
    return asks & F.col("at_source") if cfg.source_stage_only else asks


def needs_match(cfg: TransferConfig) -> Column:
    """Events some step may link: the others need no join."""
    return is_waiting(cfg) | is_late_lab(cfg) | is_ownership_request(cfg)


# ---- attribute values -----------------------------------------------------------------------------


def attribute_lookup(t: Tables, cfg: TransferConfig) -> DataFrame:
    """Attribute values of the match keys, with the attribute's uid. An unknown uid gives no rows.

    The ids come from scalar subqueries: values are filtered where they are read, and nothing is
    shuffled on the attribute, of which there are only a few.
    """
    uid = F.lit(None).cast("string")
    for key in cfg.match_keys:
        known = t.trackedentityattribute.where(F.col("uid") == key.attribute_uid)
        wanted = known.select("trackedentityattributeid").scalar()
        uid = F.when(F.col("trackedentityattributeid") == wanted, key.attribute_uid).otherwise(uid)
    return t.trackedentityattributevalue.select(
        F.col("trackedentityinstanceid").alias("person_id"), uid.alias("attribute_uid"), "value"
    ).where("attribute_uid IS NOT NULL")


def stage_lookup(t: Tables, cfg: TransferConfig) -> Staged:
    return stage(attribute_lookup(t, cfg), "attribute_lookup", ("value", "person_id"))


def holders(lookup: DataFrame, cfg: TransferConfig, i: int) -> DataFrame:
    """Persons holding a value of match key ``i``: (person_id, key_i)."""
    of_key = lookup.where((F.col("attribute_uid") == cfg.match_keys[i].attribute_uid) & F.col("value").isNotNull())
    return of_key.select("person_id", F.col("value").alias(f"key_{i}"))


def match_counts(facts: Staged, lookup: DataFrame, cfg: TransferConfig) -> DataFrame:
    """Add ``n_i``: how many attribute values equal the event's key ``i`` (0 when none, or no key).

    Values are counted before the join, so a name many persons share stays one row, and each
    event stays one row too.
    """
    found = facts.df
    for i, key in enumerate(key_names(cfg)):
        counts = holders(lookup, cfg, i).groupBy(key).agg(F.count(F.lit(1)).alias(f"n_{i}"))
        found = spread_join(
            found,
            counts,
            key,
            "left",
            hot_rows=cfg.hot_key_rows,
            left_profile=facts.profiles.get(key),
            left_split=("event_id",),
        )
    return found.fillna(0, [f"n_{i}" for i in range(len(cfg.match_keys))])


def all_matched(cfg: TransferConfig) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"n_{i}") > 0 for i in range(len(cfg.match_keys))])


def stage_queue(t: Tables, cfg: TransferConfig, events: DataFrame | None = None) -> Staged:
    """Events some step may link, read and parsed once.

    Those that may be copied, flagged or bring a late result keep the whole event, in a column of its own that
    only the steps read that write events. All a step looks for waits or was transferred, so of a laid-out table
    only the partitions of these two queues are read. ``events``: rows of the table, where only those come into question.
    """
    facts = event_facts(in_queues(t.programstageinstance if events is None else events), t, cfg).where(needs_match(cfg))
    kept = facts.withColumn("event", F.when(is_waiting(cfg) | is_late_lab(cfg), F.col("event")))
    return stage(kept, "queue", (*key_names(cfg), "target_uid"))


def stage_matched(queue: Staged, cfg: TransferConfig, lookup: Staged) -> Staged:
    """The queue without the whole events, with match counts."""
    facts = Staged(queue.df.drop("event"), queue.rows, queue.profiles)
    return Staged(stage(match_counts(facts, lookup.df, cfg), "matched").df, queue.rows, queue.profiles)


def match_pairs(facts: Staged, lookup: Staged, cfg: TransferConfig, keys: list[int]) -> DataFrame:
    """All persons per event and key, ``person_<i>``: the full fan-out of the linkage."""
    found = facts.df
    for i in keys:
        found = spread_join(
            found,
            holders(lookup.df, cfg, i).withColumnRenamed("person_id", f"person_{i}"),
            f"key_{i}",
            hot_rows=cfg.hot_key_rows,
            left_profile=facts.profiles[f"key_{i}"],
            right_profile=lookup.profiles["value"],
            left_split=("event_id",),
            right_split=(f"person_{i}",),
        )
    return found


# ---- persons with an active enrolment -------------------------------------------------------------


def known_holders(t: Tables, cfg: TransferConfig, lookup: Staged) -> DataFrame:
    """Holders of the first key whose person record exists.

    With ``same_entity`` also the other keys of the same person, ``m_i`` times each.
    """
    known = spread_join(
        holders(lookup.df, cfg, 0),
        t.trackedentityinstance.select(F.col("trackedentityinstanceid").alias("person_id")),
        "person_id",
        "left_semi",
        hot_rows=cfg.hot_key_rows,
        left_profile=lookup.profiles["person_id"],
        left_split=("key_0",),
    )
    if cfg.same_entity:
        for i in range(1, len(cfg.match_keys)):
            key = f"key_{i}"
            other = holders(lookup.df, cfg, i).groupBy("person_id", key).agg(F.count(F.lit(1)).alias(f"m_{i}"))
            known = spread_join(
                known,
                other,
                "person_id",
                hot_rows=cfg.hot_key_rows,
                left_profile=lookup.profiles["person_id"],
                right_profile=lookup.profiles["person_id"],
                left_split=("key_0",),
                right_split=(key,),
            )
    return known


def active_enrolments(t: Tables, cfg: TransferConfig) -> DataFrame:
    enrolled = t.programinstance.where(~F.col("deleted") & (F.col("status") == ACTIVE))
    return enrolled.select(
        F.col("trackedentityinstanceid").alias("person_id"),
        F.col("programinstanceid").cast("bigint").alias("enrolment_id"),
        F.col("programid").alias("program_id"),
        F.col("organisationunitid").alias("enrolment_facility_id"),
        F.coalesce(F.col("programid") == program_id(t, cfg), F.lit(False)).alias("in_program"),
    )


def stage_destinations(t: Tables, cfg: TransferConfig, lookup: Staged) -> Staged:
    """First key value -> person and active enrolment, of any program."""
    enrolled = active_enrolments(t, cfg)
    found = spread_join(
        enrolled,
        known_holders(t, cfg, lookup),
        "person_id",
        hot_rows=cfg.hot_key_rows,
        left_profile=profile(enrolled, "person_id"),
        right_profile=lookup.profiles["person_id"],
        left_split=("enrolment_id",),
        right_split=("key_0",),
    )
    return stage(found, "destinations", ("key_0",))


def join_by_first_key(events: DataFrame, matched: Staged, persons: Staged, cfg: TransferConfig) -> DataFrame:
    """Matched events x the rows of ``persons`` with their first key; ``copies`` counts the other keys."""
    others = range(1, len(cfg.match_keys))
    found = spread_join(
        events,
        persons.df,
        "key_0",
        hot_rows=cfg.hot_key_rows,
        also=tuple(f"key_{i}" for i in others) if cfg.same_entity else (),
        left_profile=matched.profiles["key_0"],
        right_profile=persons.profiles["key_0"],
        left_split=("event_id",),
        right_split=("person_id",),
    )
    count = "m" if cfg.same_entity else "n"
    copies = reduce(lambda a, b: a * b, [F.col(f"{count}_{i}") for i in others])
    return found.withColumn("copies", copies.cast("bigint"))


def link_rows(matched: Staged, destinations: Staged, cfg: TransferConfig, where: Column) -> DataFrame:
    """Source events with every key matched x active enrolments of the persons holding their first key."""
    events = matched.df.where(F.col("at_source") & all_matched(cfg) & where)
    links = join_by_first_key(events, matched, destinations, cfg).select(
        "event_id",
        "enrolment_id",
        "person_id",
        "program_id",
        "in_program",
        "executed",
        "facility_id",
        "enrolment_facility_id",
        "status",
        "transfer_status",
        "lab",
        *key_names(cfg),
        "copies",
    )
    if cfg.dedupe_transfers:
        links = links.withColumn("copies", F.lit(1).cast("bigint")).distinct()
    return links
