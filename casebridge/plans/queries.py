"""One named query per operator and step, over the tables derived from a driver folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebridge.config import CHECK_NAME, DISTRICT_NUMBER, ID_NOT_FOUND, NO_MATCH, Run, TransferConfig
from casebridge.functions.fields import merge, read_fields, set_value
from casebridge.functions.ids import expand
from casebridge.operators import lab, link, notify
from casebridge.operators.changes import apply_event_changes
from casebridge.operators.staging import stage, staging_root
from casebridge.plans.incremental import Arrivals, incremental_run
from casebridge.plans.run import TransferRun, end_state, start_run
from casebridge.sources import fixtures
from casebridge.sources.layout import lay_out, read_base, write_base
from casebridge.sources.publish import compact, latest, newest, publish_run
from casebridge.sources.tables import Tables
from casebridge.sources.value_index import build_index, new_values

CFG = TransferConfig()
THREE_KEYS = replace(CFG, match_keys=(*CFG.match_keys, DISTRICT_NUMBER))
# A facility of the derived tables, so that the notice has recipients.
STATIC_AT_HOME = replace(CFG, static_notice_facility_id=7)
RUN = Run("check", datetime(2026, 1, 1), event_base=2_000_000_000)
LAB_ONLY = "labOnly0001"
FIELDS = ("id_number", "full_name", "request", "transfer_status", "lab", "target_uid")

Query = Callable[[SparkSession, str], DataFrame]


def _run(spark: SparkSession, sf_dir: str, cfg: TransferConfig = CFG) -> TransferRun:
    return TransferRun(fixtures.load(spark, sf_dir), cfg, RUN)


def _named(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"key_0": "id_number", "key_1": "full_name"})


def _fields(events: DataFrame, document: Column | None = None, **more: str) -> DataFrame:
    """Event id and extracted fields, of the stored documents or of edited ones; ``more`` names further fields."""
    if document is not None:
        events = events.withColumn("eventdatavalues", document)
    return _named(link.event_fields(events, CFG, more))


def _event_id() -> Column:
    return F.col("programstageinstanceid").alias("event_id")


# ---- scans and filters ----


def scan_events(spark, sf_dir):
    return fixtures.load(spark, sf_dir).programstageinstance.select(
        _event_id(),
        F.col("programstageid").alias("stage_id"),
        F.col("organisationunitid").alias("facility_id"),
        "status",
    )


def attribute_lookup(spark, sf_dir):
    return link.attribute_lookup(fixtures.load(spark, sf_dir), CFG)


def json_extract(spark, sf_dir):
    return _fields(fixtures.load(spark, sf_dir).programstageinstance).select(_event_id(), *FIELDS)


def _facts(spark, sf_dir, cfg=CFG, district=False) -> tuple:
    t = fixtures.load(spark, sf_dir, district=district)
    return t, link.event_facts(t.programstageinstance, t, cfg)


def filter_source_stage(spark, sf_dir):
    t = fixtures.load(spark, sf_dir)
    at_source = F.col("programstageid") == link.stage_id(t, CFG.source_stage_uid)
    return t.programstageinstance.where(at_source).select(_event_id())


def filter_requests(spark, sf_dir):
    _, facts = _facts(spark, sf_dir)
    return facts.where(F.col("at_source") & link.valid_request(CFG)).select("event_id", "request")


def _waiting(facts: DataFrame, cfg: TransferConfig = CFG) -> DataFrame:
    return facts.where(F.col("at_source") & link.is_waiting(cfg))


def filter_waiting(spark, sf_dir):
    return _waiting(_facts(spark, sf_dir)[1]).select("event_id")


# ---- linkage ----


def _pairs(spark, sf_dir, keys: list[int], cfg: TransferConfig = CFG, district: bool = False) -> DataFrame:
    t, facts = _facts(spark, sf_dir, cfg, district)
    names = link.key_names(cfg)
    waiting = stage(_waiting(facts, cfg).select("event_id", *names), "waiting", tuple(names))
    found = link.match_pairs(waiting, link.stage_lookup(t, cfg), cfg, keys)
    person = {0: "person_by_id", 1: "person_by_name", 2: "person_by_district"}
    return found.select("event_id", *[F.col(f"person_{i}").alias(person[i]) for i in keys])


def match_by_id(spark, sf_dir):
    return _pairs(spark, sf_dir, [0])


def match_by_name(spark, sf_dir):
    return _pairs(spark, sf_dir, [1])


def match_both(spark, sf_dir):
    return _pairs(spark, sf_dir, [0, 1])


def match_both_indexed(spark, sf_dir):
    """Both keys matched with a kept index of the values: written with a part of the persons, brought up to date, read."""
    t, facts = _facts(spark, sf_dir)
    late = F.col("trackedentityinstanceid") % 3 == 0
    values = t.trackedentityattributevalue
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder, name = f"{_folder(spark)}/values", f"casebridge_values_{uuid.uuid4().hex}"
    index = build_index(t.but(trackedentityattributevalue=values.where(~late)), CFG, name, folder, buckets)
    index.add(new_values(t, CFG, values.where(late)))
    names = link.key_names(CFG)
    waiting = stage(_waiting(facts).select("event_id", *names), "waiting", tuple(names))
    found = link.match_pairs(waiting, index.lookup(), CFG, [0, 1])
    return found.select("event_id", F.col("person_0").alias("person_by_id"), F.col("person_1").alias("person_by_name"))


def match_three_keys(spark, sf_dir):
    return _pairs(spark, sf_dir, [0, 1, 2], THREE_KEYS, district=True)


def _single_copies(df: DataFrame) -> DataFrame:
    return expand(df.withColumn("first_rank", F.lit(1).cast("bigint"))).drop("rank")


def match_enrolments(spark, sf_dir):
    r = _run(spark, sf_dir)
    links = link.link_rows(r.matched, r.destinations, CFG, link.is_waiting(CFG))
    return _single_copies(links).select("event_id", "enrolment_id", "program_id")


# ---- copies ----


def transfer_rows(spark, sf_dir):
    return _named(expand(_run(spark, sf_dir).blocks.df)).select(
        "event_id", "enrolment_id", "facility_id", "enrolment_facility_id", "id_number", "full_name"
    )


def allocate_ids(spark, sf_dir):
    second = F.lit(RUN.event_base) + F.col("rank") * 2
    return expand(_run(spark, sf_dir).blocks.df).select(
        "event_id", "enrolment_id", "rank", (second - 1).alias("treatment_id"), second.alias("lab_id")
    )


def _inserted(spark, sf_dir, role: str | None = None) -> DataFrame:
    rows = _run(spark, sf_dir).inserts.df
    if role:
        rows = rows.where(F.col("role") == role)
    return _fields(rows).select(
        _event_id(),
        F.col("programinstanceid").alias("enrolment_id"),
        F.col("programstageid").alias("stage_id"),
        F.col("organisationunitid").alias("facility_id"),
        "status",
        "uid",
        F.col("created").cast("timestamp_ntz").alias("created"),
        F.col("lastupdated").cast("timestamp_ntz").alias("lastupdated"),
        "deleted",
        "storedby",
        *FIELDS,
    )


def insert_treatment(spark, sf_dir):
    return _inserted(spark, sf_dir, "treatment")


def insert_lab(spark, sf_dir):
    return _inserted(spark, sf_dir, "lab")


def transfer_inserts(spark, sf_dir):
    return _inserted(spark, sf_dir)


def uid_format(spark, sf_dir):
    well_formed = F.col("uid").rlike("^[A-Za-z][A-Za-z0-9]{10}$").alias("well_formed")
    return _run(spark, sf_dir).inserts.df.select(_event_id(), well_formed)


# ---- status, lab results, documents ----


def mark_transferred(spark, sf_dir):
    return _run(spark, sf_dir).marks


def lab_transfer_rows(spark, sf_dir):
    return _run(spark, sf_dir).lab.select("event_id", "enrolment_id")


def complete_lab_events(spark, sf_dir):
    return lab.complete_lab_events(_run(spark, sf_dir).lab)


def merge_lab(spark, sf_dir):
    merged = _run(spark, sf_dir).merged.withColumnRenamed("new_document", "eventdatavalues").drop("status")
    return _fields(merged, lab_only=LAB_ONLY).select("event_id", *FIELDS, "lab_only")


def json_set(spark, sf_dir):
    events = fixtures.load(spark, sf_dir).programstageinstance
    edited = set_value(F.col("eventdatavalues"), CFG.status_field, F.lit(CHECK_NAME))
    return _fields(events, edited, lab_only=LAB_ONLY).select(_event_id(), *FIELDS, "lab_only")


def json_merge(spark, sf_dir):
    """Every document, with a new result (the event's uid) and an extra field merged over it."""
    events = fixtures.load(spark, sf_dir).programstageinstance
    added = F.to_json(
        F.create_map(
            F.lit(CFG.lab_field),
            F.struct(F.col("uid").alias("value")),
            F.lit("extraField1"),
            F.struct(F.col("status").alias("value")),
        )
    )
    edited = merge(F.col("eventdatavalues"), added)
    more = {"lab_only": LAB_ONLY, "extra": "extraField1"}
    return _fields(events, edited, **more).select(_event_id(), *FIELDS, *more)


def _with_numbers(events: DataFrame) -> DataFrame:
    """Documents with members whose text no parser keeps: trailing zeros, over 40 digits, blanks, a nested ``value``."""
    number = F.concat(F.col("programstageinstanceid").cast("string"), F.lit(".00"))
    opening = ['{ "num00000001" : {"value" : ', number, '},"big00000001":{"in":{"value":0.10},"value":', "7" * 42, '.50,"list":[1.0,{"a":2.00}]},']
    parts = [F.lit(p) if isinstance(p, str) else p for p in opening]
    return events.withColumn("eventdatavalues", F.concat(*parts, F.substring("eventdatavalues", 2, 1 << 30)))


_NUMBERS = {"number": "num00000001", "large": "big00000001"}


def json_set_text(spark, sf_dir):
    """The whole text of every document after one value was set."""
    events = _with_numbers(fixtures.load(spark, sf_dir).programstageinstance)
    edited = events.withColumn("eventdatavalues", set_value(F.col("eventdatavalues"), CFG.status_field, F.lit(CHECK_NAME)))
    return read_fields(edited, "eventdatavalues", _NUMBERS).select(_event_id(), "eventdatavalues", *_NUMBERS)


def json_merge_text(spark, sf_dir):
    """The whole text of every document after a result and a number were merged over it."""
    events = _with_numbers(fixtures.load(spark, sf_dir).programstageinstance)
    added = F.concat(F.lit(f'{{"{CFG.lab_field}":{{"value":"'), F.col("uid"), F.lit('"}, "extraField1":{"value":1.50}}'))
    edited = events.withColumn("eventdatavalues", merge(F.col("eventdatavalues"), added))
    return read_fields(edited, "eventdatavalues", _NUMBERS).select(_event_id(), "eventdatavalues", *_NUMBERS)


def apply_changes(spark, sf_dir):
    r = _run(spark, sf_dir)
    marks = r.marks.withColumn("new_document", F.lit(None).cast("string"))
    events = r.t.programstageinstance.select("programstageinstanceid", "status", "eventdatavalues")
    return _fields(apply_event_changes(events, marks, CFG.status_field)).select(
        _event_id(), "status", "transfer_status"
    )


# ---- ownership and triage ----


def ownership_candidates(spark, sf_dir):
    rows = _run(spark, sf_dir).ownership_candidates
    return _single_copies(rows).select("event_id", "person_id", "target_facility_id")


def update_ownership(spark, sf_dir):
    return _run(spark, sf_dir).ownership


def owners_after(spark, sf_dir):
    return _run(spark, sf_dir).owners


def triage(spark, sf_dir):
    return _run(spark, sf_dir).flags


def _flagged(flag: str) -> Query:
    def query(spark, sf_dir):
        return triage(spark, sf_dir).where(F.col("new_transfer_status") == flag)

    return query


# ---- notices ----


def recipients(spark, sf_dir):
    return notify.recipients(fixtures.load(spark, sf_dir), CFG)


def message_text(spark, sf_dir):
    r = _run(spark, sf_dir)
    text = notify.message_text(notify.TRANSFER_TEXT, "key_0", "key_1").alias("text")
    return expand(r.blocks.df).select("event_id", text)


def _notice_rows(requests: DataFrame) -> DataFrame:
    return expand(requests).select("facility_id", "subject", "text")


def transfer_notices(spark, sf_dir):
    return _notice_rows(notify.transfer_notices(_run(spark, sf_dir).blocks, CFG))


def lab_notices(spark, sf_dir):
    return _notice_rows(notify.lab_notices(_run(spark, sf_dir).lab))


def notify_target(spark, sf_dir):
    return expand(notify.target_notices(_run(spark, sf_dir).blocks)).select("facility_id", "text")


def static_notice(spark, sf_dir):
    """The notice a run always sends, with everyone who gets it."""
    t = fixtures.load(spark, sf_dir)
    requests = notify.static_notice(t, STATIC_AT_HOME)
    sent = notify.message_rows(requests, notify.recipients(t, STATIC_AT_HOME), STATIC_AT_HOME)
    return sent.select("facility_id", "subject", "text", "user_id")


def _transfer_requests(r: TransferRun) -> DataFrame:
    return notify.transfer_notices(r.blocks, CFG)


def message_rows(spark, sf_dir):
    r = _run(spark, sf_dir)
    return notify.message_rows(_transfer_requests(r), r.recipients, CFG).select("facility_id", "user_id", "text")


def _message_table(table: str) -> Query:
    def query(spark, sf_dir):
        r = _run(spark, sf_dir)
        built = notify.build_messages(_transfer_requests(r), r.recipients, CFG, RUN)
        return getattr(built, table)

    return query


# ---- whole run ----


def run_messages(spark, sf_dir):
    """All messages of a run: transfers, lab results and the static notice."""
    return notify.message_counts(_run(spark, sf_dir, STATIC_AT_HOME).sent)


def run_all(spark, sf_dir):
    return end_state(_run(spark, sf_dir).result.tables, CFG)


def run_events(spark, sf_dir):
    """Every event after a run."""
    return _every_event(_run(spark, sf_dir).events)


def _every_event(events: DataFrame) -> DataFrame:
    return _fields(events, lab_only=LAB_ONLY).select(
        _event_id(),
        F.col("programinstanceid").alias("enrolment_id"),
        F.col("programstageid").alias("stage_id"),
        F.col("organisationunitid").alias("facility_id"),
        "status",
        *FIELDS,
        "lab_only",
    )


def run_published(spark, sf_dir):
    """A run published to the shared folder, as readers then find it."""
    out, t = f"{_folder(spark)}/out", fixtures.load(spark, sf_dir)
    publish_run(t, CFG, RUN, out)
    return end_state(latest(t, out), CFG)


def _folder(spark: SparkSession) -> str:
    return f"{staging_root(spark)}/casebridge/{uuid.uuid4().hex}"


def _laid_out(spark: SparkSession, sf_dir: str) -> Tables:
    """The tables with the events written by stage and queue, their values in columns of their own."""
    t, path = fixtures.load(spark, sf_dir), f"{_folder(spark)}/events"
    write_base(t.programstageinstance, CFG, path)
    return t.but(programstageinstance=read_base(t.programstageinstance, path))


def queue_laid_out(spark, sf_dir):
    """Waiting source events of a laid-out table: partitions of the queue are read, no document is parsed."""
    queue = link.stage_queue(_laid_out(spark, sf_dir), CFG).df
    return _waiting(queue).select("event_id")


def json_extract_laid_out(spark, sf_dir):
    return _fields(_laid_out(spark, sf_dir).programstageinstance).select(_event_id(), *FIELDS)


def run_compacted(spark, sf_dir):
    """Every event as readers find it after a run was published and its changes folded into whole tables."""
    out, t = f"{_folder(spark)}/out", fixtures.load(spark, sf_dir)
    publish_run(t, CFG, RUN, out)
    compact(t, out)
    return _every_event(latest(t, out).programstageinstance)


def run_twice(spark, sf_dir):
    """The end state after a second run over a published one: base, changes, and changes over these."""
    out, t = f"{_folder(spark)}/out", fixtures.load(spark, sf_dir)
    publish_run(t, CFG, RUN, out)
    base = newest(spark, out)
    now = latest(t, out, base)
    again = start_run(now, "again", datetime(2026, 1, 2), after=base)
    publish_run(now, CFG, again, out)
    return end_state(latest(t, out), CFG)


def run_incremental(spark, sf_dir):
    """The end state after a run over a part of the events and values, and one over what has come since.

    Values of every fourth person and every fifth source event come between the two; the second run looks at events
    with a touched value only.
    """
    out, t = f"{_folder(spark)}/out", fixtures.load(spark, sf_dir)
    late_value, late_event = F.col("trackedentityinstanceid") % 4 == 1, (F.col("programstageinstanceid") % 5 == 2) & (F.col("programstageid") == 101)
    new = Arrivals(t.programstageinstance.where(late_event), t.trackedentityattributevalue.where(late_value))
    early = t.but(programstageinstance=t.programstageinstance.where(~late_event), trackedentityattributevalue=t.trackedentityattributevalue.where(~late_value))
    publish_run(early, CFG, RUN, out)
    compact(early, out)
    base = newest(spark, out)
    now = latest(early, out, base)
    arrived = lay_out(new.programstageinstance, CFG)
    now = now.but(programstageinstance=now.programstageinstance.unionByName(arrived, allowMissingColumns=True), trackedentityattributevalue=t.trackedentityattributevalue)
    again = start_run(now, "again", datetime(2026, 1, 2), after=base)
    return end_state(incremental_run(now, CFG, again, new).result.tables, CFG)


def match_hot_names(spark, sf_dir):
    """How many persons hold an event's number and its name, where five names are all there are, hot on both sides.

    Holders are counted per name before the join, and hot names are cut: an event stays one row.
    """
    read = spark.read.parquet
    customers = read(f"{sf_dir}/customer.parquet").select("c_custkey", F.col("c_mktsegment").alias("name"))
    orders = read(f"{sf_dir}/orders.parquet").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    number = F.concat(F.lit("TB-"), F.col("c_custkey").cast("string"))
    events = orders.join(customers, "c_custkey").select(F.col("o_orderkey").alias("event_id"), number.alias("key_0"), F.col("name").alias("key_1"))
    held = [customers.select(F.col("c_custkey").alias("person_id"), F.lit(k.attribute_uid).alias("attribute_uid"), v.alias("value")) for k, v in zip(CFG.match_keys, (number, F.col("name")), strict=True)]
    counted = link.match_counts(stage(events, "hot_names", ("key_0", "key_1")), held[0].unionByName(held[1]), replace(CFG, hot_key_rows=1))
    return counted.select("event_id", "n_0", "n_1")


QUERIES: dict[str, Query] = {
    "scan_events": scan_events,
    "attribute_lookup": attribute_lookup,
    "json_extract": json_extract,
    "filter_source_stage": filter_source_stage,
    "filter_requests": filter_requests,
    "filter_waiting": filter_waiting,
    "match_by_id": match_by_id,
    "match_by_name": match_by_name,
    "match_both": match_both,
    "match_both_indexed": match_both_indexed,
    "match_three_keys": match_three_keys,
    "match_enrolments": match_enrolments,
    "transfer_rows": transfer_rows,
    "allocate_ids": allocate_ids,
    "insert_treatment": insert_treatment,
    "insert_lab": insert_lab,
    "transfer_inserts": transfer_inserts,
    "uid_format": uid_format,
    "mark_transferred": mark_transferred,
    "lab_transfer_rows": lab_transfer_rows,
    "complete_lab_events": complete_lab_events,
    "merge_lab": merge_lab,
    "json_set": json_set,
    "json_merge": json_merge,
    "json_set_text": json_set_text,
    "json_merge_text": json_merge_text,
    "apply_changes": apply_changes,
    "ownership_candidates": ownership_candidates,
    "update_ownership": update_ownership,
    "owners_after": owners_after,
    "flag_check_name": _flagged(CHECK_NAME),
    "flag_no_match": _flagged(NO_MATCH),
    "flag_id_not_found": _flagged(ID_NOT_FOUND),
    "triage": triage,
    "recipients": recipients,
    "message_text": message_text,
    "transfer_notices": transfer_notices,
    "lab_notices": lab_notices,
    "notify_target": notify_target,
    "static_notice": static_notice,
    "message_rows": message_rows,
    "messageconversation": _message_table("messageconversation"),
    "message": _message_table("message"),
    "messageconversation_messages": _message_table("messageconversation_messages"),
    "usermessage": _message_table("usermessage"),
    "messageconversation_usermessages": _message_table("messageconversation_usermessages"),
    "run_messages": run_messages,
    "run_events": run_events,
    "run_all": run_all,
    "run_published": run_published,
    "run_compacted": run_compacted,
    "run_twice": run_twice,
    "run_incremental": run_incremental,
    "queue_laid_out": queue_laid_out,
    "json_extract_laid_out": json_extract_laid_out,
    "match_hot_names": match_hot_names,
}
