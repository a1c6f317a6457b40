"""Each rule of the job on rows that show it and rows that do not, with its strict option."""

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import datetime

import pytest
from tiny import CFG, LAB, OTHER_STAGE, RUN, SOURCE, TREATMENT, World, document, states, transfer_status, value

from casebridge.config import DISTRICT_NUMBER

EARLY, LATE = datetime(2025, 1, 1), datetime(2025, 6, 1)


def flags(r):
    return {row["event_id"]: row["new_transfer_status"] for row in r.flags.collect()}


def marks(r):
    return {row["event_id"]: row["new_status"] for row in r.marks.collect()}


def inserted(r):
    """(role, enrolment, status of the copy's document) per new event."""
    rows = r.inserts.df.collect()
    return sorted((row["role"], row["programinstanceid"]) for row in rows)


def owners(r):
    return {(o["person_id"], o["program_id"]): o["new_facility_id"] for o in r.ownership.collect()}


# ---- the match matrix ----


def matrix():
    w = World().person(1, "A1", "Ann").person(2, "B2", "Bob")
    w.event(1, document("A1", "Ann")).event(2, document("A1", "Nobody"))
    w.event(3, document("X9", "Nobody")).event(4, document("X9", "Bob"))
    w.event(5, document("A1")).event(6, document(name="Ann")).event(7, document())
    w.event(8, document("a1", "Ann")).event(9, document("A1 ", "Ann"))
    return w


def rule_match_matrix(spark):
    r = matrix().run(spark)
    found, none = "Not Yet Transferred TB No Not Found", "No Match"
    assert marks(r) == {1: "ACTIVE"}
    assert inserted(r) == [("lab", 10), ("treatment", 10)]
    assert flags(r) == {2: "Check Name", 3: none, 4: found, 5: "Check Name", 6: found, 7: none, 8: found, 9: found}


def rule_other_events_are_left_alone(spark):
    w = World().person(1, "A1", "Ann")
    w.event(1, document("A1", "Ann", request="NONE")).event(2, document("A1", "Ann", request=None))
    w.event(3, document("A1", "Ann", state="Check Name")).event(4, document("A1", "Ann", state=None))
    w.event(5, document("A1", "Ann"), stage=OTHER_STAGE).event(6, None)
    r = w.run(spark)
    before = {e["programstageinstanceid"]: e["eventdatavalues"] for e in r.t.programstageinstance.collect()}
    after = {e["programstageinstanceid"]: e["eventdatavalues"] for e in r.events.collect()}
    assert marks(r) == {} and flags(r) == {} and before == after


def rule_without_an_active_enrolment_an_event_waits_unflagged(spark):
    w = World()
    for i, enrolment in enumerate([{"status": "COMPLETED"}, {"deleted": True}, {"deleted": None}, {"enrol": False}]):
        w.person(i, f"A{i}", f"Ann{i}", **enrolment).event(i, document(f"A{i}", f"Ann{i}"))
    r = w.run(spark)
    assert marks(r) == {} and inserted(r) == [] and flags(r) == {}


def rule_an_unknown_attribute_links_and_flags_nothing(spark):
    w = matrix()
    w.rows["trackedentityattribute"] = [(12, CFG.match_keys[1].attribute_uid)]
    r = w.run(spark)
    assert marks(r) == {} and inserted(r) == [] and flags(r) == {}


def rule_an_unknown_source_stage_transfers_nothing_but_still_flags(spark):
    w = matrix()
    w.rows["programstage"] = [(TREATMENT, "tJ5SV8gfZaA"), (LAB, "edyRc6d5Bts")]
    r = w.run(spark)
    assert marks(r) == {} and inserted(r) == [] and len(flags(r)) == 8


def rule_an_unknown_target_stage_gives_copies_without_stage(spark):
    w = matrix()
    w.rows["programstage"] = [(SOURCE, "qZ43tA7bpir"), (LAB, "edyRc6d5Bts")]
    stages = {row["role"]: row["programstageid"] for row in w.run(spark).inserts.df.collect()}
    assert stages == {"treatment": None, "lab": LAB}


def rule_a_stage_uid_used_twice_is_an_error(spark):
    w = matrix()
    w.rows["programstage"].append((999, "qZ43tA7bpir"))
    with pytest.raises(Exception, match="(?i)scalar.?subquery"):
        w.run(spark).matched


# ---- linkage ----


def two_with_one_name():
    return World().person(1, "A1", "Ann").person(2, "B2", "Ann").person(3, "A1", "Cat").event(1, document("A1", "Ann"))


def rule_keys_may_come_from_two_persons_and_fan_out(spark):
    # Persons 1 and 3 hold the number, 1 and 2 the name: 2 x 2 transfers, two copies each.
    once = [("lab", 10), ("lab", 30), ("treatment", 10), ("treatment", 30)]
    assert inserted(two_with_one_name().run(spark)) == sorted(once * 2)


def rule_same_entity(spark):
    r = two_with_one_name().run(spark, replace(CFG, same_entity=True))
    assert inserted(r) == [("lab", 10), ("treatment", 10)]


def rule_same_entity_needs_both_keys_at_one_person(spark):
    w = World().person(1, "A1", "Ann").person(2, "B2", "Bob").event(1, document("A1", "Bob"))
    assert marks(w.run(spark)) == {1: "ACTIVE"}
    assert marks(w.run(spark, replace(CFG, same_entity=True))) == {}


def rule_dedupe_transfers(spark):
    r = two_with_one_name().run(spark, replace(CFG, dedupe_transfers=True))
    assert inserted(r) == [("lab", 10), ("lab", 30), ("treatment", 10), ("treatment", 30)]


def rule_marks_ignore_the_program(spark):
    w = World().person(1, "A1", "Ann", program=2).event(1, document("A1", "Ann"))
    r = w.run(spark)
    assert marks(r) == {1: "ACTIVE"} and inserted(r) == []
    r = w.run(spark, replace(CFG, require_program=True))
    assert marks(r) == {} and inserted(r) == []


def rule_deleted_events_count(spark):
    w = World().person(1, "A1", "Ann").event(1, document("A1", "Ann"), deleted=True).event(2, document("A1", "Ann"))
    assert marks(w.run(spark)) == {1: "ACTIVE", 2: "ACTIVE"}
    r = w.run(spark, replace(CFG, skip_deleted_events=True))
    assert marks(r) == {2: "ACTIVE"} and len(inserted(r)) == 2


def rule_third_key(spark):
    w = World().person(1, "A1", "Ann").person(2, "B2", "Bob")
    w.rows["trackedentityattribute"].append((13, DISTRICT_NUMBER.attribute_uid))
    w.rows["trackedentityattributevalue"] += [(1, 13, "D1"), (2, 13, "D1")]
    w.event(1, document("A1", "Ann", **{DISTRICT_NUMBER.event_field: {"value": "D1"}}))
    w.event(2, document("A1", "Ann", **{DISTRICT_NUMBER.event_field: {"value": "D2"}}))
    r = w.run(spark, replace(CFG, match_keys=(*CFG.match_keys, DISTRICT_NUMBER)))
    assert marks(r) == {1: "ACTIVE"}
    assert len(inserted(r)) == 4
    assert flags(r) == {}


def rule_a_numeric_or_object_key_is_matched_as_text(spark):
    w = World().person(1, "17", "Ann").event(1, document(17, "Ann")).event(2, document({"q": 1}, "Ann"))
    assert marks(w.run(spark)) == {1: "ACTIVE"}


# ---- copies ----


def rule_a_copy_keeps_the_document_and_takes_the_enrolment(spark):
    doc = document("A1", "Ann", lab="pos", note=[1, {"deep": None}], number=1.5)
    w = World().person(1, "A1", "Ann", facility=3).event(1, doc, facility=2, date=EARLY, status="ACTIVE")
    rows = {row["role"]: row for row in w.run(spark).inserts.df.collect()}
    assert [rows[k]["programstageid"] for k in ("treatment", "lab")] == [TREATMENT, LAB]
    assert [rows[k]["programstageinstanceid"] for k in ("treatment", "lab")] == [1001, 1002]
    for row in rows.values():
        assert row["eventdatavalues"] == doc and row["programinstanceid"] == 10
        assert (row["organisationunitid"], row["executiondate"], row["status"]) == (2, EARLY, "COMPLETED")
        assert (row["deleted"], row["storedby"], row["created"]) == (False, "SCRIPT", datetime(2026, 1, 1))


def rule_reset_status_on_copy(spark):
    w = World().person(1, "A1", "Ann").event(1, document("A1", "Ann"))
    for cfg, expected in ((CFG, "NOTTRANSFERRED"), (replace(CFG, reset_status_on_copy=True), "AUTOMATICALLY")):
        after = states(w.run(spark, cfg))
        assert {transfer_status(after[i][2]) for i in (1001, 1002)} == {expected}
        assert transfer_status(after[1][2]) == "AUTOMATICALLY"


# ---- late lab results ----


def waiting_and_late():
    w = World().person(1, "A1", "Ann").person(2, "B2", "Bob")
    w.event(1, document("A1", "Ann", lab="pos")).event(2, document("A1", "Ann", lab="")).event(3, document("A1", "Ann"))
    w.event(4, document("B2", "Bob", state="AUTOMATICALLY", lab="neg", date={"value": "d"}), date=EARLY)
    w.event(5, document("B2", "Bob", state="AUTOMATICALLY"))
    w.event(6, document("B2", "Bob", state="AUTOMATICALLY", lab="neg"), status="COMPLETED")
    w.event(90, document(state=None, request=None, lab="OLD", own={"value": "keep"}), LAB, 20, "COMPLETED")
    w.event(91, document(state=None, request=None, lab="OLD", own={"value": "keep"}), LAB, 99, "COMPLETED")
    return w


def rule_status_and_late_results(spark):
    r = waiting_and_late().run(spark)
    assert marks(r) == {1: "COMPLETED", 2: "ACTIVE", 3: "ACTIVE"}
    # A blank result is "missing" for the mark and a result for the lab step.
    assert {row["event_id"] for row in r.lab.collect()} == {2, 4}
    after = states(r)
    assert [after[i][1] for i in (1, 2, 3, 4, 5)] == ["COMPLETED", "COMPLETED", "ACTIVE", "COMPLETED", "ACTIVE"]
    assert after[90][2]["own"] == {"value": "keep"} and after[90][2]["date"] == {"value": "d"}
    assert value(after[90][2], CFG.lab_field) == "neg" and transfer_status(after[90][2]) == "AUTOMATICALLY"
    assert value(after[91][2], CFG.lab_field) == "OLD" and transfer_status(after[91][2]) is None
    # All lab copies of the enrolment get event 2's fields; treatment copies do not.
    labs = [d for s, _, d in after.values() if s == LAB and value(d, CFG.match_keys[0].event_field) == "A1"]
    assert [(value(d, CFG.lab_field), transfer_status(d)) for d in labs] == [("", "AUTOMATICALLY")] * 3
    treatments = [transfer_status(d) for s, _, d in after.values() if s == TREATMENT]
    assert treatments == ["NOTTRANSFERRED"] * 3


def rule_blank_is_missing(spark):
    r = waiting_and_late().run(spark, replace(CFG, blank_is_missing=True))
    assert {row["event_id"] for row in r.lab.collect()} == {4}
    assert states(r)[2][1] == "ACTIVE"


def rule_merge_fields(spark):
    after = states(waiting_and_late().run(spark, replace(CFG, merge_fields=(CFG.lab_field,))))
    assert value(after[90][2], CFG.lab_field) == "neg"
    assert transfer_status(after[90][2]) is None and "date" not in after[90][2]


def rule_results_to_the_own_copy(spark):
    cfg = replace(CFG, lab_target="own_copy")
    r = waiting_and_late().run(spark, cfg)
    after = states(r)
    assert value(after[90][2], CFG.lab_field) == "OLD"
    labs = r.events.where(f"programstageid = {LAB}").collect()
    own = {e["transferredfrom"]: e["programstageinstanceid"] for e in labs}
    assert {source: transfer_status(after[own[source]][2]) for source in (1, 2, 3)} == {
        1: "NOTTRANSFERRED",
        2: "AUTOMATICALLY",
        3: "NOTTRANSFERRED",
    }


def rule_the_latest_source_wins_then_the_largest_id(spark):
    w = World().person(1, "A1", "Ann").event(90, document(lab="OLD"), LAB, 10)
    w.event(7, document("A1", "Ann", state="AUTOMATICALLY", lab="early"), date=EARLY)
    w.event(5, document("A1", "Ann", state="AUTOMATICALLY", lab="late5"), date=LATE)
    w.event(6, document("A1", "Ann", state="AUTOMATICALLY", lab="late6"), date=LATE)
    w.event(8, document("A1", "Ann", state="AUTOMATICALLY", lab="no date"), date=None)
    assert value(states(w.run(spark))[90][2], CFG.lab_field) == "late6"


def rule_an_event_with_several_enrolments_goes_to_the_smallest(spark):
    w = World().person(1, "A1", "Ann").enrol(5, 1, program=2).event(90, document(lab="A"), LAB, 10)
    w.event(91, document(lab="B"), LAB, 5).event(4, document("A1", "Ann", state="AUTOMATICALLY", lab="new"))
    after = states(w.run(spark))
    assert [value(after[i][2], CFG.lab_field) for i in (90, 91)] == ["A", "new"]
    after = states(w.run(spark, replace(CFG, require_program=True)))
    assert [value(after[i][2], CFG.lab_field) for i in (90, 91)] == ["new", "B"]


# ---- ownership ----


def moved(event_id, target, date=LATE, status="COMPLETED", **more):
    doc = document("A1", "Ann", request="PERMANENT_TRANSFER", state="AUTOMATICALLY", target=target, lab="x")
    return {"event_id": event_id, "doc": doc, "date": date, "status": status, **more}


def movers(*events):
    w = World().person(1, "A1", "Ann").own(1, 2, 1).person(2, "B2", "Bob")
    for e in events:
        w.event(**e)
    return w


def rule_all_ownership_rows_of_the_person_change(spark):
    w = movers(moved(1, "south"))
    assert owners(w.run(spark)) == {(1, 1): 2, (1, 2): 2}
    assert owners(w.run(spark, replace(CFG, owner_program_only=True))) == {(1, 1): 2}
    after = {tuple(r) for r in w.run(spark).owners.collect()}
    assert after == {(1, 1, 2), (1, 2, 2), (2, 1, 1)}


def rule_owner_already_there_unknown_target_or_open_event(spark):
    assert owners(movers(moved(1, "north"), moved(2, "nowhere")).run(spark)) == {}
    open_event = moved(1, "south", status="ACTIVE")
    open_event["doc"] = document("A1", "Ann", request="PERMANENT_TRANSFER", state="AUTOMATICALLY", target="south")
    assert owners(movers(open_event).run(spark)) == {}


def rule_any_stage_can_move_a_person(spark):
    w = movers(moved(1, "south", stage=OTHER_STAGE))
    assert owners(w.run(spark)) == {(1, 1): 2, (1, 2): 2}
    assert owners(w.run(spark, replace(CFG, source_stage_only=True))) == {}


def rule_the_latest_request_that_differs_wins(spark):
    w = movers(moved(1, "south", EARLY), moved(2, "east", LATE), moved(3, "south", EARLY), moved(9, "north", LATE))
    assert owners(w.run(spark))[1, 1] == 3
    # The very latest request is where the person already is.
    assert owners(w.run(spark, replace(CFG, owner_latest_only=True))) == {}


def rule_ownership_flips_unless_the_latest_counts(spark):
    first = movers(moved(1, "south", EARLY), moved(2, "east", LATE)).run(spark)
    again = type(first)(first.result.tables, CFG, first.run)
    assert owners(first)[1, 1] == 3 and owners(again)[1, 1] == 2
    strict = replace(CFG, owner_latest_only=True)
    first = movers(moved(1, "south", EARLY), moved(2, "east", LATE)).run(spark, strict)
    assert owners(first)[1, 1] == 3 and owners(type(first)(first.result.tables, strict, first.run)) == {}


def rule_the_name_needs_only_to_exist_for_the_moved_person(spark):
    # Person 1 has the number and another name; person 2 has the event's name.
    w = World().person(1, "A1", "Zoe").person(2, "B2", "Ann").event(**moved(1, "south"))
    assert owners(w.run(spark)) == {(1, 1): 2}
    assert owners(w.run(spark, replace(CFG, same_entity=True))) == {}
    w = World().person(1, "A1").person(2, "B2", "Ann").event(**moved(1, "south"))
    assert owners(w.run(spark)) == {}


def rule_an_event_marked_and_completed_in_this_run_moves_the_person(spark):
    w = World().person(1, "A1", "Ann")
    w.event(1, document("A1", "Ann", request="PERMANENT_TRANSFER", target="south", lab="x"))
    assert owners(w.run(spark)) == {(1, 1): 2}


def rule_a_merged_lab_event_can_move_a_person(spark):
    # Event 1 is open; the lab event it is merged into is completed and asks the same.
    w = World().person(1, "A1", "Ann").event(90, document(lab="OLD"), LAB, 10, "COMPLETED")
    w.event(1, document("A1", "Ann", request="PERMANENT_TRANSFER", state="AUTOMATICALLY", target="south", lab="x"))
    r = w.run(spark)
    assert {row["event_id"] for row in r.ownership_candidates.collect()} == {1, 90}


def rule_copies_that_say_transferred_can_move_a_person(spark):
    w = World().person(1, "A1", "Ann").event(
        1, document("A1", "Ann", request="PERMANENT_TRANSFER", target="south")
    )
    assert owners(w.run(spark)) == {}
    assert owners(w.run(spark, replace(CFG, reset_status_on_copy=True))) == {(1, 1): 2}


# ---- triage ----


def rule_any_stage_is_flagged(spark):
    w = World().person(1, "A1", "Ann").event(1, document("X", "Y"), stage=OTHER_STAGE).event(2, document("X", "Y"))
    assert flags(w.run(spark)) == {1: "No Match", 2: "No Match"}
    assert flags(w.run(spark, replace(CFG, source_stage_only=True))) == {2: "No Match"}


def rule_flag_changes_the_status_field_only(spark):
    w = World().person(1, "A1", "Ann").event(1, document("X", "Y", extra=[1, 2]))
    r = w.run(spark)
    _, status, doc = states(r)[1]
    before = json.loads(document("X", "Y", extra=[1, 2]))
    assert status == "ACTIVE" and doc == {**before, CFG.status_field: {"value": "No Match"}}
    assert r.events.where("lastupdated IS NOT NULL").isEmpty()


# ---- notices ----


def office():
    w = World().person(1, "A1", "Ann", facility=1).event(1, document("A1", "Ann"), facility=2)
    w.user(501, 1).user(502, 1, times=2).user(503, 1, group=2).user(504, 2).user(505, 1, account=False)
    return w


def told(r):
    return sorted((m["userid"], m["messagetext"]) for m in r.messages.message.collect())


TEXT = "Patient has been transferred: A1 Ann"


def rule_recipients_of_the_enrolments_facility(spark):
    # User 502 is a member twice and is told twice.
    assert told(office().run(spark)) == [(501, TEXT), (502, TEXT), (502, TEXT)]
    assert told(office().run(spark, replace(CFG, distinct_recipients=True))) == [(501, TEXT), (502, TEXT)]


def rule_notify_target(spark):
    r = office().run(spark, replace(CFG, notify_target=True, distinct_recipients=True))
    assert told(r) == [(501, TEXT), (502, TEXT), (504, TEXT)]


def rule_static_notice(spark):
    w = World().user(501, 1)
    cfg = replace(CFG, static_notice_facility_id=1)
    assert told(w.run(spark, cfg)) == [(501, "Patient has been transferred: tbnumber fullname")]
    assert told(w.run(spark, replace(cfg, static_notice=False))) == []
    assert told(w.run(spark)) == []


def rule_lab_notice_goes_to_the_events_facility(spark):
    w = office().event(2, document("A1", "Ann", state="AUTOMATICALLY", lab="x"), facility=2)
    assert (504, "Lab results transferred: A1 Ann") in told(w.run(spark))


def rule_message_tables_belong_together(spark):
    m = office().run(spark).messages
    conversations = {r["messageconversationid"]: r for r in m.messageconversation.collect()}
    messages = {r["messageid"]: r for r in m.message.collect()}
    states_of = {r["usermessageid"]: r for r in m.usermessage.collect()}
    links = m.messageconversation_messages.collect()
    user_links = m.messageconversation_usermessages.collect()
    assert sorted(conversations) == sorted(messages) == sorted(states_of) == [1, 2, 3]
    for link in links:
        # Sender and recipient are the same user.
        assert conversations[link["messageconversationid"]]["userid"] == messages[link["messageid"]]["userid"]
        assert link["sort_order"] == 1
    for link in user_links:
        user = conversations[link["messageconversationid"]]["userid"]
        assert user == states_of[link["usermessageid"]]["userid"]
    one = conversations[1]
    assert (one["subject"], one["messagetype"], one["priority"]) == ("Patient transfer", "PRIVATE", "NONE")
    assert one["created"] == one["lastmessage"] == datetime(2026, 1, 1)


def rule_a_number_too_large_for_an_int_column_fails(spark):
    r = office().run(spark, run=replace(RUN, usermessage_base=2**31))
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        r.messages


def rule_missing_columns_are_reported(spark):
    t = office().tables(spark)
    with pytest.raises(ValueError, match=r"users: missing columns \['userid'\]"):
        t.but(users=t.userinfo)


# ---- the rules as tests ----

RULES = {name: check for name, check in globals().items() if name.startswith("rule_")}


@pytest.fixture(scope="module")
def outcomes(spark):
    """Each rule is a few tiny Spark jobs that mostly wait, so they run side by side."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    with ThreadPoolExecutor(8) as pool:
        yield {name: pool.submit(check, spark) for name, check in RULES.items()}
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("rule", RULES)
def test_rule(rule, outcomes):
    outcomes[rule].result()
