"""The same queries as plain SQL over the driver's tables, for a second engine.

Written statement by statement, each step on the table the one before leaves; documents are compared by
their extracted fields.
"""

from __future__ import annotations

import re

from casebridge.sources.fixtures import oracle_ctes

FIELDS = "id_number, full_name, request, transfer_status, lab, target_uid"


def _text(field: str) -> str:
    return f"json_extract_string(eventdatavalues, '$.{field}.value')"


def _state(events: str) -> str:
    """The columns of an event state."""
    return f"event_id, enrolment_id, stage_id, executed, facility_id, status, {FIELDS}, lab_only FROM {events}"


SOURCE = "stage_id = (SELECT programstageid FROM programstage WHERE uid = 'qZ43tA7bpir')"
TREATMENT = "(SELECT programstageid FROM programstage WHERE uid = 'tJ5SV8gfZaA')"
LAB = "(SELECT programstageid FROM programstage WHERE uid = 'edyRc6d5Bts')"
VALID = "request IN ('EVENT_TRANSFER', 'PERMANENT_TRANSFER')"
BY_ID = "attr.uid = 'ZkNZOxS24k7'"
BY_NAME = "attr.uid = 'jWjSY7cktaQ'"

STEPS = {
    "attr": """
SELECT trackedentityinstanceid AS person_id, uid, value
FROM trackedentityattributevalue JOIN trackedentityattribute USING (trackedentityattributeid)""",
    "id_values": "SELECT person_id AS person_by_id, value FROM attr WHERE uid = 'ZkNZOxS24k7'",
    "name_values": "SELECT person_id AS person_by_name, value FROM attr WHERE uid = 'jWjSY7cktaQ'",
    "district_values": "SELECT person_id AS person_by_district, value FROM attr WHERE uid = 'fPlDBVvpEJR'",
    "active": """
SELECT programinstanceid AS enrolment_id, trackedentityinstanceid AS person_id, programid AS program_id,
       organisationunitid AS enrolment_facility_id
FROM programinstance JOIN trackedentityinstance USING (trackedentityinstanceid)
WHERE deleted = false AND status = 'ACTIVE'""",
    "ev0": f"""
SELECT programstageinstanceid AS event_id, programinstanceid AS enrolment_id, programstageid AS stage_id,
       executiondate AS executed, organisationunitid AS facility_id, status,
       {_text("XupJDPkqWoL")} AS id_number, {_text("bvuRnNr6INS")} AS full_name, {_text("MVQOgAxvNWh")} AS request,
       {_text("iup9aING8xC")} AS transfer_status, {_text("WTz4HSqoE5E")} AS lab,
       {_text("JpvpfVIjK7x")} AS target_uid, {_text("labOnly0001")} AS lab_only, {_text("eCy7sKTrwnA")} AS district,
       uid
FROM programstageinstance""",
    "waiting": f"SELECT * FROM ev0 WHERE {SOURCE} AND {VALID} AND transfer_status = 'NOTTRANSFERRED'",
    "waiting_links": """
SELECT w.*, i.person_by_id, n.person_by_name
FROM waiting w JOIN id_values i ON i.value = w.id_number JOIN name_values n ON n.value = w.full_name""",
    "waiting_enrolments": """
SELECT l.*, a.enrolment_id AS destination, a.program_id, a.enrolment_facility_id
FROM waiting_links l JOIN active a ON a.person_id = l.person_by_id""",
    "transfer": """
SELECT w.*, row_number() OVER (ORDER BY event_id, destination, person_by_id, person_by_name) AS rank
FROM waiting_enrolments w JOIN program p ON p.programid = w.program_id AND p.uid = 'wfd9K4dQVDR'""",
    "inserted": f"""
SELECT 2000000000 + 2 * rank - 1 AS event_id, destination AS enrolment_id, {TREATMENT} AS stage_id, executed,
       facility_id, 'COMPLETED' AS status, {FIELDS}, lab_only
FROM transfer
UNION ALL
SELECT 2000000000 + 2 * rank, destination, {LAB}, executed, facility_id, 'COMPLETED', {FIELDS}, lab_only
FROM transfer""",
    "marked": """
SELECT DISTINCT event_id, CASE WHEN lab IS NULL OR lab = '' THEN 'ACTIVE' ELSE 'COMPLETED' END AS new_status,
       'AUTOMATICALLY' AS new_transfer_status
FROM waiting_enrolments""",
    "ev1": f"SELECT {_state('ev0')} UNION ALL SELECT {_state('inserted')}",
    "ev2": """
SELECT e.* REPLACE (coalesce(m.new_status, e.status) AS status,
                    coalesce(m.new_transfer_status, e.transfer_status) AS transfer_status)
FROM ev1 e LEFT JOIN marked m USING (event_id)""",
    "late": f"""
SELECT e.* REPLACE (a.enrolment_id AS enrolment_id)
FROM ev2 e JOIN id_values i ON i.value = e.id_number JOIN name_values n ON n.value = e.full_name
JOIN active a ON a.person_id = i.person_by_id
WHERE {SOURCE} AND {VALID} AND transfer_status = 'AUTOMATICALLY' AND status = 'ACTIVE' AND lab IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY a.enrolment_id) = 1""",
    "numbered": """
SELECT programstageinstanceid AS event_id, uid, programstageinstanceid || '.00' AS number, repeat('7', 42) || '.50' AS large,
       '{ "num00000001" : {"value" : ' || programstageinstanceid || '.00},"big00000001":{"in":{"value":0.10},"value":'
       || repeat('7', 42) || '.50,"list":[1.0,{"a":2.00}]},' || substr(eventdatavalues, 2) AS doc
FROM programstageinstance""",
    "merged": f"""
SELECT e.event_id, e.enrolment_id, e.stage_id, e.executed, e.facility_id, e.status,
       {", ".join(f"coalesce(s.{f}, e.{f}) AS {f}" for f in FIELDS.split(", "))}, e.lab_only
FROM ev2 e JOIN late s ON s.enrolment_id = e.enrolment_id
WHERE e.stage_id = {LAB}
QUALIFY row_number() OVER (PARTITION BY e.event_id ORDER BY s.executed DESC, s.event_id DESC) = 1""",
    "ev3": f"""
SELECT {_state("merged")}
UNION ALL
SELECT e.* REPLACE (CASE WHEN e.event_id IN (SELECT event_id FROM late) THEN 'COMPLETED' ELSE e.status END AS status)
FROM ev2 e WHERE e.event_id NOT IN (SELECT event_id FROM merged)""",
    "source": """
SELECT e.event_id, e.executed, o.trackedentityinstanceid AS person_id, f.organisationunitid AS target_facility_id
FROM ev3 e JOIN id_values i ON i.value = e.id_number JOIN name_values n ON n.value = e.full_name
JOIN trackedentityinstance p ON p.trackedentityinstanceid = i.person_by_id
JOIN trackedentityprogramowner o ON o.trackedentityinstanceid = p.trackedentityinstanceid
     AND o.programid = (SELECT programid FROM program WHERE uid = 'wfd9K4dQVDR')
JOIN organisationunit f ON f.uid = e.target_uid
WHERE request = 'PERMANENT_TRANSFER' AND transfer_status = 'AUTOMATICALLY' AND status = 'COMPLETED'
  AND o.organisationunitid <> f.organisationunitid""",
    "owner_changes": """
SELECT o.trackedentityinstanceid AS person_id, o.programid AS program_id, s.target_facility_id AS new_facility_id
FROM trackedentityprogramowner o JOIN source s ON s.person_id = o.trackedentityinstanceid
WHERE o.trackedentityinstanceid IN (SELECT person_by_name FROM name_values)
QUALIFY row_number() OVER (PARTITION BY o.trackedentityinstanceid, o.programid
                           ORDER BY s.executed DESC, s.event_id DESC) = 1""",
    "flagged": f"""
SELECT event_id, CASE WHEN i AND NOT n THEN 'Check Name' WHEN NOT i AND NOT n THEN 'No Match'
                      WHEN n AND NOT i THEN 'Not Yet Transferred TB No Not Found' END AS new_transfer_status
FROM (SELECT event_id, EXISTS (SELECT 1 FROM id_values v WHERE v.value = e.id_number) AS i,
             EXISTS (SELECT 1 FROM name_values v WHERE v.value = e.full_name) AS n
      FROM ev3 e WHERE {VALID} AND transfer_status = 'NOTTRANSFERRED')
WHERE NOT (i AND n)""",
    "ev4": """
SELECT e.* REPLACE (coalesce(f.new_transfer_status, e.transfer_status) AS transfer_status)
FROM ev3 e LEFT JOIN flagged f USING (event_id)""",
    "told": """
SELECT held.organisationunitid AS facility_id, gm.userid AS user_id
FROM usermembership held JOIN usergroupmembers gm ON gm.userid = held.userinfoid
WHERE gm.usergroupid = (SELECT usergroupid FROM usergroup WHERE uid = 'phS5ScyDEYj')
  AND EXISTS (SELECT 1 FROM users WHERE users.userid = gm.userid)
  AND EXISTS (SELECT 1 FROM userinfo WHERE userinfo.userinfoid = gm.userid)
  AND EXISTS (SELECT 1 FROM organisationunit o WHERE o.organisationunitid = held.organisationunitid)""",
    "transfer_messages": """
SELECT enrolment_facility_id AS facility_id, user_id, event_id,
       'Patient has been transferred: ' || coalesce(id_number, '') || ' ' || coalesce(full_name, '') AS text,
       row_number() OVER (ORDER BY rank, user_id) AS n
FROM transfer JOIN told ON told.facility_id = transfer.enrolment_facility_id""",
    "lab_messages": """
SELECT 'Lab results transferred: ' || coalesce(id_number, '') || ' ' || coalesce(full_name, '') AS text, user_id
FROM late JOIN told USING (facility_id)""",
    "static_messages": """
SELECT facility_id, 'Patient transfer' AS subject, 'Patient has been transferred: tbnumber fullname' AS text, user_id
FROM told WHERE facility_id = 7""",
}

TRANSFER_TEXT = "'Patient has been transferred: ' || coalesce(id_number, '') || ' ' || coalesce(full_name, '') AS text"
CLOCK = "TIMESTAMP '2026-01-01 00:00:00'"
NUMBER = "to_base(n, 36, 10)"
INSERTED = (
    f"SELECT event_id, enrolment_id, stage_id, facility_id, status, 'E' || to_base(event_id, 36, 10) AS uid, "
    f"{CLOCK} AS created, {CLOCK} AS lastupdated, false AS deleted, 'SCRIPT' AS storedby, {FIELDS} FROM inserted"
)

FINAL = {
    "scan_events": "SELECT programstageinstanceid AS event_id, programstageid AS stage_id, "
    "organisationunitid AS facility_id, status FROM programstageinstance",
    "attribute_lookup": "SELECT person_id, uid AS attribute_uid, value FROM attr "
    "WHERE uid IN ('ZkNZOxS24k7', 'jWjSY7cktaQ')",
    "json_extract": f"SELECT event_id, {FIELDS} FROM ev0",
    "filter_source_stage": f"SELECT event_id FROM ev0 WHERE {SOURCE}",
    "filter_requests": f"SELECT event_id, request FROM ev0 WHERE {SOURCE} AND {VALID}",
    "filter_waiting": "SELECT event_id FROM waiting",
    "match_by_id": "SELECT event_id, person_by_id FROM waiting JOIN id_values ON value = id_number",
    "match_by_name": "SELECT event_id, person_by_name FROM waiting JOIN name_values ON value = full_name",
    "match_both": "SELECT event_id, person_by_id, person_by_name FROM waiting_links",
    "match_both_indexed": "SELECT event_id, person_by_id, person_by_name FROM waiting_links",
    "match_three_keys": "SELECT event_id, person_by_id, person_by_name, person_by_district "
    "FROM waiting_links JOIN district_values ON value = district",
    "match_enrolments": "SELECT event_id, destination AS enrolment_id, program_id FROM waiting_enrolments",
    "transfer_rows": "SELECT event_id, destination AS enrolment_id, facility_id, enrolment_facility_id, id_number, "
    "full_name FROM transfer",
    "allocate_ids": "SELECT event_id, destination AS enrolment_id, rank, 2000000000 + 2 * rank - 1 AS treatment_id, "
    "2000000000 + 2 * rank AS lab_id FROM transfer",
    "insert_treatment": f"{INSERTED} WHERE stage_id = {TREATMENT}",
    "insert_lab": f"{INSERTED} WHERE stage_id = {LAB}",
    "transfer_inserts": INSERTED,
    "uid_format": "SELECT event_id, true AS well_formed FROM inserted",
    "mark_transferred": "SELECT * FROM marked",
    "lab_transfer_rows": "SELECT event_id, enrolment_id FROM late",
    "complete_lab_events": "SELECT event_id, 'COMPLETED' AS new_status FROM late",
    "merge_lab": f"SELECT event_id, {FIELDS}, lab_only FROM merged",
    "json_set": "SELECT event_id, id_number, full_name, request, "
    "CASE WHEN transfer_status IS NOT NULL THEN 'Check Name' END AS transfer_status, lab, target_uid, lab_only "
    "FROM ev0",
    "json_merge": "SELECT event_id, id_number, full_name, request, transfer_status, uid AS lab, target_uid, lab_only, "
    "status AS extra FROM ev0",
    "json_set_text": """
SELECT event_id, number, large, regexp_replace(doc, '"iup9aING8xC":[{]"value":"[^"]*"', '"iup9aING8xC":{"value":"Check Name"') AS eventdatavalues
FROM numbered""",
    "json_merge_text": """
SELECT event_id, number, large, rtrim(regexp_replace(doc, ',"WTz4HSqoE5E":[{]"value":"[^"]*"[}]', ''), '}') || '},"WTz4HSqoE5E":{"value":"' || uid
       || '"}, "extraField1":{"value":1.50}}' AS eventdatavalues
FROM numbered""",
    "apply_changes": "SELECT event_id, coalesce(new_status, status) AS status, "
    "coalesce(new_transfer_status, transfer_status) AS transfer_status FROM ev0 LEFT JOIN marked USING (event_id)",
    "ownership_candidates": "SELECT event_id, person_id, target_facility_id FROM source",
    "update_ownership": "SELECT * FROM owner_changes",
    "owners_after": """
SELECT o.trackedentityinstanceid, o.programid, coalesce(c.new_facility_id, o.organisationunitid) AS organisationunitid
FROM trackedentityprogramowner o
LEFT JOIN owner_changes c ON c.person_id = o.trackedentityinstanceid AND c.program_id = o.programid""",
    "flag_check_name": "SELECT * FROM flagged WHERE new_transfer_status = 'Check Name'",
    "flag_no_match": "SELECT * FROM flagged WHERE new_transfer_status = 'No Match'",
    "flag_id_not_found": "SELECT * FROM flagged WHERE new_transfer_status = 'Not Yet Transferred TB No Not Found'",
    "triage": "SELECT * FROM flagged",
    "recipients": "SELECT * FROM told",
    "message_text": f"SELECT event_id, {TRANSFER_TEXT} FROM transfer",
    "transfer_notices": f"SELECT enrolment_facility_id AS facility_id, 'Patient transfer' AS subject, {TRANSFER_TEXT} "
    "FROM transfer",
    "lab_notices": "SELECT facility_id, 'Lab results transfer' AS subject, 'Lab results transferred: ' || "
    "coalesce(id_number, '') || ' ' || coalesce(full_name, '') AS text FROM late",
    "notify_target": f"SELECT facility_id, {TRANSFER_TEXT} FROM transfer",
    "static_notice": "SELECT * FROM static_messages",
    "message_rows": "SELECT facility_id, user_id, text FROM transfer_messages",
    "messageconversation": f"SELECT n AS messageconversationid, 'C' || {NUMBER} AS uid, {CLOCK} AS created, "
    f"{CLOCK} AS lastupdated, {CLOCK} AS lastmessage, 1 AS messagecount, 'Patient transfer' AS subject, "
    "'PRIVATE' AS messagetype, 'NONE' AS priority, 'NONE' AS status, cast(NULL AS bigint) AS user_assigned, "
    "cast(NULL AS bigint) AS lastsenderid, user_id AS userid FROM transfer_messages",
    "message": f"SELECT n AS messageid, 'M' || {NUMBER} AS uid, {CLOCK} AS created, {CLOCK} AS lastupdated, "
    "text AS messagetext, false AS internal, cast(NULL AS varchar) AS metadata, "
    "user_id AS userid FROM transfer_messages",
    "messageconversation_messages": "SELECT n AS messageconversationid, 1 AS sort_order, n AS messageid "
    "FROM transfer_messages",
    "usermessage": """
SELECT cast(n AS int) AS usermessageid, user_id AS userid, false AS isread, false AS isfollowup,
       substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-4' || substr(h, 14, 3) || '-a' || substr(h, 18, 3) || '-'
       || substr(h, 21, 12) AS usermessagekey
FROM (SELECT *, sha256('check/' || n) AS h FROM transfer_messages)""",
    "messageconversation_usermessages": "SELECT n AS messageconversationid, cast(n AS int) AS usermessageid "
    "FROM transfer_messages",
    "run_messages": """
SELECT text AS messagetext, user_id AS userid, count(*) AS messages
FROM (SELECT text, user_id FROM transfer_messages UNION ALL SELECT text, user_id FROM lab_messages
      UNION ALL SELECT text, user_id FROM static_messages)
GROUP BY text, user_id""",
    "run_events": f"SELECT event_id, enrolment_id, stage_id, facility_id, status, {FIELDS}, lab_only FROM ev4",
    "run_all": "SELECT stage_id, transfer_status, status, count(*) AS events FROM ev4 "
    "GROUP BY stage_id, transfer_status, status",
    "run_published": "SELECT stage_id, transfer_status, status, count(*) AS events FROM ev4 "
    "GROUP BY stage_id, transfer_status, status",
    "run_compacted": f"SELECT event_id, enrolment_id, stage_id, facility_id, status, {FIELDS}, lab_only FROM ev4",
    "run_twice": "SELECT stage_id, transfer_status, status, count(*) AS events FROM ev4 "
    "GROUP BY stage_id, transfer_status, status",
    "run_incremental": "SELECT stage_id, transfer_status, status, count(*) AS events FROM again_ev4 "
    "GROUP BY stage_id, transfer_status, status",
    "queue_laid_out": "SELECT event_id FROM waiting",
    "json_extract_laid_out": f"SELECT event_id, {FIELDS} FROM ev0",
    "match_hot_names": """
SELECT o_orderkey AS event_id, cast(1 AS bigint) AS n_0, n AS n_1
FROM orders JOIN customer c ON o_custkey = c_custkey
JOIN (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment) USING (c_mktsegment)""",
}


def _complete(final: str, ctes: dict[str, str]) -> str:
    """Put in front of a query the named queries it needs."""
    needed: set[str] = set()
    todo = [final]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        new = [n for n in ctes if n in words and n not in needed]
        needed.update(new)
        todo += [ctes[n] for n in new]
    parts = [f"{n} AS MATERIALIZED ({q})" for n, q in ctes.items() if n in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + final


LATE_VALUE, LATE_EVENT = "trackedentityinstanceid % 4 = 1", "(event_id % 5 = 2 AND stage_id = 101)"


def _two_runs() -> dict[str, str]:
    """The steps over the early rows, and as ``again_..`` once more over the table they leave and the late rows."""
    first = {
        **STEPS,
        "attr": f"{STEPS['attr']} WHERE NOT {LATE_VALUE}",
        "every": STEPS["ev0"],
        "ev0": f"SELECT * FROM every WHERE NOT {LATE_EVENT}",
        "new_owners": FINAL["owners_after"],
    }
    order = [n for n in first if n not in ("every", "ev0", "new_owners")]
    place = order.index("attr") + 1
    order = [*order[:place], "every", "ev0", *order[place:], "new_owners"]
    again = {**STEPS, "ev0": f"SELECT {_state('ev4')} UNION ALL SELECT {_state('every')} WHERE {LATE_EVENT}"}
    named = re.compile(r"\b(" + "|".join(STEPS) + r")\b")

    def second(name: str, sql: str) -> str:
        if name != "ev0":
            sql = named.sub(r"again_\1", sql.replace("trackedentityprogramowner", "new_owners"))
        return sql.replace("2000000000", "2100000000")

    return {n: first[n] for n in order} | {f"again_{n}": second(n, q) for n, q in again.items()}


def oracle_sql() -> dict[str, str]:
    plain = {**oracle_ctes(), **STEPS}
    steps = {"match_three_keys": {**oracle_ctes(district=True), **STEPS}, "run_incremental": {**oracle_ctes(), **_two_runs()}}
    return {k: _complete(q, steps.get(k, plain)) for k, q in FINAL.items()}
