"""Small hand-made tables: a case states only what matters to it."""

from __future__ import annotations

import json
from datetime import datetime

import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from casebridge.config import FULL_NAME, ID_NUMBER, Run, TransferConfig
from casebridge.plans.run import TransferRun
from casebridge.sources.tables import Tables

CFG = TransferConfig()
RUN = Run("tiny", datetime(2026, 1, 1), event_base=1000)
SOURCE, TREATMENT, LAB, OTHER_STAGE = 101, 102, 103, 104
DAY = datetime(2025, 5, 1)

SCHEMAS = {
    "programstageinstance": "programstageinstanceid bigint, uid string, programinstanceid bigint, "
    "programstageid int, executiondate timestamp_ntz, organisationunitid int, status string, "
    "created timestamp_ntz, lastupdated timestamp_ntz, attributeoptioncomboid bigint, deleted boolean, "
    "storedby string, createdatclient timestamp_ntz, lastupdatedatclient timestamp_ntz, geometry binary, "
    "lastsynchronized timestamp_ntz, eventdatavalues string, assigneduserid bigint, createdbyuserinfo string, "
    "lastupdatedbyuserinfo string",
    "programstage": "programstageid int, uid string",
    "program": "programid int, uid string",
    "programinstance": "programinstanceid bigint, trackedentityinstanceid bigint, programid int, "
    "organisationunitid int, status string, deleted boolean",
    "trackedentityinstance": "trackedentityinstanceid bigint",
    "trackedentityattribute": "trackedentityattributeid int, uid string",
    "trackedentityattributevalue": "trackedentityinstanceid bigint, trackedentityattributeid int, value string",
    "trackedentityprogramowner": "trackedentityinstanceid bigint, programid int, organisationunitid int",
    "organisationunit": "organisationunitid int, uid string",
    "userinfo": "userinfoid bigint",
    "users": "userid bigint",
    "usergroup": "usergroupid int, uid string",
    "usergroupmembers": "userid bigint, usergroupid int",
    "usermembership": "userinfoid bigint, organisationunitid int",
}
DEFAULTS = {
    "programstage": [(SOURCE, "qZ43tA7bpir"), (TREATMENT, "tJ5SV8gfZaA"), (LAB, "edyRc6d5Bts"), (OTHER_STAGE, "x")],
    "program": [(1, "wfd9K4dQVDR"), (2, "otherProg01")],
    "trackedentityattribute": [(11, ID_NUMBER.attribute_uid), (12, FULL_NAME.attribute_uid)],
    "organisationunit": [(1, "north"), (2, "south"), (3, "east")],
    "usergroup": [(1, "phS5ScyDEYj"), (2, "otherGroup1")],
}


def document(
    id_number=None, name=None, request="EVENT_TRANSFER", state="NOTTRANSFERRED", lab=None, target=None, **more
):
    values = {
        CFG.match_keys[0].event_field: id_number,
        CFG.match_keys[1].event_field: name,
        CFG.request_field: request,
        CFG.status_field: state,
        CFG.lab_field: lab,
        CFG.target_facility_field: target,
    }
    return json.dumps({**{k: {"value": v} for k, v in values.items() if v is not None}, **more})


def event(event_id, doc, stage=SOURCE, enrolment=None, status="ACTIVE", facility=1, date=DAY, deleted=False):
    return {
        "programstageinstanceid": event_id,
        "uid": f"uid{event_id}",
        "programinstanceid": enrolment,
        "programstageid": stage,
        "executiondate": date,
        "organisationunitid": facility,
        "status": status,
        "deleted": deleted,
        "eventdatavalues": doc,
    }


class World:
    """Persons with their values, enrolments and owners."""

    def __init__(self):
        self.rows = {name: list(DEFAULTS.get(name, [])) for name in SCHEMAS}

    def person(
        self, person, id_number=None, name=None, program=1, facility=1, status="ACTIVE", deleted=False, enrol=True
    ):
        self.rows["trackedentityinstance"].append((person,))
        if id_number is not None:
            self.rows["trackedentityattributevalue"].append((person, 11, id_number))
        if name is not None:
            self.rows["trackedentityattributevalue"].append((person, 12, name))
        if enrol:
            self.enrol(person * 10, person, program, facility, status, deleted)
        self.own(person, program, facility)
        return self

    def enrol(self, enrolment, person, program=1, facility=1, status="ACTIVE", deleted=False):
        self.rows["programinstance"].append((enrolment, person, program, facility, status, deleted))
        return self

    def own(self, person, program, facility):
        self.rows["trackedentityprogramowner"].append((person, program, facility))
        return self

    def event(self, *args, **kwargs):
        self.rows["programstageinstance"].append(event(*args, **kwargs))
        return self

    def user(self, user, facility=1, group=1, times=1, account=True):
        self.rows["userinfo"].append((user,))
        if account:
            self.rows["users"].append((user,))
        self.rows["usergroupmembers"].append((user, group))
        self.rows["usermembership"] += [(user, facility)] * times
        return self

    def tables(self, spark) -> Tables:
        made = {}
        for name, schema in SCHEMAS.items():
            kinds = StructType.fromDDL(schema)
            rows = [r if isinstance(r, dict) else dict(zip(kinds.names, r)) for r in self.rows[name]]
            # From Arrow it is a local relation, which needs no job to read.
            made[name] = spark.createDataFrame(pa.Table.from_pylist(rows, to_arrow_schema(kinds)), kinds)
        return Tables(**made)

    def run(self, spark, cfg=CFG, run=RUN) -> TransferRun:
        return TransferRun(self.tables(spark), cfg, run)


def states(r: TransferRun) -> dict:
    """event id -> (stage, status, fields) after a run."""
    return {
        row["programstageinstanceid"]: (row["programstageid"], row["status"], json.loads(row["eventdatavalues"]))
        for row in r.events.collect()
    }


def value(doc: dict, field: str):
    return doc.get(field, {}).get("value")


def transfer_status(doc: dict):
    return value(doc, CFG.status_field)
