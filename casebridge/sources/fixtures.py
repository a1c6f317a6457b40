"""Input tables derived from the driver's customer, orders, nation and supplier tables (FIXTURES.md).

The rules are SQL text that runs unchanged in Spark and in the oracle; ``{orders}`` and the like stand
for the input. Remainders in them shape the data (who lacks a name, which event has no result); every
input row is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebridge.operators.staging import stage
from casebridge.sources.tables import EVENT_COLUMNS, Tables

INPUTS = ("customer", "orders", "nation", "supplier")

# Parts of a source event's document: field, value, and when the field is left out.
_PARTS = (
    (
        "XupJDPkqWoL",
        "CASE WHEN o_orderkey % 8 = 5 THEN 'TB-X' || cast(o_orderkey AS varchar(20)) "
        "ELSE 'TB-' || cast(o_custkey AS varchar(20)) END",
        "o_orderkey % 8 = 6",
    ),
    (
        "bvuRnNr6INS",
        "CASE WHEN o_orderkey % 9 = 4 THEN 'Unknown ' || cast(o_orderkey AS varchar(20)) ELSE c_name END",
        None,
    ),
    (
        "MVQOgAxvNWh",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN 'PERMANENT_TRANSFER' "
        "WHEN o_orderpriority = '5-LOW' THEN 'NONE' ELSE 'EVENT_TRANSFER' END",
        None,
    ),
    (
        "WTz4HSqoE5E",
        "CASE WHEN o_orderkey % 12 = 1 THEN '' ELSE 'LAB-' || cast(o_orderkey % 4 AS varchar(20)) END",
        "o_orderkey % 3 = 0",
    ),
    ("JpvpfVIjK7x", "'NATION_' || cast(o_orderkey % 25 AS varchar(20))", None),
    ("iup9aING8xC", "CASE WHEN o_orderstatus = 'O' THEN 'AUTOMATICALLY' ELSE 'NOTTRANSFERRED' END", None),
)
# Third key, for the job set up with a district number too.
_DISTRICT = ("eCy7sKTrwnA", "'DT-' || cast(o_custkey AS varchar(20))", "o_orderkey % 5 = 2")


def _document(parts) -> str:
    texts = []
    for i, (field, value, absent) in enumerate(parts):
        text = f"""'{"," if i else ""}"{field}":{{{{"value":"' || ({value}) || '"}}}}'"""
        if absent:
            # The first part may be absent, so its comma goes with it.
            text = f"CASE WHEN {absent} THEN '' ELSE {text} END"
        texts.append(text)
    # A document whose first field is absent starts with a comma: take the text after it.
    body = " || ".join(texts)
    return f"""'{{{{' || CASE WHEN {parts[0][2]} THEN substr({body}, 2) ELSE {body} END || '}}}}'"""


def event_rule(district: bool = False) -> str:
    return f"""
SELECT o_orderkey AS programstageinstanceid, 'EV' || cast(o_orderkey AS varchar(20)) AS uid,
       cast(NULL AS bigint) AS programinstanceid, 101 AS programstageid, o_orderdate AS executiondate,
       cast(o_orderkey % 25 AS int) AS organisationunitid,
       CASE WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 0 THEN 'COMPLETED' ELSE 'ACTIVE' END AS status,
       {_document([*_PARTS, _DISTRICT] if district else _PARTS)} AS eventdatavalues
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
UNION ALL
SELECT 1000000000 + c_custkey, 'LB' || cast(c_custkey AS varchar(20)), c_custkey * 10, 103,
       cast('2000-01-01' AS {{ts}}), c_nationkey, 'COMPLETED',
       '{{{{"labOnly0001":{{{{"value":"keep"}}}},"WTz4HSqoE5E":{{{{"value":"OLD"}}}}}}}}'
FROM {{customer}} WHERE c_custkey % 2 = 0"""


VALUE_RULE = """
SELECT c_custkey AS trackedentityinstanceid, 11 AS trackedentityattributeid,
       'TB-' || cast(c_custkey AS varchar(20)) AS value
FROM {customer} WHERE c_custkey % 10 <> 7
UNION ALL
SELECT c_custkey, 12, CASE WHEN c_custkey % 50 = 9
       THEN 'Customer#' || lpad(cast(c_custkey - 4 AS varchar(20)), 9, '0') ELSE c_name END
FROM {customer} WHERE c_custkey % 10 <> 8"""

DISTRICT_VALUE_RULE = """
UNION ALL
SELECT c_custkey, 13, 'DT-' || cast(c_custkey AS varchar(20)) FROM {customer} WHERE c_custkey % 4 <> 3"""

RULES = {
    "programstage": "SELECT * FROM (VALUES (101, 'qZ43tA7bpir'), (102, 'tJ5SV8gfZaA'), (103, 'edyRc6d5Bts')) "
    "AS s(programstageid, uid)",
    "program": "SELECT * FROM (VALUES (1, 'wfd9K4dQVDR'), (2, 'otherProg01')) AS p(programid, uid)",
    "trackedentityattribute": "SELECT * FROM (VALUES (11, 'ZkNZOxS24k7'), (12, 'jWjSY7cktaQ'), "
    "(13, 'fPlDBVvpEJR')) AS a(trackedentityattributeid, uid)",
    "organisationunit": "SELECT n_nationkey AS organisationunitid, n_name AS uid FROM {nation}",
    "trackedentityinstance": "SELECT c_custkey AS trackedentityinstanceid FROM {customer}",
    "programinstance": """
SELECT c_custkey * 10 AS programinstanceid, c_custkey AS trackedentityinstanceid,
       CASE WHEN c_custkey % 17 = 4 THEN 2 ELSE 1 END AS programid, c_nationkey AS organisationunitid,
       CASE WHEN c_custkey % 11 = 3 THEN 'COMPLETED' ELSE 'ACTIVE' END AS status, c_custkey % 13 = 5 AS deleted
FROM {customer}
UNION ALL
SELECT c_custkey * 10 + 1, c_custkey, 2, c_nationkey, 'ACTIVE', false FROM {customer} WHERE c_custkey % 6 = 0""",
    "trackedentityprogramowner": """
SELECT c_custkey AS trackedentityinstanceid, 1 AS programid, c_nationkey AS organisationunitid FROM {customer}
UNION ALL
SELECT c_custkey, 2, c_nationkey FROM {customer} WHERE c_custkey % 6 = 0""",
    "userinfo": "SELECT s_suppkey AS userinfoid FROM {supplier}",
    "users": "SELECT s_suppkey AS userid FROM {supplier} WHERE s_suppkey % 7 <> 3",
    "usergroup": "SELECT * FROM (VALUES (1, 'phS5ScyDEYj'), (2, 'otherGroup1')) AS g(usergroupid, uid)",
    "usergroupmembers": "SELECT s_suppkey AS userid, 1 AS usergroupid FROM {supplier} WHERE s_suppkey % 2 = 0 "
    "UNION ALL SELECT s_suppkey, 2 FROM {supplier}",
    "usermembership": "SELECT s_suppkey AS userinfoid, s_nationkey AS organisationunitid FROM {supplier}",
}

# What events are derived from.
_ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
# Event columns the rules do not derive.
_ABSENT = {
    "created": "timestamp_ntz",
    "lastupdated": "timestamp_ntz",
    "attributeoptioncomboid": "bigint",
    "deleted": "boolean",
    "storedby": "string",
    "createdatclient": "timestamp_ntz",
    "lastupdatedatclient": "timestamp_ntz",
    "geometry": "binary",
    "lastsynchronized": "timestamp_ntz",
    "assigneduserid": "bigint",
    "createdbyuserinfo": "string",
    "lastupdatedbyuserinfo": "string",
}

_events: dict[tuple, DataFrame] = {}


def load(spark: SparkSession, sf_dir: str, *, district: bool = False) -> Tables:
    """The derived tables. The event table, which takes a join, is written once per application."""
    inputs = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in INPUTS}

    def derive(rule: str, **more) -> DataFrame:
        used = {n: df for n, df in inputs.items() if f"{{{n}}}" in rule}
        for n, text in more.items():
            rule = rule.replace(f"{{{n}}}", text)
        return spark.sql(rule, **used)

    # As many files of events as cores, as a table of any size would have: orders are dealt before documents are made of them.
    orders = inputs["orders"].select(*_ORDER_COLUMNS)
    inputs["orders"] = orders.repartition(spark.sparkContext.defaultParallelism)
    key = (spark.sparkContext.applicationId, sf_dir, district)
    if key not in _events:
        kind = inputs["orders"].schema["o_orderdate"].dataType.simpleString()
        events = derive(event_rule(district), ts=kind)
        for column, absent in _ABSENT.items():
            events = events.withColumn(column, F.lit(None).cast(absent))
        _events[key] = stage(events.select(*EVENT_COLUMNS), "programstageinstance").df
    tables = {name: derive(rule) for name, rule in RULES.items()}
    values = derive(VALUE_RULE + (DISTRICT_VALUE_RULE if district else ""))
    return Tables(programstageinstance=_events[key], trackedentityattributevalue=values, **tables)


def oracle_ctes(district: bool = False) -> dict[str, str]:
    """The same rules as named queries over the tables of the oracle."""
    names = {n: n for n in INPUTS}
    rules = {
        **RULES,
        "trackedentityattributevalue": VALUE_RULE + (DISTRICT_VALUE_RULE if district else ""),
        "programstageinstance": event_rule(district),
    }
    return {name: rule.format(ts="timestamp", **names) for name, rule in rules.items()}
