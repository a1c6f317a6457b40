"""The input tables of a job, their readers and a check that every named column is there."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession

# Table names and the columns the jobs name.
EVENT_COLUMNS = (
    "programstageinstanceid",
    "uid",
    "programinstanceid",
    "programstageid",
    "executiondate",
    "organisationunitid",
    "status",
    "created",
    "lastupdated",
    "attributeoptioncomboid",
    "deleted",
    "storedby",
    "createdatclient",
    "lastupdatedatclient",
    "geometry",
    "lastsynchronized",
    "eventdatavalues",
    "assigneduserid",
    "createdbyuserinfo",
    "lastupdatedbyuserinfo",
)
REQUIRED = {
    "programstageinstance": EVENT_COLUMNS,
    "programstage": ("programstageid", "uid"),
    "program": ("programid", "uid"),
    "programinstance": (
        "programinstanceid",
        "trackedentityinstanceid",
        "programid",
        "organisationunitid",
        "status",
        "deleted",
    ),
    "trackedentityinstance": ("trackedentityinstanceid",),
    "trackedentityattribute": ("trackedentityattributeid", "uid"),
    "trackedentityattributevalue": ("trackedentityinstanceid", "trackedentityattributeid", "value"),
    "trackedentityprogramowner": ("trackedentityinstanceid", "programid", "organisationunitid"),
    "organisationunit": ("organisationunitid", "uid"),
    "userinfo": ("userinfoid",),
    "users": ("userid",),
    "usergroup": ("usergroupid", "uid"),
    "usergroupmembers": ("userid", "usergroupid"),
    "usermembership": ("userinfoid", "organisationunitid"),
}


@dataclass(frozen=True)
class Tables:
    programstageinstance: DataFrame
    programstage: DataFrame
    program: DataFrame
    programinstance: DataFrame
    trackedentityinstance: DataFrame
    trackedentityattribute: DataFrame
    trackedentityattributevalue: DataFrame
    trackedentityprogramowner: DataFrame
    organisationunit: DataFrame
    userinfo: DataFrame
    users: DataFrame
    usergroup: DataFrame
    usergroupmembers: DataFrame
    usermembership: DataFrame

    def __post_init__(self):
        for table, columns in REQUIRED.items():
            missing = set(columns) - set(getattr(self, table).columns)
            if missing:
                raise ValueError(f"{table}: missing columns {sorted(missing)}")

    @property
    def spark(self) -> SparkSession:
        return self.programstageinstance.sparkSession

    def but(self, **changed: DataFrame) -> Tables:
        return replace(self, **changed)

    @classmethod
    def from_parquet(cls, spark: SparkSession, folder: str) -> Tables:
        """Tables stored as ``<folder>/<table>``."""
        return cls(**{f.name: spark.read.parquet(f"{folder}/{f.name}") for f in fields(cls)})

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str) -> Tables:
        """Tables of a catalog database, whatever their format."""
        return cls(**{f.name: spark.table(f"{database}.{f.name}") for f in fields(cls)})
