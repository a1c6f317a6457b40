"""Move a person to another facility on a permanent transfer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebridge.config import TransferConfig
from casebridge.operators.link import all_matched, is_ownership_request, join_by_first_key, known_holders, program_id
from casebridge.operators.spread import profile, spread_join
from casebridge.operators.staging import Staged, stage
from casebridge.sources.tables import Tables


def stage_owned(t: Tables, cfg: TransferConfig, lookup: Staged) -> Staged:
    """First key value -> person and the facility that owns the person in the program."""
    owners = t.trackedentityprogramowner.where(F.col("programid") == program_id(t, cfg)).select(
        F.col("trackedentityinstanceid").alias("person_id"), F.col("organisationunitid").alias("owner_facility_id")
    )
    found = spread_join(
        known_holders(t, cfg, lookup),
        owners,
        "person_id",
        hot_rows=cfg.hot_key_rows,
        left_profile=lookup.profiles["person_id"],
        left_split=("key_0",),
    )
    return stage(found, "owned", ("key_0",))


def requests(t: Tables, cfg: TransferConfig, matched: Staged, owned: Staged) -> DataFrame:
    """Permanent transfers with their person, target facility and present owner."""
    asking = matched.df.where(is_ownership_request(cfg) & all_matched(cfg))
    facilities = t.organisationunit.select(
        F.col("uid").alias("target_uid"), F.col("organisationunitid").alias("target_facility_id")
    )
    located = spread_join(
        asking,
        facilities,
        "target_uid",
        hot_rows=cfg.hot_key_rows,
        left_profile=matched.profiles.get("target_uid"),
        left_split=("event_id",),
    )
    return join_by_first_key(located, matched, owned, cfg).select(
        "event_id", "executed", "person_id", "target_facility_id", "owner_facility_id", "copies"
    )


def differs():
    return F.col("owner_facility_id") != F.col("target_facility_id")


def ownership_candidates(t: Tables, cfg: TransferConfig, matched: Staged, owned: Staged) -> DataFrame:
    """Requests whose target is not the present owner."""
    return requests(t, cfg, matched, owned).where(differs())


def update_ownership(
    t: Tables, cfg: TransferConfig, matched: Staged, owned: Staged, lookup: Staged
) -> DataFrame:
    """Change set (person_id, program_id, new_facility_id).

    The latest request of a person wins, then the largest event id. The name only has to exist for the
    person. All ownership rows of the person change, unless ``owner_program_only``.
    """
    asked = requests(t, cfg, matched, owned)
    if not cfg.owner_latest_only:
        asked = asked.where(differs())
    last = F.max(F.struct("executed", "event_id", "target_facility_id", "owner_facility_id")).alias("last")
    picks = asked.groupBy("person_id").agg(last).select("person_id", "last.*")
    if cfg.owner_latest_only:
        picks = picks.where(differs())
    named = lookup.df.where(F.col("attribute_uid") == cfg.match_keys[1].attribute_uid).select("person_id").distinct()
    picks = picks.join(named, "person_id", "left_semi").select("person_id", "target_facility_id")
    owners = t.trackedentityprogramowner.select(
        F.col("trackedentityinstanceid").alias("person_id"), F.col("programid").alias("program_id")
    )
    if cfg.owner_program_only:
        owners = owners.where(F.col("program_id") == program_id(t, cfg))
    return spread_join(
        owners,
        picks,
        "person_id",
        hot_rows=cfg.hot_key_rows,
        left_profile=profile(owners, "person_id"),
        left_split=("program_id",),
    ).select("person_id", "program_id", F.col("target_facility_id").alias("new_facility_id"))
