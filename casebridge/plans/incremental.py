"""Runs over what has changed since the last one.

After a run every event that could be linked has been, and every event with an unknown value is flagged. What is still pending
(waiting or transferred events that found no enrolment, say) can only act again when something about one of its match values has
come: a new event with the value, an attribute value, or an enrolment, a record or an owner of a person who holds it. So the
queue of the next run is made of the events with such a touched value. Of a laid-out table only the partitions of the queues are
read for it; lab events, which may be any old ones, are read as in a full run, by stage.

The result is that of a full run. Requests for ownership are an exception the original job has made: without
``owner_latest_only`` they may flip the owner in every run, so all of them stay in the queue.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebridge.config import Run, TransferConfig
from casebridge.operators.link import attribute_lookup, event_fields, is_ownership_request, key_names
from casebridge.operators.staging import Staged, stage
from casebridge.plans.run import TransferRun
from casebridge.sources.layout import in_queues
from casebridge.sources.tables import Tables
from casebridge.sources.value_index import ValueIndex


@dataclass(frozen=True)
class Arrivals:
    """Rows of the tables that have come since the last run, were changed (as they were and as they are) or have gone.

    A table without any may be left out. Changes of the catalogues (stages, programs, attributes) need a full run.
    """

    programstageinstance: DataFrame | None = None
    trackedentityattributevalue: DataFrame | None = None
    trackedentityinstance: DataFrame | None = None
    programinstance: DataFrame | None = None
    trackedentityprogramowner: DataFrame | None = None
    organisationunit: DataFrame | None = None


def touched_values(t: Tables, cfg: TransferConfig, new: Arrivals, lookup: Staged) -> Staged:
    """``value``: the match values about which something has come, each once."""
    found: list[DataFrame] = []
    if new.programstageinstance is not None:
        keys = event_fields(new.programstageinstance, cfg).select(F.explode(F.array(*key_names(cfg))).alias("value"))
        found.append(keys)
    if new.trackedentityattributevalue is not None:
        found.append(attribute_lookup(t.but(trackedentityattributevalue=new.trackedentityattributevalue), cfg).select("value"))
    of_person = (new.trackedentityinstance, new.programinstance, new.trackedentityprogramowner)
    persons = [df.select(F.col("trackedentityinstanceid").alias("person_id")) for df in of_person if df is not None]
    if persons:
        found.append(lookup.df.join(reduce(DataFrame.unionAll, persons).distinct(), "person_id", "left_semi").select("value"))
    if not found:
        return stage(lookup.df.select("value").limit(0), "touched")
    return stage(reduce(DataFrame.unionAll, found).where("value IS NOT NULL").distinct(), "touched")


def pending_events(t: Tables, cfg: TransferConfig, new: Arrivals, lookup: Staged) -> DataFrame:
    """Events that can act in the next run, as rows of the event table; some others may be among them."""
    events = in_queues(t.programstageinstance)
    touched = touched_values(t, cfg, new, lookup).df
    rest, parts = event_fields(events, cfg), []
    for key in key_names(cfg):  # by one key after the other, so that no event comes twice
        on = rest[key] == touched.value
        parts.append(rest.join(touched, on, "left_semi"))
        rest = rest.join(touched, on, "left_anti")
    asking = is_ownership_request(replace(cfg, source_stage_only=False))
    if not cfg.owner_latest_only:
        parts.append(rest.where(asking))
    elif new.organisationunit is not None:
        places = new.organisationunit.select(F.col("uid").alias("place")).where("place IS NOT NULL").distinct()
        asked = rest.where(asking)
        parts.append(asked.join(places, asked.target_uid == places.place, "left_semi"))
    return reduce(DataFrame.unionByName, [p.select(events.columns) for p in parts])


def incremental_run(t: Tables, cfg: TransferConfig, run: Run, new: Arrivals, index: ValueIndex | None = None) -> TransferRun:
    """The next run over ``t``, which holds the published state and all that has come since, ``new``."""
    following = TransferRun(t, cfg, run, index)
    following.pending = pending_events(t, cfg, new, following.lookup)
    return following
