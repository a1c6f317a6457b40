"""Runs over what has changed: the same result as a full run, from the touched events alone."""

from dataclasses import fields, replace
from datetime import datetime

import pytest
from compare import connect, difference
from pyspark.sql import functions as F
from tiny import CFG, World, document

from casebridge.config import PERMANENT, Run
from casebridge.operators.notify import Messages
from casebridge.plans import oracle
from casebridge.plans.incremental import Arrivals, incremental_run
from casebridge.plans.queries import QUERIES
from casebridge.plans.run import TransferRun, start_run
from casebridge.sources import fixtures
from casebridge.sources.layout import lay_out, plain
from casebridge.sources.publish import compact, latest, newest, publish_run

SF = "/root/testdata/sf0.001"
RUN = Run("first", datetime(2026, 1, 1), event_base=2_000_000_000)
LATER = Run("second", datetime(2026, 1, 2), event_base=3_000_000_000)


def same(a, b):
    columns = [c for c in a.columns if c != "geometry"]
    assert sorted(a.columns) == sorted(b.columns)
    assert sorted(map(str, a.select(columns).collect())) == sorted(map(str, b.select(columns).collect()))


def test_an_incremental_run_is_the_full_run(spark, tmp_path):
    """Events, values and enrolments come. (``run_incremental`` does it with the default rules.)"""
    t, out, cfg = fixtures.load(spark, SF), str(tmp_path), replace(CFG, owner_latest_only=True)
    late = F.col("programstageinstanceid") % 11 == 3
    person = F.col("trackedentityinstanceid")
    new = Arrivals(
        programstageinstance=t.programstageinstance.where(late & (F.col("programstageid") == 101)),
        trackedentityattributevalue=t.trackedentityattributevalue.where(person % 9 == 1),
        programinstance=t.programinstance.where(person % 7 == 2),
    )
    early = t.but(
        programstageinstance=t.programstageinstance.where(~(late & (F.col("programstageid") == 101))),
        trackedentityattributevalue=t.trackedentityattributevalue.where(person % 9 != 1),
        programinstance=t.programinstance.where(person % 7 != 2),
    )
    publish_run(early, cfg, RUN, out)
    compact(early, out, cfg)
    published = latest(early, out, cfg=cfg)
    now = published.but(
        programstageinstance=published.programstageinstance.unionByName(lay_out(new.programstageinstance, cfg), allowMissingColumns=True),
        trackedentityattributevalue=t.trackedentityattributevalue,
        programinstance=t.programinstance,
    )
    full, part = TransferRun(now, cfg, LATER), incremental_run(now, cfg, LATER, new)
    same(full.changed_events, part.changed_events)
    same(full.owner_changes, part.owner_changes)
    assert full.inserts.rows == part.inserts.rows > 0
    for f in fields(Messages):
        if f.name in ("message", "usermessage"):
            same(getattr(full.messages, f.name), getattr(part.messages, f.name))
    waiting = part.queue.df.where("at_source AND transfer_status = 'NOTTRANSFERRED'").count()
    every = full.queue.df.where("at_source AND transfer_status = 'NOTTRANSFERRED'").count()
    assert waiting < every and part.queue.rows < 0.8 * full.queue.rows


QUIET = replace(CFG, static_notice=False, owner_latest_only=True)


def waiting_world():
    """Event 5 waits for an enrolment, 6 has been flagged, 7 asks for a facility that is not there yet."""
    w = World().person(1, "N1", "Ann", enrol=False).person(2, "N2", "Bob").user(7)
    w.event(5, document("N1", "Ann")).event(6, document("N9", "Zoe", state="No Match"))
    return w.event(7, document("N2", "Bob", request=PERMANENT, state="AUTOMATICALLY", target="west"), status="COMPLETED")


def later(w):
    made = World()
    made.rows = {k: list(v) for k, v in w.rows.items()}
    return made


@pytest.mark.parametrize(
    ("come", "table", "queue"),
    [
        (lambda w: w, None, []),
        (lambda w: w.enrol(19, 1), "programinstance", [5]),
        (lambda w: w.event(8, document("N1", "Ann")), "programstageinstance", [5, 8]),
        (lambda w: w.person(3, "N1", "Cy"), "trackedentityattributevalue", [5]),
        (lambda w: w.own(1, 1, 2), "trackedentityprogramowner", [5]),
        (lambda w: w.rows["organisationunit"].append((9, "west")) or w, "organisationunit", [7]),
        (lambda w: w.person(4, "N4", "Ann"), "trackedentityattributevalue", [5]),
        (lambda w: w.person(4, "N4", "Dee"), "trackedentityinstance", []),
    ],
)
def test_what_comes_decides_what_is_looked_at(spark, come, table, queue):
    w = waiting_world()
    before, now = w.tables(spark), come(later(w)).tables(spark)
    new = {table: getattr(now, table).exceptAll(getattr(before, table))} if table else {}
    part = incremental_run(now, QUIET, LATER, Arrivals(**new))
    assert sorted(r["event_id"] for r in part.queue.df.collect()) == queue
    if table in ("programinstance", "organisationunit"):
        full = TransferRun(now, QUIET, LATER)
        same(full.changed_events, part.changed_events)
        same(full.owner_changes, part.owner_changes)


def test_a_changed_event_is_looked_at_once(spark):
    """An event of the queue both of whose values are touched; its rows before and after the change are given."""
    w = waiting_world()
    t = later(w).enrol(19, 1).tables(spark)
    event = t.programstageinstance.where("programstageinstanceid = 5")
    part = incremental_run(t, QUIET, LATER, Arrivals(event.unionAll(event), t.trackedentityattributevalue, programinstance=t.programinstance))
    assert [r["event_id"] for r in part.queue.df.where("event_id = 5").collect()] == [5]
    assert part.inserts.rows == 2


def test_the_scan_of_the_pending_events_is_pruned(spark, tmp_path):
    w = waiting_world()
    t, out = w.tables(spark), str(tmp_path)
    publish_run(t, QUIET, replace(RUN, event_base=100), out)
    compact(t, out, QUIET)
    now = latest(t, out, cfg=QUIET)
    part = incremental_run(now, QUIET, LATER, Arrivals(trackedentityattributevalue=t.trackedentityattributevalue))
    plan = part.pending._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") > 1 and "from_json" not in plan
    assert all("queuepart" in line.split("PartitionFilters:")[1][:80] for line in plan.splitlines() if "FileScan" in line and "queuepart" in line)
    assert start_run(now, "x", datetime(2026, 1, 2), after=newest(spark, out)).parent == "compact-2"
    assert not any(c.startswith("value_") for c in plain(part.pending).columns)


def test_query_against_sql(spark):
    assert difference(QUERIES["run_incremental"](spark, SF), connect(SF), oracle.oracle_sql()["run_incremental"]) == ""
