"""Ownership on its own makes only the merges and copies that may ask for a new owner, and finds what a whole run finds."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from tiny import CFG, LAB, World, document

from casebridge.config import PERMANENT
from casebridge.sources import fixtures

CONFIGS = {
    "plain": CFG,
    "own_copy": replace(CFG, lab_target="own_copy"),
    "lab field only": replace(CFG, merge_fields=(CFG.lab_field,)),
    "request field": replace(CFG, merge_fields=(CFG.request_field, CFG.status_field, CFG.target_facility_field)),
    "reset_status_on_copy": replace(CFG, reset_status_on_copy=True),
    "source_stage_only": replace(CFG, source_stage_only=True),
}


def world():
    """Three persons, each with an old lab event, a waiting event to copy and a late result; the first two ask for a new owner."""
    w = World()
    for person, request, target in ((1, PERMANENT, "south"), (2, PERMANENT, "east"), (3, "EVENT_TRANSFER", "south")):
        who = {"id_number": f"TB-{person}", "name": f"P{person}"}
        w.person(person, *who.values())
        old = document(**who, request=PERMANENT, state="AUTOMATICALLY", target="south")
        w.event(person * 100, old, LAB, person * 10, "COMPLETED")
        w.event(person * 100 + 1, document(**who, request=PERMANENT, lab="" if person == 2 else None, target="east"))
        w.event(person * 100 + 2, document(**who, request=request, state="AUTOMATICALLY", lab="pos", target=target))
    return w


def found(r):
    columns = ("event_id", "person_id", "target_facility_id", "owner_facility_id", "copies")
    asked = sorted(tuple(row[c] for c in columns) for row in r.ownership_candidates.collect())
    return asked, sorted(map(tuple, r.ownership.collect()))


@pytest.mark.parametrize("cfg", CONFIGS.values(), ids=CONFIGS)
def test_ownership_alone_finds_what_a_whole_run_finds(spark, cfg):
    alone, whole = world().run(spark, cfg), world().run(spark, cfg)
    whole.result.tables.programstageinstance.count()
    asked, moved = found(alone)
    assert (asked, moved) == found(whole)
    assert asked and {p for p, _, _ in moved} >= {1}
    made = {"inserts", "merged_copies", "merged_rows", "rows_after_lab"} & set(vars(alone))
    assert made <= ({"inserts", "merged_copies"} if cfg.reset_status_on_copy else set())
    assert alone.after_lab.df.where(F.col("request") != PERMANENT).isEmpty()


def test_copies_that_no_asking_result_reaches_are_not_made(spark):
    r = world().run(spark)
    reached = {row["event_id"] for row in r.asking_copies.collect()}
    all_copies = {row["event_id"] for row in r.merged_copies.collect()}
    assert reached < all_copies and len(reached) == 2


def test_orders_are_dealt_before_documents_are_made(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(fixtures, "stage", lambda df, name, real=fixtures.stage: seen.append(df) or real(df, name))
    t = fixtures.load(spark, "/root/testdata/sf0.001/")
    tree = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" in tree and "Repartition" not in tree[: tree.index("Join")]
    assert len(t.programstageinstance.inputFiles()) >= spark.sparkContext.defaultParallelism
