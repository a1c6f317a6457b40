"""Whole runs: repeated, published, interrupted, and on tables where one value holds a third of the rows."""

from collections import Counter
from dataclasses import fields, replace
from datetime import datetime

import duckdb
import pytest
from compare import rows
from pyspark.sql import functions as F
from tiny import CFG

from casebridge.config import Run
from casebridge.operators.changes import apply_event_changes, merge_into
from casebridge.operators.link import event_fields, field_names
from casebridge.operators.staging import stage
from casebridge.plans import jobs
from casebridge.plans.oracle import FINAL, STEPS, _complete
from casebridge.plans.run import TransferRun, end_state, start_run
from casebridge.sources import fixtures
from casebridge.sources.publish import latest, newest, publish, published_messages
from casebridge.sources.tables import Tables

SF = "/root/testdata/sf0.001"
RUN = Run("first", datetime(2026, 1, 1), event_base=2_000_000_000)


@pytest.fixture(scope="module")
def tables(spark):
    return fixtures.load(spark, SF)


@pytest.fixture(scope="module")
def first(tables):
    return TransferRun(tables, CFG, RUN)


def state(t):
    return {tuple(r)[:3]: r["events"] for r in end_state(t, CFG).collect()}


def test_rows_outside_the_change_set_stay(first):
    base = first.t.programstageinstance
    changed = first.event_changes.select(F.col("event_id").alias("programstageinstanceid"))
    kept = base.join(changed, "programstageinstanceid", "left_anti")
    assert kept.exceptAll(first.events).isEmpty()
    assert first.events.count() == base.count() + 2 * 306
    assert first.event_changes.groupBy("event_id").count().where("count > 1").isEmpty()


def test_each_transfer_has_one_copy_of_each_kind(first):
    copies = first.inserts.df.groupBy("rank").agg(F.collect_set("role").alias("roles"), F.count("*").alias("n"))
    assert copies.count() == 306 and copies.where("n <> 2 OR size(roles) <> 2").isEmpty()
    ids = first.events.select("programstageinstanceid")
    assert ids.distinct().count() == ids.count()


def test_a_second_run_copies_nothing(spark, tables, first, tmp_path):
    publish(first.result, RUN, str(tmp_path))
    base = newest(spark, str(tmp_path))
    t = latest(tables, str(tmp_path), base)
    again = TransferRun(t, CFG, start_run(t, "second", datetime(2026, 1, 2), after=base))
    assert again.run.event_base == 2_000_000_000 + 612
    assert again.inserts.rows == 0 and again.marks.isEmpty() and again.flags.isEmpty()
    assert state(again.result.tables) == state(t)
    # Without ``owner_latest_only`` ownership still flips.
    assert again.ownership_candidates.select("person_id").distinct().count() == 23


def test_the_run_is_its_jobs_one_after_the_other(first):
    """Each job on the table the one before leaves, as separate statements would."""

    def same(a, b):
        assert a.count() > 0 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()

    def changed(t, changes, name):
        for column in ("new_status", "new_transfer_status", "new_document"):
            if column not in changes.columns:
                changes = changes.withColumn(column, F.lit(None).cast("string"))
        events = apply_event_changes(t.programstageinstance, changes, CFG.status_field)
        return t.but(programstageinstance=stage(events, name).df)

    t = first.t
    made = jobs.transfer_events(t, CFG, RUN)
    copied = t.but(programstageinstance=stage(t.programstageinstance.unionByName(made.inserts), "copied").df)
    marked = changed(copied, jobs.mark_transferred(copied, CFG), "marked")
    late = jobs.transfer_lab(marked, CFG)
    completed = changed(marked, late.completed, "completed")
    merged = changed(completed, late.merged.select("event_id", "new_document"), "merged")
    same(jobs.update_ownership(merged, CFG), first.ownership)
    same(late.notices, first.notices.where("call = 3"))
    last = changed(merged, jobs.triage_events(merged, CFG), "last")
    plain = [c for c in last.programstageinstance.columns if c != "eventdatavalues"]
    ours, theirs = event_fields(first.events, CFG), event_fields(last.programstageinstance, CFG)
    same(ours.select(*plain, *field_names(CFG)), theirs.select(*plain, *field_names(CFG)))
    assert jobs.link_events(t, CFG, require_program=True).count() < jobs.link_events(t, CFG).count()


def test_publish(spark, tables, first, tmp_path):
    out = str(tmp_path)
    assert latest(tables, out) is tables and published_messages(spark, out) is None
    publish(first.result, RUN, out)
    t = latest(tables, out)
    assert state(t) == state(first.result.tables) and sum(state(t).values()) == 1575 + 612
    told = published_messages(spark, out)
    counts = {getattr(told, f.name).count() for f in fields(told)}
    assert counts == {52 + 13}
    base = newest(spark, out)
    second = start_run(t, "second", datetime(2026, 1, 2), after=base)
    assert second == start_run(t, "second", datetime(2026, 1, 2), told, after=base)
    assert (second.conversation_base, second.message_base, second.usermessage_base) == (65, 65, 65)
    assert start_run(tables, "first", datetime(2026, 1, 2), told).message_base == 65
    with pytest.raises(ValueError, match="is published"):
        publish(first.result, RUN, out)


def test_the_chain_of_runs_decides_not_their_clocks(spark, tables, first, tmp_path):
    out = str(tmp_path)
    small = replace(first.result, messages=replace(first.messages, **{f.name: getattr(first.messages, f.name).limit(0) for f in fields(first.messages)}))
    publish(small, replace(RUN, run_id="a", run_ts=datetime(2026, 1, 2)), out)
    with pytest.raises(ValueError, match="computed from None"):
        publish(small, replace(RUN, run_id="stale"), out)
    publish(small, replace(RUN, run_id="b", run_ts=datetime(2026, 1, 1), parent="a", message_base=7), out)
    assert (newest(spark, out).run_id, newest(spark, out).step, newest(spark, out).message_base) == ("b", 2, 7)
    with pytest.raises(ValueError, match="computed from a"):
        publish(small, replace(RUN, run_id="c", parent="a"), out)
    assert any("/runs/b/" in f for f in latest(tables, out).programstageinstance.inputFiles())


def test_a_failure_before_the_marker_leaves_the_old_tables(spark, tables, first, tmp_path):
    out = str(tmp_path)
    failing = first.messages.usermessage.withColumn("userid", F.raise_error(F.lit("disk full")).cast("bigint"))
    broken = replace(first.result, messages=replace(first.messages, usermessage=failing))
    with pytest.raises(Exception, match="disk full"):
        publish(broken, RUN, out)
    assert latest(tables, out) is tables
    publish(first.result, RUN, out)
    assert state(latest(tables, out)) == state(first.result.tables)


def test_merge_into_needs_a_format_that_supports_it(spark, first):
    spark.createDataFrame([(1, "a")], "id bigint, status string").write.mode("overwrite").saveAsTable("plain_events")
    changes = spark.createDataFrame([(1, "b")], "id bigint, new_status string")
    try:
        with pytest.raises(Exception, match="UNSUPPORTED_FEATURE"):
            merge_into("plain_events", changes, "id", {"status": "new_status"})
    finally:
        spark.sql("DROP TABLE plain_events")


# ---- hot values ----


def skewed(t: Tables) -> Tables:
    """A third of the events share one number and one name, held by several persons; one facility is busy."""
    hot = F.col("programstageinstanceid") % 3 == 0
    source = F.col("programstageid") == 101
    # Documents of these events name the hot person; a sixth of all events has no number.
    text = F.regexp_replace("eventdatavalues", '"TB-[^"]*"', '"HOT"')
    text = F.regexp_replace(text, '"bvuRnNr6INS":\\{"value":"[^"]*"', '"bvuRnNr6INS":{"value":"Hot Name"')
    text = F.regexp_replace(text, '"NATION_[^"]*"', '"NATION_3"')
    text = F.when(hot & source, text).otherwise(F.col("eventdatavalues"))
    events = t.programstageinstance.withColumn("eventdatavalues", text)
    shared = (F.col("trackedentityinstanceid") < 6) & (F.col("trackedentityattributeid") == 11)
    named = (F.col("trackedentityinstanceid") < 5) & (F.col("trackedentityattributeid") == 12)
    value = F.when(shared, "HOT").when(named, "Hot Name").otherwise(F.col("value"))
    # Person 2 has many enrolments and many old lab events.
    enrolments = t.programinstance.unionByName(
        t.trackedentityinstance.select(
            (F.col("trackedentityinstanceid") * 10 + 5).alias("programinstanceid"),
            F.lit(2).cast("bigint").alias("trackedentityinstanceid"),
            F.lit(1).alias("programid"),
            F.lit(3).alias("organisationunitid"),
            F.lit("ACTIVE").alias("status"),
            F.lit(False).alias("deleted"),
        ).where("trackedentityinstanceid < 4 OR programinstanceid < 90")
    )
    old = F.col("programstageid") == 103
    events = events.withColumn("programinstanceid", F.when(old, F.lit(20)).otherwise(F.col("programinstanceid")))
    members = t.usermembership.unionByName(t.usermembership.withColumn("organisationunitid", F.lit(3)))
    return t.but(
        programstageinstance=events,
        trackedentityattributevalue=t.trackedentityattributevalue.withColumn("value", value),
        programinstance=enrolments,
        usermembership=members,
    )


def test_hot_values_give_the_plain_result(spark, tables):
    t = skewed(tables)
    r = TransferRun(t, replace(CFG, hot_key_rows=1, copy_chunk=2), RUN)
    con = duckdb.connect()
    for f in fields(Tables):
        df = getattr(t, f.name)
        if f.name == "programstageinstance":
            df = df.drop("geometry")
        con.register(f.name, df.toArrow())

    def expect(sql: str, df) -> None:
        found = con.execute(_complete(sql, STEPS))
        names = [d[0] for d in found.description]
        assert sorted(df.columns) == sorted(names)
        ours = rows(df.columns, map(tuple, df.collect()))
        theirs = rows(names, found.fetchall())
        assert sum(theirs.values()) > 0 and ours == theirs

    # The job did cut: the hot values were seen.
    assert r.matched.profiles["key_0"].over(r.matched.rows // 8)["HOT"] > r.matched.rows / 8
    assert r.blocks.rows > 1000
    seen = Counter(e for e, in r.blocks.df.select("event_id").collect())
    assert max(seen.values()) > 20
    expect(FINAL["mark_transferred"], r.marks)
    expect(FINAL["lab_transfer_rows"], r.lab.select("event_id", "enrolment_id"))
    expect(FINAL["triage"], r.flags)
    expect(FINAL["update_ownership"], r.ownership)
    expect(FINAL["run_all"], end_state(r.result.tables, CFG))
    expect(
        "SELECT event_id, enrolment_id, stage_id, facility_id FROM inserted",
        r.inserts.df.select(
            F.col("programstageinstanceid").alias("event_id"),
            F.col("programinstanceid").alias("enrolment_id"),
            F.col("programstageid").alias("stage_id"),
            F.col("organisationunitid").alias("facility_id"),
        ),
    )
    expect(
        "SELECT n AS messageid, text AS messagetext, user_id AS userid FROM transfer_messages",
        r.messages.message.where("messagetext LIKE 'Patient%'").select("messageid", "messagetext", "userid"),
    )
