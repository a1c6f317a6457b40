"""Publishing: one winner, changes over a base, compaction, pruned reads, and refusal of unsound results."""

import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import fields, replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from tiny import CFG, World, document

from casebridge.config import Run
from casebridge.functions import ids
from casebridge.operators import copies, lab, link, notify, ownership
from casebridge.operators.changelog import newest_rows, over_base
from casebridge.operators.link import event_fields, field_names, stage_queue
from casebridge.operators.notify import Messages
from casebridge.plans import run as steps
from casebridge.plans.run import TransferRun, start_run
from casebridge.sources import fixtures
from casebridge.sources import publish as publishing
from casebridge.sources.layout import is_derived, lay_out, plain, read_base, write_base
from casebridge.sources.publish import _markers, compact, latest, newest, publish, published_messages
from casebridge.sources.shared import exists, put_once, remove_folder

SF = "/root/testdata/sf0.001"
RUN = Run("first", datetime(2026, 1, 1, 2, 3, 4, 567), event_base=2_000_000_000)


@pytest.fixture(scope="module")
def tables(spark):
    return fixtures.load(spark, SF)


@pytest.fixture(scope="module")
def first(tables):
    return TransferRun(tables, CFG, RUN).result


NO_NOTICE = replace(CFG, static_notice=False)


@pytest.fixture(scope="module")
def tiny(spark):
    """Tables and a run of one transfer: two copies, a mark, two messages."""
    w = World().person(1, "N1", "Ann").user(7).user(8).event(5, document("N1", "Ann")).event(6, document("N2", "Bob"))
    run = Run("r", datetime(2026, 1, 1), event_base=100)
    t = w.tables(spark)
    return t, TransferRun(t, NO_NOTICE, run).result, run


# ---- one winner ----


@pytest.mark.parametrize("scheme", ["", "file:"])
def test_a_file_is_created_once(spark, tmp_path, scheme):
    path = f"{scheme}{tmp_path}/a folder/1%20.json"
    with ThreadPoolExecutor(8) as pool:
        for i in range(10):
            won = list(pool.map(lambda k, i=i: put_once(spark, f"{path}-{i}", f"text {k} é"), range(8)))
            assert sum(won) == 1
            assert spark.read.text(f"{tmp_path}/a folder").where(F.col("value") == f"text {won.index(True)} é").count() >= 1
    assert len([p for p in (tmp_path / "a folder").iterdir() if not p.name.endswith(".crc")]) == 10


def test_a_file_of_another_file_system_is_created_once(spark, tmp_path):
    """Through a view, as a cluster may name its store."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.once.link./in", f"file://{tmp_path}")
    with ThreadPoolExecutor(6) as pool:
        won = list(pool.map(lambda k: put_once(spark, "viewfs://once/in/new/marker", str(k)), range(6)))
    assert sum(won) == 1 and exists(spark, "viewfs://once/in/new/marker")
    assert (tmp_path / "new" / "marker").read_text() == str(won.index(True))


def test_of_six_publishers_one_wins(spark, tiny, tmp_path):
    out, (_, result, run) = str(tmp_path), tiny

    def attempt(k):
        try:
            return publish(result, replace(run, run_id=f"r{k}"), out)
        except ValueError as error:
            assert "was computed from" in str(error)
            return None

    with ThreadPoolExecutor(6) as pool:
        won = [p for p in pool.map(attempt, range(6)) if p]
    assert len(won) == 1
    assert _markers(spark, out).count() == 1 and newest(spark, out).path == won[0]
    assert len(list((tmp_path / "runs").glob("*/*"))) == 1  # what the others had written is gone


# ---- changes over a base ----


def test_newest_rows_over_a_base(spark):
    def table(rows):
        return spark.createDataFrame(rows, "k int, v string, log_step int")

    base = table([(1, "a", 0), (2, "b", 0), (3, "c", 0), (None, "n", 0)])
    logs = [table([(2, "b1", 9), (4, "d1", 9)]), table([]), table([(4, "d2", 1), (5, "e2", 1)])]
    seen = over_base(base, newest_rows(logs, ["k"]), ["k"])
    assert sorted((r["k"] or 0, r["v"], r["log_step"]) for r in seen.collect()) == [(0, "n", 0), (1, "a", 0), (2, "b1", 9), (3, "c", 0), (4, "d2", 1), (5, "e2", 1)]


def test_only_changed_and_new_rows_are_published(spark, tables, first, tmp_path):
    path = publish(first, RUN, str(tmp_path))
    log = spark.read.parquet(f"{path}/programstageinstance")
    assert log.count() < 0.7 * tables.programstageinstance.count() + 612
    old = log.join(tables.programstageinstance.select("programstageinstanceid"), "programstageinstanceid", "left_semi")
    assert old.count() == log.count() - 612 == TransferRun(tables, CFG, RUN).event_changes.where("event_id < 2000000000").count()
    assert old.select(plain(old).columns).exceptAll(tables.programstageinstance.select(plain(old).columns)).count() == old.count()


def test_a_run_reads_the_events_twice(spark, tables, tmp_path, monkeypatch):
    """Once for the queue, once for lab targets: the write included."""
    tables.programstageinstance.write.parquet(f"{tmp_path}/events")
    t = tables.but(programstageinstance=spark.read.parquet(f"{tmp_path}/events"))
    written = []

    def watch(module, name):
        original = getattr(module, name)

        def watched(df, *args, **kwargs):
            written.append(df._jdf.queryExecution().executedPlan().toString())
            return original(df, *args, **kwargs)

        monkeypatch.setattr(module, name, watched)

    for module in (copies, ids, lab, link, notify, ownership, steps):
        watch(module, "stage")
    watch(publishing, "_write")
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    try:
        publish(TransferRun(t, CFG, RUN).result, RUN, f"{tmp_path}/out")
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert len(written) > 15
    assert sum(plan.count(f"{tmp_path}/events]") for plan in written) == 2


def test_compaction_keeps_what_readers_see(spark, tables, first, tmp_path):
    out = str(tmp_path)
    assert compact(tables, out) is None
    publish(first, RUN, out)
    base = newest(spark, out)
    before = latest(tables, out)
    seen = {n: getattr(before, n).select(plain(getattr(before, n)).columns).drop("geometry") for n in ("programstageinstance", "trackedentityprogramowner")}
    rows = {n: sorted(map(str, df.collect())) for n, df in seen.items()}
    told = published_messages(spark, out).message.count()
    compact(tables, out)
    after = latest(tables, out)
    for n, df in seen.items():
        assert sorted(map(str, getattr(after, n).select(df.columns).collect())) == rows[n]
        assert dict(getattr(after, n).select(df.columns).dtypes) == dict(df.dtypes)
    assert published_messages(spark, out).message.count() == told
    assert latest(tables, out, base).programstageinstance.count() == len(rows["programstageinstance"])  # older readers go on
    assert compact(tables, out) is None
    assert newest(spark, out).step == 2 and start_run(after, "s", datetime(2026, 1, 2), after=newest(spark, out)).parent == "compact-2"


def test_a_compaction_that_comes_late_is_refused(spark, tiny, tmp_path, monkeypatch):
    out, (t, result, run) = str(tmp_path), tiny
    publish(result, run, out)
    base = newest(spark, out)
    monkeypatch.setattr(publishing, "write_base", lambda *args: put_once(spark, f"{out}/published/00000002.json", "{}"))
    with pytest.raises(ValueError, match="published since"):
        compact(t, out)
    assert base.step == 1 and not list((tmp_path / "runs").glob("compact*/*"))


# ---- pruned reads of a laid-out table ----


def laid_out(spark, events, folder):
    write_base(events, CFG, folder)
    return read_base(events, folder)


def test_the_queue_of_a_laid_out_table_reads_its_partitions_and_parses_nothing(spark, tables, tmp_path):
    t = tables.but(programstageinstance=laid_out(spark, tables.programstageinstance, f"{tmp_path}/events"))
    caught = []

    original = link.stage
    link.stage = lambda df, *a, **k: caught.append(df) or original(df, *a, **k)
    try:
        queue = stage_queue(t, CFG)
    finally:
        link.stage = original
    plan = caught[0]._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[[^]]*", plan)[0]
    assert "queuepart" in filters and "from_json" not in plan
    expected = stage_queue(tables, CFG)
    columns = [c for c in queue.df.columns if c != "event"]
    assert queue.rows == expected.rows and queue.df.select(columns).exceptAll(expected.df.select(columns)).isEmpty()


def test_a_run_over_a_laid_out_table_is_the_same(spark, tables, first, tmp_path):
    t = tables.but(programstageinstance=laid_out(spark, tables.programstageinstance, f"{tmp_path}/events"))
    result = TransferRun(t, CFG, RUN).result
    columns = [c for c in plain(first.tables.programstageinstance).columns if c != "geometry"]
    ours, theirs = (event_fields(r.tables.programstageinstance.select(columns), CFG) for r in (result, first))
    assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()
    assert not any(is_derived(c) for c in result.tables.programstageinstance.columns)


def test_derived_columns_hold_what_a_parse_gives(spark):
    w = World()
    for i, lab in enumerate([None, "", "x", 1.50, {"q": 1}]):
        w.event(i, document("N", "A", lab=lab))
    w.event(10, None).event(11, "broken {").event(12, document(state="a/b c=é")).event(13, "{}", stage=None)
    events = w.tables(spark).programstageinstance
    derived = event_fields(lay_out(events, CFG), CFG).select("programstageinstanceid", *field_names(CFG))
    parsed = event_fields(events, CFG).select("programstageinstanceid", *field_names(CFG))
    assert sorted(map(str, derived.collect())) == sorted(map(str, parsed.collect()))


def test_any_stage_and_status_come_back_from_a_laid_out_table(spark, tmp_path):
    w = World().event(1, document(state="")).event(2, document(state="a/b c=é")).event(3, document(), stage=None).event(4, None)
    events = w.tables(spark).programstageinstance
    back = laid_out(spark, events, f"{tmp_path}/events")
    assert sorted(map(str, plain(back).select(events.columns).collect())) == sorted(map(str, events.collect()))
    assert plain(back).select(events.columns).dtypes == events.dtypes


# ---- refusals ----


@pytest.mark.parametrize(
    ("broken", "said"),
    [
        (lambda r: replace(r, messages=replace(r.messages, usermessage=r.messages.usermessage.limit(1))), "unequal length"),
        (lambda r: replace(r, messages=replace(r.messages, message=r.messages.message.withColumn("messageid", F.lit(7)))), "messageid twice"),
        (lambda r: replace(r, messages=replace(r.messages, message=r.messages.message.withColumn("messageid", F.col("messageid") - 1))), "given out before"),
        (lambda r: replace(r, changes=replace(r.changes, programstageinstance=r.changes.programstageinstance.unionAll(r.changes.programstageinstance))), "programstageinstanceid twice"),
        (lambda r: replace(r, changes=replace(r.changes, programstageinstance=r.changes.programstageinstance.withColumn("programstageinstanceid", F.lit(None).cast("bigint")))), "rows without"),
    ],
)
def test_unsound_results_are_refused(spark, tiny, tmp_path, broken, said):
    _, result, run = tiny
    with pytest.raises(ValueError, match=said):
        publish(broken(result), run, str(tmp_path))
    assert newest(spark, str(tmp_path)) is None and not list(tmp_path.glob("runs/*/*"))
    publish(result, run, str(tmp_path))


def test_an_event_in_two_classes_is_refused(spark, tmp_path):
    w = World().person(1, "N1", "Ann").event(5, document("N1", "Ann"))
    r = TransferRun(w.tables(spark), replace(CFG, static_notice=False), Run("r", datetime(2026, 1, 1), event_base=100))
    r.flags = spark.createDataFrame([(5, "Check Name")], "event_id bigint, new_transfer_status string")
    with pytest.raises(ValueError, match="programstageinstanceid twice"):
        publish(r.result, r.run, str(tmp_path))


def test_a_run_with_nothing_to_do_is_published(spark, tmp_path):
    w = World().person(1, "N1", "Ann").event(5, document("N1", "Ann", request="NONE"))
    run = Run("r", datetime(2026, 1, 1), event_base=100)
    publish(TransferRun(w.tables(spark), replace(CFG, static_notice=False), run).result, run, str(tmp_path))
    assert latest(w.tables(spark), str(tmp_path)).programstageinstance.count() == 1
    assert {getattr(published_messages(spark, str(tmp_path)), f.name).count() for f in fields(Messages)} == {0}


def test_removing_a_folder(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/x/y")
    remove_folder(spark, f"{tmp_path}/x")
    assert not (tmp_path / "x").exists() and not exists(spark, f"{tmp_path}/x")
