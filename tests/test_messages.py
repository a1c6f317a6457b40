"""Messages are requests times recipients: rows when they are read, never a written table."""

from collections import Counter
from dataclasses import fields, replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from tiny import CFG, World, document

from casebridge.config import Run
from casebridge.functions import ids
from casebridge.operators import copies, lab, link, notify, ownership
from casebridge.operators.notify import Messages, message_counts
from casebridge.plans import run as steps
from casebridge.plans.run import TransferRun, end_state, start_run
from casebridge.sources import publish as publishing
from casebridge.sources.publish import RECIPIENTS, REQUESTS, latest, newest, publish, published_messages

QUIET = replace(CFG, static_notice=False)
RUN = Run("r", datetime(2026, 1, 1, 5), event_base=100)
INT_MOST = 2**31 - 1


def busy(events=12, users=40):
    """One facility with many users: messages by far outnumber all else."""
    w = World().person(1, "N1", "Ann")
    for i in range(events):
        w.event(i + 1, document("N1", "Ann"))
    for u in range(users):
        w.user(u)
    return w


def table(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_no_table_as_long_as_the_messages_is_written(spark, tmp_path, monkeypatch):
    longest = Counter()

    def watch(module, name):
        original = getattr(module, name)

        def watched(df, label, *args, **kwargs):
            longest[label] = max(longest[label], df.count())
            return original(df, label, *args, **kwargs)

        monkeypatch.setattr(module, name, watched)

    for module in (copies, ids, lab, link, notify, ownership, steps):
        watch(module, "stage")
    watch(publishing, "_write")
    r = TransferRun(busy().tables(spark), QUIET, RUN)
    publish(r.result, RUN, str(tmp_path))
    told = published_messages(spark, str(tmp_path))
    assert {getattr(told, f.name).count() for f in fields(Messages)} == {12 * 40}
    assert max(longest.values()) < 100 and {REQUESTS, RECIPIENTS} <= set(longest)


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_message_rows_are_dealt_to_tasks_by_their_number(spark, tmp_path, monkeypatch, broadcast):
    """What messages are made from is small: by its bytes one task would make them all."""
    monkeypatch.setattr(notify, "MESSAGES_LEAST", 500, raising=False)
    monkeypatch.setattr(notify, "MESSAGES_MOST", 1000, raising=False)
    cfg = replace(QUIET, hot_key_rows=5, copy_chunk=1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        r = TransferRun(busy(60, 200).tables(spark), cfg, RUN)
        publish(r.result, RUN, str(tmp_path))
        for told in (r.messages, published_messages(spark, str(tmp_path), cfg)):
            rows = told.message.select("messageid", "userid", F.spark_partition_id().alias("task")).collect()
            assert sorted(x["messageid"] for x in rows) == list(range(1, 12_001))
            made = Counter(x["task"] for x in rows)
            assert len(made) > 8 and max(made.values()) < 4_000
        counted = message_counts(r.sent).withColumn("task", F.spark_partition_id()).collect()
        assert {x["messages"] for x in counted} == {60} and len(counted) == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_published_messages_are_those_of_the_run(spark, tmp_path):
    """Several facilities, a member twice, and a second run's messages with its own id, clock and numbers."""
    out = str(tmp_path)
    w = World().person(1, "N1", "Ann").person(2, "N2", "Bob", facility=2).event(5, document("N1", "Ann")).event(6, document("N2", "Bob"))
    w.user(7).user(8, times=2).user(8, facility=2).user(9, facility=2)
    t = w.tables(spark)
    first = TransferRun(t, QUIET, RUN)
    publish(first.result, RUN, out)
    told = published_messages(spark, out)
    for f in fields(Messages):
        assert table(getattr(told, f.name)) == table(getattr(first.messages, f.name))
        assert getattr(told, f.name).dtypes == getattr(first.messages, f.name).dtypes
    base = newest(spark, out)
    total = first.messages.message.count()
    assert (base.conversation_base, base.message_base, base.usermessage_base) == (total,) * 3
    more = w.event(11, document("N2", "Bob")).tables(spark)
    now = latest(more, out, base)
    later = TransferRun(now, QUIET, start_run(now, "later", datetime(2026, 1, 2), after=base))
    publish(later.result, later.run, out)
    both = published_messages(spark, out)
    for f in fields(Messages):
        assert table(getattr(both, f.name)) == sorted(table(getattr(first.messages, f.name)) + table(getattr(later.messages, f.name)))
    assert sorted(r["messageid"] for r in both.message.collect()) == list(range(1, both.message.count() + 1))


def test_numbers_past_an_int_are_kept(spark, tmp_path):
    """A run with more messages than an int column has numbers ends, is published, and the next run goes on from it."""
    out, t = str(tmp_path), busy(2, 3).tables(spark)
    run = replace(RUN, usermessage_base=INT_MOST - 4)
    r = TransferRun(t, QUIET, run)
    assert end_state(r.result.tables, QUIET).agg(F.sum("events")).first()[0] == 6
    publish(r.result, run, out)
    told = published_messages(spark, out)
    assert sorted(x["usermessageid"] for x in told.usermessage.collect()) == [INT_MOST - 3 + i for i in range(6)]
    assert dict(r.messages.usermessage.dtypes)["usermessageid"] == dict(told.usermessage.dtypes)["usermessageid"] == "bigint"
    base = newest(spark, out)
    now = latest(t, out, base)
    again = TransferRun(now, QUIET, start_run(now, "again", datetime(2026, 1, 2), after=base))
    assert again.run.usermessage_base == INT_MOST + 2
    publish(again.result, again.run, out)
    fits = TransferRun(t, QUIET, replace(RUN, usermessage_base=INT_MOST - 6)).messages
    assert dict(fits.usermessage.dtypes)["usermessageid"] == "int"
    assert max(x["usermessageid"] for x in fits.usermessage.collect()) == INT_MOST


def test_counted_messages_are_the_rows_counted(spark):
    """Users of several facilities, members twice, and one text in several facilities."""
    w = World().person(1, "N1", "Ann").enrol(11, 1, facility=2).enrol(12, 1, facility=2).person(2, "N2", "Bob")
    w.event(1, document("N1", "Ann")).event(2, document("N1", "Ann")).event(3, document("N2", "Bob"))
    w.user(7).user(8, times=2).user(8, facility=2).user(9, facility=2)
    for cfg in (QUIET, replace(QUIET, hot_key_rows=1, copy_chunk=1)):
        r = TransferRun(w.tables(spark), cfg, RUN)
        rows = r.messages.message.groupBy("messagetext", "userid").agg(F.count(F.lit(1)).alias("messages"))
        counted = message_counts(r.sent)
        assert table(counted) == table(rows) and counted.dtypes == rows.dtypes
        assert max(x["messages"] for x in counted.collect()) > 4


@pytest.mark.parametrize(
    ("broken", "said"),
    [
        (lambda s: replace(s, requests=s.requests.where("first_rank > 1")), "missing or given twice"),
        (lambda s: replace(s, requests=s.requests.unionAll(s.requests)), "missing or given twice"),
        (lambda s: replace(s, requests=s.requests.withColumn("first_rank", F.lit(None).cast("bigint"))), "without numbers"),
        (lambda s: replace(s, requests=s.requests.withColumn("message_base", F.lit(-1).cast("bigint"))), "without numbers"),
        (lambda s: replace(s, placed=s.placed.where("user_id <> 7")), "not those the requests count"),
        (lambda s: replace(s, placed=s.placed.withColumn("place", F.lit(1).cast("bigint"))), "not those the requests count"),
    ],
)
def test_unsound_requests_are_refused(spark, tmp_path, broken, said):
    result = TransferRun(busy(2, 9).tables(spark), QUIET, RUN).result
    sent = broken(result.sent)
    with pytest.raises(ValueError, match=said):
        publish(replace(result, sent=sent, messages=sent.messages), RUN, str(tmp_path))
    assert newest(spark, str(tmp_path)) is None and not list(tmp_path.glob("runs/*/*"))
