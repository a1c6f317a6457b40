"""Notices to the users of a facility, as rows of the five message tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebridge.config import (
    LAB_SUBJECT,
    LAB_TEXT,
    MESSAGE_TYPE,
    STATIC_TEXT,
    TRANSFER_SUBJECT,
    TRANSFER_TEXT,
    Run,
    TransferConfig,
)
from casebridge.functions.clock import run_clock
from casebridge.functions.fields import message_text
from casebridge.functions.ids import number_rows, uid, uuid_of
from casebridge.operators.spread import Profile, profile, spread_join
from casebridge.operators.staging import Staged, stage
from casebridge.sources.tables import Tables


@dataclass(frozen=True)
class Messages:
    messageconversation: DataFrame
    message: DataFrame
    messageconversation_messages: DataFrame
    usermessage: DataFrame
    messageconversation_usermessages: DataFrame


#: The largest number of an int column.
INT_MOST = 2**31 - 1
#: Messages that are worth a task of their own, up to the width of a shuffle, and messages a task makes at most on average.
MESSAGES_LEAST, MESSAGES_MOST = 1 << 17, 1 << 24
#: What the numbers of a run's messages are added to, one for each kind of id.
BASES = ("conversation_base", "message_base", "usermessage_base")


@dataclass(frozen=True)
class Sent:
    """Messages as what they follow from. As rows they are requests times recipients, far more than either.

    ``requests``: a row stands for ``copies`` notices to the ``users`` of a facility, numbered from ``first_rank`` on, with
    the id, clock and bases of its run. ``placed``: the recipients, whose ``place`` less the facility's ``first_place`` picks
    among a notice's numbers. ``total`` counts the messages, ``asked`` and ``held`` are the profiles of the facilities.
    """

    requests: DataFrame
    placed: DataFrame
    total: int
    asked: Profile
    held: Profile
    cfg: TransferConfig
    run: Run | None = None

    @cached_property
    def messages(self) -> Messages:
        _refuse_past_int(self)
        return message_tables(self, self.run.usermessage_base + self.total)


def recipients(t: Tables, cfg: TransferConfig) -> DataFrame:
    """(facility_id, user_id): members of the notified group per facility, repeated memberships kept."""
    group_id = t.usergroup.where(F.col("uid") == cfg.notify_group_uid).select("usergroupid").scalar()
    members = (
        t.usergroupmembers.where(F.col("usergroupid") == group_id)
        .join(t.users.select("userid"), "userid")
        .select(F.col("userid").alias("userinfoid"))
        .join(t.userinfo.select("userinfoid"), "userinfoid")
    )
    places = t.usermembership.select("userinfoid", "organisationunitid")
    known = spread_join(
        places,
        t.organisationunit.select("organisationunitid"),
        "organisationunitid",
        hot_rows=cfg.hot_key_rows,
        left_profile=profile(places, "organisationunitid"),
        left_split=("userinfoid",),
    )
    found = spread_join(
        known,
        members,
        "userinfoid",
        hot_rows=cfg.hot_key_rows,
        left_profile=profile(places, "userinfoid"),
        left_split=("organisationunitid",),
    ).select(F.col("organisationunitid").alias("facility_id"), F.col("userinfoid").alias("user_id"))
    return found.distinct() if cfg.distinct_recipients else found


def transfer_notices(blocks: Staged, cfg: TransferConfig) -> DataFrame:
    """To the facility of the enrolment; ``notify_target`` adds the facility of the event."""
    text = message_text(TRANSFER_TEXT, "key_0", "key_1")

    def to(facility: str, call: int) -> DataFrame:
        return blocks.df.select(
            F.lit(call).alias("call"),
            "first_rank",
            "copies",
            F.col(facility).alias("facility_id"),
            F.lit(TRANSFER_SUBJECT).alias("subject"),
            text.alias("text"),
        )

    told = to("enrolment_facility_id", 1)
    return told.unionByName(target_notices(blocks)) if cfg.notify_target else told


def target_notices(blocks: Staged) -> DataFrame:
    """The same notice to the facility of the event."""
    return blocks.df.select(
        F.lit(2).alias("call"),
        "first_rank",
        "copies",
        "facility_id",
        F.lit(TRANSFER_SUBJECT).alias("subject"),
        message_text(TRANSFER_TEXT, "key_0", "key_1").alias("text"),
    )


def lab_notices(lab: DataFrame) -> DataFrame:
    return lab.select(
        F.lit(3).alias("call"),
        F.col("event_id").alias("first_rank"),
        F.lit(1).cast("bigint").alias("copies"),
        "facility_id",
        F.lit(LAB_SUBJECT).alias("subject"),
        message_text(LAB_TEXT, "key_0", "key_1").alias("text"),
    )


def static_notice(t: Tables, cfg: TransferConfig) -> DataFrame:
    """The one notice a run always sends."""
    return t.spark.range(1).select(
        F.lit(4).alias("call"),
        F.lit(1).cast("bigint").alias("first_rank"),
        F.lit(1).cast("bigint").alias("copies"),
        F.lit(cfg.static_notice_facility_id).alias("facility_id"),
        F.lit(TRANSFER_SUBJECT).alias("subject"),
        F.lit(STATIC_TEXT).alias("text"),
    )


def send(requests: DataFrame, told: DataFrame, cfg: TransferConfig, run: Run | None = None) -> Sent:
    """The messages of ``requests`` to the recipients ``told``, numbered by request and user.

    Requests and recipients are numbered, not the messages: a request takes one number per message it
    leads to, and a recipient's place in its facility picks among them. The large product of the two is
    never sorted nor written.
    """
    hot_rows = _hot_requests(cfg)
    recipient_order = ["facility_id", "user_id"]
    users = number_rows(told, recipient_order, name="recipients", profile=("facility_id",))
    placed = users.df.withColumnRenamed("first_rank", "place")
    facilities = placed.groupBy("facility_id").agg(
        F.count(F.lit(1)).alias("users"), F.min("place").alias("first_place")
    )
    asked = stage(requests, "requests", ("facility_id",))
    answered = spread_join(
        asked.df.withColumnRenamed("first_rank", "request_rank"),
        facilities,
        "facility_id",
        hot_rows=hot_rows,
        left_profile=asked.profiles["facility_id"],
        left_split=("call", "request_rank"),
    ).withColumn("size", F.col("copies") * F.col("users"))
    numbered = number_rows(answered, ["call", "request_rank"], size="size", name="request_order")
    run_id = F.lit(run.run_id if run else "").alias("run_id")
    bases = [F.lit(getattr(run, b) if run else 0).cast("bigint").alias(b) for b in BASES]
    now = (run_clock(run) if run else F.lit(None).cast("timestamp_ntz")).alias("sent")
    return Sent(
        numbered.df.select("*", run_id, now, *bases),
        placed.select("facility_id", "user_id", "place", run_id),
        numbered.numbers,
        asked.profiles["facility_id"],
        users.profiles["facility_id"],
        cfg,
        run,
    )


def _hot_requests(cfg: TransferConfig) -> int:
    """One request row is up to copy_chunk requests."""
    return max(1, cfg.hot_key_rows // cfg.copy_chunk)


def _tasks(sent: Sent) -> int:
    """Tasks that make the messages, by their number: what they are made from is small and would fill one or a few."""
    width = int(sent.requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(width, sent.total // MESSAGES_LEAST), -(-sent.total // MESSAGES_MOST))


def sent_rows(sent: Sent) -> DataFrame:
    """One row per message: its request's columns, the user, and its number from 1 in ``number``.

    Busy facilities and facilities with many users are cut on both sides, the users into larger pieces: each is met by
    all slices of the requests.
    """
    met = spread_join(
        sent.requests,
        sent.placed,
        "facility_id",
        hot_rows=_hot_requests(sent.cfg),
        also=("run_id",),
        left_profile=sent.asked,
        right_profile=sent.held,
        left_split=("run_id", "first_rank"),
        right_split=("run_id", "place"),
        right_hot_rows=16 * _hot_requests(sent.cfg),
        tasks=_tasks(sent),
    )
    copy = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).alias("copy")
    number = F.col("first_rank") + F.col("copy") * F.col("users") + F.col("place") - F.col("first_place")
    return met.select("*", copy).withColumn("number", number)


def message_rows(requests: DataFrame, told: DataFrame, cfg: TransferConfig) -> DataFrame:
    """One row per request and recipient of its facility, numbered by request and user in ``number``."""
    return sent_rows(send(requests, told, cfg)).select("facility_id", "user_id", "subject", "text", "number")


def message_counts(sent: Sent) -> DataFrame:
    """(messagetext, userid, messages): how many messages of a text a user gets.

    Requests are added up per text and facility, recipients per facility, before they meet. What meets is then one row per
    text and user, but for users of several facilities: only theirs are added up again.
    """
    asked = sent.requests.groupBy("run_id", "facility_id", "text").agg(F.sum("copies").alias("copies"))
    held = sent.placed.groupBy("run_id", "facility_id", "user_id").agg(F.count(F.lit(1)).alias("times"))
    several = held.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")

    def met(users: DataFrame) -> DataFrame:
        found = spread_join(
            asked,
            users,
            "facility_id",
            hot_rows=_hot_requests(sent.cfg),
            also=("run_id",),
            left_profile=sent.asked,
            right_profile=sent.held,
            left_split=("text",),
            right_split=("user_id",),
            right_hot_rows=16 * _hot_requests(sent.cfg),
            tasks=_tasks(sent),
        )
        return found.select(F.col("text").alias("messagetext"), F.col("user_id").alias("userid"), (F.col("copies") * F.col("times")).alias("messages"))

    once = met(held.join(several, "user_id", "left_anti"))
    again = met(held.join(several, "user_id", "left_semi")).groupBy("messagetext", "userid").agg(F.sum("messages").alias("messages"))
    return once.unionByName(again)


def build_messages(requests: DataFrame, told: DataFrame, cfg: TransferConfig, run: Run) -> Messages:
    """Rows of the five message tables, in table column order. One number per message serves all ids."""
    return send(requests, told, cfg, run).messages


def _refuse_past_int(sent: Sent) -> None:
    """Numbers that start past an int column, though no published run has led there, fail instead of wrapping round."""
    if sent.total and sent.run is not None and sent.run.parent is None and sent.run.usermessage_base >= INT_MOST:
        first = F.lit(sent.run.usermessage_base + 1).cast("int")
        sent.requests.sparkSession.range(1).select(first).collect()


def message_tables(sent: Sent, usermessage_most: int) -> Messages:
    """The five tables, derived from requests and recipients whenever they are read.

    ``usermessageid`` is an int where the numbers up to ``usermessage_most`` fit, and a bigint where they do not.
    """
    rows = sent_rows(sent)
    numbered = rows.select(
        (F.col("number") + F.col("conversation_base")).alias("messageconversationid"),
        (F.col("number") + F.col("message_base")).alias("messageid"),
        (F.col("number") + F.col("usermessage_base")).cast("int" if usermessage_most <= INT_MOST else "bigint").alias("usermessageid"),
        F.col("user_id").alias("userid"),
        "subject",
        "text",
        "run_id",
        "sent",
    )
    now = F.col("sent")
    return Messages(
        messageconversation=numbered.select(
            "messageconversationid",
            uid("C", F.col("messageconversationid")).alias("uid"),
            F.lit(1).alias("messagecount"),
            now.alias("created"),
            now.alias("lastupdated"),
            "subject",
            F.lit(MESSAGE_TYPE).alias("messagetype"),
            F.lit("NONE").alias("priority"),
            F.lit("NONE").alias("status"),
            F.lit(None).cast("bigint").alias("user_assigned"),
            F.lit(None).cast("bigint").alias("lastsenderid"),
            now.alias("lastmessage"),
            "userid",
        ),
        message=numbered.select(
            "messageid",
            uid("M", F.col("messageid")).alias("uid"),
            now.alias("created"),
            now.alias("lastupdated"),
            F.col("text").alias("messagetext"),
            F.lit(False).alias("internal"),
            F.lit(None).cast("string").alias("metadata"),
            "userid",
        ),
        messageconversation_messages=numbered.select(
            "messageconversationid", F.lit(1).alias("sort_order"), "messageid"
        ),
        usermessage=numbered.select(
            "usermessageid",
            uuid_of(F.col("run_id"), F.col("usermessageid")).alias("usermessagekey"),
            "userid",
            F.lit(False).alias("isread"),
            F.lit(False).alias("isfollowup"),
        ),
        messageconversation_usermessages=numbered.select("messageconversationid", "usermessageid"),
    )
