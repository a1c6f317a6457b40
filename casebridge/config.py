"""Settings of a transfer job: the fixed identifiers, the opt-in strict rules and the run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime


@dataclass(frozen=True)
class MatchKey:
    """One value an event and a person must share."""

    attribute_uid: str
    event_field: str


# Identifiers, states and texts that must equal those in the data.
ID_NUMBER = MatchKey("ZkNZOxS24k7", "XupJDPkqWoL")
FULL_NAME = MatchKey("jWjSY7cktaQ", "bvuRnNr6INS")
DISTRICT_NUMBER = MatchKey("fPlDBVvpEJR", "eCy7sKTrwnA")
WAITING = "NOTTRANSFERRED"
TRANSFERRED = "AUTOMATICALLY"
CHECK_NAME = "Check Name"
NO_MATCH = "No Match"
ID_NOT_FOUND = "Not Yet Transferred TB No Not Found"
ACTIVE = "ACTIVE"
COMPLETED = "COMPLETED"
PERMANENT = "PERMANENT_TRANSFER"
TRANSFER_SUBJECT = "Patient transfer"
TRANSFER_TEXT = "Patient has been transferred: "
LAB_SUBJECT = "Lab results transfer"
LAB_TEXT = "Lab results transferred: "
STATIC_TEXT = "Patient has been transferred: tbnumber fullname"
MESSAGE_TYPE = "PRIVATE"


@dataclass(frozen=True)
class TransferConfig:
    """What to match and where to copy. Defaults are the values the original job uses."""

    notify_group_uid: str = "phS5ScyDEYj"
    source_stage_uid: str = "qZ43tA7bpir"
    treatment_stage_uid: str = "tJ5SV8gfZaA"
    lab_stage_uid: str = "edyRc6d5Bts"
    program_uid: str = "wfd9K4dQVDR"
    # The person comes from the first key; every further key only has to exist.
    match_keys: tuple[MatchKey, ...] = (ID_NUMBER, FULL_NAME)
    request_field: str = "MVQOgAxvNWh"
    request_values: tuple[str, ...] = ("EVENT_TRANSFER", PERMANENT)
    status_field: str = "iup9aING8xC"
    lab_field: str = "WTz4HSqoE5E"
    target_facility_field: str = "JpvpfVIjK7x"
    static_notice_facility_id: int = 12111

    # Strict rules; the defaults keep the original behaviour.
    same_entity: bool = False
    dedupe_transfers: bool = False
    require_program: bool = False
    blank_is_missing: bool = False
    lab_target: str = "enrolment"  # or "own_copy"
    merge_fields: tuple[str, ...] | None = None
    reset_status_on_copy: bool = False
    source_stage_only: bool = False
    owner_program_only: bool = False
    skip_deleted_events: bool = False
    notify_target: bool = False
    static_notice: bool = True
    distinct_recipients: bool = False
    owner_latest_only: bool = False

    # A join key with more rows than this (and than a fair share) is cut into slices.
    hot_key_rows: int = 1_000_000
    # Copies of one linked row are expanded in pieces of this size.
    copy_chunk: int = 1_000

    def __post_init__(self):
        if len(self.match_keys) < 2:
            raise ValueError("two match keys at least: who the person is, and one to confirm it")
        if self.source_stage_uid in (self.treatment_stage_uid, self.lab_stage_uid):
            raise ValueError("copies go to other stages than the one they come from")
        if self.lab_target not in ("enrolment", "own_copy"):
            raise ValueError(f"lab_target: {self.lab_target!r}")


@dataclass(frozen=True)
class Run:
    """Identity of one run: its clock, where new ids start, and the published run it was computed from."""

    run_id: str
    run_ts: datetime
    event_base: int
    conversation_base: int = 0
    message_base: int = 0
    usermessage_base: int = 0
    parent: str | None = None
