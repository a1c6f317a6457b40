"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one JSON line.

Each query runs once to warm up and then twice; the faster run counts. Shuffle bytes and scans of the
event table come from Spark's event log of that run. Beside them, and not in the total, stand a run with its publishing
(``publish``: changes and messages written and checked) and the same steps one statement after the other, each
writing the table for the next one (``statements``).
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from casebridge.operators.changes import apply_event_changes
from casebridge.operators.staging import stage, workspace
from casebridge.plans import jobs
from casebridge.plans.queries import CFG, QUERIES, RUN
from casebridge.sources import fixtures
from casebridge.sources.publish import publish_run

HEADLINE = ("match_both", "triage", "message_rows", "run_all")


def session(cpus: str, log: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.dir", f"file:{log}")
        .getOrCreate()
    )


def events_of(log: str):
    for file in Path(log).rglob("*"):
        if file.is_file():
            for line in file.read_text(errors="ignore").splitlines():
                if line.startswith("{"):
                    yield json.loads(line)


def scans(plan: dict) -> int:
    """Scans of the event table in a plan."""
    here = plan["nodeName"].startswith("Scan parquet") and "programstageinstance]" in json.dumps(plan["metadata"])
    return int(here) + sum(scans(child) for child in plan["children"])


def measures(log: str, spans: dict[str, tuple[float, float]]) -> dict:
    found = {name: {"shuffle_bytes": 0, "event_scans": 0} for name in spans}

    def owner(ms: float):
        return next((found[n] for n, (a, b) in spans.items() if a <= ms <= b), None)

    last_plan: dict[int, tuple[float, dict]] = {}
    for e in events_of(log):
        if e["Event"] == "SparkListenerTaskEnd":
            into = owner(e["Task Info"]["Finish Time"])
            if into is not None:
                written = (e.get("Task Metrics") or {}).get("Shuffle Write Metrics", {})
                into["shuffle_bytes"] += written.get("Shuffle Bytes Written", 0)
        elif e["Event"].endswith("SparkListenerSQLExecutionStart"):
            last_plan[e["executionId"]] = (e["time"], e["sparkPlanInfo"])
    for started, plan in last_plan.values():
        into = owner(started)
        if into is not None:
            into["event_scans"] += scans(plan)
    return found


def publish(spark: SparkSession, sf_dir: str, folder: str) -> None:
    publish_run(fixtures.load(spark, sf_dir), CFG, RUN, folder)


def statements(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Every job on the event table that the one before it has left, as separate statements would."""
    t = fixtures.load(spark, sf_dir)

    def after(t, events, name):
        events.write.parquet(f"{folder}/{name}")
        return t.but(programstageinstance=spark.read.parquet(f"{folder}/{name}"))

    def changed(t, changes, name):
        absent = {c: F.lit(None).cast("string") for c in ("new_status", "new_transfer_status", "new_document") if c not in changes.columns}
        return after(t, apply_event_changes(t.programstageinstance, stage(changes.withColumns(absent), name).df, CFG.status_field), name)

    with workspace(spark):
        made = jobs.transfer_events(t, CFG, RUN)
        t = after(t, t.programstageinstance.unionByName(made.inserts), "copied")
        made.notices.write.parquet(f"{folder}/transfer_notices")
        t = changed(t, jobs.mark_transferred(t, CFG), "marked")
        late = jobs.transfer_lab(t, CFG)
        late.notices.write.parquet(f"{folder}/lab_notices")
        completed = changed(t, late.completed, "completed")
        t = changed(completed, late.merged.select("event_id", "new_document"), "merged")
        jobs.update_ownership(t, CFG).write.parquet(f"{folder}/owners")
        changed(t, jobs.triage_events(t, CFG), "flagged")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    log = tempfile.mkdtemp(prefix="bench-events-")
    spark = session(cpus, log)
    spark.sparkContext.setLogLevel("ERROR")
    fixtures.load(spark, sf_dir)

    def run(name: str) -> tuple[float, float]:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return start * 1000, time.time() * 1000

    spans = {}
    for name in HEADLINE:
        run(name)
        spans[name] = min((run(name) for _ in range(2)), key=lambda s: s[1] - s[0])
    more = {}
    for job in (publish, statements):
        for _ in range(2):
            folder, start = tempfile.mkdtemp(prefix="bench-out-"), time.time()
            job(spark, sf_dir, f"file:{folder}/out")
            more[job.__name__] = (start * 1000, time.time() * 1000)
    spark.stop()
    seconds = {name: round((b - a) / 1000, 3) for name, (a, b) in spans.items()}
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cores": cpus,
                "settings": {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"},
                "beside": {name: round((b - a) / 1000, 3) for name, (a, b) in more.items()},
                "measures": measures(log, spans | more),
            }
        )
    )


if __name__ == "__main__":
    main()
