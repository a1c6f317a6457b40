"""Cut a plan by writing an intermediate table to the shared folder of the cluster.

The steps of a job go into one folder, its workspace, which is removed when the job ends, well or not. A workspace with a key
is a journal: a job that is started again with the same key, after its driver was lost, takes up the steps that were
written whole and works out the others. The key has to stand for all a job depends on (``job_key``).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field
from urllib.parse import urlparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from casebridge.operators.spread import Profile
from casebridge.sources.shared import exists, remove_folder


@dataclass(frozen=True)
class Staged:
    """A written table with its row count and the profiles of key columns; ``numbers`` are what numbered rows take."""

    df: DataFrame
    rows: int
    profiles: dict[str, Profile] = field(default_factory=dict)
    numbers: int = 0


@dataclass
class Workspace:
    """Where the steps of one job are written, and how many there are so far."""

    folder: str
    steps: int = 0
    taken_up: int = 0


_workspace: ContextVar[Workspace | None] = ContextVar("workspace", default=None)


def staging_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset, one in the warehouse.

    A warehouse in a machine's own folder, Spark's default, will do for a local session only: a cluster has to name a folder
    that all its machines share.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if urlparse(warehouse).scheme in ("", "file") and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir is not set: staged tables need a folder that the whole cluster shares")
    return f"{warehouse}/staging"


@contextmanager
def workspace(spark: SparkSession, key: str | None = None) -> Iterator[Workspace]:
    """Steps staged inside go to one folder, which is removed at the end.

    What is staged can only be read inside. Jobs with one key must not run at the same time.
    """
    here = Workspace(f"{staging_root(spark)}/casebridge/{f'job-{key}' if key else uuid.uuid4().hex}")
    token = _workspace.set(here)
    try:
        yield here
    finally:
        _workspace.reset(token)
        remove_folder(spark, here.folder)


def job_key(*parts: object, tables: tuple[DataFrame, ...] = ()) -> str:
    """A key that follows from ``parts`` (by their repr) and from the files and columns the tables are read from."""
    digest = hashlib.sha256()
    for part in parts:
        digest.update(repr(part).encode() + b"\0")
    for df in tables:
        digest.update(df.schema.json().encode() + b"\0")
        for name in sorted(df.inputFiles()):
            digest.update(name.encode() + b"\0")
    return digest.hexdigest()[:32]


def stage(df: DataFrame, name: str, profile: tuple[str, ...] = ()) -> Staged:
    """Write ``df`` and read it back. The rows are counted during the write."""
    spark, here = df.sparkSession, _workspace.get()
    if here is None:
        path = f"{staging_root(spark)}/casebridge/{uuid.uuid4().hex}/{name}"
    else:  # steps come in the order of the program, so number, name and columns tell them apart
        here.steps += 1
        path = f"{here.folder}/{here.steps:03d}-{name}-{hashlib.sha256(df.schema.json().encode()).hexdigest()[:8]}"
    if here is not None and exists(spark, f"{path}/_SUCCESS"):
        here.taken_up += 1
        written = spark.read.schema(df.schema).parquet(path)
        rows = written.count()
    else:
        seen = Observation(name)
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
        rows = seen.get.get("rows", 0)
        written = spark.read.schema(df.schema).parquet(path)
    return Staged(written, rows, {c: Profile(rows, (written.select(c),)) for c in profile})
