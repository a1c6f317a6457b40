"""The one clock of a run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casebridge.config import Run


def run_clock(run: Run) -> Column:
    """The run's time without a zone, the same in every session zone."""
    return F.lit(run.run_ts.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
