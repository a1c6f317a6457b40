"""Tables as a base and logs of changed rows: a log holds the whole new row of every key it changes, or a new key's row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column has it."""
    while name in df.columns:
        name += "_"
    return name


def newest_rows(logs: list[DataFrame], key: list[str]) -> DataFrame:
    """One log of several, in order: of each key the rows of its last log. Only keys are compared, rows move once."""
    if len(logs) == 1:
        return logs[0]
    step = unused(logs[-1], "log_step")
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn(step, F.lit(i)) for i, df in enumerate(logs)])
    last = rows.groupBy(*key).agg(F.max(step).alias(step))
    return rows.join(last, [*key, step], "left_semi").drop(step)


def over_base(base: DataFrame, log: DataFrame, key: list[str], keys: DataFrame | None = None) -> DataFrame:
    """The base with the log's rows in place of its own; ``keys``: the log's keys, where they are at hand.

    Filters on the result reach both scans, so only base rows that pass them meet the keys.
    """
    return base.join((log if keys is None else keys).select(*key), key, "left_anti").select(base.columns).unionByName(log, allowMissingColumns=True)
