"""Equi join that cuts hot keys into slices, so that no task gets a whole hot group.

A key is hot when it has more rows than a fair share of the shuffle. Rows of a hot key are dealt to
slices by a hash of the row, and the other side is repeated once per slice. Where both sides are hot
the slices form a grid, chosen so that few rows are repeated, and every pair still meets exactly once. Keys are counted
exactly, as an aggregate over the key column, where the table has more rows than one task may take of a key. The
hot keys only steer where rows go; the result is that of the plain join.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from math import ceil, sqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ONE_SIDED = ("left", "left_semi", "left_anti")
#: Cells a task of a join with a given number of tasks is meant for: several, so that tasks come out about equal.
CELLS_EACH = 16


@dataclass(frozen=True)
class Profile:
    """Row count of a table, and its key column (in one or more parts), counted when a join needs it."""

    rows: int
    keys: tuple[DataFrame, ...]
    _counted: dict[int, dict] = field(default_factory=dict, compare=False, repr=False)

    def __add__(self, other: Profile) -> Profile:
        """Of both tables together."""
        return Profile(self.rows + other.rows, self.keys + other.keys)

    def over(self, rows: int) -> dict:
        """Exact counts of the values with more than ``rows`` rows: fewer than ``self.rows / rows`` values."""
        if self.rows <= rows:
            return {}
        if rows not in self._counted:
            keys = reduce(DataFrame.unionAll, self.keys)
            counts = keys.groupBy(keys.columns[0]).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows)
            self._counted[rows] = {value: n for value, n in counts.collect()}
        return self._counted[rows]


def profile(df: DataFrame, column: str) -> Profile:
    return Profile(df.count(), (df.select(column),))


def fair_share(seen: Profile, width: int, hot_rows: int) -> int:
    """Rows of one key a task can take."""
    return max(hot_rows, seen.rows // width, 1)


def hot_values(seen: Profile | None, width: int, hot_rows: int) -> dict:
    """Hot value -> (rows, slices); fewer than ``width`` values."""
    if seen is None:
        return {}
    fair = fair_share(seen, width, hot_rows)
    return {v: (n, min(width, ceil(n / fair))) for v, n in seen.over(fair).items()}


def grid(left: tuple[int, int], right: tuple[int, int], width: int) -> tuple[int, int]:
    """Slices of both sides of one key, given the rows and wanted slices of each.

    ``left_rows * r + right_rows * l`` rows move for l by r slices. With more cells than ``width`` asked for, the
    two are lowered to the cheapest with ``l * r <= width``.
    """
    (a, l), (b, r) = left, right
    if l * r <= width:
        return l, r
    l = max(1, min(l, int(sqrt(width * a / b)) if b else l))
    r = max(1, min(r, width // l))
    return min(left[1], max(l, width // r)), r


def _dealt(df: DataFrame, key: str, own: str, other: str, table: list, split: list[str], repeat: bool) -> DataFrame:
    """Add the slice columns ``own`` (by row hash) and ``other`` (repeated)."""
    kind = T.StructType(
        [
            T.StructField("_value", df.schema[key].dataType),
            T.StructField("_own", T.IntegerType()),
            T.StructField("_other", T.IntegerType()),
        ]
    )
    # Fewer than 2 * width rows: no more keys can be over a fair share.
    hot = F.broadcast(df.sparkSession.createDataFrame(table, kind))
    joined = df.join(hot, F.col(key).eqNullSafe(F.col("_value")), "left")
    dealt = F.pmod(F.xxhash64(*split), F.coalesce("_own", F.lit(1))).cast("int")
    repeated = F.explode(F.sequence(F.lit(0), F.coalesce("_other", F.lit(1)) - 1)) if repeat else F.lit(0)
    return joined.select("*", dealt.alias(own)).select("*", repeated.alias(other)).drop("_value", "_own", "_other")


def _dealt_join(left: DataFrame, right: DataFrame, on: list[str], how: str, tasks: int) -> DataFrame:
    """Join in that many tasks.

    The keys are one column, NULL where one of them is: of several, Spark drops those it knows to be constant from the join,
    and would shuffle the rows again for the rest. So it would for a column whose parts may be NULL on one side only.
    """
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    cell = F.when(known, F.struct(*[F.when(known, F.col(c)).alias(c) for c in on]))
    left, right = (df.withColumn("_cell", cell).repartition(tasks, "_cell") for df in (left, right))
    met = left.join(right.drop(*on), "_cell", how).drop("_cell")
    return met.select(*on, *[c for c in met.columns if c not in on])


def spread_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    *,
    hot_rows: int,
    also: tuple[str, ...] = (),
    left_profile: Profile | None = None,
    right_profile: Profile | None = None,
    left_split: tuple[str, ...] = (),
    right_split: tuple[str, ...] = (),
    right_hot_rows: int | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Join on ``key`` (and ``also``). ``*_split`` names columns that tell the rows of one key apart.

    ``left``, ``left_semi`` and ``left_anti`` cut the left side only. ``tasks`` is for joins that make far more rows than they
    read: Spark sizes tasks by the bytes they read and would make all the rows in one or a few. Keys are then cut finer, and the
    cells dealt to that many tasks.
    """
    width = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")) if tasks is None else tasks * CELLS_EACH
    left_hot = hot_values(left_profile, width, hot_rows)
    right_hot = {} if how in ONE_SIDED else hot_values(right_profile, width, right_hot_rows or hot_rows)
    if how == "inner":
        left_hot.pop(None, None)
        right_hot.pop(None, None)
    values = list(left_hot) + [v for v in right_hot if v not in left_hot]
    on = [key, *also]

    def met(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        return left.join(right, on, how) if tasks is None else _dealt_join(left, right, on, how, tasks)

    if not values:
        return met(left, right, on)
    cuts = [(v, *grid(left_hot.get(v, (0, 1)), right_hot.get(v, (0, 1)), width)) for v in values]
    left = _dealt(left, key, "_l", "_r", cuts, list(left_split) or left.columns, bool(right_hot))
    # NULL never matches, so the right side has nothing to repeat for it.
    flipped = [(v, r, n) for v, n, r in cuts if v is not None]
    right = _dealt(right, key, "_r", "_l", flipped, list(right_split) or right.columns, bool(left_hot))
    return met(left, right, [*on, "_l", "_r"]).drop("_l", "_r")
