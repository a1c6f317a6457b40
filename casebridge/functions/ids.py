"""Row numbers, ids and identifiers that come out the same when a task is run again."""

from __future__ import annotations

from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebridge.operators.staging import Staged, stage


def number_rows(
    df: DataFrame, order: list[str], *, size: str | None = None, name: str = "numbered", profile: tuple[str, ...] = ()
) -> Staged:
    """Add ``first_rank``: a dense number from 1 in the given order; a row takes ``size`` numbers (1 by default).

    Rows are range-partitioned and sorted, so each partition counts on its own and only one total per
    partition reaches the driver. The partitions are written before they are counted: bounds and
    positions then cannot change under a later reader. ``order`` must be unique up to equal rows.
    The numbered rows come with the profiles of the written ones.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    staged = stage(placed, name, profile)
    rows = staged.df.withColumn("_part", F.shiftrightunsigned("_slot", 33))
    taken = F.count(F.lit(1)) if size is None else F.sum(size)
    totals = sorted(rows.groupBy("_part").agg(taken.alias("n")).collect())
    sizes = [n for _, n in totals]
    offsets = {"_part": [part for part, _ in totals], "_offset": list(accumulate(sizes, initial=0))[: len(sizes)]}
    kinds = pa.schema([("_part", pa.int64()), ("_offset", pa.int64())])
    table = df.sparkSession.createDataFrame(pa.table(offsets, schema=kinds))
    if size is None:
        before = F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))
    else:
        earlier = Window.partitionBy("_part").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum(size).over(earlier), F.lit(0))
    # One row per range partition, so the broadcast is bounded by the shuffle width.
    numbered = (
        rows.withColumn("_before", before)
        .join(F.broadcast(table), "_part")
        .withColumn("first_rank", (F.col("_offset") + F.col("_before") + 1).cast("bigint"))
        .drop("_slot", "_part", "_offset", "_before")
    )
    return Staged(numbered, staged.rows, staged.profiles, sum(sizes))


def chunk(df: DataFrame, rows: int) -> DataFrame:
    """Split rows of many ``copies`` into pieces of ``rows`` copies at most, told apart by ``piece``."""
    width = F.lit(rows).cast("bigint")
    pieces = df.where("copies > 0").withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("copies") - 1, width)))
    return pieces.withColumn("copies", F.least(width, F.col("copies") - F.col("piece")))


def expand(df: DataFrame) -> DataFrame:
    """One row per copy, numbered ``rank``."""
    last = F.col("first_rank") + F.col("copies") - 1
    return df.withColumn("rank", F.explode(F.sequence("first_rank", last))).drop("first_rank", "copies")


def uid(letter: str, number: Column) -> Column:
    """Eleven characters, a letter first; distinct for distinct ids, so no two new rows collide."""
    digits = F.lpad(F.conv(number.cast("string"), 10, 36), 10, "0")
    fits = number < F.lit(36**10)
    return F.concat(F.lit(letter), F.when(fits, digits).otherwise(F.raise_error(F.lit("id too large for a uid"))))


def uuid_of(*parts: Column) -> Column:
    """A UUID-shaped key derived from its parts: the same on a repeated task."""
    h = F.sha2(F.concat_ws("/", *[p.cast("string") for p in parts]), 256)
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("4"), F.substring(h, 14, 3)),
        F.concat(F.lit("a"), F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    )
