"""Reading tables, intermediate tables in the shared folder, and text columns in Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebridge.operators.staging import staging_root

SPANS = T.ArrayType(
    T.StructType(
        [T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType())]
    )
)
SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or where it is unset a folder in the warehouse. A cluster has to name one its machines share."""
    return staging_root(spark)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: the plan is cut, and lost executors cost nothing."""
    path = f"{shared_root(df.sparkSession)}/casebridge-llm/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a filter below; each stands for 64 places.
FILTER_ROWS = 1 << 20


def split_by_ids(rows: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``key`` may be among ``ids``, and rows whose key surely is not.

    The ids set bits at hashed places of a table of at most ``FILTER_ROWS`` words, which is broadcast, so that a join
    that follows need not move the rows that cannot match. Rows without a key are surely not among them. The fuller
    the table, the more rows pass for nothing; results don't depend on it.
    """
    place = F.pmod(F.xxhash64(key), F.lit(FILTER_ROWS * 64))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))
    word, bits = unused(rows, "id_word"), unused(rows, "id_bits")
    marks = ids.where(F.col(key).isNotNull()).select(F.floor(place / 64).alias(word), bit.alias(bits))
    marked = rows.withColumn(word, F.floor(place / 64)).join(F.broadcast(marks.groupBy(word).agg(F.bit_or(bits).alias(bits))), word, "left")
    maybe = F.coalesce(F.col(bits).bitwiseAND(bit) != 0, F.lit(False)) & F.col(key).isNotNull()
    return marked.where(maybe).select(rows.columns), marked.where(~maybe).select(rows.columns)


def without_ids(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is not among ``ids``; only those that may be are moved."""
    maybe, surely_not = split_by_ids(rows, ids, key)
    return surely_not.unionByName(maybe.join(ids.select(key), key, "left_anti").select(rows.columns))


def crc_mod(column: str, by: int) -> Column:
    """Remainder of the crc32 of an id written as text."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(by))


def span_list(spans: Column) -> Column:
    """Spans (kind, start, end) as comma-joined ``kind:start:end``."""
    written = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", written)


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def span_array(texts: pa.Array, spans_of: Callable[[str | None], list[tuple]]) -> pa.Array:
    """The spans of each text of an Arrow column as a column."""
    names = SPAN.names
    return pa.array([[dict(zip(names, s, strict=True)) for s in spans_of(t.as_py())] for t in texts], pa.list_(SPAN))
