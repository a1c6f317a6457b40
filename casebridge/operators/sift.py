"""Tell rows that a join may touch from rows it surely does not, so that only the former are moved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebridge.operators.changelog import unused

#: Rows of the broadcast table of bits, by the number of keys within these bounds; each holds 64 places.
WORDS_LEAST, WORDS_MOST = 1 << 10, 1 << 22
#: Keys a row is meant for, and places each sets in it.
KEYS_EACH, PLACES = 4, 3


def _mask(column: str) -> Column:
    """Some bits of a word, by a hash of the key of their own."""
    other, one = F.xxhash64(F.lit(1), column), F.lit(1).cast("long")
    mask = F.lit(0).cast("long")
    for i in range(PLACES):
        place = F.shiftrightunsigned(other, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", one, place))
    return mask


def sift(rows: DataFrame, keys: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``column`` may be among ``keys``, and rows whose value surely is not.

    Keys are counted, and each sets a few bits of one word of a table of bits, which is broadcast. With up to
    ``KEYS_EACH * WORDS_MOST`` keys about one row in two hundred passes for nothing; the table grows no further, so
    with more keys more rows do, and results never depend on it: a join still has to follow. Rows without a
    value are surely not among the keys. Both tables must hold ``column`` in the same type.
    """
    words = WORDS_LEAST
    wanted = keys.count() // KEYS_EACH
    while words < min(wanted, WORDS_MOST):
        words *= 2
    word, bits = unused(rows, "sift_word"), unused(rows, "sift_bits")
    place = F.pmod(F.xxhash64(column), F.lit(words)).cast("int")
    marks = keys.where(F.col(column).isNotNull()).select(place.alias(word), _mask(column).alias(bits))
    met = rows.withColumn(word, place).join(F.broadcast(marks.groupBy(word).agg(F.bit_or(bits).alias(bits))), word, "left")
    maybe = F.coalesce(F.col(bits).bitwiseAND(_mask(column)) == _mask(column), F.lit(False)) & F.col(column).isNotNull()
    return met.where(maybe).select(rows.columns), met.where(~maybe).select(rows.columns)
