"""Sifting: no row that a join needs is lost, rows without a key stay, most others are not moved."""

import pytest
from pyspark.sql import functions as F

from casebridge.operators import sift as module
from casebridge.operators.sift import sift


@pytest.mark.parametrize("words", [1, 1 << 20])
def test_every_row_is_on_one_side_and_matches_on_the_first(spark, monkeypatch, words):
    monkeypatch.setattr(module, "WORDS_LEAST", words)
    monkeypatch.setattr(module, "WORDS_MOST", words)
    rows = spark.range(3000).select(F.when(F.col("id") % 10 > 0, F.col("id") % 500).alias("k"), F.col("id").alias("v"))
    keys = spark.createDataFrame([(3,), (3,), (77,), (None,), (10**12,)], "k bigint")
    maybe, surely_not = sift(rows, keys, "k")
    both = maybe.unionAll(surely_not)
    assert both.exceptAll(rows).isEmpty() and rows.exceptAll(both).isEmpty()
    assert surely_not.join(keys, "k", "left_semi").isEmpty()
    assert maybe.where("k IS NULL").isEmpty()
    if words > 1:
        assert maybe.count() < 30


def test_the_table_grows_with_the_keys(spark):
    """Fifty thousand keys: of as many other rows few pass, and a bounded table only lets more pass."""
    keys = spark.range(50_000).select((F.col("id") * 2).alias("k"))
    rows = spark.range(100_000).select(F.col("id").alias("k"))
    maybe, surely_not = sift(rows, keys, "k")
    assert maybe.join(keys, "k", "left_semi").count() == 50_000
    assert 50_000 <= maybe.count() < 51_500 and maybe.count() + surely_not.count() == 100_000


def test_columns_of_any_name_come_through(spark):
    rows = spark.sql("SELECT 1L AS k, 'a' AS sift_word, 'b' AS sift_bits, 'c' AS _word, 'd' AS _bits")
    for part in sift(rows, rows.select("k"), "k"):
        assert all(tuple(r) == (1, "a", "b", "c", "d") for r in part.collect())


def test_no_keys_and_no_rows(spark):
    rows = spark.range(5).withColumnRenamed("id", "k")
    none = rows.where("k < 0")
    assert [df.count() for df in sift(rows, none, "k")] == [0, 5]
    assert [df.count() for df in sift(none, rows, "k")] == [0, 0]
