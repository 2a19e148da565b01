"""Filtered joins equal plain joins, with a filter of any size, and shuffle fewer rows."""
import pytest
from pyspark.sql import functions as F

from threadcorpus.operators import bloom


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def frames(spark):
    big = spark.range(20_000).select(F.when(F.col("id") % 97 != 0, F.concat(F.lit("k"), F.col("id") % 5000)).alias("key"),
                                     F.col("id").alias("n"))
    keys = spark.range(0, 5000, 13).select(F.concat(F.lit("k"), "id").alias("key"))
    return big, keys.unionByName(keys.limit(5)).unionByName(spark.createDataFrame([(None,)], "key string"))


@pytest.mark.parametrize("max_bits", [64, 1 << 13, bloom.MAX_BITS])
def test_filtered_joins_equal_plain_joins(frames, max_bits):
    big, keys = frames
    assert rows_of(bloom.filtered_semi(big, keys, "key", max_bits)) == rows_of(big.join(keys, "key", "left_semi"))
    assert rows_of(bloom.filtered_anti(big, keys, ["key"], max_bits)) == rows_of(big.join(keys, "key", "left_anti"))


def test_no_key_is_missed_and_few_others_pass(frames):
    big, keys = frames
    passed = big.where(bloom.key_filter(keys, "key"))
    partners = big.join(keys, big.key.eqNullSafe(keys.key), "left_semi").count()
    assert partners <= passed.count() <= partners + 0.02 * big.count()
    assert passed.where(F.col("key").isNull()).count() == big.where(F.col("key").isNull()).count()


def test_empty_sides(spark, frames):
    big, keys = frames
    assert bloom.filtered_semi(big, keys.limit(0), "key").count() == 0
    assert bloom.filtered_anti(big, keys.limit(0), "key").count() == big.count()
    assert bloom.filtered_semi(big.limit(0), keys, "key").count() == 0


def test_filter_size_is_bounded():
    assert bloom.filter_bits(0) == bloom.MIN_BITS
    assert bloom.filter_bits(10 ** 12) == bloom.MAX_BITS
    assert 12_000 <= bloom.filter_bits(1000) <= 24_000
