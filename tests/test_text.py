import math

from pyspark.sql import functions as F

from threadcorpus.functions.text import (bare_id, blank_length, epoch_month, is_too_short, sanitize,
                                         share_threshold, thread_key, words)


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_sanitize_removes_urls_and_breaks(spark):
    assert one(spark, sanitize("v"), "a (http://x.y/z) b https://q") == "a  b "
    assert one(spark, sanitize("v"), "x\r\ny\nz") == "x y z"


def test_too_short_boundary_and_deleted(spark):
    assert one(spark, is_too_short("v"), "0123456789") is True
    assert one(spark, is_too_short("v"), "01234567890") is False
    assert one(spark, is_too_short("v"), "[deleted]") is True
    assert one(spark, is_too_short("v"), "😀" * 11) is False


def test_words_follow_python_unicode_classes(spark):
    assert one(spark, words("v"), "Für x² éa ½_b‿c") == ["Für", "x²", "e", "a", "½_b", "c"]


def test_blank_length(spark):
    assert one(spark, blank_length("v"), "") == 1
    assert one(spark, blank_length("v"), "a  b ") == 4


def test_thread_keys(spark):
    df = spark.createDataFrame([("submission", "abc", None), ("comment", "x", "t3_abc")],
                               "kind string, id string, link_id string")
    rows = df.select(thread_key("kind", "id", "link_id").alias("k")).collect()
    assert [r.k for r in rows] == ["t3_abc", "t3_abc"]
    assert one(spark, bare_id("v"), "t3_abc") == "abc"


def test_month_and_threshold(spark):
    assert one(spark, epoch_month("v"), 1262304000, "v bigint") == "2010-01"
    assert one(spark, epoch_month("v"), 1264982399, "v bigint") == "2010-01"
    for total in (1, 2, 100, 19999):
        got = one(spark, share_threshold("v"), total, "v bigint")
        assert math.isclose(got, math.exp(-math.sqrt(total) / 4) + 0.015, rel_tol=1e-12)
