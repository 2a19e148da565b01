"""The bucketed store: same posts as plain joins, no exchange of posts, hot threads over many buckets."""
import pytest
from pyspark.sql import functions as F

from threadcorpus.operators import threads as T
from threadcorpus.session import materialize
from threadcorpus.sources import store


@pytest.fixture(scope="module")
def posts(spark):
    rows = [("comment", f"c{i}", "t3_hot" if i % 3 == 0 else f"t3_{i % 50}", i) for i in range(3000)]
    rows += [("submission", f"{i}", None, i) for i in range(50)] + [("comment", "c0", "t3_hot", 0)] * 40 + [("comment", None, None, 1)]
    return spark.createDataFrame(rows, "kind string, id string, link_id string, created_utc bigint")


def rows_of(df):
    return sorted(map(tuple, df.select("kind", "id", "link_id", "created_utc").collect()), key=repr)


def plan_of(spark, df):
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("max_rows", [0, 10**6])
def test_semi_join_of_a_store(spark, posts, max_rows):
    kept = store.write_store(posts, buckets=8)
    keys = materialize(spark.createDataFrame([("t3_hot",), ("t3_7",), ("t3_none",)], "link_id string"))
    found = store.of_threads(kept, keys, max_rows=max_rows)
    keyed = posts.withColumn("link_id", F.when(F.col("kind") == "submission", F.concat(F.lit("t3_"), "id")).otherwise(F.col("link_id")))
    assert rows_of(found) == rows_of(keyed.where("link_id in ('t3_hot', 't3_7')"))


def test_posts_are_not_exchanged(spark, posts):
    kept = store.write_store(posts, buckets=8)
    keys = materialize(spark.range(60).select(F.concat(F.lit("t3_"), "id").alias("link_id"), F.lit("de").alias("lang")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = store.of_threads(kept, keys, "inner", ["lang"], max_rows=0)
        once = T.dedup_thread(found, ("lang", "link_id", store.PART))
        plan = plan_of(spark, once)
        assert plan.count("Arguments: hashpartitioning") == 1 and "Bucketed: true" in plan  # the keys alone
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_a_hot_thread_lies_in_many_buckets_and_copies_in_one(spark, posts):
    kept = store.write_store(posts, buckets=32)
    files = kept.withColumn("file", F.input_file_name()).where("link_id = 't3_hot'")
    assert files.select("file").distinct().count() > 8
    assert files.where("id = 'c0'").select("file").distinct().count() == 1


def test_a_store_opened_again(spark, posts, tmp_dir):
    store.write_store(posts, tmp_dir + "/s", buckets=4)
    again = store.open_store(spark, tmp_dir + "/s", 4)
    assert again.count() == posts.count()
    assert "hashpartitioning" not in plan_of(spark, again.groupBy("link_id", store.PART).count())
