"""Posts written once in buckets of their thread, so that joins and aggregates by thread move no posts.

The bucket of a post is decided by its thread and by one of ``PARTS`` parts of
the thread, cut by a hash of the post's id: a thread of a third of all posts
lies in many buckets, and copies of one post still lie in one. A key set of
threads is repeated for each part; it is the only side that is shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadcorpus.functions.text import thread_key
from threadcorpus.operators import joins
from threadcorpus.session import scratch_path

PARTS = 16
PART = "thread_part"


def write_store(posts: DataFrame, path: str | None = None, buckets: int | None = None, parts: int = PARTS) -> DataFrame:
    """``posts`` of both kinds as a table bucketed by (``link_id``, ``thread_part``), sorted inside its buckets.

    ``link_id`` becomes the thread key of submissions too. The plan of
    ``posts`` runs once. Without ``path`` the table is an intermediate one of
    the running job.
    """
    spark = posts.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = posts.withColumn("link_id", thread_key(F.col("kind"), F.col("id"), F.col("link_id"))) \
        .withColumn(PART, F.pmod(F.xxhash64("kind", "id"), F.lit(parts)).cast("int"))
    name = f"thread_store_{uuid.uuid4().hex}"
    keyed.repartition(n, "link_id", PART).write.bucketBy(n, "link_id", PART).sortBy("link_id", PART, "kind", "id") \
        .option("path", path or scratch_path(spark)).saveAsTable(name)
    return spark.table(name)


def open_store(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """A store written by an earlier session, with its number of buckets."""
    name = f"thread_store_{uuid.uuid4().hex}"
    columns = spark.read.parquet(path).schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet CLUSTERED BY (link_id, {PART}) "
              f"SORTED BY (link_id, {PART}, kind, id) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def _spread(keys: DataFrame, parts: int) -> DataFrame:
    return keys.withColumn(PART, F.explode(F.array(*map(F.lit, range(parts)))))


def of_threads(store: DataFrame, keys: DataFrame, how: str = "left_semi", columns: Sequence[str] = (),
               max_rows: int | None = None, parts: int = PARTS) -> DataFrame:
    """Posts of a store whose thread is in ``keys`` (``link_id`` and ``columns``); posts stay in their buckets.

    ``keys`` are written and distinct. Up to ``max_rows`` they are broadcast,
    beyond that shuffled to the buckets.
    """
    keys = keys.select("link_id", *columns)
    limit = joins.BROADCAST_MAX_ROWS if max_rows is None else max_rows
    if joins.broadcast_rows(keys) <= limit:
        return store.join(F.broadcast(keys), "link_id", how)
    return store.join(_spread(keys, parts), ["link_id", PART], how)
