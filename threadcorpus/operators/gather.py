"""Threads as units: runs of posts in thread order, gathered into chunks of bounded size.

A thread is one chunk if it is small. A larger one is cut after every
``chunk_bytes`` bytes of its posts, so that no row, task or line of a file
holds more than that and one post, however large the thread is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadcorpus.operators.ordering import rank_in_group
from threadcorpus.operators.threads import thread_order

CHUNK_BYTES = 1 << 20


def gather_threads(posts: DataFrame, columns: Sequence[str], group: Sequence[str] = ("link_id",),
                   order: Sequence | None = None, size: Column | None = None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """A10: ``(*group, chunk, n_posts, posts)``, posts an array of ``pos`` and ``columns`` in thread order.

    ``order`` (default: thread order) must be total inside a thread; give
    ``(batch, created_utc, id)`` for the order of reading. ``size`` is a post's
    bytes, by default those of its body.
    """
    size = F.octet_length("body") if size is None else size
    ranked = rank_in_group(posts.withColumn("_size", F.coalesce(size, F.lit(0)).cast("bigint")), list(group),
                           order or thread_order(), "pos", weight="_size")
    chunk = F.floor(F.col("pos_before") / F.lit(chunk_bytes)).cast("bigint")
    return ranked.groupBy(*group, chunk.alias("chunk")).agg(
        F.count("*").alias("n_posts"), F.array_sort(F.collect_list(F.struct("pos", *columns))).alias("posts"))


def thread_posts(chunks: DataFrame, group: Sequence[str] = ("link_id",)) -> DataFrame:
    """The posts of gathered threads, a row for each: ``(*group, chunk, pos, ...)``."""
    return chunks.select(*group, "chunk", F.explode("posts").alias("_p")).select(*group, "chunk", "_p.*")


def gather_lengths(posts: DataFrame, label: Column, length: Column, group: Sequence[str] = ("link_id",),
                   order: Sequence | None = None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``(*group, chunk, n_posts, lale)``: label and length of every post in thread order, in chunks."""
    marked = posts.withColumn("label", label).withColumn("length", length)
    chunks = gather_threads(marked, ["label", "length"], group, order, F.lit(16), chunk_bytes)
    return chunks.select(*group, "chunk", "n_posts", F.transform(
        "posts", lambda p: F.struct(p["label"].alias("label"), p["length"].alias("length"))).alias("lale"))


def length_shares(chunks: DataFrame, group: Sequence[str] = ("link_id",)) -> DataFrame:
    """``(*group, n_posts, target, total)``: lengths summed inside each chunk, then over a thread's chunks."""
    zero = F.lit(0).cast("bigint")
    part = chunks.select(
        *group, "n_posts",
        F.aggregate(F.filter("lale", lambda x: x["label"]), zero, lambda a, x: a + x["length"]).alias("target"),
        F.aggregate("lale", zero, lambda a, x: a + x["length"]).alias("total"))
    return part.groupBy(*group).agg(*[F.sum(c).alias(c) for c in ("n_posts", "target", "total")])
