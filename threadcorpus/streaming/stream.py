"""Structured Streaming forms of labelling, community counts and duplicate removal.

Inputs are folders that receive files (monthly dumps as they are published);
every query keeps its progress in a checkpoint location under the session's
checkpoint folder, so a restarted or failed job continues where it stopped.
``trigger(availableNow=True)`` processes what is there and stops.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from threadcorpus.functions.text import epoch_month
from threadcorpus.operators.lang import LanguageModel, label_multi, one_each
from threadcorpus.session import checkpoint_dir
from threadcorpus.sources.readers import parse_posts


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for a stream's files and state, under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex}")


def label_stream(spark: SparkSession, source: str, sink: str, model: LanguageModel,
                 targets, checkpoint: str, kind: str = "comment", files_per_batch: int = 1) -> StreamingQuery:
    """Label JSON-line files as they arrive; labels are appended as parquet.

    Each micro-batch runs the batch labeller unchanged (``foreachBatch``): the
    lexicon and n-gram joins and per-post aggregations need the whole batch.
    A post is labelled once per batch and the label joined to all its copies,
    keyed by kind and id. Malformed lines go to ``<sink>/rejects``, labels to
    ``<sink>/labels``. Writing is idempotent per batch id, so a retried batch
    does not duplicate.
    """
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch).load(source)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_posts(batch, kind)
        parsed.where("malformed").select("raw").write.mode("overwrite").text(
            os.path.join(sink, "rejects", f"batch={batch_id}"))
        posts = parsed.where(~F.col("malformed"))
        keys = ["kind", "id"]
        labels = label_multi(one_each(posts.select(*keys, "body")), model, targets, id_col=keys)
        out = posts.select(*keys, "subreddit", "created_utc").join(labels, keys, "left")
        out.write.mode("overwrite").parquet(os.path.join(sink, "labels", f"batch={batch_id}"))

    return (lines.writeStream.foreachBatch(per_batch)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def community_counts(labelled: DataFrame, label_col: str = "label") -> DataFrame:
    """Running positives and totals per month and community (a streaming aggregation)."""
    with_month = labelled.withColumn("month", epoch_month(F.col("created_utc")))
    return with_month.groupBy("month", "subreddit").agg(
        F.count_if(F.col(label_col)).alias("n"), F.count("*").alias("total"))


def share_of(counts: DataFrame) -> DataFrame:
    """Monthly share from running counts (communities with at least one positive)."""
    return counts.where(F.col("n") > 0).withColumn("prop", F.col("n") / F.col("total"))


def write_snapshot(stream: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Write the full result of a streaming aggregation after every batch, each to a folder of its own.

    :func:`latest_snapshot` reads the last one that was written whole.
    """
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").parquet(
            os.path.join(sink, f"version={batch_id}"))

    return (stream.writeStream.outputMode("complete").foreachBatch(per_batch)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def latest_snapshot(spark: SparkSession, sink: str) -> DataFrame:
    """The result of the last batch that :func:`write_snapshot` completed."""
    versions = spark.read.parquet(sink)
    last = versions.agg(F.max("_batch")).first()[0]
    return versions.where(F.col("_batch") == F.lit(last)).drop("_batch", "version")


CONTRIBUTION = ["source", "publication", "month", "subreddit"]


def contribute(labelled: DataFrame, sink: str, checkpoint: str, label_col: str = "label") -> StreamingQuery:
    """T2 by contributions: what each micro-batch adds to the counts of a month and community, kept by its source.

    ``labelled`` has ``source`` (the dump a row comes from), ``publication``
    (its edition, in order), ``subreddit``, ``created_utc`` and the label. A
    batch writes its own partial counts and nothing else: no snapshot of all
    counts is held or written, and a retried batch replaces its own folder.
    """
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        part = batch.withColumn("month", epoch_month(F.col("created_utc"))).groupBy(*CONTRIBUTION).agg(
            F.count_if(F.col(label_col)).alias("n"), F.count("*").alias("total"))
        part.write.mode("overwrite").parquet(os.path.join(sink, f"batch={batch_id}"))

    return (labelled.writeStream.foreachBatch(per_batch)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def merged_counts(spark: SparkSession, sink: str) -> DataFrame:
    """Counts per month and community from contributions; of each source its last publication counts.

    A dump that is published again takes the place of its earlier edition, in
    all months that either holds.
    """
    parts = spark.read.parquet(sink)
    # One row for each dump.
    last = parts.groupBy("source").agg(F.max("publication").alias("publication"))
    return parts.join(F.broadcast(last), ["source", "publication"]).groupBy("month", "subreddit").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"))


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started within keep their state in RocksDB: bounded memory, changes saved for each batch."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def dedup_stream(posts: DataFrame, sink: str, checkpoint: str, keys=("kind", "id")) -> StreamingQuery:
    """Append one copy of every post, however late its other copies arrive.

    The keys seen are keyed state on disk: a micro-batch looks up its own keys
    and reads nothing that was written before, so its work does not grow with
    the history. A post of an old month is kept as long as it is new. Of copies
    that arrive in one micro-batch any one is kept. A retried batch replaces
    its own folder.
    """
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(sink, f"batch={batch_id}"))

    with state_on_disk(posts.sparkSession):
        return (posts.dropDuplicates(list(keys)).writeStream.foreachBatch(per_batch)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def append_to(stream: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Append a stateless or watermarked stream to a parquet folder."""
    return (stream.writeStream.format("parquet").option("path", sink)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(availableNow=True).start())
