"""Whole jobs from files to files: labelling dumps, community statistics, thread selection, corpus rendering.

Each job takes paths and writes its results into folders below ``out``; the
folders of one job are inputs of the next. Dumps are named by their month
(``RC_yyyy-mm``, ``RS_yyyy-mm``). A job decodes each dump once, into a typed
table that all its steps read. Lines that cannot be parsed go to
``<out>/rejects``. Intermediate tables are deleted at the end of a job.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadcorpus.operators import corpus as C
from threadcorpus.operators import lang as L
from threadcorpus.operators import render as R
from threadcorpus.operators import stats as S
from threadcorpus.operators import threads as T
from threadcorpus.session import in_scratch, materialize
from threadcorpus.sources import readers, sinks
from threadcorpus.sources.store import PART, of_threads, write_store

KEYS = ["kind", "id"]


def _posts(spark: SparkSession, comments: Sequence[str], submissions: Sequence[str], out: str,
           keep: Callable[[DataFrame], DataFrame] = materialize) -> DataFrame:
    """Well-formed posts of both kinds, without advertisements, as a table; other lines are written to the rejects.

    Compressed dumps are one task for each file; from here on tasks are cut by
    size, or with ``keep=write_store`` by thread.
    """
    parts = [readers.read_posts(spark, paths, kind)
             for paths, kind in ((comments, "comment"), (submissions, "submission")) if paths]
    posts = keep((parts[0] if len(parts) == 1 else T.all_posts(*parts)).withColumn("batch", readers.batch_key("file_path")))
    sinks.write_raw(posts.where("malformed"), os.path.join(out, "rejects"), partition_by=("batch",))
    return readers.drop_orphans(posts.where(~F.col("malformed")))


@in_scratch
def label_comments(spark: SparkSession, comments: Sequence[str], model: L.LanguageModel, out: str,
                   target: str = "de", reference: str = "en", overwrite: bool = False) -> list[str]:
    """G1 + K10: label comment dumps for one language; dumps of batches already done are not read again.

    Writes ``meta`` (id, community and label of every comment), ``raw`` (the
    original lines of the target's comments) and ``ids`` (their distinct ids),
    a folder for each batch, and then lists the batches in ``done``. With
    ``overwrite`` all batches are done again. Returns the dumps that were read.
    """
    done = os.path.join(out, "done")
    pending = sinks.pending_dumps(spark, comments, done, overwrite)
    if not pending:
        return pending
    posts = _posts(spark, pending, (), out)
    labels = materialize(L.label_single(L.one_each(posts.select(*KEYS, "body")), model, target, reference, id_col=KEYS))
    by_batch = {"partition_by": ("batch",)}
    meta = posts.select(*KEYS, "subreddit", "batch").join(labels, KEYS, "left")
    sinks.write_tsv(meta.select("id", "subreddit", "label", "batch"), os.path.join(out, "meta"), header=False, **by_batch)
    found = L.keep_language(labels)
    kept = posts.join(found.select(*KEYS), KEYS, "left_semi")
    sinks.write_raw(kept, os.path.join(out, "raw"), **by_batch)
    sinks.write_keys(kept.select("id", "batch").distinct(), os.path.join(out, "ids"), **by_batch)
    batches = spark.createDataFrame([(d,) for d in pending], "path string").select(readers.batch_key("path").alias("batch"))
    sinks.commit_batches(batches.distinct(), done)
    return pending


@in_scratch
def community_statistics(spark: SparkSession, meta: str, out: str) -> None:
    """Monthly and overall shares from label folders (``meta`` of :func:`label_comments`).

    Writes ``stats`` (all communities, a triple of columns for each month) and
    ``selected`` (overall columns of those over the threshold).
    """
    labels = readers.read_lang_meta(spark, meta).withColumn("month", F.substring("batch", 4, 7))
    monthly = materialize(S.monthly_share(labels, "german"))
    sinks.write_csv(S.community_stats(monthly), os.path.join(out, "stats"))
    sinks.write_csv(S.filter_communities(S.corpus_share(monthly)), os.path.join(out, "selected"))


@in_scratch
def select_threads(spark: SparkSession, comments: Sequence[str], submissions: Sequence[str], ids: str,
                   communities: str, out: str) -> None:
    """Threads chosen by the share of words in comments of the target language.

    ``ids`` and ``communities`` are written by the jobs before. Writes
    ``scores`` (every thread with a target comment in a listed community),
    ``comments`` and ``submissions`` (original lines of the selected threads).
    """
    posts = _posts(spark, comments, submissions, out, write_store)
    said = posts.where(F.col("kind") == "comment")
    members = readers.read_keys(spark, ids)
    threads = materialize(T.union_keys(T.members(said, materialize(members), "id")))
    candidates = of_threads(said, threads)
    scores = materialize(T.thread_word_scores(candidates, members, readers.read_subreddit_stats(spark, communities)))
    sinks.write_tsv(scores, os.path.join(out, "scores"))
    lines = of_threads(posts, materialize(scores.where("selected").select("link_id")))
    for kind in ("comment", "submission"):
        sinks.write_raw(lines.where(F.col("kind") == kind), os.path.join(out, f"{kind}s"))


@in_scratch
def threads_by_language(spark: SparkSession, comments: Sequence[str], submissions: Sequence[str],
                        model: L.LanguageModel, targets: Sequence[str], out: str, reference: str = "en") -> None:
    """Threads chosen by the share of posts in each of several languages, with their submissions.

    Writes ``meta`` (every post with its language), ``communities`` and
    ``threads`` (scores for each language), ``posts`` (posts of the chosen
    threads as JSON lines, copies dropped, in thread order with their position)
    and ``duplicates`` (copies dropped for each thread).
    """
    posts = _posts(spark, comments, submissions, out, write_store)
    labels = L.label_multi(L.one_each(posts.select(*KEYS, "body")), model, targets, reference, id_col=KEYS)
    meta = materialize(posts.select(*KEYS, "created_utc", "subreddit", "subreddit_id", "link_id", "parent_id")
                       .join(labels, KEYS, "left"))
    is_submission = (F.col("kind") == F.lit("submission")).alias("submission")
    sinks.write_tsv(meta.select("id", is_submission, "language", "created_utc", "subreddit", "subreddit_id", "link_id",
                                "parent_id"), os.path.join(out, "meta"))
    community = materialize(S.community_scores(meta, targets))
    sinks.write_tsv(community, os.path.join(out, "communities"))
    scores = materialize(S.thread_scores(meta, community, targets))
    sinks.write_tsv(scores, os.path.join(out, "threads"))
    fields = ["lang", "link_id", PART, *KEYS, "created_utc", "author", "subreddit", "parent_id", "body"]
    group = ("lang", "link_id")
    chosen = materialize(scores.where("exceeded").select("lang", "link_id").distinct())
    found = of_threads(posts, chosen, "inner", ["lang"]).select(*fields)
    sinks.write_tsv(T.duplicate_report(found.drop(PART), group), os.path.join(out, "duplicates"))
    # Copies of a post lie in one bucket, so they collapse without a shuffle, and so do their times.
    ordered = T.order_thread(T.dedup_thread(found, (*group, PART)).drop(PART), group,
                             narrow=T.first_times(found, (*group, PART)))
    sinks.write_post_records(ordered, os.path.join(out, "posts"), group, ["pos"])


@in_scratch
def render_corpus(spark: SparkSession, comments: Sequence[str], submissions: Sequence[str], threads: str, out: str,
                  attributes: Sequence[str] = ("author", "date"), nested: bool = False) -> None:
    """Posts rendered as XML and assembled with their metadata into the vertical corpus.

    ``threads`` is a tab-separated table of thread metadata with the bare thread
    id as ``id``. Writes ``xml``, ``comment_metadata`` and
    ``submission_metadata`` (a folder for each batch), ``vertical`` and
    ``left_out`` (threads and posts without metadata). ``attributes`` are the
    metadata columns that become attributes of a post's tag; ``nested`` renders
    nested markdown.
    """
    posts = _posts(spark, comments, submissions, out)
    sinks.write_xml_corpus(R.render_posts(posts, nested=nested), os.path.join(out, "xml"))
    tables = []
    for kind in ("comment", "submission"):
        path = os.path.join(out, f"{kind}_metadata")
        rows = L.one_each(sinks.post_metadata(posts.where(F.col("kind") == kind)), ["id"])
        sinks.write_post_metadata(rows, path)
        tables.append(rows.select("id", *attributes))
    meta = readers.read_metadata(spark, threads)
    sinks.write_vertical(C.assemble_texts(posts, meta, *tables), os.path.join(out, "vertical"))
    sinks.write_tsv(C.assembly_rejects(posts, meta, *tables), os.path.join(out, "left_out"))
