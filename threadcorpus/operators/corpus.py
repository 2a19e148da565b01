"""Vertical corpus: tokens and sentences, sentence tags, thread assembly.

A text of the corpus is a thread: its opening tag with thread metadata, the
submission (if any), its comments in thread order, the closing tag. Nothing is
gathered per thread: the result is one row per output line carrying explicit
order keys ``(text_id, part, created_utc, post_id, line_no)``, and the sink
range-partitions and sorts on them, so a huge thread spans several files in
order instead of one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadcorpus.functions.markup import render_open_tag, typed_blocks
from threadcorpus.functions.text import bare_id
from threadcorpus.operators.ordering import keep_first

# Fixed values of the vertical format.
# Tokens: an XML entity, a run of word characters, or one other visible character.
TOKEN = r"&[A-Za-z0-9#]+;|[\p{L}\p{N}_]+|[^ \t\n\p{L}\p{N}_]"
# A sentence ends after . ! or ? followed by white space.
SENTENCE_END = r"([.!?])[ \t\n]+"
SENTENCE_MARK = "\u0001"
PARAGRAPH_OPEN, PARAGRAPH_CLOSE = "<p>", "</p>"
SENTENCE_OPEN, SENTENCE_CLOSE = "<s>", "</s>"
# Parts of an assembled text, in output order.
PART_OPEN, PART_SUBMISSION, PART_COMMENTS, PART_CLOSE = 0, 1, 2, 3


def _tokens(s: Column) -> Column:
    return F.regexp_extract_all(s, F.lit(TOKEN), 0)


def _paragraphs(c) -> Column:
    return F.transform(typed_blocks(c), lambda x: x["text"])


def _sentence_tokens(paragraph: Column) -> Column:
    """Tokens of each sentence of a paragraph (sentences without tokens dropped)."""
    marked = F.regexp_replace(paragraph, SENTENCE_END, "$1" + SENTENCE_MARK)
    return F.filter(F.transform(F.split(marked, SENTENCE_MARK), _tokens), lambda t: F.size(t) > 0)


def vertical_lines(c) -> Column:
    """One token per line, a blank line between sentences, ``<p>``/``</p>`` around paragraphs."""
    def paragraph(p: Column) -> Column:
        body = F.flatten(F.transform(_sentence_tokens(p), lambda toks, i: F.when(
            i > 0, F.concat(F.array(F.lit("")), toks)).otherwise(toks)))
        return F.concat(F.array(F.lit(PARAGRAPH_OPEN)), body, F.array(F.lit(PARAGRAPH_CLOSE)))
    return F.flatten(F.transform(_paragraphs(c), paragraph))


def tagged_lines(c) -> Column:
    """X3 + X4 in one pass: ``<p>``, ``<s>``, tokens, ``</s>`` between sentences, ``</s>``, ``</p>``.

    Equal to :func:`insert_sentence_tags` applied to :func:`vertical_lines`.
    """
    def paragraph(p: Column) -> Column:
        body = F.flatten(F.transform(_sentence_tokens(p), lambda toks, i: F.when(
            i > 0, F.concat(F.array(F.lit(SENTENCE_CLOSE), F.lit(SENTENCE_OPEN)), toks)).otherwise(toks)))
        return F.concat(F.array(F.lit(PARAGRAPH_OPEN), F.lit(SENTENCE_OPEN)), body,
                        F.array(F.lit(SENTENCE_CLOSE), F.lit(PARAGRAPH_CLOSE)))
    return F.flatten(F.transform(_paragraphs(c), paragraph))


def insert_sentence_tags(lines: DataFrame, key: Sequence[str], pos: str = "line_no",
                         line: str = "line") -> DataFrame:
    """X4 on exploded lines: ``<s>`` after ``<p>``, ``</s>`` before ``</p>``, a blank line
    inside a paragraph becomes ``</s>`` + ``<s>``, other blank lines are dropped.

    Returns ``(*key, pos, sub, line)``; ``sub`` orders the one or two lines an
    input line turns into. The paragraph state is the last ``<p>``/``</p>`` up
    to the line, found with a window over one text's lines.
    """
    marker = F.when(F.col(line).isin(PARAGRAPH_OPEN, PARAGRAPH_CLOSE), F.col(line))
    upto = Window.partitionBy(*key).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    state = lines.withColumn("_last", F.last(marker, ignorenulls=True).over(upto))
    in_par = F.coalesce(F.col("_last") == F.lit(PARAGRAPH_OPEN), F.lit(False))
    out = (F.when(F.col(line) == F.lit(PARAGRAPH_OPEN), F.array(F.lit(PARAGRAPH_OPEN), F.lit(SENTENCE_OPEN)))
           .when(F.col(line) == F.lit(PARAGRAPH_CLOSE), F.array(F.lit(SENTENCE_CLOSE), F.lit(PARAGRAPH_CLOSE)))
           .when((F.col(line) == F.lit("")) & in_par, F.array(F.lit(SENTENCE_CLOSE), F.lit(SENTENCE_OPEN)))
           .when(F.col(line) == F.lit(""), F.array().cast("array<string>"))
           .otherwise(F.array(F.col(line))))
    return state.select(*key, pos, F.posexplode(out).alias("sub", line))


def _meta_tags(meta: DataFrame, kind: str) -> DataFrame:
    """Opening tag of every post of a kind that has a metadata row: ``(kind, id, tag)``."""
    cols = [(c, F.col(c)) for c in meta.columns if c != "id"]
    return meta.select(F.lit(kind).alias("kind"), "id", render_open_tag(kind, [("id", F.col("id")), *cols]).alias("tag"))


def _live_posts(posts: DataFrame, thread_meta: DataFrame) -> DataFrame:
    """Posts with ``text_id`` whose thread has metadata (skewed threads are split by AQE: only this side is large)."""
    keyed = posts.withColumn("text_id", bare_id(F.col("link_id")))
    return keyed.join(thread_meta.select(F.col("id").alias("text_id")), "text_id", "left_semi")


def assemble_texts(posts: DataFrame, thread_meta: DataFrame, comment_meta: DataFrame,
                   submission_meta: DataFrame | None = None) -> DataFrame:
    """X5 + X6 + J9 + J10 + J11 + P15 + P16: the vertical corpus as ordered line rows.

    ``posts`` hold both kinds (``kind``, ``id``, ``link_id``, ``created_utc``,
    ``body``); ``thread_meta`` is keyed by the bare thread id (``id``),
    ``comment_meta`` and ``submission_meta`` by post id (one row for each id,
    see :func:`merge_metadata`); their other columns become attributes in
    column order. Of a post that occurs more than once the earliest copy is
    taken. Threads without metadata are left out, as are posts without metadata
    of their kind (see :func:`assembly_rejects`; without ``submission_meta``
    submissions need none); a thread without submission simply has no
    submission part. Missing metadata values render as ``NA``. Returns
    ``(text_id, part, created_utc, post_id, line_no, line)``; the opening and
    closing rows of a text have ``created_utc = 0`` and ``post_id = ''``.

    Both kinds of posts go through one scan, and copies and metadata meet them
    in one shuffle by ``(kind, id)``; a second, narrow scan lists the threads.
    """
    thread_cols = [c for c in thread_meta.columns if c != "id"]
    threads = posts.select(bare_id(F.col("link_id")).alias("text_id")).distinct()
    kept = threads.join(thread_meta.withColumnRenamed("id", "text_id"), "text_id", "inner")
    open_tag = render_open_tag("text", [("id", F.col("text_id")), *thread_cols])
    ends = F.array(F.struct(F.lit(PART_OPEN).alias("part"), open_tag.alias("line")),
                   F.struct(F.lit(PART_CLOSE).alias("part"), F.lit("</text>").alias("line")))
    frame = kept.select("text_id", F.explode(ends).alias("e")).select(
        "text_id", "e.part", F.lit(0).cast("bigint").alias("created_utc"), F.lit("").alias("post_id"),
        F.lit(0).alias("line_no"), "e.line")
    tags = _meta_tags(comment_meta, "comment")
    if submission_meta is not None:
        tags = tags.unionByName(_meta_tags(submission_meta, "submission"))
    live = _live_posts(posts, thread_meta).select("text_id", "kind", "id", "created_utc", "body")
    tagged = keep_first(live, ["kind", "id"], ["created_utc"]).join(tags, ["kind", "id"], "left")
    is_submission = F.col("kind") == F.lit("submission")
    if submission_meta is None:
        bare = render_open_tag("submission", [("id", F.col("id"))])
        tagged = tagged.withColumn("tag", F.when(is_submission, bare).otherwise(F.col("tag")))
    close = F.concat(F.lit("</"), F.col("kind"), F.lit(">"))
    content = F.concat(F.array("tag"), F.coalesce(tagged_lines(F.col("body")), F.array().cast("array<string>")),
                       F.array(close))
    lines = tagged.where(F.col("tag").isNotNull()).select(
        "text_id", F.when(is_submission, F.lit(PART_SUBMISSION)).otherwise(F.lit(PART_COMMENTS)).alias("part"),
        "created_utc", F.col("id").alias("post_id"), F.posexplode(content).alias("line_no", "line"))
    return frame.unionByName(lines)


def assembly_rejects(posts: DataFrame, thread_meta: DataFrame, comment_meta: DataFrame,
                     submission_meta: DataFrame | None = None) -> DataFrame:
    """Threads and posts left out of the corpus for missing metadata: ``(kind, id)``.

    Posts of a thread without metadata are covered by the thread's row.
    """
    threads = posts.select(bare_id(F.col("link_id")).alias("id")).distinct()
    no_meta = threads.join(thread_meta.select("id"), "id", "left_anti").select(F.lit("thread").alias("kind"), "id")
    known = comment_meta.select(F.lit("comment").alias("kind"), "id")
    live = _live_posts(posts, thread_meta).select("kind", "id")
    if submission_meta is None:
        live = live.where(F.col("kind") == "comment")
    else:
        known = known.unionByName(submission_meta.select(F.lit("submission").alias("kind"), "id"))
    return no_meta.unionByName(live.distinct().join(known, ["kind", "id"], "left_anti"))


def corpus_order() -> list[Column]:
    """Sort keys of assembled corpus lines."""
    return [F.col("text_id"), F.col("part"), F.col("created_utc"), F.col("post_id"), F.col("line_no")]


def merge_metadata(first: DataFrame, second: DataFrame, key: str = "id") -> DataFrame:
    """U3 + W8: concatenate two metadata tables; for a key in both, the first table's row wins.

    Columns missing on one side are NULL (rendered ``NA`` in tags). The pick is
    a partial ``min_by`` per key, so repeated keys are collapsed map-side.
    """
    tagged = first.withColumn("_src", F.lit(0)).unionByName(second.withColumn("_src", F.lit(1)),
                                                            allowMissingColumns=True)
    return keep_first(tagged, [key], ["_src"]).drop("_src")
