"""Registered queries of the file formats: each writes its rows, reads them back and returns what was read."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadcorpus.functions.text import blank_length
from threadcorpus.operators import corpus as C
from threadcorpus.operators import gather as G
from threadcorpus.operators import lang as L
from threadcorpus.operators import render as R
from threadcorpus.operators import threads as T
from threadcorpus.operators.joins import checked_join
from threadcorpus.operators.ordering import sorted_for_output
from threadcorpus.plans import catalog, jobs
from threadcorpus.plans import oracle as O
from threadcorpus.plans.catalog import (ASSEMBLY_VIEWS, PARSED_COLS, QueryFn, assembly, conv_json_lines, with_ctes)
from threadcorpus.plans.context import language_model
from threadcorpus.plans.fixtures import TARGET_LANGS, fixture
from threadcorpus.session import materialize
from threadcorpus.sources import readers, regions, sinks
from threadcorpus.streaming.stream import work_dir

QUERIES: dict[str, tuple[QueryFn, str]] = {}


def register(name: str, sql: str):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = (fn, sql)
        return fn
    return wrap


def write_dumps(spark: SparkSession, sf_dir: str, name: str = "posts_conv") -> tuple[str, str]:
    """Raw lines of both kinds of a thread fixture written as compressed dumps of one month: their paths."""
    base = work_dir(spark, "dump")
    lines = conv_json_lines(spark, sf_dir, name)
    comments, submissions = os.path.join(base, "RC_2014-01.gz"), os.path.join(base, "RS_2014-01.bz2")
    sinks.write_raw(lines.where(F.col("kind") == "comment"), comments, "value", "gzip")
    sinks.write_raw(lines.where(F.col("kind") == "submission"), submissions, "value", "bzip2")
    return comments, submissions


def dump_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dumps read as canonical posts."""
    comments, submissions = write_dumps(spark, sf_dir)
    return readers.read_posts(spark, [comments], "comment").unionByName(
        readers.read_posts(spark, [submissions], "submission"))


PARENT = "CASE WHEN kind = 'comment' AND turn = 3 THEN 'None' ELSE parent_id END"
BATCH = "CASE WHEN kind = 'comment' THEN 'RC_2014-01' ELSE 'RS_2014-01' END"


@register("file_posts", with_ctes(("posts_conv",)) + f"""
SELECT id, kind, link_id, {PARENT} AS parent_id, subreddit, subreddit_id, created_utc, author, body,
       '' AS is_submitter, '' AS permalink, false AS malformed, {BATCH} AS batch
FROM posts_conv""")
def q_file_posts(spark, sf_dir):
    """K1 + S1 + S2 + S10: gz and bz2 dumps, parsed, with the batch of their file."""
    return dump_posts(spark, sf_dir).select(*PARSED_COLS, readers.batch_key("file_path").alias("batch"))


@register("file_post_metadata", with_ctes(("posts_conv",)) + f"""
SELECT id, author, strftime(make_timestamp(created_utc * 1000000), '%Y-%m-%d %H:%M:%S') AS date, link_id,
       'NA' AS is_submitter, {PARENT} AS parent_id, 'NA' AS permalink, subreddit, subreddit_id, {BATCH} AS batch
FROM posts_conv""")
def q_file_post_metadata(spark, sf_dir):
    """K8 + S9: metadata of dumped posts, a folder for each batch."""
    path = work_dir(spark, "post-metadata")
    sinks.write_post_metadata(sinks.post_metadata(dump_posts(spark, sf_dir)), path)
    return readers.read_metadata(spark, path, sep=",")


LANG_ROWS = """SELECT id, concat('"', subreddit) AS subreddit,
  CASE WHEN doc_id % 7 = 0 THEN NULL ELSE gold = 'de' END AS german FROM {posts}"""


@register("file_lang_meta", with_ctes(("posts",)) + "\n" + LANG_ROWS.format(posts="posts"))
def q_file_lang_meta(spark, sf_dir):
    """K3 + S3: headerless label rows with missing labels and quotes in names."""
    path = work_dir(spark, "lang-meta")
    sinks.write_tsv(spark.sql(LANG_ROWS, posts=fixture(spark, sf_dir, "posts")), path, header=False)
    return readers.read_lang_meta(spark, path)


ODD_ROWS = """SELECT id, concat(' ', subreddit, chr(9), chr(92), 't', chr(13), chr(10), body, chr(92), chr(92), 'n', chr(92), '" ') AS title,
  CASE WHEN doc_id % 5 = 0 THEN NULL ELSE concat(chr(9), gold, chr(10)) END AS author FROM {posts}"""


@register("file_odd_values", with_ctes(("posts",)) + "\n" + ODD_ROWS.format(posts="posts"))
def q_file_odd_values(spark, sf_dir):
    """K3 + S9: whole texts with tabs, line ends, quotes and backslashes as values of a tab-separated table."""
    path = work_dir(spark, "odd-values")
    sinks.write_tsv(spark.sql(ODD_ROWS, posts=fixture(spark, sf_dir, "posts")), path)
    return readers.read_tsv(spark, path)


POST_ROWS = """SELECT id, kind = 'submission' AS submission, CASE WHEN turn % 3 = 0 THEN NULL ELSE 'de' END AS language,
  created_utc, concat(subreddit, '"') AS subreddit, subreddit_id, link_id, {parent} AS parent_id FROM {posts_conv}"""


@register("file_post_meta", with_ctes(("posts_conv",)) + "\n"
          + POST_ROWS.format(posts_conv="posts_conv", parent="nullif(parent_id, 'None')"))
def q_file_post_meta(spark, sf_dir):
    """K3 + S4: post meta rows with a header; ``None`` is a missing value."""
    path = work_dir(spark, "post-meta")
    rows = spark.sql(POST_ROWS.replace("{parent}", "parent_id"), posts_conv=fixture(spark, sf_dir, "posts_conv"))
    sinks.write_tsv(rows, path)
    return readers.read_post_meta(spark, path)


STAT_ROWS = """SELECT concat(subreddit, ', "', CAST(count(*) AS STRING), '"') AS subreddit,
  CAST(count(CASE WHEN gold = 'de' THEN 1 END) AS BIGINT) AS corpus_N, CAST(count(*) AS BIGINT) AS corpus_total,
  count(CASE WHEN gold = 'de' THEN 1 END) / CAST(count(*) AS DOUBLE) AS corpus_prop FROM {posts} GROUP BY subreddit"""


@register("file_subreddit_stats", with_ctes(("posts",)) + "\n" + STAT_ROWS.format(posts="posts"))
def q_file_subreddit_stats(spark, sf_dir):
    """K4 + S5: community statistics, commas and quotes in names."""
    path = work_dir(spark, "subreddit-stats")
    sinks.write_csv(spark.sql(STAT_ROWS, posts=fixture(spark, sf_dir, "posts")), path)
    return readers.read_subreddit_stats(spark, path)


@register("file_keys", with_ctes(("posts_conv_dup",)) + """
SELECT DISTINCT 'list' AS source, id AS key FROM posts_conv_dup
UNION ALL SELECT DISTINCT 'column' AS source, link_id AS key FROM posts_conv_dup""")
def q_file_keys(spark, sf_dir):
    """K2 + K3 + S6: distinct keys from an id list and from a column of a table."""
    ids, table = work_dir(spark, "ids"), work_dir(spark, "key-table")
    posts = fixture(spark, sf_dir, "posts_conv_dup")
    sinks.write_keys(posts, ids)
    sinks.write_tsv(posts.select("id", "link_id"), table)
    listed = readers.read_keys(spark, ids).select(F.lit("list").alias("source"), F.col("id").alias("key"))
    return listed.unionByName(readers.read_keys(spark, table, "link_id").select(
        F.lit("column").alias("source"), F.col("link_id").alias("key")))


@register("file_threads", with_ctes(("posts_conv",)) + """
SELECT CAST(0 AS INTEGER) AS pos, id, link_id, body FROM posts_conv
UNION ALL SELECT CAST(1 AS INTEGER) AS pos, concat(id, '_reply') AS id, link_id, NULL AS body FROM posts_conv""")
def q_file_threads(spark, sf_dir):
    """Lines holding an array of posts (here a post and an empty reply), a row for each post."""
    path = work_dir(spark, "threads")
    posts = fixture(spark, sf_dir, "posts_conv")
    pair = F.array(F.struct("id", "link_id", "body"),
                   F.struct(F.concat("id", F.lit("_reply")).alias("id"), "link_id",
                            F.lit(None).cast("string").alias("body")))
    sinks.write_raw(posts.select(F.to_json(pair).alias("raw")), path)
    return readers.read_threads(spark, path).select("pos", "id", "link_id", "body")


@register("file_post_records", with_ctes(("posts_conv",)) + """
SELECT id, kind, link_id, created_utc, nullif(parent_id, 'None') AS parent_id, body FROM posts_conv""")
def q_file_post_records(spark, sf_dir):
    """K5: one JSON object for each post, in thread order."""
    path = work_dir(spark, "post-records")
    posts = fixture(spark, sf_dir, "posts_conv").select(
        "id", "kind", "link_id", "created_utc",
        F.when(F.col("parent_id") != "None", F.col("parent_id")).alias("parent_id"), "body")
    sinks.write_post_records(posts, path)
    return spark.read.schema(posts.schema).json(path)


@register("file_post_lengths", with_ctes(("posts_conv",)) + """
SELECT link_id, kind, id, author = 'user' AS member, CAST(len(string_split(body, ' ')) AS BIGINT) AS length
FROM posts_conv""")
def q_file_post_lengths(spark, sf_dir):
    """A11 + K6: mark and length of every post of a thread, a JSON object for each."""
    path = work_dir(spark, "post-lengths")
    rows = fixture(spark, sf_dir, "posts_conv").select(
        "link_id", "kind", "id", (F.col("author") == "user").alias("member"),
        blank_length("body").cast("bigint").alias("length"))
    sinks.write_json_records(rows, path)
    return spark.read.schema(rows.schema).json(path)


THREAD_PLACES = """placed AS (SELECT *, row_number() OVER w AS pos, coalesce(sum({size}) OVER
  (PARTITION BY link_id ORDER BY created_utc, kind = 'submission', id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bytes
  FROM posts_conv WINDOW w AS (PARTITION BY link_id ORDER BY created_utc, kind = 'submission', id))"""


@register("file_gathered_threads", with_ctes(("posts_conv",), THREAD_PLACES.format(size="strlen(body)")) + """
SELECT link_id, CAST(bytes // 2000 AS BIGINT) AS chunk, CAST(pos AS BIGINT) AS pos, kind, id, body FROM placed""")
def q_file_gathered_threads(spark, sf_dir):
    """A10 + K5 + S7: threads gathered in order, in chunks of about 2,000 bytes, written and read back."""
    path = work_dir(spark, "gathered")
    chunks = G.gather_threads(fixture(spark, sf_dir, "posts_conv"), ["kind", "id", "body"], chunk_bytes=2000)
    sinks.write_threads(chunks, path)
    return G.thread_posts(readers.read_gathered(spark, path, chunks.schema))


@register("file_thread_lale", with_ctes(("posts_conv",), THREAD_PLACES.format(size="16")) + """
, rows AS (SELECT link_id, CAST(bytes // 32 AS BIGINT) AS chunk, author = 'user' AS label,
                  CAST(len(string_split(body, ' ')) AS BIGINT) AS length FROM placed)
SELECT link_id, CAST(count(DISTINCT chunk) AS BIGINT) AS n_chunks, CAST(count(*) AS BIGINT) AS n_posts,
       CAST(coalesce(sum(CASE WHEN label THEN length END), 0) AS BIGINT) AS target, CAST(sum(length) AS BIGINT) AS total
FROM rows GROUP BY link_id""")
def q_file_thread_lale(spark, sf_dir):
    """A11 + K6: label and length of the posts of each thread, two posts a chunk, written, read back and summed."""
    path = work_dir(spark, "lale")
    chunks = G.gather_lengths(fixture(spark, sf_dir, "posts_conv"), F.col("author") == "user",
                              blank_length("body").cast("bigint"), chunk_bytes=32)
    sinks.write_threads(chunks, path)
    back = readers.read_gathered(spark, path, chunks.schema)
    return G.length_shares(back).join(back.groupBy("link_id").agg(F.count("*").alias("n_chunks")), "link_id")


@register("drop_orphans", with_ctes(("posts_conv",)) + """
SELECT id, kind FROM posts_conv WHERE NOT (kind = 'submission' AND created_utc % 3 = 0)""")
def q_drop_orphans(spark, sf_dir):
    """submissions without a community id (advertisements) dropped; comments without one stay."""
    posts = fixture(spark, sf_dir, "posts_conv").withColumn(
        "subreddit_id", F.when(F.col("created_utc") % 3 != 0, F.col("subreddit_id")))
    return readers.drop_orphans(posts).select("id", "kind")


@register("label_hook", with_ctes(("posts_conv",)) + """
SELECT id, CASE WHEN length(body) % 2 = 0 THEN 'even' ELSE 'odd' END AS label
FROM (SELECT id, """ + O.sanitize("body") + """ AS body FROM posts_conv)""")
def q_label_hook(spark, sf_dir):
    """A classifier that is loaded once a task and labels batches of texts."""
    def load():
        names = {0: "even", 1: "odd"}
        return lambda texts: (texts.str.len() % 2).map(names)
    return L.label_with_model(fixture(spark, sf_dir, "posts_conv"), load)


@register("file_xml_corpus", with_ctes(("posts_markup",), O.entity_cte()) + f"""
SELECT id, {O.escape_spoilers(O.decode_entities(O.markdown_html(O.xml_unescape('body'))))} AS html
FROM posts_markup, emap""")
def q_file_xml_corpus(spark, sf_dir):
    """K7 + S8: rendered posts written as XML files, their regions read back."""
    path = work_dir(spark, "xml")
    sinks.write_xml_corpus(R.render_posts(fixture(spark, sf_dir, "posts_markup")), path)
    regions = readers.read_regions(spark, path, "text")
    return regions.select(F.col("attrs")["id"].alias("id"), F.array_join("lines", "\n").alias("html"))


@register("file_vertical", with_ctes(ASSEMBLY_VIEWS, assembly()) + """
, placed AS (SELECT *, row_number() OVER (ORDER BY text_id, part, created_utc, post_id, line_no) - 1 AS line_no_all
       FROM corpus_lines)
SELECT text_id, CAST(line_no_all AS BIGINT) AS line_no,
       CAST(line_no_all - min(line_no_all) OVER (PARTITION BY text_id) AS BIGINT) AS pos,
       CAST(CASE WHEN part = 2 THEN dense_rank() OVER (PARTITION BY part ORDER BY text_id, created_utc, post_id) - 1 END AS BIGINT)
         AS comment_no, line
FROM placed""")
def q_file_vertical(spark, sf_dir):
    """K9 + S8: the vertical corpus written in order; every line read back with its place, text and comment."""
    path = work_dir(spark, "vertical")
    lines = C.assemble_texts(*(fixture(spark, sf_dir, v) for v in ASSEMBLY_VIEWS))
    sinks.write_vertical(lines, path)
    found = regions.region_lines(spark, path, ["text", "comment"])
    texts = regions.region_table(found, "text").select(
        F.col("region").alias("text"), F.col("attrs")["id"].alias("text_id"), "first_line")
    return checked_join(found, materialize(texts), "text").select(
        "text_id", "line_no", (F.col("line_no") - F.col("first_line")).alias("pos"), F.col("comment").alias("comment_no"), "line")


@register("file_sentence_tags", with_ctes(("posts_conv",)) + f"""
, v AS (SELECT id, {O.vertical_lines('body')} AS lines FROM posts_conv),
x AS (SELECT id, CAST(unnest(range(len(lines))) AS INTEGER) AS n, unnest(lines) AS line FROM v),
g AS (SELECT row_number() OVER (ORDER BY id, n) - 1 AS line_no, line FROM x),
st AS (SELECT *, last_value(CASE WHEN line IN ('<p>', '</p>') THEN line END IGNORE NULLS)
                 OVER (ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_m FROM g),
o AS (SELECT line_no, CASE WHEN line = '<p>' THEN ['<p>', '<s>'] WHEN line = '</p>' THEN ['</s>', '</p>']
                           WHEN line = '' AND coalesce(last_m = '<p>', false) THEN ['</s>', '<s>']
                           WHEN line = '' THEN []::VARCHAR[] ELSE [line] END AS arr FROM st)
SELECT CAST(line_no AS BIGINT) AS line_no, CAST(unnest(range(len(arr))) AS INTEGER) AS sub, unnest(arr) AS line FROM o""")
def q_file_sentence_tags(spark, sf_dir):
    """X4 on vertical files: sentence tags by the scan over files and tasks."""
    path = work_dir(spark, "untagged")
    lines = fixture(spark, sf_dir, "posts_conv").select("id", F.posexplode(C.vertical_lines(F.col("body"))).alias("n", "line"))
    sorted_for_output(lines, ["id"], ["n"]).select("line").write.text(path, compression="gzip")
    return regions.tag_sentences(spark, path)


@register("pending_batches", with_ctes(("posts",)) + f"""
SELECT DISTINCT {O.month('created_utc')} AS batch FROM posts
EXCEPT SELECT {O.month('created_utc')} AS batch FROM posts WHERE created_utc < 1277942400""")
def q_pending_batches(spark, sf_dir):
    """Months that a key table on disk does not hold yet."""
    from threadcorpus.functions.text import epoch_month
    path = work_dir(spark, "done")
    months = fixture(spark, sf_dir, "posts").select(epoch_month(F.col("created_utc")).alias("batch"), "created_utc")
    sinks.write_tsv(months.where(F.col("created_utc") < 1277942400).select("batch"), path)
    return sinks.pending_batches(months.select("batch").distinct(), readers.read_keys(spark, path, "batch"))


@register("key_union", with_ctes(("posts_conv",)) + """
SELECT DISTINCT link_id FROM posts_conv""")
def q_key_union(spark, sf_dir):
    """Thread keys of both kinds' tables united."""
    posts = fixture(spark, sf_dir, "posts_conv")
    return T.union_keys(posts.where(F.col("kind") == "comment"), posts.where(F.col("kind") == "submission"))


# ------------------------------------------------------- whole jobs from files to files

SECOND_HALF = 1277942400
HALF_META = catalog.META.replace(O.month("p.created_utc"),
                                 f"CASE WHEN p.created_utc < {SECOND_HALF} THEN '2010-01' ELSE '2010-07' END")


def write_comment_dumps(spark: SparkSession, sf_dir: str) -> list[str]:
    """Comments with a known language written as two dumps, one for each half of the year."""
    base = work_dir(spark, "comments")
    posts = fixture(spark, sf_dir, "posts")
    value = F.to_json(F.struct("id", "body", "link_id", "subreddit", "subreddit_id", "created_utc")).alias("raw")
    first, second = os.path.join(base, "RC_2010-01.gz"), os.path.join(base, "RC_2010-07.bz2")
    sinks.write_raw(posts.where(F.col("created_utc") < SECOND_HALF).select(value), first)
    sinks.write_raw(posts.where(F.col("created_utc") >= SECOND_HALF).select(value), second, compression="bzip2")
    return [first, second]


def labelled_dumps(spark: SparkSession, sf_dir: str) -> tuple[list[str], str]:
    """G1 applied to the comment dumps: their paths, and the folder of its results."""
    dumps, out = write_comment_dumps(spark, sf_dir), work_dir(spark, "label-job")
    # The first month, then both: the second run reads the new month only.
    for known in (dumps[:1], dumps):
        jobs.label_comments(spark, known, language_model(spark, sf_dir), out)
    return dumps, out


@register("job_label_comments", with_ctes(("posts",), catalog.MODEL, catalog.SINGLE) + f"""
SELECT p.id, p.subreddit, l.label AS german, l.label IS TRUE AS listed,
       CASE WHEN p.created_utc < {SECOND_HALF} THEN 'RC_2010-01' ELSE 'RC_2010-07' END AS batch,
       CASE WHEN l.label THEN p.body END AS body
FROM posts p JOIN labels l USING (id)""")
def q_job_label_comments(spark, sf_dir):
    """G1: dumps to labels, original lines and ids; all three read back."""
    _, out = labelled_dumps(spark, sf_dir)
    meta = readers.read_lang_meta(spark, os.path.join(out, "meta"))
    ids = readers.read_keys(spark, os.path.join(out, "ids")).withColumn("_listed", F.lit(True))
    raw = readers.parse_posts(spark.read.text(os.path.join(out, "raw")), "comment").select("id", "body")
    return meta.join(ids, "id", "left").join(raw, "id", "left").select(
        "id", "subreddit", "german", F.col("_listed").isNotNull().alias("listed"), "batch", "body")


@register("job_communities", with_ctes(("posts",), catalog.MODEL, catalog.SINGLE, HALF_META, catalog.MONTHLY,
                                       catalog.CORPUS) + f"""
SELECT * FROM corpus WHERE corpus_N > 1 AND corpus_prop >= {O.threshold('corpus_total')}""")
def q_job_communities(spark, sf_dir):
    """G1 + G2: dumps to the communities over the threshold."""
    _, out = labelled_dumps(spark, sf_dir)
    jobs.community_statistics(spark, os.path.join(out, "meta"), out)
    return readers.read_subreddit_stats(spark, os.path.join(out, "selected"))


SCORE_ROWS = ("link_id STRING, subreddit STRING, prior DOUBLE, n_posts BIGINT, target_words BIGINT, all_words BIGINT, "
              "score DOUBLE, selected BOOLEAN")


@register("job_select_threads", catalog.QUERIES["thread_word_scores"][1].replace(catalog.META, HALF_META))
def q_job_select_threads(spark, sf_dir):
    """G1 + G2 + G3: dumps to the scores of their threads."""
    dumps, out = labelled_dumps(spark, sf_dir)
    jobs.community_statistics(spark, os.path.join(out, "meta"), out)
    jobs.select_threads(spark, dumps, [], os.path.join(out, "ids"), os.path.join(out, "selected"),
                        os.path.join(out, "threads"))
    return readers.read_tsv(spark, os.path.join(out, "threads", "scores"), SCORE_ROWS)


@register("job_thread_lines", with_ctes(("posts_conv",), """
scores AS (SELECT link_id, sum(CASE WHEN author = 'user' THEN len(string_split(body, ' ')) ELSE 0 END)
                  / CAST(sum(len(string_split(body, ' '))) AS DOUBLE) AS score
           FROM posts_conv WHERE kind = 'comment' GROUP BY link_id HAVING count(CASE WHEN author = 'user' THEN 1 END) > 0)""") + """
SELECT kind, id, link_id, body FROM posts_conv
WHERE CASE WHEN kind = 'submission' THEN 't3_' || string_split(id, '_')[-1] ELSE link_id END
      IN (SELECT link_id FROM scores WHERE score >= 0.1)""")
def q_job_thread_lines(spark, sf_dir):
    """Original lines of both kinds of the selected threads, from dumps of both kinds, read back."""
    comments, submissions = write_dumps(spark, sf_dir)
    out, posts = work_dir(spark, "line-job"), fixture(spark, sf_dir, "posts_conv")
    sinks.write_keys(posts.where((F.col("kind") == "comment") & (F.col("author") == "user")), os.path.join(out, "ids"))
    sinks.write_csv(posts.select("subreddit").distinct().select(
        "subreddit", F.lit(1).alias("corpus_N"), F.lit(1).alias("corpus_total"), F.lit(1.0).alias("corpus_prop")),
        os.path.join(out, "communities"))
    jobs.select_threads(spark, [comments], [submissions], os.path.join(out, "ids"), os.path.join(out, "communities"), out)
    kinds = [readers.parse_posts(spark.read.text(os.path.join(out, f"{k}s")), k) for k in ("comment", "submission")]
    return T.all_posts(*kinds).select("kind", "id", "link_id", "body")


@register("job_threads_by_language", catalog.QUERIES["thread_extract"][1])
def q_job_threads_by_language(spark, sf_dir):
    """Dumps of both kinds, with copies, to ordered posts of the threads of each language."""
    comments, submissions = write_dumps(spark, sf_dir, "posts_conv_dup")
    out = work_dir(spark, "language-job")
    jobs.threads_by_language(spark, [comments], [submissions], language_model(spark, sf_dir), TARGET_LANGS, out)
    return spark.read.schema("lang STRING, link_id STRING, id STRING, kind STRING, created_utc BIGINT, pos BIGINT") \
        .json(os.path.join(out, "posts"))


@register("job_render_corpus", with_ctes(
    ("posts_conv_dup", "thread_meta"),
    "posts_open AS (SELECT id, kind, link_id, created_utc, author, body FROM posts_conv_dup)",
    "comment_meta AS (SELECT DISTINCT id, author FROM posts_open WHERE kind = 'comment')",
    "submission_meta AS (SELECT DISTINCT id, author FROM posts_open WHERE kind = 'submission')",
    assembly(["author"])) + """
SELECT line, CAST(count(*) AS BIGINT) AS n FROM corpus_lines GROUP BY line""")
def q_job_render_corpus(spark, sf_dir):
    """Dumps and thread metadata to the vertical corpus; its lines counted."""
    comments, submissions = write_dumps(spark, sf_dir, "posts_conv_dup")
    threads, out = work_dir(spark, "thread-table"), work_dir(spark, "render-job")
    sinks.write_tsv(fixture(spark, sf_dir, "thread_meta"), threads)
    jobs.render_corpus(spark, [comments], [submissions], threads, out, ["author"])
    return spark.read.text(os.path.join(out, "vertical")).groupBy(F.col("value").alias("line")).agg(
        F.count("*").alias("n"))


def oracle() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items()}


def queries() -> dict[str, QueryFn]:
    return {name: fn for name, (fn, _) in QUERIES.items()}
