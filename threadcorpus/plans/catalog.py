"""Registered queries: one per operator family, each with its DuckDB oracle.

Every query reads the driver tables (through the fixture views) and runs the
library operators on all rows. ``QUERIES[name] = (fn(spark, sf_dir), sql)``;
``sql`` is None where no SQL restatement exists (checked by unit tests).
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadcorpus.functions import markup as M
from threadcorpus.functions import nested as N
from threadcorpus.functions.text import blank_length, epoch_month, is_too_short, sanitize, words
from threadcorpus.operators import corpus as C
from threadcorpus.operators import evaluate as E
from threadcorpus.operators import features as FT
from threadcorpus.operators import lang as L
from threadcorpus.operators import render as R
from threadcorpus.operators import stats as S
from threadcorpus.operators import threads as T
from threadcorpus.plans import oracle as O
from threadcorpus.plans.context import MODEL_LANGS, label_meta, language_model, multi_meta, single_labels
from threadcorpus.plans.fixtures import TARGET_LANGS, fixture, oracle_views
from threadcorpus.session import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = (fn, sql)
        return fn
    return wrap


def with_ctes(views: tuple[str, ...], *ctes: str) -> str:
    head = oracle_views(*views)
    parts = [c.strip().rstrip(",") for c in ctes if c.strip()]
    if not head:
        return "WITH " + ",\n".join(parts)
    return head + (",\n" + ",\n".join(parts) if parts else "")


MODEL = O.model_ctes()
SINGLE = O.single_label_ctes("posts", "labels")
META = f"""meta AS (SELECT p.id, p.subreddit, {O.month('p.created_utc')} AS month, l.label
                  FROM posts p JOIN labels l USING (id))"""

# ------------------------------------------------------------------ text

LINKS_VIEW = """SELECT p.id, CASE WHEN g.url IS NULL THEN p.body
                   ELSE concat(p.body, ' see (', g.url, ') or ', g.url, ' end') END AS body
  FROM {posts} p LEFT JOIN {pages} g ON g.page_id = p.doc_id"""


def posts_with_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts whose bodies carry page URLs (stand-in input for URL removal)."""
    return spark.sql(LINKS_VIEW, posts=fixture(spark, sf_dir, "posts"),
                     pages=read_table(spark, sf_dir, "pages"))


@register("sanitize_text", with_ctes(("posts",), f"links AS ({LINKS_VIEW.format(posts='posts', pages='pages')})",
                                     f"clean AS (SELECT id, {O.sanitize('body')} AS clean, body FROM links)") + f"""
SELECT id, clean, {O.too_short('clean')} AS too_short,
       CAST(len({O.words('clean')}) AS BIGINT) AS n_words,
       CAST(len(string_split(body, ' ')) AS BIGINT) AS blank_len
FROM clean""")
def q_sanitize_text(spark, sf_dir):
    """Sanitize bodies (URLs, line breaks), short test, word count, blank-split length."""
    posts = posts_with_links(spark, sf_dir)
    clean = posts.select("id", "body", sanitize("body").alias("clean"))
    return clean.select("id", "clean", is_too_short("clean").alias("too_short"),
                        F.size(words("clean")).cast("bigint").alias("n_words"),
                        blank_length("body").cast("bigint").alias("blank_len"))


# --------------------------------------------------------------- language (L, A9)

@register("lexicon", with_ctes((), MODEL) + "\nSELECT lang, word, n_docs FROM lex")
def q_lexicon(spark, sf_dir):
    """L1: lexicon of words in >= 3 documents per language."""
    return L.build_lexicon(read_table(spark, sf_dir, "documents"))


RATES_INPUT = f"""rin AS (SELECT id, {O.sanitize('body')} AS clean FROM posts),
rin_long AS (SELECT id, clean FROM rin WHERE NOT {O.too_short('clean')})"""


@register("error_rates", with_ctes(("posts",), MODEL, RATES_INPUT,
                                   O.error_rate_ctes("rin_long", "rates", MODEL_LANGS))
          + "\nSELECT * FROM rates")
def q_error_rates(spark, sf_dir):
    """A9 + J8: per post dictionary error rate for each language."""
    posts = fixture(spark, sf_dir, "posts").select("id", sanitize("body").alias("clean"))
    model = language_model(spark, sf_dir)
    return L.error_rates(posts, model.index, MODEL_LANGS, index_rows=model.index_rows,
                         skip=is_too_short("clean"))


@register("unknown_words_de", with_ctes(("posts",), MODEL, RATES_INPUT) + f"""
, uw AS (SELECT id, lower(unnest({O.words('clean')})) AS word FROM rin_long),
uf AS (SELECT id, word, count(*) AS freq FROM uw GROUP BY id, word)
SELECT word, CAST(count(*) AS BIGINT) AS n_posts, CAST(sum(freq) AS BIGINT) AS n_occurrences
FROM uf WHERE word NOT IN (SELECT word FROM lexidx WHERE in_de = 1) GROUP BY word""")
def q_unknown_words(spark, sf_dir):
    """J8 anti form: words of the posts absent from the German lexicon."""
    posts = fixture(spark, sf_dir, "posts").select("id", sanitize("body").alias("clean"))
    model = language_model(spark, sf_dir)
    return L.unknown_words(posts.where(~is_too_short("clean")), model.index, "de")


@register("langid_profile", with_ctes((), MODEL) + "\nSELECT lang, gram, lp FROM ng_lp")
def q_langid_profile(spark, sf_dir):
    """L2 training: add-one smoothed trigram log-probabilities per language."""
    return L.profile_rows(language_model(spark, sf_dir).profile)


@register("langid_documents", with_ctes((), MODEL,
                                        f"din AS (SELECT doc_id AS id, {O.sanitize('text')} AS clean FROM documents)",
                                        O.langid_ctes("din", "lid")) + """
SELECT d.doc_id, d.lang AS gold, l.langid, l.langid_score
FROM documents d LEFT JOIN lid l ON l.id = d.doc_id""")
def q_langid_documents(spark, sf_dir):
    """L2 scoring: most probable language of every document (whole texts; NULL for texts without a trigram)."""
    docs = read_table(spark, sf_dir, "documents")
    clean = docs.select(F.col("doc_id").alias("id"), sanitize("text").alias("clean"))
    lid = L.score_langid(clean, language_model(spark, sf_dir).profile)
    return docs.select("doc_id", F.col("lang").alias("gold")).join(
        lid.withColumnRenamed("id", "doc_id"), "doc_id", "left")


@register("label_single", with_ctes(("posts",), MODEL, SINGLE) + "\nSELECT id, label FROM labels")
def q_label_single(spark, sf_dir):
    """L3 + L5: one-target (German) label of every post: NULL, true or false."""
    return single_labels(spark, sf_dir)


@register("label_multi", with_ctes(("posts",), MODEL, O.multi_label_ctes("posts", "ml"))
          + "\nSELECT id, language FROM ml")
def q_label_multi(spark, sf_dir):
    """L4 + L5: many-target label (de, fr, es, other or NULL) of every post."""
    posts = fixture(spark, sf_dir, "posts")
    return L.label_multi(posts, language_model(spark, sf_dir), TARGET_LANGS)


# ------------------------------------------------------------ statistics (A1-A3)

@register("label_counts", with_ctes(("posts",), MODEL, SINGLE, META) + """
SELECT month, subreddit, label, CAST(count(*) AS BIGINT) AS n FROM meta GROUP BY month, subreddit, label""")
def q_label_counts(spark, sf_dir):
    """A1: posts per month, community and label."""
    return S.label_counts(label_meta(spark, sf_dir))


MONTHLY = """monthly AS (SELECT month, subreddit, CAST(count_if(label) AS BIGINT) AS n,
                            CAST(count(*) AS BIGINT) AS total, count_if(label) / count(*) AS prop
                     FROM meta GROUP BY month, subreddit HAVING count_if(label) > 0)"""
CORPUS = """corpus AS (SELECT subreddit, CAST(sum(n) AS BIGINT) AS corpus_N, CAST(sum(total) AS BIGINT) AS corpus_total,
                          sum(n) / sum(total) AS corpus_prop FROM monthly GROUP BY subreddit)"""


@register("monthly_share", with_ctes(("posts",), MODEL, SINGLE, META, MONTHLY) + "\nSELECT * FROM monthly")
def q_monthly_share(spark, sf_dir):
    """A2 + F6: monthly share of German posts per community (communities with >= 1)."""
    return S.monthly_share(label_meta(spark, sf_dir))


@register("monthly_share_window", with_ctes(("posts",), MODEL, SINGLE, META) + """
, c AS (SELECT month, subreddit, label, count(*) AS n FROM meta GROUP BY ALL),
s AS (SELECT *, sum(n) OVER (PARTITION BY month, subreddit) AS total FROM c)
SELECT month, subreddit, CAST(n AS BIGINT) AS n, CAST(total AS BIGINT) AS total, n / total AS prop
FROM s WHERE label""")
def q_monthly_share_window(spark, sf_dir):
    """A1 + W1 + F6: the same share through counts per label and a window total."""
    counts = S.label_counts(label_meta(spark, sf_dir))
    shared = S.with_share(counts, ["month", "subreddit"])
    return shared.where(F.col("label")).select(
        "month", "subreddit", "n", F.col("total").cast("bigint").alias("total"), "prop")


@register("monthly_rank", with_ctes(("posts",), MODEL, SINGLE, META, MONTHLY) + """
SELECT month, subreddit, n, prop,
       CAST(row_number() OVER (PARTITION BY month ORDER BY n DESC, prop DESC, subreddit) AS BIGINT) AS rank
FROM monthly""")
def q_monthly_rank(spark, sf_dir):
    """Rank of each community within its month."""
    ranked = S.rank_monthly(S.monthly_share(label_meta(spark, sf_dir)))
    return ranked.select("month", "subreddit", "n", "prop", F.col("rank").cast("bigint"))


@register("corpus_share", with_ctes(("posts",), MODEL, SINGLE, META, MONTHLY, CORPUS) + "\nSELECT * FROM corpus")
def q_corpus_share(spark, sf_dir):
    """A3: corpus totals over the months with a positive post."""
    return S.corpus_share(S.monthly_share(label_meta(spark, sf_dir)))


@register("top_communities", with_ctes(("posts",), MODEL, SINGLE, META, MONTHLY, CORPUS) + """
SELECT * FROM corpus ORDER BY corpus_N DESC, corpus_prop DESC, subreddit LIMIT 5""")
def q_top_communities(spark, sf_dir):
    """Top-5 communities by positives, then share (a top-k report)."""
    return S.top_communities(S.corpus_share(S.monthly_share(label_meta(spark, sf_dir))), 5)


@register("community_filter", with_ctes(("posts",), MODEL, SINGLE, META, MONTHLY, CORPUS) + f"""
SELECT subreddit, corpus_N, corpus_total, corpus_prop, round({O.threshold('corpus_total')}, 6) AS threshold
FROM corpus WHERE corpus_N > 1 AND corpus_prop >= {O.threshold('corpus_total')}""")
def q_community_filter(spark, sf_dir):
    """F3 + P9: communities passing the size-dependent share threshold."""
    corpus = S.corpus_share(S.monthly_share(label_meta(spark, sf_dir)))
    kept = S.filter_communities(corpus)
    return kept.select("subreddit", "corpus_N", "corpus_total", "corpus_prop",
                       F.round("threshold", 6).alias("threshold"))


YEAR_2010 = [f"2010-{m:02d}" for m in range(1, 13)]


@register("monthly_wide", with_ctes(("posts",), MODEL, SINGLE, META, MONTHLY, CORPUS) + "\nSELECT c.subreddit, c.corpus_N, c.corpus_total, c.corpus_prop, " + ", ".join(
    f"""max(CASE WHEN m.month = '{m}' THEN m.n END) AS "RC_{m}_N", max(CASE WHEN m.month = '{m}' THEN m.total END) AS "RC_{m}_total", max(CASE WHEN m.month = '{m}' THEN m.prop END) AS "RC_{m}_prop\""""
    for m in [f"2010-{k:02d}" for k in range(1, 13)]) + """
FROM corpus c JOIN monthly m USING (subreddit) GROUP BY c.subreddit, c.corpus_N, c.corpus_total, c.corpus_prop""")
def q_monthly_wide(spark, sf_dir):
    """J4 + U4 + A3: one row per community, corpus totals then a (N, total, prop) triple per month of 2010."""
    return S.community_stats(S.monthly_share(label_meta(spark, sf_dir)), YEAR_2010)


# ------------------------------------------------------- threads, count based

ML_CONV = O.multi_label_ctes("posts_conv_dup", "ml")
CONV_META = "cmeta AS (SELECT p.*, ml.language FROM posts_conv_dup p LEFT JOIN ml USING (id))"


def _long_union(base: str, langs, cols: str, extra: str = "") -> str:
    parts = []
    for l in langs:
        sel = cols.format(l=l)
        parts.append(f"SELECT '{l}' AS lang, {sel} FROM {base} WHERE t_{l} > 0")
    return " UNION ALL ".join(parts)


CS_BASE = "cs_base AS (SELECT subreddit_id, count(*) AS total, " + ", ".join(
    f"count_if(language = '{l}') AS t_{l}" for l in TARGET_LANGS) + " FROM cmeta GROUP BY subreddit_id)"
CS = f"""cs AS (SELECT lang, subreddit_id, CAST(target AS BIGINT) AS target, CAST(total AS BIGINT) AS total,
                   target / total AS fraction, {O.threshold('total')} AS threshold,
                   target / total >= {O.threshold('total')} AS exceeded
            FROM ({_long_union('cs_base', TARGET_LANGS, 'subreddit_id, t_{l} AS target, total')}) u)"""
TS_BASE = "ts_base AS (SELECT link_id, count(*) AS total, " + ", ".join(
    f"count_if(language = '{l}') AS t_{l}, max(CASE WHEN language = '{l}' THEN subreddit_id END) AS sid_{l}"
    for l in TARGET_LANGS) + " FROM cmeta GROUP BY link_id)"
TS = f"""ts AS (SELECT t.lang, t.link_id, t.subreddit_id, CAST(t.target AS BIGINT) AS target,
                   CAST(t.total AS BIGINT) AS total, t.target / t.total AS fraction,
                   c.fraction AS subreddit_fraction, (t.target / t.total) * c.fraction AS score,
                   (t.target / t.total) * c.fraction >= 0.1 AS exceeded
            FROM ({_long_union('ts_base', TARGET_LANGS, 'link_id, t_{l} AS target, total, sid_{l} AS subreddit_id')}) t
            JOIN cs c ON c.lang = t.lang AND c.subreddit_id = t.subreddit_id)"""
G4 = (("posts_conv_dup",), MODEL, ML_CONV, CONV_META, CS_BASE, CS)


def _conv_meta(spark, sf_dir):
    return multi_meta(spark, sf_dir, "posts_conv_dup")


def _community(spark, sf_dir):
    return S.community_scores(_conv_meta(spark, sf_dir), TARGET_LANGS)


def _thread_scores(spark, sf_dir):
    meta = _conv_meta(spark, sf_dir)
    return S.thread_scores(meta, _community(spark, sf_dir), TARGET_LANGS)


@register("community_scores", with_ctes(*G4) + """
SELECT lang, subreddit_id, target, total, fraction, round(threshold, 6) AS threshold, exceeded FROM cs""")
def q_community_scores(spark, sf_dir):
    """A4 + A8 + F4: per language and community, target/total posts, fraction, threshold flag."""
    scores = S.community_scores(_conv_meta(spark, sf_dir), TARGET_LANGS)
    return scores.withColumn("threshold", F.round("threshold", 6))


@register("thread_scores", with_ctes(*G4, TS_BASE, TS) + "\nSELECT * FROM ts")
def q_thread_scores(spark, sf_dir):
    """A5 + J7: per language and thread, post fraction times community fraction."""
    return _thread_scores(spark, sf_dir)


EXTRACT = """ex AS (SELECT DISTINCT k.lang, p.link_id, p.id, p.kind, p.created_utc
            FROM posts_conv_dup p JOIN (SELECT DISTINCT lang, link_id FROM ts WHERE exceeded) k
            ON k.link_id = p.link_id)"""


@register("thread_extract", with_ctes(*G4, TS_BASE, TS, EXTRACT) + """
SELECT lang, link_id, id, kind, created_utc,
       CAST(row_number() OVER (PARTITION BY lang, link_id
            ORDER BY created_utc, CASE WHEN kind = 'submission' THEN 1 ELSE 0 END, id) AS BIGINT) AS pos
FROM ex""")
def q_thread_extract(spark, sf_dir):
    """J3 + W5 + W4: posts of exceeded threads per language, copies dropped, position in thread."""
    posts = fixture(spark, sf_dir, "posts_conv_dup")
    extracted = T.extract_threads(posts, _thread_scores(spark, sf_dir))
    group = ("lang", "link_id")
    deduped = T.dedup_thread(extracted.select("lang", "link_id", "id", "kind", "created_utc"), group)
    return T.order_thread(deduped, group, narrow=T.first_times(extracted, group))


@register("duplicate_report", with_ctes(("posts_conv_dup",)) + """
SELECT link_id, CAST(sum(c - 1) AS BIGINT) AS skipped
FROM (SELECT link_id, kind, id, count(*) AS c FROM posts_conv_dup GROUP BY link_id, kind, id) t
GROUP BY link_id HAVING sum(c - 1) > 0""")
def q_duplicate_report(spark, sf_dir):
    """Repeated posts per thread that the dedup skips."""
    return T.duplicate_report(fixture(spark, sf_dir, "posts_conv_dup"))


@register("thread_submissions", with_ctes(*G4, TS_BASE, TS) + """
SELECT p.id, p.link_id, p.created_utc FROM posts_conv p
WHERE p.kind = 'submission' AND p.id IN (SELECT substring(link_id, 4) FROM ts WHERE lang = 'de' AND score >= 0.1)""")
def q_thread_submissions(spark, sf_dir):
    """J2 + S11: submissions of German threads scoring >= 0.1."""
    subs = fixture(spark, sf_dir, "posts_conv").where(F.col("kind") == "submission")
    picked = S.selected_threads(_thread_scores(spark, sf_dir).where(F.col("lang") == "de"))
    return T.submissions_of_threads(subs, picked).select("id", "link_id", "created_utc")


@register("thread_head", with_ctes(("posts_conv",)) + """
SELECT link_id, first(id ORDER BY created_utc, id) AS head_id,
       first(subreddit ORDER BY created_utc, id) AS subreddit
FROM posts_conv GROUP BY link_id""")
def q_thread_head(spark, sf_dir):
    """First post of each thread (time, then id) and its community."""
    return T.thread_head(fixture(spark, sf_dir, "posts_conv"))


@register("thread_shape", with_ctes(("posts_conv",)) + """
, o AS (SELECT link_id, id, row_number() OVER w AS rn, count(*) OVER (PARTITION BY link_id) AS n
        FROM posts_conv WINDOW w AS (PARTITION BY link_id
             ORDER BY created_utc, CASE WHEN kind = 'submission' THEN 1 ELSE 0 END, id))
SELECT link_id, CAST(max(n) AS BIGINT) AS n_posts, max(CASE WHEN rn = 1 THEN id END) AS first_id,
       max(CASE WHEN rn = n THEN id END) AS last_id FROM o GROUP BY link_id""")
def q_thread_shape(spark, sf_dir):
    """A10 / W4 summary: size, first and last post of each thread in thread order."""
    return T.thread_shape(fixture(spark, sf_dir, "posts_conv"))


# ------------------------------------------------------- threads, word based

IDS = "gids AS (SELECT DISTINCT id FROM labels WHERE label)"
FILTERED = f"cf AS (SELECT * FROM corpus WHERE corpus_N > 1 AND corpus_prop >= {O.threshold('corpus_total')})"
TKEYS = "tkeys AS (SELECT DISTINCT p.link_id FROM posts p JOIN gids USING (id))"
G3 = (("posts",), MODEL, SINGLE, META, MONTHLY, CORPUS, IDS, FILTERED, TKEYS)


def _german_ids(spark, sf_dir):
    return T.target_ids(label_meta(spark, sf_dir))


def _filtered_communities(spark, sf_dir):
    return S.filter_communities(S.corpus_share(S.monthly_share(label_meta(spark, sf_dir))))


def _thread_comments(spark, sf_dir):
    posts = fixture(spark, sf_dir, "posts")
    ids = _german_ids(spark, sf_dir)
    keys = T.union_keys(posts.join(ids, "id", "left_semi"))
    return T.comments_of_threads(posts, keys)


@register("comment_ids", with_ctes(*G3) + "\nSELECT id FROM gids")
def q_comment_ids(spark, sf_dir):
    """Distinct ids of German comments."""
    return _german_ids(spark, sf_dir)


@register("thread_refs", with_ctes(*G3) + """
SELECT p.id, p.created_utc, p.subreddit_id, 'None' AS parent_id, p.link_id FROM posts p JOIN gids USING (id)""")
def q_thread_refs(spark, sf_dir):
    """Thread reference columns of German comments."""
    posts = fixture(spark, sf_dir, "posts").withColumn("parent_id", F.lit("None"))
    return T.thread_refs(posts.join(_german_ids(spark, sf_dir), "id", "left_semi"))


@register("thread_comments", with_ctes(*G3) + """
SELECT p.id, p.link_id FROM posts p WHERE p.link_id IN (SELECT link_id FROM tkeys)""")
def q_thread_comments(spark, sf_dir):
    """U1 + J1: all comments of threads with at least one German comment."""
    return _thread_comments(spark, sf_dir).select("id", "link_id")


@register("thread_word_scores", with_ctes(*G3) + """
, tc AS (SELECT p.*, CASE WHEN g.id IS NULL THEN 'nope' ELSE 'german' END AS la,
                len(string_split(p.body, ' ')) AS le
         FROM posts p LEFT JOIN gids g USING (id) WHERE p.link_id IN (SELECT link_id FROM tkeys)),
tsum AS (SELECT link_id, CAST(sum(CASE WHEN la = 'german' THEN le ELSE 0 END) AS BIGINT) AS target_words,
                CAST(sum(le) AS BIGINT) AS all_words, CAST(count(*) AS BIGINT) AS n_posts,
                first(subreddit ORDER BY created_utc, id) AS subreddit FROM tc GROUP BY link_id)
SELECT t.link_id, t.subreddit, c.corpus_prop AS prior, t.n_posts, t.target_words, t.all_words,
       (c.corpus_prop * t.target_words) / t.all_words AS score,
       (c.corpus_prop * t.target_words) / t.all_words >= 0.1 AS selected
FROM tsum t JOIN cf c USING (subreddit)""")
def q_thread_word_scores(spark, sf_dir):
    """A6 + J5 + J6 + W6 + F5: word-weighted German score of threads in listed communities."""
    return T.thread_word_scores(_thread_comments(spark, sf_dir), _german_ids(spark, sf_dir),
                                _filtered_communities(spark, sf_dir))


# ------------------------------------------------------------------ markup

@register("decode_entities", with_ctes((), O.entity_cte()) + f"""
SELECT page_id, {O.decode_entities('html')} AS decoded FROM pages, emap""")
def q_decode_entities(spark, sf_dir):
    """P11 + P12: numeric and named character references of every page decoded in one pass."""
    pages = read_table(spark, sf_dir, "pages")
    return R.decode_entities_rows(pages, ["page_id"], "html")


@register("markup_blocks", with_ctes(("posts",)) + f"""
, tb AS (SELECT id, {O.typed_blocks(O.xml_unescape('body'))} AS blocks FROM posts),
ex AS (SELECT id, unnest(range(len(blocks))) AS pos, unnest(blocks) AS blk FROM tb)
SELECT id, CAST(pos AS INTEGER) AS pos, blk.t AS type, blk.text AS text FROM ex""")
def q_markup_blocks(spark, sf_dir):
    """Typed markdown blocks (position, type, plain text) of every post."""
    posts = fixture(spark, sf_dir, "posts")
    blocks = posts.select("id", F.posexplode(M.typed_blocks(M.xml_unescape("body"))).alias("pos", "blk"))
    return blocks.select("id", "pos", F.col("blk.t").alias("type"), F.col("blk.text").alias("text"))


@register("render_xml", with_ctes(("posts_conv",), O.entity_cte()) + f"""
SELECT id, '<text id="' || {O.xml_escape_attr('id')} || '">' || chr(10)
           || {O.escape_spoilers(O.decode_entities(O.markdown_html(O.xml_unescape('body'))))}
           || chr(10) || '</text>' AS xml
FROM posts_conv, emap""")
def q_render_xml(spark, sf_dir):
    """X2 + P10-P14: every post rendered as a ``<text>`` element of clean XML."""
    return R.render_posts(fixture(spark, sf_dir, "posts_conv"))


@register("markup_variety_blocks", with_ctes(("posts_markup",)) + f"""
, tb AS (SELECT id, {O.typed_blocks(O.xml_unescape('body'))} AS blocks FROM posts_markup),
ex AS (SELECT id, unnest(range(len(blocks))) AS pos, unnest(blocks) AS blk FROM tb)
SELECT id, CAST(pos AS INTEGER) AS pos, blk.t AS type, blk.text AS text FROM ex""")
def q_markup_variety_blocks(spark, sf_dir):
    """Blocks of posts with headings, links, spoilers, quotes, lists, code and references."""
    posts = fixture(spark, sf_dir, "posts_markup")
    blocks = posts.select("id", F.posexplode(M.typed_blocks(M.xml_unescape("body"))).alias("pos", "blk"))
    return blocks.select("id", "pos", F.col("blk.t").alias("type"), F.col("blk.text").alias("text"))


@register("markup_variety_xml", with_ctes(("posts_markup",), O.entity_cte()) + f"""
SELECT id, '<text id="' || {O.xml_escape_attr('id')} || '">' || chr(10)
           || {O.escape_spoilers(O.decode_entities(O.markdown_html(O.xml_unescape('body'))))}
           || chr(10) || '</text>' AS xml
FROM posts_markup, emap""")
def q_markup_variety_xml(spark, sf_dir):
    """X2 + P10-P14: the same posts rendered, links and spoiler titles included."""
    return R.render_posts(fixture(spark, sf_dir, "posts_markup"))


@register("markup_variety_references", with_ctes(("posts_markup",), O.entity_cte()) + f"""
SELECT id, {O.decode_entities('body')} AS decoded FROM posts_markup, emap""")
def q_markup_variety_references(spark, sf_dir):
    """P11 + P12: padded, invalid, unknown and bare references of the same posts."""
    return R.decode_entities_rows(fixture(spark, sf_dir, "posts_markup"), ["id"], "body")


NESTED = with_ctes(("posts_nested",), O.nested_ctes("posts_nested")).replace("WITH ", "WITH RECURSIVE ", 1)


@register("markup_nested_blocks", NESTED + """
SELECT id, CAST(pos AS INTEGER) AS pos, path, t AS type, text FROM nested""")
def q_markup_nested_blocks(spark, sf_dir):
    """Blocks of nested lists and quotes, lazy lines, fences, tables and definitions, with their containers."""
    posts = fixture(spark, sf_dir, "posts_nested")
    blocks = posts.select("id", F.posexplode(N.nested_blocks(M.xml_unescape("body"))).alias("pos", "blk"))
    return blocks.select("id", "pos", "blk.path", F.col("blk.t").alias("type"), "blk.text")


@register("markup_nested_xml", NESTED + f""",
{O.nested_html_ctes().strip()},
{O.entity_cte()}
SELECT id, '<text id="' || {O.xml_escape_attr('id')} || '">' || chr(10) || {O.escape_spoilers(O.decode_entities('html'))}
           || chr(10) || '</text>' AS xml
FROM nested_html, emap""")
def q_markup_nested_xml(spark, sf_dir):
    """X1 + X2: the same posts rendered, with nested lists, quotes, tables and links by reference."""
    return R.render_posts(fixture(spark, sf_dir, "posts_nested"), nested=True)


SPOILER_VIEW = """SELECT CAST(conv_id AS STRING) AS conv_id, turn,
  concat('<p><a href="', CASE WHEN turn % 2 = 0 THEN '#s' ELSE '/s' END, '" title="',
         replace(text, ',', '"'), '">spoiler</a> ', text, '</p>') AS html
  FROM {conversations}"""


@register("spoiler_escape", with_ctes((), f"sp AS ({SPOILER_VIEW.format(conversations='conversations')})") + f"""
SELECT conv_id, turn, {O.escape_spoilers('html')} AS html FROM sp""")
def q_spoiler_escape(spark, sf_dir):
    """Quotes inside spoiler-link titles escaped (links built around conversation text)."""
    sp = spark.sql(SPOILER_VIEW, conversations=read_table(spark, sf_dir, "conversations"))
    return sp.select("conv_id", "turn", M.escape_spoilers("html").alias("html"))


# ------------------------------------------------------------------ corpus

@register("vertical_lines", with_ctes(("posts_conv",)) + f"""
, v AS (SELECT id, {O.vertical_lines('body')} AS lines FROM posts_conv)
SELECT id, CAST(unnest(range(len(lines))) AS INTEGER) AS line_no, unnest(lines) AS line FROM v""")
def q_vertical_lines(spark, sf_dir):
    """Every post as one token per line with sentence and paragraph breaks."""
    posts = fixture(spark, sf_dir, "posts_conv")
    return posts.select("id", F.posexplode(C.vertical_lines(F.col("body"))).alias("line_no", "line"))


@register("sentence_tags", with_ctes(("posts_conv",)) + f"""
, v AS (SELECT id, {O.vertical_lines('body')} AS lines FROM posts_conv),
x AS (SELECT id, CAST(unnest(range(len(lines))) AS INTEGER) AS line_no, unnest(lines) AS line FROM v),
st AS (SELECT *, last_value(CASE WHEN line IN ('<p>', '</p>') THEN line END IGNORE NULLS)
                 OVER (PARTITION BY id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_m
       FROM x),
o AS (SELECT id, line_no, CASE WHEN line = '<p>' THEN ['<p>', '<s>'] WHEN line = '</p>' THEN ['</s>', '</p>']
                              WHEN line = '' AND coalesce(last_m = '<p>', false) THEN ['</s>', '<s>']
                              WHEN line = '' THEN []::VARCHAR[] ELSE [line] END AS arr FROM st)
SELECT id, line_no, CAST(unnest(range(len(arr))) AS INTEGER) AS sub, unnest(arr) AS line FROM o""")
def q_sentence_tags(spark, sf_dir):
    """X4 (window form) applied to the vertical lines of every post."""
    posts = fixture(spark, sf_dir, "posts_conv")
    lines = posts.select("id", F.posexplode(C.vertical_lines(F.col("body"))).alias("line_no", "line"))
    return C.insert_sentence_tags(lines, ["id"])


@register("tagged_lines", with_ctes(("posts_conv",)) + f"""
, v AS (SELECT id, {O.tagged_lines('body')} AS lines FROM posts_conv)
SELECT id, CAST(unnest(range(len(lines))) AS INTEGER) AS line_no, unnest(lines) AS line FROM v""")
def q_tagged_lines(spark, sf_dir):
    """X3 + X4 in one projection: tagged lines of every post, nothing shuffled."""
    return fixture(spark, sf_dir, "posts_conv").select(
        "id", F.posexplode(C.tagged_lines(F.col("body"))).alias("line_no", "line"))


def _post_lines_sql(src: str, meta: str, level: str, cols, part: int) -> str:
    tag = O.open_tag(level, [("id", "p.id"), *[(c, f"m.{c}") for c in cols]])
    return f"""SELECT text_id, {part} AS part, created_utc, post_id,
       CAST(unnest(range(len(c))) AS INTEGER) AS line_no, unnest(c) AS line
FROM (SELECT p.text_id, p.created_utc, p.id AS post_id,
             list_concat(list_concat([{tag}], {O.tagged_lines('p.body')}), ['</{level}>']) AS c
      FROM {src} p JOIN {meta} m ON m.id = p.id) q"""


def assembly(comment_cols=("author", "created_utc")) -> str:
    """CTE ``corpus_lines``: the vertical corpus of ``posts_open``."""
    return f"""keyed AS (SELECT DISTINCT *, string_split(link_id, '_')[-1] AS text_id FROM posts_open),
kept AS (SELECT t.text_id, m.subreddit, m.created_utc FROM (SELECT DISTINCT text_id FROM keyed) t
         JOIN thread_meta m ON m.id = t.text_id),
live AS (SELECT * FROM keyed WHERE text_id IN (SELECT text_id FROM kept)),
lsub AS (SELECT * FROM live WHERE kind = 'submission'),
lcom AS (SELECT * FROM live WHERE kind = 'comment'),
corpus_lines AS (
  SELECT text_id, 0 AS part, CAST(0 AS BIGINT) AS created_utc, '' AS post_id, 0 AS line_no,
         {O.open_tag('text', [('id', 'text_id'), ('subreddit', 'subreddit'), ('created_utc', 'created_utc')])} AS line
  FROM kept
  UNION ALL {_post_lines_sql('lsub', 'submission_meta', 'submission', ['author'], 1)}
  UNION ALL {_post_lines_sql('lcom', 'comment_meta', 'comment', list(comment_cols), 2)}
  UNION ALL SELECT text_id, 3, CAST(0 AS BIGINT), '', 0, '</text>' FROM kept)"""


ASSEMBLY_VIEWS = ("posts_open", "thread_meta", "comment_meta", "submission_meta")


@register("assemble_corpus", with_ctes(ASSEMBLY_VIEWS, assembly()) + """
SELECT text_id, CAST(part AS INTEGER) AS part, created_utc, post_id, CAST(line_no AS INTEGER) AS line_no, line
FROM corpus_lines""")
def q_assemble_corpus(spark, sf_dir):
    """X5 + X6 + J9-J11 + P15 + P16: threads with metadata as sentence-tagged vertical text."""
    return C.assemble_texts(*(fixture(spark, sf_dir, v) for v in ASSEMBLY_VIEWS))


@register("assembly_rejects", with_ctes(ASSEMBLY_VIEWS) + """
, t AS (SELECT DISTINCT string_split(link_id, '_')[-1] AS id FROM posts_open)
SELECT 'thread' AS kind, id FROM t WHERE id NOT IN (SELECT id FROM thread_meta)
UNION ALL
SELECT DISTINCT p.kind, p.id FROM posts_open p
WHERE string_split(p.link_id, '_')[-1] IN (SELECT id FROM thread_meta)
  AND CASE WHEN p.kind = 'comment' THEN p.id NOT IN (SELECT id FROM comment_meta)
           ELSE p.id NOT IN (SELECT id FROM submission_meta) END""")
def q_assembly_rejects(spark, sf_dir):
    """J9 - J11 anti joins: threads, comments and submissions left out for missing metadata."""
    return C.assembly_rejects(*(fixture(spark, sf_dir, v) for v in ASSEMBLY_VIEWS))


@register("read_order_shape", with_ctes(("posts_conv_dup",)) + f"""
, b AS (SELECT *, {O.month('created_utc')} AS batch FROM posts_conv_dup)
SELECT link_id, CAST(count(*) AS BIGINT) AS n_posts, arg_min(id, (batch, created_utc, id)) AS first_id,
       arg_max(id, (batch, created_utc, id)) AS last_id FROM b GROUP BY link_id""")
def q_read_order_shape(spark, sf_dir):
    """Threads in the order of reading, batch by batch: size, first and last post."""
    posts = fixture(spark, sf_dir, "posts_conv_dup").withColumn("batch", epoch_month(F.col("created_utc")))
    return T.thread_shape(posts, ["batch", "created_utc", "id"])


# ------------------------------------------------------------------ evaluation

@register("corpus_summary", with_ctes(("posts_conv",)) + f"""
SELECT kind, CAST(count(*) AS BIGINT) AS n_posts, CAST(sum(len({O.words('body')})) AS BIGINT) AS n_tokens,
       CAST(min(year(DATE '1970-01-01' + CAST(floor(created_utc / 86400) AS INTEGER))) AS INTEGER) AS first_year,
       CAST(max(year(DATE '1970-01-01' + CAST(floor(created_utc / 86400) AS INTEGER))) AS INTEGER) AS last_year
FROM posts_conv GROUP BY kind""")
def q_corpus_summary(spark, sf_dir):
    """Size report per post kind (posts, word tokens, first and last year)."""
    return E.corpus_summary(fixture(spark, sf_dir, "posts_conv"))


SAMPLE_SEED = "s42"


@register("thread_sample", with_ctes(*G4, TS_BASE, TS) + f"""
, b AS (SELECT link_id, score, CAST(least(floor(score * 5), 4) AS INTEGER) AS stratum FROM ts WHERE lang = 'de'),
r AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5(link_id || '{SAMPLE_SEED}'), link_id) AS rn FROM b)
SELECT link_id, score, stratum, CAST(rn AS INTEGER) AS sample_rank FROM r WHERE rn <= 2""")
def q_thread_sample(spark, sf_dir):
    """Two German threads per score fifth, chosen by seeded hash (annotation sample)."""
    scores = _thread_scores(spark, sf_dir).where(F.col("lang") == "de").select("link_id", "score")
    sample = E.stratified_sample(scores, "link_id", E.score_bins(F.col("score"), 5), 2, SAMPLE_SEED)
    return sample.select("link_id", "score", "stratum", "sample_rank")


ML_POSTS = O.multi_label_ctes("posts", "ml")
GOLD = "gl AS (SELECT p.gold, ml.language FROM posts p JOIN ml USING (id))"


@register("label_confusion", with_ctes(("posts",), MODEL, ML_POSTS, GOLD) + """
SELECT gold, language AS predicted, CAST(count(*) AS BIGINT) AS n FROM gl GROUP BY gold, language""")
def q_label_confusion(spark, sf_dir):
    """Confusion counts of the many-language label against the documents' language."""
    posts = fixture(spark, sf_dir, "posts")
    pred = L.label_multi(posts, language_model(spark, sf_dir), TARGET_LANGS).join(
        posts.select("id", "gold"), "id")
    return E.confusion(pred, "language", "gold")


@register("label_quality", with_ctes(("posts",), MODEL, ML_POSTS, GOLD) + "\n" + " UNION ALL ".join(
    f"""SELECT '{c}' AS class, tp, fp, fn, CASE WHEN tp + fp = 0 THEN NULL ELSE tp / (tp + fp) END AS precision,
       CASE WHEN tp + fn = 0 THEN NULL ELSE tp / (tp + fn) END AS recall,
       CASE WHEN 2 * tp + fp + fn = 0 THEN NULL ELSE 2 * tp / (2 * tp + fp + fn) END AS f1
FROM (SELECT CAST(count_if(language = '{c}' AND gold = '{c}') AS BIGINT) AS tp,
             CAST(count_if(language = '{c}' AND NOT coalesce(gold = '{c}', false)) AS BIGINT) AS fp,
             CAST(count_if(gold = '{c}' AND NOT coalesce(language = '{c}', false)) AS BIGINT) AS fn FROM gl) q_{c}"""
    for c in TARGET_LANGS))
def q_label_quality(spark, sf_dir):
    """Precision, recall and F1 of the many-language label per target language."""
    posts = fixture(spark, sf_dir, "posts")
    pred = L.label_multi(posts, language_model(spark, sf_dir), TARGET_LANGS).join(
        posts.select("id", "gold"), "id")
    return E.label_quality(pred, "language", "gold", TARGET_LANGS)


HELD_OUT = 5
HELD_VIEWS = f"""train_docs AS (SELECT * FROM documents WHERE doc_id % {HELD_OUT} <> 0),
held AS (SELECT * FROM posts WHERE doc_id % {HELD_OUT} = 0)"""


@register("label_quality_held_out", with_ctes(("posts",), HELD_VIEWS, MODEL.replace("FROM documents", "FROM train_docs"),
                                              O.multi_label_ctes("held", "ml")) + """
SELECT p.gold, ml.language AS predicted, CAST(count(*) AS BIGINT) AS n FROM held p JOIN ml USING (id)
GROUP BY p.gold, ml.language""")
def q_label_quality_held_out(spark, sf_dir):
    """E2 on rows the model never saw: fitted on four fifths of the documents, judged on the rest."""
    docs = read_table(spark, sf_dir, "documents").where(F.col("doc_id") % HELD_OUT != 0)
    held = fixture(spark, sf_dir, "posts").where(F.col("doc_id") % HELD_OUT == 0)
    labels = L.label_multi(held, L.train_language_model(docs, MODEL_LANGS), TARGET_LANGS)
    return E.confusion(held.select("id", "gold").join(labels, "id"), "language", "gold")


@register("langid_features", with_ctes((), O.feature_ctes("documents", FT.PER_LANGUAGE)) + """
SELECT lang, gram, score, rank FROM ft_best""")
def q_langid_features(spark, sf_dir):
    """L2: the 1- to 4-grams of each language with the highest gain on the language less that on the source."""
    return FT.select_features(FT.gram_gains(read_table(spark, sf_dir, "documents")))


HELD_DOCS = f"""train_docs AS (SELECT * FROM documents WHERE doc_id % {HELD_OUT} <> 0),
held_docs AS (SELECT doc_id AS id, lang, text AS clean FROM documents WHERE doc_id % {HELD_OUT} = 0)"""


@register("langid_features_held_out", with_ctes((), HELD_DOCS, O.feature_ctes("train_docs", FT.PER_LANGUAGE),
                                                MODEL.replace("FROM documents", "FROM train_docs"),
                                                O.feature_langid_ctes("held_docs", "fl"), O.langid_ctes("held_docs", "tl")) + """
SELECT h.id, h.lang AS gold, f.langid AS by_features, f.langid_score AS features_score, t.langid AS by_trigrams
FROM held_docs h LEFT JOIN fl f USING (id) LEFT JOIN tl t USING (id)""")
def q_langid_features_held_out(spark, sf_dir):
    """L2 on documents that neither model saw: languages by the selected grams beside those by all trigrams."""
    docs = read_table(spark, sf_dir, "documents")
    train, held = docs.where(F.col("doc_id") % HELD_OUT != 0), docs.where(F.col("doc_id") % HELD_OUT == 0)
    held = held.select(F.col("doc_id").alias("id"), F.col("lang").alias("gold"), F.col("text").alias("clean"))
    features = FT.score_features(held, FT.train_features(train)).select(
        "id", F.col("langid").alias("by_features"), F.col("langid_score").alias("features_score"))
    trigrams = L.score_langid(held, L.train_langid(train)).select("id", F.col("langid").alias("by_trigrams"))
    return held.drop("clean").join(features, "id", "left").join(trigrams, "id", "left")


SWEEP = [0.05, 0.1, 0.2, 0.3, 0.5]


@register("threshold_sweep", with_ctes(*G3) + """
, tc AS (SELECT p.*, CASE WHEN g.id IS NULL THEN 'nope' ELSE 'german' END AS la,
                len(string_split(p.body, ' ')) AS le
         FROM posts p LEFT JOIN gids g USING (id) WHERE p.link_id IN (SELECT link_id FROM tkeys)),
tsum AS (SELECT link_id, sum(CASE WHEN la = 'german' THEN le ELSE 0 END) AS target_words, sum(le) AS all_words,
                first(subreddit ORDER BY created_utc, id) AS subreddit FROM tc GROUP BY link_id),
sc AS (SELECT t.link_id, (c.corpus_prop * t.target_words) / t.all_words AS score FROM tsum t JOIN cf c USING (subreddit)),
tg AS (SELECT link_id, count_if(gold = 'de') * 2 > count(*) AS gold_de FROM posts GROUP BY link_id),
j AS (SELECT sc.score, tg.gold_de FROM sc JOIN tg USING (link_id)),
t AS (SELECT unnest([""" + ", ".join(f"CAST({t} AS DOUBLE)" for t in SWEEP) + """]) AS threshold)
SELECT threshold, CAST(count_if(score >= threshold AND gold_de) AS BIGINT) AS tp,
       CAST(count_if(score >= threshold AND NOT gold_de) AS BIGINT) AS fp,
       CAST(count_if(score < threshold AND gold_de) AS BIGINT) AS fn
FROM t, j GROUP BY threshold""")
def q_threshold_sweep(spark, sf_dir):
    """Errors of the word-weighted thread rule at several cut-offs against majority gold."""
    scores = T.thread_word_scores(_thread_comments(spark, sf_dir), _german_ids(spark, sf_dir),
                                  _filtered_communities(spark, sf_dir))
    posts = fixture(spark, sf_dir, "posts")
    gold = posts.groupBy("link_id").agg(
        ((F.count_if(F.col("gold") == "de") * 2) > F.count("*")).alias("gold_de"))
    return E.sweep_threshold(scores.join(gold, "link_id"), "score", "gold_de", SWEEP)


# ------------------------------------------------------------------ sources

def conv_json_lines(spark: SparkSession, sf_dir: str, name: str = "posts_conv") -> DataFrame:
    """Stand-in raw dump lines ``(kind, value)`` of ``posts_conv`` (or another thread fixture).

    Submissions carry ``selftext`` and no thread fields; comments of turn 3 lack
    ``parent_id``; posts of odd conversations quote ``created_utc``.
    """
    p = fixture(spark, sf_dir, name)
    quoted = (F.col("conv_id") % 2) == 1
    created = F.when(quoted, F.col("created_utc").cast("string"))
    sub_fields = [F.col("id"), F.col("body").alias("selftext"), "subreddit", "subreddit_id", "author"]
    com_fields = [F.col("id"), "body", "link_id",
                  F.when(F.col("turn") != 3, F.col("parent_id")).alias("parent_id"),
                  "subreddit", "subreddit_id", "author"]

    def js(fields):
        return F.when(quoted, F.to_json(F.struct(*fields, created.alias("created_utc")))) \
            .otherwise(F.to_json(F.struct(*fields, F.col("created_utc"))))
    return p.select("kind", F.when(F.col("kind") == "submission", js(sub_fields))
                    .otherwise(js(com_fields)).alias("value"))


PARSED_COLS = ["id", "kind", "link_id", "parent_id", "subreddit", "subreddit_id", "created_utc",
               "author", "body", "is_submitter", "permalink", "malformed"]


@register("parse_posts", with_ctes(("posts_conv",)) + """
SELECT id, kind, link_id, CASE WHEN kind = 'comment' AND turn = 3 THEN 'None' ELSE parent_id END AS parent_id,
       subreddit, subreddit_id, created_utc, author, body, '' AS is_submitter, '' AS permalink,
       false AS malformed
FROM posts_conv""")
def q_parse_posts(spark, sf_dir):
    """S2 + P6: dump lines of both kinds parsed into the canonical post schema."""
    from threadcorpus.sources.readers import parse_posts
    lines = conv_json_lines(spark, sf_dir)
    subs = parse_posts(lines.where(F.col("kind") == "submission").select("value"), "submission")
    coms = parse_posts(lines.where(F.col("kind") == "comment").select("value"), "comment")
    return subs.unionByName(coms).select(*PARSED_COLS)


BATCH_VIEW = """SELECT DISTINCT concat('/dumps/', CASE WHEN length(subreddit) % 2 = 0 THEN 'comments/RC_' ELSE 'submissions/RS_' END, month, '.', subreddit, '.zst') AS file_name FROM {meta}"""


@register("batch_keys", with_ctes(("posts",)) + f"""
, m AS (SELECT {O.month('created_utc')} AS month, subreddit FROM posts),
f AS ({BATCH_VIEW.format(meta='m')})
SELECT file_name, regexp_extract(file_name, '(R[CS]_[0-9]{{4}}-[0-9]{{2}})', 1) AS batch,
       regexp_replace(regexp_extract(file_name, '([^/]+)$', 1), '\\.[^.]+$', '') AS base
FROM f""")
def q_batch_keys(spark, sf_dir):
    """Batch key and base name of dump file names (one file per month and community)."""
    from threadcorpus.functions.text import epoch_month
    from threadcorpus.sources.readers import base_name, batch_key
    m = fixture(spark, sf_dir, "posts").select(epoch_month(F.col("created_utc")).alias("month"), "subreddit")
    files = spark.sql(BATCH_VIEW, meta=m)
    return files.select("file_name", batch_key("file_name").alias("batch"), base_name("file_name").alias("base"))


# ------------------------------------------------------------------ streaming

def _two_arrivals(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows, split into what arrives before a stream stops and what arrives before it starts again."""
    half = F.pmod(F.xxhash64(*rows.columns), F.lit(2))
    return rows.where(half == 0), rows.where(half == 1)


@register("stream_labels", with_ctes(("posts",), MODEL, ML_POSTS) + "\nSELECT id, language FROM ml")
def q_stream_labels(spark, sf_dir):
    """Posts arriving as JSON-line files, labelled per micro-batch (many-language rule); the stream starts twice."""
    from threadcorpus.streaming import stream as ST
    base = ST.work_dir(spark, "labels")
    posts = fixture(spark, sf_dir, "posts")
    lines = posts.select(F.to_json(F.struct("id", "body", "link_id", "subreddit", "subreddit_id",
                                            "created_utc")).alias("value"))
    for arrived in _two_arrivals(lines):
        arrived.repartition(2).write.mode("append").text(os.path.join(base, "in"))
        q = ST.label_stream(spark, os.path.join(base, "in"), os.path.join(base, "out"),
                            language_model(spark, sf_dir), TARGET_LANGS, os.path.join(base, "state"))
        q.awaitTermination()
    return spark.read.parquet(os.path.join(base, "out", "labels")).select("id", "language")


@register("stream_monthly_share", with_ctes(("posts",), MODEL, SINGLE, META, MONTHLY) + "\nSELECT * FROM monthly")
def q_stream_monthly_share(spark, sf_dir):
    """Running monthly German share per community over arriving label files; the stream starts twice."""
    from threadcorpus.streaming import stream as ST
    base = ST.work_dir(spark, "shares")
    meta = label_meta(spark, sf_dir).select("id", "subreddit", "created_utc", "label")
    for arrived in _two_arrivals(meta):
        arrived.repartition(2).write.mode("append").parquet(os.path.join(base, "in"))
        source = spark.readStream.schema(meta.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(base, "in"))
        q = ST.write_snapshot(ST.community_counts(source), os.path.join(base, "out"), os.path.join(base, "state"))
        q.awaitTermination()
    return ST.share_of(ST.latest_snapshot(spark, os.path.join(base, "out"))).select(
        "month", "subreddit", "n", "total", "prop")


@register("stream_replaced_month", with_ctes(("posts",), MODEL, SINGLE, META, MONTHLY) + "\nSELECT * FROM monthly")
def q_stream_replaced_month(spark, sf_dir):
    """T2 by contributions: dumps of two halves of a year, the first one published again with other labels."""
    from threadcorpus.streaming import stream as ST
    base = ST.work_dir(spark, "contributions")
    half = F.when(F.col("created_utc") < 1277942400, F.lit("first")).otherwise(F.lit("second"))
    meta = label_meta(spark, sf_dir).select("subreddit", "created_utc", "label", half.alias("source"))
    first, second = meta.where(F.col("source") == "first"), meta.where(F.col("source") == "second")
    wrong = first.withColumn("label", ~F.col("label")).withColumn("subreddit", F.concat("subreddit", F.lit("_old")))
    for publication, arrived in ((1, wrong), (1, second), (2, first)):
        arrived = arrived.withColumn("publication", F.lit(publication))
        arrived.repartition(2).write.mode("append").parquet(os.path.join(base, "in"))
        source = spark.readStream.schema(arrived.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(base, "in"))
        ST.contribute(source, os.path.join(base, "out"), os.path.join(base, "state")).awaitTermination()
    return ST.share_of(ST.merged_counts(spark, os.path.join(base, "out"))).select("month", "subreddit", "n", "total", "prop")


@register("stream_dedup", with_ctes(("posts_conv_dup",)) + """
SELECT DISTINCT kind, id, link_id FROM posts_conv_dup""")
def q_stream_dedup(spark, sf_dir):
    """Repeated posts dropped from files that arrive one by one, in two starts, the newest months of each first."""
    from threadcorpus.streaming import stream as ST
    base = ST.work_dir(spark, "dedup")
    posts = fixture(spark, sf_dir, "posts_conv_dup").select("kind", "id", "link_id", "created_utc")
    for arrived in _two_arrivals(posts):
        arrived.repartitionByRange(2, F.desc("created_utc")).write.mode("append").parquet(os.path.join(base, "in"))
        source = spark.readStream.schema(posts.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(base, "in"))
        q = ST.dedup_stream(source, os.path.join(base, "out"), os.path.join(base, "state"))
        q.awaitTermination()
    return spark.read.parquet(os.path.join(base, "out")).select("kind", "id", "link_id")


SECOND_META = """SELECT CAST(conv_id AS STRING) AS id, max(author) AS author, max(subreddit) AS subreddit
  FROM {posts_conv} GROUP BY conv_id"""


@register("merge_metadata", with_ctes(("posts_conv", "thread_meta")) + f"""
, second AS ({SECOND_META.format(posts_conv='posts_conv')})
SELECT id, subreddit, created_utc, CAST(NULL AS VARCHAR) AS author FROM thread_meta
UNION ALL
SELECT id, subreddit, CAST(NULL AS VARCHAR) AS created_utc, author FROM second
WHERE id NOT IN (SELECT id FROM thread_meta)""")
def q_merge_metadata(spark, sf_dir):
    """U3 + W8: thread metadata merged from two tables, the first table winning per id."""
    posts = fixture(spark, sf_dir, "posts_conv")
    merged = C.merge_metadata(fixture(spark, sf_dir, "thread_meta"), spark.sql(SECOND_META, posts_conv=posts))
    return merged.select("id", "subreddit", "created_utc", "author")


def oracle() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items() if sql is not None}


def queries() -> dict[str, QueryFn]:
    return {name: fn for name, (fn, _) in QUERIES.items()}
