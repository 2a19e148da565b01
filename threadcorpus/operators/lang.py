"""Language identification: lexicon, dictionary error rates, n-gram naive Bayes.

The reference delegates to a spell-checker and a pretrained classifier called
once per post. Here both are Spark jobs: a lexicon table and a character
n-gram profile are trained from labelled text, and words and n-grams of posts
are looked up and summed in their tasks or, beyond a checked size of the model,
exploded, joined and aggregated back per post. Dictionary tests run first; only
posts that pass them are scored by n-grams (the cheap-test-first gate).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadcorpus.functions.text import is_too_short, sanitize, words
from threadcorpus.operators.grams import PACKED, gram_lists, gram_sums, gram_totals
from threadcorpus.operators.joins import BROADCAST_MAX_ROWS, broadcast_rows, checked_join
from threadcorpus.operators.ordering import keep_first
from threadcorpus.operators.tokens import HELD_WORDS, word_misses, word_texts
from threadcorpus.session import materialize

# Fixed values of the labelling rules.
ENGLISH_ERROR_MIN = 0.3   # a post counts as non-English above this error rate
TARGET_ERROR_MAX = 0.7    # a target language stays a candidate below this error rate
LEXICON_MIN_DOCS = 3      # lexicon: words found in at least this many documents
NGRAM = 3                 # character n-gram order of the classifier
LOGPROB_SCALE = 1_000_000  # log-probabilities kept as BIGINT micro-units


# ---------------------------------------------------------------- lexicon (L1)

def build_lexicon(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
                  id_col: str = "doc_id", min_docs: int = LEXICON_MIN_DOCS) -> DataFrame:
    """Lexicon ``(lang, word, n_docs)``: lower-cased words found in >= ``min_docs`` documents."""
    docs = labelled.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("_text"))
    return word_texts(docs, "lang", "_text").withColumnRenamed("n", "n_docs").where(F.col("n_docs") >= min_docs)


def lexicon_index(lexicon: DataFrame, langs: Sequence[str]) -> DataFrame:
    """One row per word with a 0/1 flag per language (``in_<lang>``), materialized.

    One join against this table answers membership for every language at once.
    """
    flags = [F.max((F.col("lang") == F.lit(lang)).cast("int")).alias(f"in_{lang}") for lang in langs]
    index = lexicon.where(F.col("lang").isin(list(langs))).groupBy("word").agg(*flags)
    return materialize(index)


# ------------------------------------------------------- scoring pieces against a model

def _pieces_with_model(pieces: DataFrame, key: str, table: DataFrame, table_rows: int) -> DataFrame:
    """Attach model rows to exploded pieces ``(_pid, key)``; adds the multiplicity ``cnt`` where they have none.

    With a model small enough to broadcast (checked size), every piece
    probes the broadcast hash table directly and the following per-post
    aggregation combines map-side: only one row per post and task is shuffled.
    Beyond that size, pieces are first counted per (post, piece) and joined
    by a shuffle, in which hot pieces (frequent words or n-grams) are split by
    their size.
    """
    if "cnt" not in pieces.columns:
        pieces = pieces.withColumn("cnt", F.lit(1).cast("bigint"))
    if table_rows <= BROADCAST_MAX_ROWS:
        return pieces.join(F.broadcast(table), key, "left")
    counted = pieces.groupBy("_pid", key).agg(F.sum("cnt").alias("cnt"))
    return checked_join(counted, table, key, "left", max_rows=BROADCAST_MAX_ROWS, small_rows=table_rows)


# ----------------------------------------------------------- error rates

def error_rates(posts: DataFrame, index: DataFrame, langs: Sequence[str],
                id_col: str = "id", text_col: str = "clean", index_rows: int | None = None,
                skip=None) -> DataFrame:
    """Per post with at least one word: ``n_words`` and ``err_<lang>``.

    ``err_<lang>`` = occurrences of words missing from that language's lexicon
    divided by all word occurrences. Words are looked up and summed in the tasks
    that hold the posts while the lexicon index is small enough (checked size);
    a larger one is joined to a row for each word, broadcast when its size
    allows, and summed per post with map-side partial aggregation. ``skip`` is an optional boolean column of
    posts to leave out (they produce no words).
    """
    rows = broadcast_rows(index) if index_rows is None else index_rows
    if rows <= HELD_WORDS:
        kept = F.col(text_col) if skip is None else F.when(~skip, F.col(text_col))
        per_post = word_misses(posts.select(F.col(id_col).alias("_pid"), kept.alias("_text")), "_pid", "_text", index,
                               [f"in_{lang}" for lang in langs], rows)
    else:
        toks = words(F.col(text_col))
        if skip is not None:
            toks = F.when(~skip, toks)
        pieces = posts.select(F.col(id_col).alias("_pid"), F.explode(toks).alias("token")) \
            .select("_pid", F.lower("token").alias("word"))
        joined = _pieces_with_model(pieces, "word", index, rows)
        aggs = [F.sum("cnt").alias("n_words")]
        for lang in langs:
            known = F.coalesce(F.col(f"in_{lang}"), F.lit(0)) == 1
            aggs.append(F.sum(F.when(known, F.lit(0)).otherwise(F.col("cnt"))).alias(f"miss_in_{lang}"))
        per_post = joined.groupBy("_pid").agg(*aggs)
    cols = [F.col("_pid").alias(id_col), F.col("n_words")]
    cols += [(F.col(f"miss_in_{lang}") / F.col("n_words")).alias(f"err_{lang}") for lang in langs]
    return per_post.select(*cols)


def unknown_words(posts: DataFrame, index: DataFrame, lang: str,
                  id_col: str = "id", text_col: str = "clean") -> DataFrame:
    """Anti-join form of the dictionary check: words of ``lang``'s texts absent from its lexicon.

    Returns ``(word, n_posts, n_occurrences)``.
    """
    tokens = posts.select(F.col(id_col).alias("_pid"),
                          F.explode(words(F.col(text_col))).alias("token"))
    freq = tokens.groupBy("_pid", F.lower("token").alias("word")).agg(F.count("*").alias("freq"))
    known = index.where(F.col(f"in_{lang}") == 1).select("word")
    missing = checked_join(freq, known, "word", "left_anti")
    return missing.groupBy("word").agg(F.count("*").alias("n_posts"),
                                       F.sum("freq").alias("n_occurrences"))


# ------------------------------------------------------------ n-gram model (L2)

def char_ngrams(c, n: int = NGRAM):
    """All overlapping character (code point) n-grams of a string, in order.

    A zero-width look-ahead match at every position yields the n-gram starting
    there in one linear regex pass; positions inside a surrogate pair are
    skipped so every n-gram consists of whole code points.
    """
    pattern = r"(?s)(?=([^\x{DC00}-\x{DFFF}].{%d}))" % (n - 1)
    return F.regexp_extract_all(c, F.lit(pattern), 1)


@dataclass
class NgramProfile:
    """Trained character n-gram naive Bayes model.

    ``table`` has one row per n-gram with ``lp_<lang>`` (BIGINT micro-log-probability,
    add-one smoothed); ``unseen`` and ``prior`` hold the per-language constants.
    The per-language constants are a handful of numbers; everything that grows
    with the training text stays a DataFrame.
    """

    table: DataFrame
    langs: list[str]
    unseen: dict[str, int]
    prior: dict[str, int]
    rows: int
    n: int = NGRAM


def train_langid(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
                 n: int = NGRAM) -> NgramProfile:
    """Train an add-one smoothed character n-gram naive Bayes model.

    ``lp(g, L) = round(1e6 * ln((count(g, L) + 1) / (total(L) + V)))`` with V the
    number of distinct n-grams over all languages; prior ``round(1e6 * ln(docs(L) / docs))``.
    Integer log-probabilities make the later sums independent of summation order.
    """
    docs = labelled.where(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.lower(F.col(text_col)).alias("_t"))
    counts = materialize(gram_totals(docs, ["lang"], "_t", [n]))
    # Per-language constants: bounded by the number of languages.
    totals = counts.groupBy("lang").agg(F.sum("cnt").alias("total"))
    vocab = counts.select("gram").distinct().count()
    per_lang = docs.groupBy("lang").agg(F.count("*").alias("d")).collect()
    doc_counts = {r["lang"]: r["d"] for r in per_lang}
    n_docs = sum(doc_counts.values())
    langs = sorted(doc_counts)
    scale = F.lit(float(LOGPROB_SCALE))
    unseen_rows = (totals.select("lang", F.round(scale * F.ln(F.lit(1.0) / (F.col("total") + F.lit(vocab))))
                                 .cast("bigint").alias("u")).collect())
    unseen = {r["lang"]: r["u"] for r in unseen_rows}
    prior_rows = (docs.sparkSession.createDataFrame(per_lang)
                  .select("lang", F.round(scale * F.ln(F.col("d") / F.lit(float(n_docs))))
                          .cast("bigint").alias("p")).collect())
    prior = {r["lang"]: r["p"] for r in prior_rows}
    lp = counts.join(F.broadcast(totals), "lang").select(
        "gram", "lang",
        F.round(scale * F.ln((F.col("cnt") + F.lit(1)) / (F.col("total") + F.lit(vocab))))
        .cast("bigint").alias("lp"))
    wide = lp.groupBy("gram").pivot("lang", langs).agg(F.first("lp"))
    table = materialize(wide.select("gram", *[F.col(lang).alias(f"lp_{lang}") for lang in langs]))
    return NgramProfile(table=table, langs=langs, unseen=unseen, prior=prior, rows=table.count(), n=n)


def profile_rows(profile: NgramProfile) -> DataFrame:
    """Long form ``(lang, gram, lp)`` of the observed n-grams of a profile."""
    stacked = F.expr("stack({k}, {args}) AS (lang, lp)".format(
        k=len(profile.langs),
        args=", ".join(f"'{lang}', lp_{lang}" for lang in profile.langs)))
    return profile.table.select("gram", stacked).where(F.col("lp").isNotNull())


def score_langid(posts: DataFrame, profile: NgramProfile, id_col: str = "id",
                 text_col: str = "clean") -> DataFrame:
    """Most probable language per post: ``(id, langid, langid_score)``.

    With a profile small enough to broadcast (checked size) the n-grams of a post
    are looked up and summed in its task; beyond that they are counted and
    joined by a shuffle. Ties go to the alphabetically last language.
    """
    lowered = posts.select(F.col(id_col).alias("_pid"), F.lower(F.col(text_col)).alias("_t"))
    if profile.rows <= BROADCAST_MAX_ROWS and profile.n <= PACKED and profile.langs:
        table = profile.table.select("gram", *[f"lp_{lang}" for lang in profile.langs])
        found = gram_sums(lowered, "_pid", "_t", profile.n, table, [profile.unseen[lang] for lang in profile.langs])
        per_post = found.groupBy("_pid").agg(*[F.sum(f"lp_{lang}").alias(f"s_{lang}") for lang in profile.langs])
    else:
        grams = gram_lists(lowered, "_pid", "_t", [profile.n])
        joined = _pieces_with_model(grams, "gram", profile.table, profile.rows)
        sums = [F.sum(F.col("cnt") * F.coalesce(F.col(f"lp_{lang}"), F.lit(profile.unseen[lang])))
                .alias(f"s_{lang}") for lang in profile.langs]
        per_post = joined.groupBy("_pid").agg(*sums)
    candidates = F.array(*[F.struct((F.col(f"s_{lang}") + F.lit(profile.prior[lang])).alias("score"),
                                    F.lit(lang).alias("lang")) for lang in profile.langs])
    best = F.array_max(candidates)
    return per_post.select(F.col("_pid").alias(id_col), best["lang"].alias("langid"),
                           best["score"].alias("langid_score"))


# -------------------------------------------------------------- rules

@dataclass
class LanguageModel:
    """Lexicon index plus n-gram profile, both materialized once and reused."""

    index: DataFrame
    profile: NgramProfile
    langs: list[str]
    index_rows: int


def train_language_model(labelled: DataFrame, langs: Sequence[str], text_col: str = "text",
                         lang_col: str = "lang", id_col: str = "doc_id",
                         min_docs: int = LEXICON_MIN_DOCS) -> LanguageModel:
    """Build lexicon index and n-gram profile from labelled text.

    Texts are dealt by id once for each of the models built from them.
    """
    docs = labelled.select(id_col, lang_col, text_col).repartition(id_col)
    lexicon = build_lexicon(docs, text_col, lang_col, id_col, min_docs)
    index = lexicon_index(lexicon, langs)
    profile = train_langid(docs, text_col, lang_col)
    return LanguageModel(index=index, profile=profile, langs=list(langs), index_rows=broadcast_rows(index))


def _key(id_col: str | Sequence[str]):
    """One column that identifies a post: a column, or several as a struct."""
    return F.col(id_col) if isinstance(id_col, str) else F.struct(*id_col)


def _columns(id_col: str | Sequence[str]) -> list:
    return [F.col("_pid").alias(id_col)] if isinstance(id_col, str) else [F.col(f"_pid.{c}") for c in id_col]


def _prepared(posts: DataFrame, id_col: str | Sequence[str], body_col: str) -> DataFrame:
    """Sanitized texts by key, the empty one where too short to be labelled.

    All steps read the same two columns, so that error rates and labels share a shuffle of the texts; the gate has its own.
    """
    return posts.select(_key(id_col).alias("_pid"), sanitize(F.col(body_col)).alias("clean")) \
        .withColumn("clean", F.when(is_too_short(F.col("clean")), F.lit("")).otherwise(F.col("clean"))).repartition("_pid")


def _of_posts(prepared: DataFrame, gated: DataFrame) -> DataFrame:
    """Posts of the keys in ``gated``: the keys are held, so that texts are not sorted for the join."""
    return prepared.join(gated.select("_pid").hint("shuffle_hash"), "_pid", "left_semi")


def one_each(posts: DataFrame, keys: Sequence[str] = ("kind", "id")) -> DataFrame:
    """One copy of every post (the least), so that labels can be joined back to all copies."""
    return keep_first(posts, list(keys), [])


def label_single(posts: DataFrame, model: LanguageModel, target: str = "de", reference: str = "en",
                 id_col: str | Sequence[str] = "id", body_col: str = "body") -> DataFrame:
    """One-target rule: ``(id, label)`` with label NULL (too short), true or false.

    True iff the post has words, its ``reference`` error rate is over 0.3, its
    ``target`` error rate under 0.7, and the classifier answers ``target``.
    """
    prepared = _prepared(posts, id_col, body_col)
    rates = error_rates(prepared, model.index, [reference, target], "_pid", "clean", model.index_rows)
    gated = rates.where((F.col(f"err_{reference}") > ENGLISH_ERROR_MIN)
                        & (F.col(f"err_{target}") < TARGET_ERROR_MAX)).select("_pid")
    lid = score_langid(_of_posts(prepared, gated), model.profile, "_pid", "clean")
    labelled = prepared.join(lid, "_pid", "left")
    label = F.when(F.col("clean") == "", F.lit(None).cast("boolean")) \
        .otherwise(F.coalesce(F.col("langid") == F.lit(target), F.lit(False)))
    return labelled.select(*_columns(id_col), label.alias("label"))


def label_multi(posts: DataFrame, model: LanguageModel, targets: Sequence[str],
                reference: str = "en", id_col: str | Sequence[str] = "id", body_col: str = "body") -> DataFrame:
    """Many-target rule: ``(id, language)``, language NULL, ``other`` or a target code.

    NULL when too short or without words; ``other`` when the reference error
    rate is at most 0.3; else the classifier's answer if it is one of the
    targets with error rate under 0.7, otherwise ``other``.
    """
    targets = list(targets)
    langs = [reference] + [t for t in targets if t != reference]
    prepared = _prepared(posts, id_col, body_col)
    rates = error_rates(prepared, model.index, langs, "_pid", "clean", model.index_rows)
    candidates = F.filter(
        F.array(*[F.when(F.col(f"err_{t}") < TARGET_ERROR_MAX, F.lit(t)) for t in targets]),
        lambda x: x.isNotNull())
    rated = rates.select("_pid", (F.col(f"err_{reference}") > ENGLISH_ERROR_MIN).alias("non_ref"),
                         candidates.alias("candidates"))
    gated = rated.where(F.col("non_ref") & (F.size("candidates") > 0))
    lid = score_langid(_of_posts(prepared, gated), model.profile, "_pid", "clean")
    decided = rated.join(lid, "_pid", "left").select(
        "_pid",
        F.when(~F.col("non_ref"), F.lit("other"))
        .when(F.array_contains(F.col("candidates"), F.col("langid")), F.col("langid"))
        .otherwise(F.lit("other")).alias("language"))
    # Posts that are too short or have no words are absent from ``decided``.
    return prepared.join(decided, "_pid", "left").select(*_columns(id_col), "language")


def label_with(posts: DataFrame, fn: Callable[[pd.Series], pd.Series], id_col: str = "id",
               body_col: str = "body", out_col: str = "label",
               out_type: T.DataType = T.StringType()) -> DataFrame:
    """Pluggable per-post classifier (L6): ``fn`` maps a batch of texts to labels, an Arrow batch at a time."""
    return label_with_model(posts, lambda: fn, id_col, body_col, out_col, out_type)


def label_with_model(posts: DataFrame, load: Callable[[], Callable[[pd.Series], pd.Series]], id_col: str = "id",
                     body_col: str = "body", out_col: str = "label",
                     out_type: T.DataType = T.StringType()) -> DataFrame:
    """L6 with a model: ``load`` returns the function of a batch of texts and is called once in each task.

    What ``load`` reads (a file that the executors see, a broadcast value) is
    held while the task's batches pass by.
    """
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        classify = load()
        for texts in batches:
            yield classify(texts)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    udf = F.pandas_udf(run, out_type)
    return posts.select(F.col(id_col), udf(sanitize(F.col(body_col))).alias(out_col))


def keep_language(labelled: DataFrame, col: str = "label", value=True) -> DataFrame:
    """keep posts labelled as the target (NULL and false dropped)."""
    if value is True:
        return labelled.where(F.col(col))
    return labelled.where(F.col(col) == F.lit(value))

