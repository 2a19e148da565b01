"""Community statistics: monthly and corpus shares, thresholds, scores.

All aggregations are single ``groupBy`` passes with conditional counts, so
Spark combines map-side before the shuffle: a community holding a third of
all posts costs one partial row per map task, not a third of the data in one
task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadcorpus.functions.text import THREAD_SCORE_CUTOFF, share_threshold
from threadcorpus.operators.joins import checked_join
from threadcorpus.operators.ordering import rank_in_group
from threadcorpus.session import materialize

# Fixed value: communities need more than this many positive posts overall.
MIN_CORPUS_N = 1


def label_counts(meta: DataFrame, label_col: str = "label",
                 by: Sequence[str] = ("month", "subreddit")) -> DataFrame:
    """A1: number of posts per ``by`` and label value (NULL labels are a group too)."""
    return meta.groupBy(*by, F.col(label_col).alias("label")).agg(F.count("*").alias("n"))


def with_share(counts: DataFrame, by: Sequence[str], n_col: str = "n") -> DataFrame:
    """Add the group ``total`` and ``prop = n / total`` to every row.

    Meant for aggregated count tables (a few rows per group).
    """
    w = Window.partitionBy(*by)
    total = F.sum(n_col).over(w)
    return counts.withColumn("total", total).withColumn("prop", F.col(n_col) / F.col("total"))


def monthly_share(meta: DataFrame, label_col: str = "label",
                  by: Sequence[str] = ("month", "subreddit")) -> DataFrame:
    """A2 + F6: per month and community ``n`` (positives), ``total`` (all posts, unlabelled too), ``prop``.

    Communities without a positive post in a month are left out.
    """
    agg = meta.groupBy(*by).agg(F.count_if(F.col(label_col)).alias("n"), F.count("*").alias("total"))
    return agg.where(F.col("n") > 0).withColumn("prop", F.col("n") / F.col("total"))


def rank_monthly(monthly: DataFrame, month_col: str = "month") -> DataFrame:
    """Rank communities within a month by ``n`` desc, ``prop`` desc (ties by name).

    The input is the aggregated monthly table: one row per community and month.
    A month of many communities is ranked in pieces, never in one task.
    """
    return rank_in_group(monthly, [month_col], [F.desc("n"), F.desc("prop"), F.asc("subreddit")], "rank")


def corpus_share(monthly: DataFrame) -> DataFrame:
    """A3: ``corpus_N``, ``corpus_total`` summed over the months present, ``corpus_prop``.

    Months in which a community had no positive post are absent from the
    monthly table, so they do not count towards ``corpus_total``.
    """
    agg = monthly.groupBy("subreddit").agg(F.sum("n").cast("bigint").alias("corpus_N"),
                                           F.sum("total").cast("bigint").alias("corpus_total"))
    return agg.withColumn("corpus_prop", F.col("corpus_N") / F.col("corpus_total"))


def top_communities(corpus: DataFrame, k: int) -> DataFrame:
    """The ``k`` communities with most positives (then highest share, then name).

    ``orderBy().limit()`` plans as a distributed top-k (each task keeps k rows).
    """
    return corpus.orderBy(F.desc("corpus_N"), F.desc("corpus_prop"), F.asc("subreddit")).limit(k)


def monthly_wide(monthly: DataFrame, months: Sequence[str] | None = None,
                 prefix: str = "RC_") -> DataFrame:
    """One row per community, a ``<prefix><month>_{N,total,prop}`` triple per month.

    Replaces one full outer join per month with a single pivot. Pass ``months``
    to skip the job that finds the distinct months and to fix the width.
    """
    keyed = monthly.withColumn("_m", F.concat(F.lit(prefix), F.col("month")))
    values = [prefix + m for m in months] if months is not None else None
    grouped = keyed.groupBy("subreddit")
    pivoted = (grouped.pivot("_m", values) if values is not None else grouped.pivot("_m"))
    return pivoted.agg(F.first("n").alias("N"), F.first("total").alias("total"),
                       F.first("prop").alias("prop"))


def community_stats(monthly: DataFrame, months: Sequence[str] | None = None) -> DataFrame:
    """``stats``: corpus columns first, then the monthly triples."""
    wide = monthly_wide(monthly, months)
    corpus = corpus_share(monthly)
    joined = corpus.join(wide, "subreddit")
    month_cols = [c for c in wide.columns if c != "subreddit"]
    return joined.select("subreddit", "corpus_N", "corpus_total", "corpus_prop", *month_cols)


def filter_communities(corpus: DataFrame, min_n: int = MIN_CORPUS_N) -> DataFrame:
    """F3 + P9: keep ``corpus_N > min_n`` and ``corpus_prop >= exp(-sqrt(corpus_total)/4) + 0.015``."""
    threshold = share_threshold(F.col("corpus_total"))
    return corpus.where((F.col("corpus_N") > min_n) & (F.col("corpus_prop") >= threshold)) \
        .withColumn("threshold", threshold)


def _stack(langs: Sequence[str], value_prefix: str, extra: Sequence[str] = ()) -> F.Column:
    fields = ["lang", "target"] + [e for e in extra]
    args = []
    for lang in langs:
        args.append(f"'{lang}'")
        args.append(f"`{value_prefix}{lang}`")
        args.extend(f"`{e}_{lang}`" for e in extra)
    return F.expr(f"stack({len(langs)}, {', '.join(args)}) AS ({', '.join(fields)})")


def community_scores(meta: DataFrame, langs: Sequence[str], label_col: str = "language",
                     key: str = "subreddit_id") -> DataFrame:
    """A4 + A8 + F4: per language and community with >= 1 post in it.

    ``target`` posts in the language, ``total`` posts of all kinds and labels,
    ``fraction``, ``threshold`` and ``exceeded = fraction >= threshold`` (a flag,
    not a filter). One aggregation serves all languages.
    """
    aggs = [F.count("*").alias("total")]
    aggs += [F.count_if(F.col(label_col) == F.lit(lang)).alias(f"t_{lang}") for lang in langs]
    per_key = meta.groupBy(key).agg(*aggs)
    long = per_key.select(key, "total", _stack(langs, "t_")).where(F.col("target") > 0)
    threshold = share_threshold(F.col("total"))
    return long.select("lang", key, "target", "total",
                       (F.col("target") / F.col("total")).alias("fraction"),
                       threshold.alias("threshold"),
                       ((F.col("target") / F.col("total")) >= threshold).alias("exceeded"))


def thread_scores(meta: DataFrame, communities: DataFrame, langs: Sequence[str],
                  label_col: str = "language", cutoff: float = THREAD_SCORE_CUTOFF) -> DataFrame:
    """A5 + J7: per language and thread with >= 1 post in it.

    ``fraction`` = target / total posts of the thread; ``subreddit_fraction`` is
    the community's fraction (community flag not required); ``score`` is their
    product and ``exceeded = score >= cutoff``.
    """
    # Counts per (thread, community) keep only integer buffers, so the big
    # aggregation over all posts is hash based; the community per language is
    # then picked from the few rows per thread.
    counts = [F.count("*").alias("n")]
    counts += [F.count_if(F.col(label_col) == F.lit(lang)).alias(f"t_{lang}") for lang in langs]
    per_pair = meta.groupBy("link_id", "subreddit_id").agg(*counts)
    aggs = [F.sum("n").alias("total")]
    for lang in langs:
        aggs.append(F.sum(f"t_{lang}").alias(f"t_{lang}"))
        aggs.append(F.max(F.when(F.col(f"t_{lang}") > 0, F.col("subreddit_id"))).alias(f"sid_{lang}"))
    per_thread = per_pair.groupBy("link_id").agg(*aggs)
    long = per_thread.select("link_id", "total", _stack(langs, "t_", ["sid"])) \
        .where(F.col("target") > 0).withColumnRenamed("sid", "subreddit_id")
    community = materialize(communities.select(
        "lang", "subreddit_id", F.col("fraction").alias("subreddit_fraction")))
    joined = checked_join(long, community, ["lang", "subreddit_id"], "inner")
    fraction = F.col("target") / F.col("total")
    score = fraction * F.col("subreddit_fraction")
    return joined.select("lang", "link_id", "subreddit_id", "target", "total",
                         fraction.alias("fraction"), "subreddit_fraction",
                         score.alias("score"), (score >= F.lit(cutoff)).alias("exceeded"))


def selected_threads(scores: DataFrame, cutoff: float = THREAD_SCORE_CUTOFF) -> DataFrame:
    """Thread keys with ``score >= cutoff``."""
    return scores.where(F.col("score") >= F.lit(cutoff))
