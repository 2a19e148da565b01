"""Language profiles of fixed size: character n-grams ranked by information gain (L2).

A gram is worth keeping for a language if its presence in a document tells
much about the language and little about the source, so the rank is the
information gain on "this language or another" less the gain on the source.
Gains are sums of ``x ln x`` over document counts, rounded to integers term by
term, so they do not depend on the order of summation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadcorpus.operators.grams import gram_lists, gram_totals
from threadcorpus.operators.joins import checked_join
from threadcorpus.operators.lang import LOGPROB_SCALE, char_ngrams
from threadcorpus.session import materialize

SIZES = (1, 2, 3, 4)     # lengths of the grams
PER_LANGUAGE = 300       # grams kept for each language
GAIN_SCALE = 1000.0      # x ln x in thousandths: exact in a BIGINT up to 10^14 documents


def mixed_ngrams(c, sizes: Sequence[int] = SIZES) -> Column:
    """All overlapping character n-grams of the given lengths (null: null)."""
    return F.concat(*[char_ngrams(c, n) for n in sizes])


def _xlnx(x: Column) -> Column:
    return F.when(x > 0, F.round(F.lit(GAIN_SCALE) * x * F.ln(x)).cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def _labelled(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    return docs.where(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        F.lower(F.col(text_col)).alias("_t"))


def gram_gains(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
               sizes: Sequence[int] = SIZES) -> DataFrame:
    """``(lang, gram, score)`` of every gram that is likelier in the language than elsewhere.

    ``score`` is the number of documents times (gain on the language less gain
    on the source), in thousandths of a nat. Rows without a language are left
    out, a null source is one source, a null or empty text counts as a document
    without grams, repeated rows count each. A gram is counted once a document
    and combined before the shuffle, so a frequent gram is a row a task.
    """
    docs = _labelled(labelled, text_col, lang_col, source_col)
    places = materialize(docs.groupBy("lang", "source").agg(F.count("*").alias("docs")))
    langs = {r["lang"]: r["n"] for r in places.groupBy("lang").agg(F.sum("docs").alias("n")).collect()}
    n = F.lit(sum(langs.values())).cast("bigint")
    sources = materialize(places.groupBy("source").agg(F.sum("docs").alias("source_docs")))
    all_sources = F.lit(sources.agg(F.sum(_xlnx(F.col("source_docs")))).first()[0] or 0).cast("bigint")
    counts = materialize(gram_totals(docs, ["lang", "source"], "_t", sizes, once=True).withColumnRenamed("cnt", "n"))

    by_source = checked_join(counts.groupBy("gram", "source").agg(F.sum("n").alias("n")), sources, "source")
    rest = F.col("source_docs") - F.col("n")
    grams = by_source.groupBy("gram").agg(
        F.sum("n").alias("docs"), F.sum(_xlnx(F.col("n"))).alias("inside"),
        F.sum(_xlnx(rest) - _xlnx(F.col("source_docs"))).alias("outside"))
    without = n - F.col("docs")
    source_gain = ((_xlnx(n) - all_sources) - (_xlnx(F.col("docs")) - F.col("inside"))
                   - (_xlnx(without) - (all_sources + F.col("outside"))))

    of_lang = F.create_map(*[x for lang, m in sorted(langs.items()) for x in (F.lit(lang), F.lit(m).cast("bigint"))]) \
        if langs else F.create_map().cast("map<string,bigint>")
    pairs = counts.groupBy("gram", "lang").agg(F.sum("n").alias("held")).withColumn("lang_docs", of_lang[F.col("lang")])
    held, lang_docs = F.col("held"), F.col("lang_docs")
    lang_gain = ((_xlnx(n) - _xlnx(lang_docs) - _xlnx(n - lang_docs))
                 - (_xlnx(F.col("docs")) - _xlnx(held) - _xlnx(F.col("docs") - held))
                 - (_xlnx(without) - _xlnx(lang_docs - held) - _xlnx(without - lang_docs + held)))
    return (pairs.join(grams, "gram").where(held / F.col("docs") > lang_docs / n)
            .select("lang", "gram", (lang_gain - source_gain).alias("score")))


def select_features(gains: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """The best grams of each language: ``(lang, gram, score, rank)``, ties by the gram.

    A rank limit is applied in every task before the shuffle, so at most
    ``per_language`` rows of a language leave a task.
    """
    best = Window.partitionBy("lang").orderBy(F.desc("score"), "gram")
    return gains.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= per_language)


@dataclass
class FeatureProfile:
    """Naive Bayes over selected grams: ``table`` holds ``gram`` and ``lp_<lang>`` (BIGINT micro-units)."""

    table: DataFrame
    langs: list[str]
    prior: dict[str, int]
    sizes: tuple[int, ...] = SIZES


def train_features(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                   sizes: Sequence[int] = SIZES, per_language: int = PER_LANGUAGE) -> FeatureProfile:
    """A profile of at most ``per_language`` grams for each language, however large the text.

    ``lp(g, L) = round(1e6 * ln((count(g, L) + 1) / (total(L) + V)))`` over the
    V selected grams; prior ``round(1e6 * ln(docs(L) / docs))``.
    """
    docs = _labelled(labelled, text_col, lang_col, source_col)
    chosen = materialize(select_features(gram_gains(labelled, text_col, lang_col, source_col, sizes), per_language)
                         .select("gram").distinct())
    size = chosen.count()
    per_lang = {r["lang"]: r["d"] for r in docs.groupBy("lang").agg(F.count("*").alias("d")).collect()}
    langs = sorted(per_lang)
    found = checked_join(gram_totals(docs, ["lang"], "_t", sizes), chosen, "gram")
    seen = materialize(found.groupBy("gram").agg(*[
        F.sum(F.when(F.col("lang") == lang, F.col("cnt")).otherwise(F.lit(0))).alias(f"n_{i}")
        for i, lang in enumerate(langs)] or [F.sum("cnt").alias("n")]))
    totals = seen.agg(*[F.coalesce(F.sum(f"n_{i}"), F.lit(0)).alias(f"n_{i}") for i in range(len(langs))]
                      or [F.count("*").alias("n")]).first()
    scale = F.lit(float(LOGPROB_SCALE))
    lps = [F.round(scale * F.ln((F.col(f"n_{i}") + F.lit(1)) / F.lit(totals[f"n_{i}"] + size))).cast("bigint")
           .alias(f"lp_{lang}") for i, lang in enumerate(langs)]
    n_docs = float(sum(per_lang.values()))
    row = docs.sparkSession.range(1).select(F.lit(0), *[
        F.round(scale * F.ln(F.lit(d) / F.lit(n_docs))).cast("bigint").alias(f"p_{i}")
        for i, d in enumerate(per_lang[x] for x in langs)]).first()
    return FeatureProfile(table=materialize(seen.select("gram", *lps)), langs=langs,
                          prior={lang: row[f"p_{i}"] for i, lang in enumerate(langs)}, sizes=tuple(sizes))


def score_features(posts: DataFrame, profile: FeatureProfile, id_col: str = "id", text_col: str = "clean") -> DataFrame:
    """Most probable language of every post that holds a selected gram: ``(id, langid, langid_score)``.

    Grams outside the profile are skipped; ties go to the alphabetically last
    language. The profile is broadcast after its size is checked; sums are
    combined before the shuffle. A profile without languages names none.
    """
    if not profile.langs:
        return posts.select(id_col, F.lit(None).cast("string").alias("langid"),
                            F.lit(None).cast("bigint").alias("langid_score")).where(F.lit(False))
    lowered = posts.select(F.col(id_col).alias("_pid"), F.lower(F.col(text_col)).alias("_t"))
    grams = gram_lists(lowered, "_pid", "_t", profile.sizes)
    sums = checked_join(grams, profile.table, "gram").groupBy("_pid").agg(
        *[F.sum(F.col(f"lp_{lang}") * F.col("cnt")).alias(f"s_{i}") for i, lang in enumerate(profile.langs)])
    best = F.array_max(F.array(*[F.struct((F.col(f"s_{i}") + F.lit(profile.prior[lang])).alias("score"),
                                          F.lit(lang).alias("lang")) for i, lang in enumerate(profile.langs)]))
    return sums.select(F.col("_pid").alias(id_col), best["lang"].alias("langid"), best["score"].alias("langid_score"))
