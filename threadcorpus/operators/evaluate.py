"""Evaluation: corpus size report, stratified thread sample, label quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadcorpus.functions.text import epoch_date, words


def corpus_summary(posts: DataFrame) -> DataFrame:
    """Posts, word tokens and first/last year per post kind."""
    year = F.year(epoch_date(F.col("created_utc")))
    return posts.groupBy("kind").agg(
        F.count("*").alias("n_posts"),
        F.sum(F.size(words(F.col("body")))).cast("bigint").alias("n_tokens"),
        F.min(year).alias("first_year"),
        F.max(year).alias("last_year"))


def score_bins(score: Column, bins: int) -> Column:
    """Equal-width bins of a score in [0, 1]; 1.0 falls into the last bin."""
    return F.least(F.floor(score * F.lit(bins)), F.lit(bins - 1)).cast("int")


def stratified_sample(scores: DataFrame, key: str, stratum: Column, n: int, seed: str,
                      salts: int | None = None) -> DataFrame:
    """``n`` rows per stratum, chosen by ``md5(key || seed)`` (deterministic).

    Two-phase top-k: rows are ranked within (stratum, salt) pieces first, so
    no task holds a whole stratum; there are as many salts as shuffle
    partitions, unless given. The second ranking sees at most
    ``n * salts`` rows per stratum. The result is exactly the global top ``n``.
    """
    salts = salts or int(scores.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.md5(F.concat(F.col(key).cast("string"), F.lit(seed))), F.col(key)]
    staged = scores.withColumn("stratum", stratum).withColumn(
        "_salt", F.pmod(F.xxhash64(F.col(key)), F.lit(salts)))
    first = staged.withColumn("_r", F.row_number().over(
        Window.partitionBy("stratum", "_salt").orderBy(*order))).where(F.col("_r") <= n)
    second = first.withColumn("sample_rank", F.row_number().over(
        Window.partitionBy("stratum").orderBy(*order))).where(F.col("sample_rank") <= n)
    return second.drop("_salt", "_r")


def confusion(pred: DataFrame, pred_col: str, gold_col: str) -> DataFrame:
    """Counts per (gold, predicted) pair; NULL predictions are a class of their own."""
    return pred.groupBy(F.col(gold_col).alias("gold"), F.col(pred_col).alias("predicted")) \
        .agg(F.count("*").alias("n"))


def label_quality(pred: DataFrame, pred_col: str, gold_col: str, classes: Sequence[str]) -> DataFrame:
    """Per class ``tp``, ``fp``, ``fn``, precision, recall and F1 (one aggregation)."""
    aggs = []
    for c in classes:
        p, g = F.col(pred_col) == F.lit(c), F.col(gold_col) == F.lit(c)
        aggs += [F.count_if(p & g).alias(f"tp_{c}"),
                 F.count_if(p & ~F.coalesce(g, F.lit(False))).alias(f"fp_{c}"),
                 F.count_if(g & ~F.coalesce(p, F.lit(False))).alias(f"fn_{c}")]
    wide = pred.agg(*aggs)
    stacked = F.expr("stack({k}, {a}) AS (class, tp, fp, fn)".format(
        k=len(classes), a=", ".join(f"'{c}', tp_{c}, fp_{c}, fn_{c}" for c in classes)))
    long = wide.select(stacked)
    precision = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    return long.select("class", "tp", "fp", "fn", precision.alias("precision"), recall.alias("recall"),
                       F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"))


def sweep_threshold(scored: DataFrame, score_col: str, gold_col: str,
                    thresholds: Sequence[float]) -> DataFrame:
    """``tp``, ``fp``, ``fn`` of the rule ``score >= t`` for every ``t`` in one pass."""
    aggs = []
    for i, t in enumerate(thresholds):
        p, g = F.col(score_col) >= F.lit(t), F.col(gold_col)
        aggs += [F.count_if(p & g).alias(f"tp{i}"), F.count_if(p & ~g).alias(f"fp{i}"),
                 F.count_if(~p & g).alias(f"fn{i}")]
    wide = scored.agg(*aggs)
    stacked = F.expr("stack({k}, {a}) AS (threshold, tp, fp, fn)".format(
        k=len(thresholds), a=", ".join(f"CAST({t} AS DOUBLE), tp{i}, fp{i}, fn{i}"
                                       for i, t in enumerate(thresholds))))
    return wide.select(stacked)
