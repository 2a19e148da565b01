"""Inputs shared by the registered queries: fixture posts, models, stage outputs.

A model (lexicon index + n-gram profile) is trained once per application and
data folder and kept in the checkpoint folder, the way a user trains it once
and reuses it for every labelling job. Labelled posts are a stage output in
the same sense (the label files of the original workflow): written once to
the checkpoint folder and read by the statistics and thread stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadcorpus.functions.text import epoch_month
from threadcorpus.operators.lang import LanguageModel, label_multi, label_single, one_each, train_language_model
from threadcorpus.plans.fixtures import REFERENCE_LANG, SINGLE_TARGET, TARGET_LANGS, fixture
from threadcorpus.session import materialize, read_table

MODEL_LANGS = [REFERENCE_LANG, *TARGET_LANGS]

_MODELS: dict[tuple[str, str], LanguageModel] = {}
_STAGES: dict[tuple[str, str, str], DataFrame] = {}


def _stage(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STAGES:
        _STAGES[key] = materialize(build())
    return _STAGES[key]


def language_model(spark: SparkSession, sf_dir: str) -> LanguageModel:
    """Lexicon and n-gram profile trained on the labelled ``documents`` table."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        docs = read_table(spark, sf_dir, "documents")
        _MODELS[key] = train_language_model(docs, MODEL_LANGS)
    return _MODELS[key]


def single_labels(spark: SparkSession, sf_dir: str, posts: DataFrame | None = None) -> DataFrame:
    """One-target labels of the ``posts`` fixture: ``(id, label)``."""
    posts = posts if posts is not None else fixture(spark, sf_dir, "posts")
    return label_single(posts, language_model(spark, sf_dir), SINGLE_TARGET, REFERENCE_LANG)


def keyed_single_labels(spark: SparkSession, sf_dir: str, posts: DataFrame) -> DataFrame:
    """One label for each post, whatever its number of copies: ``(kind, id, label)``."""
    return label_single(one_each(posts.select("kind", "id", "body")), language_model(spark, sf_dir),
                        SINGLE_TARGET, REFERENCE_LANG, id_col=["kind", "id"])


def label_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label meta rows ``(id, subreddit, link_id, created_utc, month, label)`` of ``posts`` (stage output)."""
    def build() -> DataFrame:
        posts = fixture(spark, sf_dir, "posts")
        labels = keyed_single_labels(spark, sf_dir, posts)
        return posts.select("kind", "id", "subreddit", "link_id", "created_utc",
                            epoch_month(F.col("created_utc")).alias("month")).join(labels, ["kind", "id"]).drop("kind")
    return _stage(spark, sf_dir, "label_meta", build)


def multi_meta(spark: SparkSession, sf_dir: str, name: str = "posts_conv") -> DataFrame:
    """Post meta rows of a thread fixture with the many-language label ``language`` (stage output)."""
    def build() -> DataFrame:
        posts = fixture(spark, sf_dir, name)
        labels = label_multi(one_each(posts.select("kind", "id", "body")), language_model(spark, sf_dir),
                             TARGET_LANGS, REFERENCE_LANG, id_col=["kind", "id"])
        return posts.drop("body").join(labels, ["kind", "id"], "left")
    return _stage(spark, sf_dir, "multi_meta:" + name, build)
