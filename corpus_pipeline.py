"""Training corpus pipeline over ``documents``: classify, deduplicate, decontaminate, mask, pack.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``docs``, whatever their types and names. Stages
give no rows for an empty table; each states below what it does with null,
empty and repeated texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadcorpus.llm import cnn, decontaminate, forest, packing, pii
from threadcorpus.llm.common import table
from threadcorpus.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte-level network does not reject.

    A null text is judged as the empty one; equal texts are judged alike,
    whatever their length: every chunk is read. A score at the bound stays.
    """
    return cnn.keep_good(docs, cnn.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts: the least doc_id (null last), ties by a hash of the row.

    Documents without words (null and empty texts) are no copies of each
    other and stay; a row repeated with all its columns stays once.
    """
    return forest.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more than a trace of the benchmark.

    Null and empty texts hold none and stay; repeated rows stay or go together;
    an empty benchmark removes nothing.
    """
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked by its kind; null texts and texts without any stay, rows are never dropped."""
    return pii.mask(docs, pii.fit(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document's tokens in the training sequences.

    A null text, or one without words, has no tokens and no row; a long text
    has a row for each piece; repeated rows are packed each.
    """
    return packing.pack_documents(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("benchmark", benchmark),
          ("personal_data", personal_data), ("pack", pack)]

# Trained models decide in two stages; tests hold run() against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
