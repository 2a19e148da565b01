"""Sinks: raw lines, key lists, TSV/CSV tables, JSON records, XML corpus, vertical text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadcorpus.functions.text import epoch_timestamp, escape_field, py_bool_text
from threadcorpus.operators.ordering import sorted_for_output
from threadcorpus.session import ship
from threadcorpus.sources.readers import batch_key


def _writer(df: DataFrame, partition_by: Sequence[str]) -> DataFrameWriter:
    """Overwrite the whole folder, or with ``partition_by`` only the folders of the values that are written."""
    mode = "dynamic" if partition_by else "static"
    return df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*partition_by)


def write_raw(df: DataFrame, path: str, col: str = "raw", compression: str = "gzip",
              partition_by: Sequence[str] = ()) -> None:
    """K1: the original line of every kept record, a folder for each value of ``partition_by``."""
    _writer(df.select(col, *partition_by), partition_by).text(path, compression=compression)


def write_keys(df: DataFrame, path: str, col: str = "id", compression: str = "gzip",
               partition_by: Sequence[str] = ()) -> None:
    """K2: one key per line, a folder for each value of ``partition_by``."""
    _writer(df.select(F.col(col).cast("string"), *partition_by), partition_by).text(path, compression=compression)


def tsv_ready(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Booleans rendered ``True``/``False``, NULL as ``None`` (the TSV convention), strings escaped; ``keep`` as they are."""
    cols = []
    for f in df.schema.fields:
        if f.name in keep:
            cols.append(F.col(f.name))
        elif isinstance(f.dataType, T.BooleanType):
            cols.append(py_bool_text(F.col(f.name)).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            cols.append(escape_field(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_tsv(df: DataFrame, path: str, header: bool = True, compression: str = "gzip",
              partition_by: Sequence[str] = ()) -> None:
    """K3: tab-separated table (label meta, key tables, post meta, scores), a folder for each value of ``partition_by``.

    A value stays in its column whatever it holds: tabs, line ends, NUL and
    backslashes are escaped, blanks at its ends stay. NULL and the text
    ``None`` are written alike, and the empty text is read back as NULL.
    """
    (_writer(tsv_ready(df, partition_by), partition_by)
     .csv(path, sep="\t", header=header, nullValue="None", emptyValue="", quote="", escape="",
          ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression=compression))


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """K4: comma-separated statistics with header; quotes inside values are doubled."""
    df.write.mode("overwrite").csv(path, header=True, escape='"', compression=compression)


def write_post_records(df: DataFrame, path: str, keys: Sequence[str] = ("link_id",),
                       order: Sequence = ("created_utc", "id"), compression: str = "gzip") -> None:
    """K5 (re-aimed): one JSON object per post, files in thread order.

    A thread is never packed into one array on one line (that line could hold
    a third of the data); posts are range-partitioned and sorted by thread and
    order, so every thread's posts are contiguous and in order across files.
    NULL fields are kept (``ignoreNullFields=false``).
    """
    ordered = sorted_for_output(df, list(keys), list(order))
    payload = F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    ordered.select(payload.alias("value")).write.mode("overwrite").text(path, compression=compression)


def write_threads(chunks: DataFrame, path: str, group: Sequence[str] = ("link_id",), compression: str = "gzip") -> None:
    """K5, K6: gathered threads, one JSON object for each chunk, a thread's chunks in order across files.

    A line is bounded by the chunk; a thread of one chunk is one line.
    """
    payload = F.to_json(F.struct(*[F.col(c) for c in chunks.columns]), {"ignoreNullFields": "false"})
    sorted_for_output(chunks, list(group), ["chunk"]).select(payload.alias("value")) \
        .write.mode("overwrite").text(path, compression=compression)


def write_json_records(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """K6: one JSON object per row (e.g. thread scores with their word sums)."""
    payload = F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    df.select(payload.alias("value")).write.mode("overwrite").text(path, compression=compression)


def _wrap_corpus(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    yield pd.DataFrame({"value": ["<corpus>"]})
    for pdf in batches:
        yield pdf[["value"]]
    yield pd.DataFrame({"value": ["</corpus>"]})


def write_xml_corpus(df: DataFrame, path: str, col: str = "xml", compression: str = "gzip") -> None:
    """K7: XML files of ``<text>`` elements, each file wrapped in ``<corpus>``.

    Each partition becomes one file; ``mapInPandas`` adds the root element
    around the partition's rows (Spark's XML writer would escape the inner
    markup, so the elements are written as text).
    """
    rows = df.select(F.col(col).alias("value"))
    ship(df.sparkSession)
    rows.mapInPandas(_wrap_corpus, "value string").write.mode("overwrite") \
        .text(path, compression=compression)


def post_metadata(posts: DataFrame) -> DataFrame:
    """K8: metadata columns of canonical posts with the UTC time as ``date`` and the file's month as ``batch``."""
    date = F.date_format(epoch_timestamp(F.col("created_utc")), "yyyy-MM-dd HH:mm:ss")
    return posts.select("id", "author", date.alias("date"), "link_id", "is_submitter", "parent_id", "permalink",
                        "subreddit", "subreddit_id", batch_key("file_path").alias("batch"))


def write_post_metadata(df: DataFrame, path: str, batch_col: str = "batch") -> None:
    """K8: post metadata CSV, one folder per input batch (month); quotes inside values are doubled."""
    df.write.mode("overwrite").partitionBy(batch_col).csv(path, header=True, escape='"', compression="gzip")


def write_vertical(lines: DataFrame, path: str, compression: str = "gzip") -> None:
    """K9: the vertical corpus, texts whole and in order (range-partitioned, sorted)."""
    ordered = sorted_for_output(lines, ["text_id"], ["part", "created_utc", "post_id", "line_no"])
    ordered.select("line").write.mode("overwrite").text(path, compression=compression)


def pending_batches(inputs: DataFrame, done: DataFrame, key: str = "batch",
                    overwrite: bool = False) -> DataFrame:
    """Input batches whose output does not exist yet (all of them with ``overwrite``)."""
    if overwrite:
        return inputs
    return inputs.join(done.select(key).distinct(), key, "left_anti")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``batch`` of every batch whose outputs are complete; empty before the first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], "batch string")
    return spark.read.text(path).select(F.col("value").alias("batch")).distinct()


def commit_batches(batches: DataFrame, path: str) -> None:
    """Note batches as done, after all their outputs are written.

    A run that ends before this does its batches again, and replaces their
    folders; files appear in the manifest whole or not at all.
    """
    batches.select("batch").coalesce(1).write.mode("append").text(path)


def pending_dumps(spark: SparkSession, dumps: Sequence[str], manifest: str, overwrite: bool = False) -> list[str]:
    """The dumps, named by their batch, that a manifest does not list."""
    named = spark.createDataFrame([(d,) for d in dumps], "path string").withColumn("batch", batch_key("path"))
    return sorted(r.path for r in pending_batches(named, read_manifest(spark, manifest), "batch", overwrite).collect())
