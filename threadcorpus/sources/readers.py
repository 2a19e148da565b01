"""Sources: compressed line-delimited posts, TSV/CSV tables, key lists, threads, regions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadcorpus.functions.text import THREAD_PREFIX, unescape_field

# File suffixes of the codecs that Spark's text source decodes.
SPARK_CODECS = ("gz", "bz2", "zst")

RAW_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("selftext", T.StringType()),
    T.StructField("subreddit", T.StringType()),
    T.StructField("subreddit_id", T.StringType()),
    T.StructField("link_id", T.StringType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("author", T.StringType()),
    # Numbers and quoted numbers both parse into a string field; cast afterwards.
    T.StructField("created_utc", T.StringType()),
    T.StructField("is_submitter", T.BooleanType()),
    T.StructField("permalink", T.StringType()),
    T.StructField("_corrupt_record", T.StringType()),
])

POST_COLUMNS = ["id", "kind", "link_id", "parent_id", "subreddit", "subreddit_id", "created_utc",
                "author", "body", "is_submitter", "permalink", "malformed", "raw"]


# Seconds as a number or quoted number, with or without a fraction (which is cut off).
EPOCH = "try_cast(try_cast(trim(j.created_utc) AS DECIMAL(30, 9)) AS BIGINT)"


def codec_of(path: str) -> str:
    """Compression suffix of a path; anything else is an error."""
    suffix = path.rsplit(".", 1)[-1].lower() if "." in path else ""
    if suffix not in SPARK_CODECS:
        raise ValueError(f"no reader for this file's suffix: {path}")
    return suffix


def read_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines of compressed files as ``(value, file_path)``; codec chosen by suffix.

    gz, bz2 and zst files are read by Spark's text source (bz2 splits, the
    others are one task per file). Other suffixes raise ValueError; xz files
    are to be recompressed first, as Spark has no codec for them.
    """
    paths = list(paths)
    if not paths:
        raise ValueError("no input paths")
    for path in paths:
        codec_of(path)
    return spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file_path"))


def parse_posts(lines: DataFrame, kind: str) -> DataFrame:
    """S2 + P6: JSON lines to the canonical post schema; malformed lines are kept and flagged.

    ``kind`` is ``comment`` or ``submission``. Submissions take their text from
    ``selftext``, their thread key is ``t3_<id>`` and their parent ``None``;
    absent ``parent_id`` becomes ``None``, absent ``is_submitter``/``permalink``
    the empty string. ``created_utc`` accepts numbers and quoted numbers; a
    value that is neither flags the line as malformed.
    """
    if kind not in ("comment", "submission"):
        raise ValueError(f"unknown post kind {kind!r}")
    extra = [c for c in lines.columns if c != "value"]
    parsed = lines.select(*extra, F.col("value").alias("raw"),
                          F.from_json("value", RAW_SCHEMA,
                                      {"mode": "PERMISSIVE",
                                       "columnNameOfCorruptRecord": "_corrupt_record"}).alias("j"))
    j = F.col("j")
    is_sub = kind == "submission"
    link_id = F.concat(F.lit(THREAD_PREFIX), j["id"]) if is_sub else j["link_id"]
    parent = F.lit("None") if is_sub else F.coalesce(j["parent_id"], F.lit("None"))
    body = j["selftext"] if is_sub else j["body"]
    submitter = F.coalesce(F.when(j["is_submitter"], F.lit("True"))
                           .when(~j["is_submitter"], F.lit("False")), F.lit(""))
    return parsed.select(
        j["id"].alias("id"), F.lit(kind).alias("kind"), link_id.alias("link_id"), parent.alias("parent_id"),
        j["subreddit"].alias("subreddit"), j["subreddit_id"].alias("subreddit_id"),
        F.expr(EPOCH).alias("created_utc"),
        j["author"].alias("author"), body.alias("body"), submitter.alias("is_submitter"),
        F.coalesce(j["permalink"], F.lit("")).alias("permalink"),
        (j["_corrupt_record"].isNotNull() | j.isNull()
         | (j["created_utc"].isNotNull() & F.expr(EPOCH).isNull())).alias("malformed"), "raw", *extra)


def read_posts(spark: SparkSession, paths: Sequence[str], kind: str) -> DataFrame:
    """S1 + S2: compressed JSON lines of one kind as canonical posts (with ``file_path``)."""
    return parse_posts(read_lines(spark, paths), kind)


def drop_orphans(posts: DataFrame) -> DataFrame:
    """submissions without ``subreddit_id`` (advertisements) are dropped."""
    return posts.where(~((F.col("kind") == "submission") & F.col("subreddit_id").isNull()))


LANG_META_SCHEMA = "id STRING, subreddit STRING, german BOOLEAN"
POST_META_SCHEMA = ("id STRING, submission BOOLEAN, language STRING, created_utc BIGINT, "
                    "subreddit STRING, subreddit_id STRING, link_id STRING, parent_id STRING")


def read_tsv(spark: SparkSession, path, schema: str | None = None, header: bool = True,
             null: str = "None") -> DataFrame:
    """Tab-separated values without quotes, escaped ones restored; without a schema all columns are strings."""
    df = spark.read.csv(path, sep="\t", quote="", escape="", schema=schema, nullValue=null, header=header)
    return df.select(*[unescape_field(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def read_lang_meta(spark: SparkSession, path) -> DataFrame:
    """S3: headerless 3-column label TSV; ``None`` is a missing label."""
    return read_tsv(spark, path, LANG_META_SCHEMA, header=False)


def read_post_meta(spark: SparkSession, path) -> DataFrame:
    """8-column post meta TSV with header (``None`` read as NULL)."""
    return read_tsv(spark, path, POST_META_SCHEMA)


def read_subreddit_stats(spark: SparkSession, path) -> DataFrame:
    """Community statistics CSV, the corpus columns typed."""
    df = spark.read.csv(path, header=True, inferSchema=False, escape='"')
    return df.select(F.col("subreddit"), F.col("corpus_N").cast("bigint"),
                     F.col("corpus_total").cast("bigint"), F.col("corpus_prop").cast("double"))


def read_keys(spark: SparkSession, path, col: str | None = None) -> DataFrame:
    """Distinct keys from an id list (one per line) or the ``col`` column of a header TSV."""
    if col is None:
        return spark.read.text(path).select(F.trim("value").alias("id")).where(F.col("id") != "").distinct()
    return read_tsv(spark, path, null="").select(col).distinct()


def read_threads(spark: SparkSession, path, comment_schema: T.StructType | None = None) -> DataFrame:
    """One JSON array of comments per line -> one row per comment with ``pos``.

    Lines that are no such array are in :func:`thread_rejects`.
    """
    schema = T.ArrayType(comment_schema or RAW_SCHEMA)
    arrays = spark.read.text(path).select(F.from_json("value", schema).alias("thread"))
    return arrays.select(F.posexplode("thread").alias("pos", "c")).select("pos", "c.*")


def read_gathered(spark: SparkSession, path, schema) -> DataFrame:
    """Chunks of threads as written by ``write_threads``, of the given schema."""
    return spark.read.schema(schema).json(path)


def thread_rejects(spark: SparkSession, path) -> DataFrame:
    """Lines of a thread file that :func:`read_threads` cannot parse: ``(value)``."""
    parsed = spark.read.text(path).select("value", F.from_json("value", T.ArrayType(RAW_SCHEMA)).alias("thread"))
    return parsed.where(F.col("thread").isNull() & (F.trim("value") != "")).select("value")


ATTRIBUTE = r'([A-Za-z_][A-Za-z0-9_]*)="([^"]*)"'


def unescape_attr(value: Column) -> Column:
    """Undo the escaping of attribute values (``&amp;`` last, so nothing is unescaped twice)."""
    for name, char in (("&quot;", '"'), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        value = F.replace(value, F.lit(name), F.lit(char))
    return value


def region_attributes(tag: Column) -> Column:
    """Attributes of an opening tag as a map, their values unescaped."""
    return F.map_from_arrays(F.regexp_extract_all(tag, F.lit(ATTRIBUTE), 1),
                             F.transform(F.regexp_extract_all(tag, F.lit(ATTRIBUTE), 2), unescape_attr))


def content_lines(lines) -> Column:
    """Lines between two tags: without the empty rest that stands before the closing tag."""
    lines = F.col(lines) if isinstance(lines, str) else lines
    return F.when(F.element_at(lines, -1) == "", F.slice(lines, 1, F.size(lines) - 1)).otherwise(lines)


def read_regions(spark: SparkSession, path, level: str) -> DataFrame:
    """Regions ``<level ...>`` ... ``</level>`` of a vertical file as ``(attrs, lines)``.

    Records are split on the closing tag, so a region never straddles two
    rows; ``lines`` are the content lines between the tags, blank ones (which
    end sentences) included.
    """
    records = spark.read.option("lineSep", f"</{level}>").text(path)
    opened = records.select(F.regexp_extract("value", f"(<{level}[ >][^\\n]*)", 1).alias("tag"),
                            F.split(F.regexp_replace("value", f"(?s)^.*?<{level}[ >][^\\n]*\\n", ""), "\n")
                            .alias("lines")).where(F.col("tag") != "")
    return opened.select(region_attributes(F.col("tag")).alias("attrs"), content_lines("lines").alias("lines"))


def nested_regions(regions: DataFrame, level: str) -> DataFrame:
    """Regions of ``level`` nested in the lines of outer regions: ``(outer, pos, attrs, lines)``."""
    text = F.array_join("lines", "\n")
    parts = F.split(text, f"</{level}>")
    exploded = regions.select(F.col("attrs").alias("outer"), F.posexplode(parts).alias("pos", "chunk"))
    inner = exploded.select("outer", "pos",
                            F.regexp_extract("chunk", f"(<{level}[ >][^\\n]*)", 1).alias("tag"),
                            F.regexp_replace("chunk", f"(?s)^.*?<{level}[ >][^\\n]*\\n?", "").alias("body"))
    return inner.where(F.col("tag") != "").select(
        "outer", "pos", region_attributes(F.col("tag")).alias("attrs"),
        content_lines(F.split("body", "\n")).alias("lines"))


def read_metadata(spark: SparkSession, path, sep: str = "\t") -> DataFrame:
    """S9 + P16: metadata table, every column a string, missing and empty values ``NA``.

    Tab-separated tables are written without quotes, with escapes, and read so.
    """
    df = read_tsv(spark, path, null="") if sep == "\t" else \
        spark.read.csv(path, sep=sep, quote='"', escape='"', header=True, inferSchema=False)
    df = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    return df.replace("", None).na.fill("NA")


def batch_key(file_name) -> Column:
    """Batch (month) key of a dump's file name, of either kind: ``RC_yyyy-mm`` or ``RS_yyyy-mm``."""
    c = F.col(file_name) if isinstance(file_name, str) else file_name
    return F.regexp_extract(c, r"(R[CS]_[0-9]{4}-[0-9]{2})", 1)


def base_name(path) -> Column:
    """File name without folder and last suffix."""
    c = F.col(path) if isinstance(path, str) else path
    return F.regexp_replace(F.regexp_extract(c, r"([^/]+)$", 1), r"\.[^.]+$", "")
