"""Repeated and colliding ids, null keys, late files, snapshots, character references."""
import os

import pytest
from pyspark.sql import functions as F

from threadcorpus import session
from threadcorpus.functions.markup import decode_entities
from threadcorpus.operators.lang import label_multi, one_each, train_language_model
from threadcorpus.operators.ordering import keep_first, rank_in_group
from threadcorpus.operators.render import render_posts
from threadcorpus.streaming import stream as ST
from inputs import SF_SMALL


@pytest.fixture(scope="module")
def model(spark):
    return train_language_model(session.read_table(spark, SF_SMALL, "documents"), ["en", "de", "fr", "es"])


@pytest.fixture(scope="module")
def texts(spark):
    docs = session.read_table(spark, SF_SMALL, "documents").where(F.length("text") > 800)
    return {r.lang: r.text for r in docs.groupBy("lang").agg(F.min("text").alias("text")).collect()}


def test_labels_are_keyed_by_kind_and_id(spark, model, texts):
    rows = [("comment", "1", texts["de"]), ("submission", "1", texts["en"]), ("comment", "1", texts["de"])]
    posts = spark.createDataFrame(rows, "kind string, id string, body string")
    keys = ["kind", "id"]
    labels = label_multi(one_each(posts), model, ["de", "fr", "es"], id_col=keys)
    got = {(r.kind, r.id): r.language for r in labels.collect()}
    assert got == {("comment", "1"): "de", ("submission", "1"): "other"}
    assert posts.join(labels, keys, "left").count() == 3


def test_rendering_keeps_rows_that_share_an_id(spark):
    posts = spark.createDataFrame([("1", "one"), ("1", "two")], "id string, body string")
    xml = sorted(r.xml for r in render_posts(posts).collect())
    assert len(xml) == 2 and "one" in xml[0] and "two" in xml[1]


def test_long_character_references(spark):
    df = spark.createDataFrame([("&#0000000228;&#x000000E4;&#0;&#99999999999;",)], "t string")
    assert df.select(decode_entities("t").alias("d")).first().d == "ää\ufffd\ufffd"


def test_rank_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 5)], "k string, t int")
    assert sorted((r.k or "", r.t, r.pos) for r in rank_in_group(df, ["k"], ["t"]).collect()) \
        == [("", 1, 1), ("", 2, 2), ("a", 5, 1)]


def test_keep_first_breaks_ties_by_the_other_columns(spark):
    rows = [("a", 1, "y"), ("a", 1, "x")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "id string, t int, v string")
        assert keep_first(df, ["id"], ["t"]).first().v == "x"


def test_dedup_stream_keeps_late_months_and_continues(spark, tmp_dir):
    source, sink, state = (os.path.join(tmp_dir, n) for n in ("in", "out", "state"))
    schema = "kind string, id string, created_utc bigint"

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        ST.dedup_stream(stream, sink, state).awaitTermination()

    arrive([("c", "1", 1_500_000_000), ("c", "1", 1_500_000_000), ("s", "1", 1_500_000_000)])
    arrive([("c", "1", 1_500_000_000), ("c", "0", 1_200_000_000)])
    assert sorted((r.kind, r.id) for r in spark.read.parquet(sink).collect()) == [("c", "0"), ("c", "1"), ("s", "1")]


def test_dedup_stream_reads_only_what_arrives(spark, tmp_dir):
    source, state = (os.path.join(tmp_dir, n) for n in ("in", "state"))
    schema = "kind string, id string, created_utc bigint"
    read, kept = [], []
    for i in range(4):  # as many new posts each time, and all earlier ones once more in the last
        rows = [("c", f"{i}_{k}", i) for k in range(50)] + ([("c", f"{j}_{k}", 9) for j in range(3) for k in range(50)] if i == 3 else [])
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        sink = os.path.join(tmp_dir, f"out{i}")  # a folder of its own: nothing written before can be read
        q = ST.dedup_stream(spark.readStream.schema(schema).parquet(source), sink, state)
        q.awaitTermination()
        read.append(sum(p["numInputRows"] for p in q.recentProgress))
        kept.append(spark.read.parquet(sink).count())
    assert read == [50, 50, 50, 200] and kept == [50, 50, 50, 50]
    assert any(f.endswith(".zip") for _, _, names in os.walk(state) for f in names)  # RocksDB snapshots


def test_label_job_reads_new_months_only(spark, model, texts, tmp_dir, monkeypatch):
    import json
    from threadcorpus.plans import jobs
    out, decoded = os.path.join(tmp_dir, "out"), []
    read_posts = jobs.readers.read_posts
    monkeypatch.setattr(jobs.readers, "read_posts", lambda spark, paths, kind: decoded.append(list(paths)) or read_posts(spark, paths, kind))
    dumps = []
    for month, key in (("01", "a"), ("02", "b")):
        dumps.append(os.path.join(tmp_dir, f"RC_2014-{month}.gz"))
        lines = [json.dumps({"id": key + i, "body": texts[lang], "subreddit": "s", "link_id": "t3_x", "created_utc": 1})
                 for i, lang in (("1", "de"), ("2", "en"))] + ["{broken"]
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(dumps[-1], compression="gzip")

    def ids():
        return sorted(r.id for r in spark.read.text(os.path.join(out, "ids")).selectExpr("value as id").collect())

    assert jobs.label_comments(spark, dumps[:1], model, out) == dumps[:1] and ids() == ["a1"]
    # A crash after the outputs are written and before the batch is listed: the batch is done again, nothing doubles.
    with monkeypatch.context() as m:
        m.setattr(jobs.sinks, "commit_batches", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            jobs.label_comments(spark, dumps, model, out)
    assert jobs.label_comments(spark, dumps, model, out) == dumps[1:] and ids() == ["a1", "b1"]
    assert jobs.label_comments(spark, dumps, model, out) == []
    assert decoded == [dumps[:1], dumps[1:], dumps[1:]]
    assert spark.read.text(os.path.join(out, "rejects")).count() == 2
    assert jobs.readers.read_lang_meta(spark, os.path.join(out, "meta")).count() == 4


def test_label_stream_keeps_copies_and_malformed_lines(spark, model, texts, tmp_dir):
    import json
    source, sink, state = (os.path.join(tmp_dir, n) for n in ("in", "out", "state"))
    line = json.dumps({"id": "1", "body": texts["de"], "subreddit": "s", "created_utc": 1})
    spark.createDataFrame([(line,)] * 3 + [("{broken",)], "value string").coalesce(1).write.text(source)
    ST.label_stream(spark, source, sink, model, ["de", "fr", "es"], state).awaitTermination()
    assert [r.language for r in spark.read.parquet(os.path.join(sink, "labels")).collect()] == ["de"] * 3
    assert [r.value for r in spark.read.text(os.path.join(sink, "rejects")).collect()] == ["{broken"]
