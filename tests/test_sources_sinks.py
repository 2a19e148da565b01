import bz2
import glob
import gzip
import os

import pytest
import zstandard
from pyspark.sql import functions as F

from threadcorpus.sources import readers as R
from threadcorpus.sources import sinks as K

LINES = ['{"id":"a","body":"x","link_id":"t3_q","subreddit":"s","subreddit_id":"t5_s","created_utc":1,"author":"u"}',
         '{"id":"b","body":"y","link_id":"t3_q","subreddit":"s","subreddit_id":"t5_s","created_utc":"2","is_submitter":true}',
         '{"id":"c","body":"z","link_id":"t3_q"']


def write_codecs(d):
    data = "\n".join(LINES).encode()
    paths = {"gz": gzip.compress(data), "bz2": bz2.compress(data),
             "zst": zstandard.ZstdCompressor().compress(data)}
    out = []
    for ext, blob in paths.items():
        p = os.path.join(d, f"RC_2010-01.{ext}")
        with open(p, "wb") as f:
            f.write(blob)
        out.append(p)
    return out


def test_every_codec_gives_the_same_lines(spark, tmp_dir):
    paths = write_codecs(tmp_dir)
    lines = R.read_lines(spark, paths).collect()
    by_file = {}
    for r in lines:
        by_file.setdefault(os.path.basename(r.file_path).rsplit(".", 1)[-1], []).append(r.value)
    assert set(by_file) == {"gz", "bz2", "zst"}
    for ext, got in by_file.items():
        assert sorted(got) == sorted(LINES), ext


def test_unsupported_suffix(spark, tmp_dir):
    with pytest.raises(ValueError):
        R.read_lines(spark, [os.path.join(tmp_dir, "x.json")])
    with pytest.raises(ValueError):
        R.read_lines(spark, [os.path.join(tmp_dir, "x.xz")])


def test_times_with_fractions_and_bad_times(spark):
    lines = [('{"id":"a","created_utc":1262304000.0}',), ('{"id":"b","created_utc":"soon"}',), ('{"id":"c"}',)]
    rows = {r.id: r for r in R.parse_posts(spark.createDataFrame(lines, "value string"), "comment").collect()}
    assert rows["a"].created_utc == 1262304000 and not rows["a"].malformed
    assert rows["b"].malformed and not rows["c"].malformed


def test_tsv_keeps_any_value(spark, tmp_dir):
    odd = ["\t", "a\nb", "a\r\nb", "\\t", "\\\\", "\\", "\\\t\\n", "\0", "\\0", "\\\0", " x ", "#", '"', "a\\", "\\\\0\0", "\u2028\u00a0", None]
    rows = [(str(i), a, b) for i, (a, b) in enumerate((a, b) for a in odd for b in odd)]
    df = spark.createDataFrame(rows, "id string, title string, author string").repartition(3)
    path = os.path.join(tmp_dir, "odd")
    K.write_tsv(df, path)
    assert {tuple(r) for r in R.read_tsv(spark, path).collect()} == set(rows)
    missing = [(i, a or "NA", b or "NA") for i, a, b in rows if a and b]
    assert {tuple(r) for r in R.read_metadata(spark, path).collect()} >= set(missing)


def test_tsv_keeps_quotes(spark, tmp_dir):
    df = spark.createDataFrame([("1", '"Hi', "x"), ("2", "b", "y")], "id string, title string, author string")
    path = os.path.join(tmp_dir, "quoted")
    K.write_tsv(df, path)
    assert {tuple(r) for r in R.read_metadata(spark, path).collect()} == {("1", '"Hi', "x"), ("2", "b", "y")}


def test_thread_rejects(spark, tmp_dir):
    path = os.path.join(tmp_dir, "threads")
    spark.createDataFrame([('[{"id":"a"},{"id":"b"}]',), ("not json",)], "value string").write.text(path)
    assert R.read_threads(spark, path).count() == 2
    assert [r.value for r in R.thread_rejects(spark, path).collect()] == ["not json"]


def test_regions_keep_blank_lines(spark, tmp_dir):
    path = os.path.join(tmp_dir, "v.vrt")
    with open(path, "w") as f:
        f.write('<thread id="a &quot;b&quot;">\nx\n\ny\n</thread>\n<thread id="c">\nz\n</thread>')
    rows = {r.attrs["id"]: r["lines"] for r in R.read_regions(spark, path, "thread").collect()}
    assert rows == {'a "b"': ["x", "", "y"], "c": ["z"]}


def test_parse_posts_defaults_and_malformed(spark, tmp_dir):
    paths = write_codecs(tmp_dir)
    posts = R.read_posts(spark, [p for p in paths if p.endswith(".gz")], "comment")
    rows = {r.id: r for r in posts.collect() if not r.malformed}
    assert rows["a"].created_utc == 1 and rows["b"].created_utc == 2
    assert rows["a"].parent_id == "None" and rows["a"].is_submitter == "" and rows["b"].is_submitter == "True"
    assert posts.where("malformed").count() == 1
    subs = spark.createDataFrame([('{"id":"s1","selftext":"t","subreddit":"s"}',)], "value string")
    sub = R.parse_posts(subs, "submission").first()
    assert sub.link_id == "t3_s1" and sub.body == "t" and sub.parent_id == "None"
    assert R.drop_orphans(R.parse_posts(subs, "submission")).count() == 0


def test_tsv_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([("1", "s", True), ("2", "s", None), ("3", "t", False)],
                               "id string, subreddit string, german boolean")
    out = os.path.join(tmp_dir, "lang")
    K.write_tsv(df, out, header=False)
    text = sorted(l for f in glob.glob(out + "/*.gz") for l in gzip.open(f, "rt").read().splitlines())
    assert text == ["1\ts\tTrue", "2\ts\tNone", "3\tt\tFalse"]
    back = sorted(map(tuple, R.read_lang_meta(spark, out).collect()))
    assert back == [("1", "s", True), ("2", "s", None), ("3", "t", False)]


def test_keys_and_batch_names(spark, tmp_dir):
    out = os.path.join(tmp_dir, "ids")
    K.write_keys(spark.createDataFrame([("a",), ("b",), ("a",)], "id string"), out)
    assert sorted(r.id for r in R.read_keys(spark, out).collect()) == ["a", "b"]
    df = spark.createDataFrame([("/x/RC_2015-01-lang.tsv.gz",)], "f string")
    r = df.select(R.batch_key("f").alias("b"), R.base_name("f").alias("n")).first()
    assert r.b == "RC_2015-01" and r.n == "RC_2015-01-lang.tsv"
    inputs = spark.createDataFrame([("RC_2015-01",), ("RC_2015-02",)], "batch string")
    done = spark.createDataFrame([("RC_2015-01",)], "batch string")
    assert [r.batch for r in K.pending_batches(inputs, done).collect()] == ["RC_2015-02"]
    assert K.pending_batches(inputs, done, overwrite=True).count() == 2


def test_xml_corpus_and_vertical_writers(spark, tmp_dir):
    xml = spark.createDataFrame([('<text id="1">\n<p>a</p>\n</text>',)], "xml string").coalesce(1)
    out = os.path.join(tmp_dir, "xml")
    K.write_xml_corpus(xml, out)
    body = "".join(gzip.open(f, "rt").read() for f in sorted(glob.glob(out + "/*.gz")))
    assert body.startswith("<corpus>\n<text id=\"1\">") and body.rstrip().endswith("</corpus>")
    lines = spark.createDataFrame(
        [("2", 0, 0, "", 0, "<text id=\"2\">"), ("1", 3, 0, "", 0, "</text>"), ("1", 2, 5, "c", 1, "w"),
         ("1", 0, 0, "", 0, "<text id=\"1\">"), ("1", 2, 5, "c", 0, "<comment id=\"c\">"), ("2", 3, 0, "", 0, "</text>")],
        "text_id string, part int, created_utc long, post_id string, line_no int, line string")
    out = os.path.join(tmp_dir, "vrt")
    K.write_vertical(lines, out)
    text = [l for f in sorted(glob.glob(out + "/part-*")) for l in gzip.open(f, "rt").read().splitlines()]
    assert text == ['<text id="1">', '<comment id="c">', "w", "</text>", '<text id="2">', "</text>"]


def test_threads_and_regions(spark, tmp_dir):
    p = os.path.join(tmp_dir, "threads.json")
    with open(p, "w") as f:
        f.write('[{"id":"a","link_id":"t3_x"},{"id":"b","link_id":"t3_x"}]\n[{"id":"c","link_id":"t3_y"}]\n')
    rows = sorted((r.id, r.pos) for r in R.read_threads(spark, p).collect())
    assert rows == [("a", 0), ("b", 1), ("c", 0)]
    v = os.path.join(tmp_dir, "corpus.vrt")
    with open(v, "w") as f:
        f.write('<thread id="t3_x">\n<comment id="a">\n<p>\nw\n</p>\n</comment>\n<comment id="b">\nz\n</comment>\n'
                '</thread>\n<thread id="t3_y">\n<comment id="c">\nq\n</comment>\n</thread>\n')
    regions = R.read_regions(spark, v, "thread")
    assert sorted(r.attrs["id"] for r in regions.collect()) == ["t3_x", "t3_y"]
    nested = R.nested_regions(regions, "comment").collect()
    got = sorted((r.outer["id"], r.attrs["id"], tuple(r.lines)) for r in nested)
    assert got == [("t3_x", "a", ("<p>", "w", "</p>")), ("t3_x", "b", ("z",)), ("t3_y", "c", ("q",))]


def test_label_job_keeps_rejects_and_unlabelled_comments(spark, tmp_dir):
    import json
    import os
    from threadcorpus.operators import lang as L
    from threadcorpus.plans import jobs
    de = "der hund und die katze sind im garten und spielen heute zusammen"
    en = "the dog and the cat are in the garden and play together today"
    rows = [(i, t, l) for i, (t, l) in enumerate([(de, "de")] * 4 + [(en, "en")] * 4)]
    model = L.train_language_model(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), ["en", "de"])
    lines = [json.dumps({"id": "a", "body": de, "subreddit": "x", "link_id": "t3_1", "created_utc": 1}),
             json.dumps({"id": "a", "body": de, "subreddit": "x", "link_id": "t3_1", "created_utc": 1}),
             json.dumps({"id": "b", "body": en, "subreddit": 'q"x', "link_id": "t3_1", "created_utc": "2"}),
             json.dumps({"id": "c", "body": "kurz", "subreddit": "x", "link_id": "t3_2", "created_utc": 3}), "{broken"]
    dump, out = os.path.join(tmp_dir, "RC_2015-03.gz"), os.path.join(tmp_dir, "out")
    spark.createDataFrame([(x,) for x in lines], "raw string").write.text(dump, compression="gzip")
    jobs.label_comments(spark, [dump], model, out)
    meta = sorted(map(tuple, R.read_lang_meta(spark, os.path.join(out, "meta")).collect()), key=str)
    assert meta == sorted([("a", "x", True, "RC_2015-03")] * 2 + [("b", 'q"x', False, "RC_2015-03"),
                                                                  ("c", "x", None, "RC_2015-03")], key=str)
    assert sorted(r.value for r in spark.read.text(os.path.join(out, "raw")).collect()) == lines[:2]
    assert [r.id for r in R.read_keys(spark, os.path.join(out, "ids")).collect()] == ["a"]
    assert [r.value for r in spark.read.text(os.path.join(out, "rejects")).collect()] == ["{broken"]
    jobs.community_statistics(spark, os.path.join(out, "meta"), out)
    stats = R.read_subreddit_stats(spark, os.path.join(out, "stats")).collect()
    assert [tuple(r)[:3] for r in stats] == [("x", 2, 3)]
