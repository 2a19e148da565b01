from pyspark.sql import functions as F

from threadcorpus.operators import corpus as C
from threadcorpus.operators import threads as T


def posts(spark):
    rows = [("1", "submission", "t3_1", 100, "Title text. Second one!"),
            ("1_1", "comment", "t3_1", 100, "first comment"),
            ("1_2", "comment", "t3_1", 200, "later"),
            ("1_2", "comment", "t3_1", 200, "later"),
            ("2_1", "comment", "t3_2", 50, "no submission here"),
            ("3_1", "comment", "t3_3", 60, "thread without meta")]
    return spark.createDataFrame(rows, "id string, kind string, link_id string, created_utc long, body string")


def test_dedup_order_and_report(spark):
    p = posts(spark)
    ordered = T.order_thread(T.dedup_thread(p))
    got = sorted((r.link_id, r.pos, r.id) for r in ordered.collect())
    # comments sort before a submission at the same time
    assert got == [("t3_1", 1, "1_1"), ("t3_1", 2, "1"), ("t3_1", 3, "1_2"), ("t3_2", 1, "2_1"), ("t3_3", 1, "3_1")]
    assert [(r.link_id, r.skipped) for r in T.duplicate_report(p).collect()] == [("t3_1", 1)]
    again = T.dedup_thread(T.dedup_thread(p))
    assert again.count() == T.dedup_thread(p).count()


def test_sentence_tags_edge_cases(spark):
    lines = ["<p>", "a", "", "b", "", "</p>", "", "x", "<p>", "c", "</p>"]
    df = spark.createDataFrame([("t", i, l) for i, l in enumerate(lines)], "id string, line_no int, line string")
    out = [r.line for r in C.insert_sentence_tags(df, ["id"]).orderBy("line_no", "sub").collect()]
    assert out == ["<p>", "<s>", "a", "</s>", "<s>", "b", "</s>", "<s>", "</s>", "</p>", "x",
                   "<p>", "<s>", "c", "</s>", "</p>"]
    assert out.count("<s>") == out.count("</s>")


def test_tagged_lines_equal_tags_on_vertical(spark):
    texts = ["One two. Three four! Five?\n\nNext para here.", "No end", "---\n\nx"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, body string")
    fused = {r.id: r.l for r in df.select("id", C.tagged_lines(F.col("body")).alias("l")).collect()}
    lines = df.select("id", F.posexplode(C.vertical_lines(F.col("body"))).alias("line_no", "line"))
    tagged = C.insert_sentence_tags(lines, ["id"]).orderBy("id", "line_no", "sub").collect()
    by_id = {}
    for r in tagged:
        by_id.setdefault(r.id, []).append(r.line)
    assert by_id == fused
    assert fused["0"][:6] == ["<p>", "<s>", "One", "two", ".", "</s>"]


def test_assembly_drops_and_rejects(spark):
    p = posts(spark)
    tmeta = spark.createDataFrame([("1", "board"), ("2", None)], "id string, subreddit string")
    cmeta = spark.createDataFrame([("1_1", "u1"), ("2_1", "u2")], "id string, author string")
    lines = C.assemble_texts(p, tmeta, cmeta)
    ordered = [r.line for r in lines.orderBy(*C.corpus_order()).collect()]
    assert ordered[0] == '<text id="1" subreddit="board">'
    assert '<submission id="1">' in ordered and '<comment id="1_1" author="u1">' in ordered
    assert '<text id="2" subreddit="NA">' in ordered
    assert not any("1_2" in l for l in ordered)
    assert ordered.count("</text>") == 2
    rej = sorted((r.kind, r.id) for r in C.assembly_rejects(p, tmeta, cmeta).collect())
    assert rej == [("comment", "1_2"), ("thread", "3")]
    smeta = spark.createDataFrame([("9", "u")], "id string, author string")
    rej = sorted((r.kind, r.id) for r in C.assembly_rejects(p, tmeta, cmeta, smeta).collect())
    assert rej == [("comment", "1_2"), ("submission", "1"), ("thread", "3")]
    assert not any(r.line.startswith("<submission") for r in C.assemble_texts(p, tmeta, cmeta, smeta).collect())


def test_assembly_takes_a_repeated_post_once(spark):
    p = posts(spark)
    tmeta = spark.createDataFrame([("1", "board")], "id string, subreddit string")
    cmeta = spark.createDataFrame([("1_1", "u1"), ("1_2", "u2")], "id string, author string")
    lines = [r.line for r in C.assemble_texts(p, tmeta, cmeta).orderBy(*C.corpus_order()).collect()]
    assert lines[-8:-1] == ['<comment id="1_2" author="u2">', "<p>", "<s>", "later", "</s>", "</p>", "</comment>"]
