from collections import Counter

from pyspark.sql import functions as F

from threadcorpus.functions.text import words
from threadcorpus.operators import lang as L
from threadcorpus.operators import tokens as W

TEXTS = [(1, "de", "Der HUND, der_1 Äpfel\x00ß – “der” 5€ x²"), (1, "de", "der Σ ΑΣ'Β"), (2, "fr", None), (3, None, ""), (4, "fr", "…!? –"),
         (None, "fr", "İstanbul der"), (5, "de", "der 漢字 x٣"), (5, "en", "the the THE"), (6, "en", "!! 😀 ‼")]


def test_plain_texts_are_cut_as_by_the_jvm(spark):
    """Every code point cut in the tasks, alone and between letters, gives the words that Spark gives."""
    points = [chr(p) for p in range(0x3000) if not W._OTHER.search(chr(p))]
    assert len(points) > 600 and "İ" not in points
    texts = [t for c in points for t in (c, f"A{c}Bc")]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    bounds, code, different = W._cut(texts, {})
    got = {t: [different[c] for c in code[lo:hi]] for t, lo, hi in zip(texts, bounds, bounds[1:])}
    for cut in (F.transform(words("t"), F.lower), words(F.lower("t"))):
        assert {r["t"]: r["w"] for r in df.select("t", cut.alias("w")).collect()} == got


def test_broken_bytes_are_left_to_the_jvm(spark):
    column = spark.sql("SELECT CAST(b AS STRING) AS t FROM VALUES (X'6180FF62'), (X'6162'), (NULL) AS x(b)").toArrow().column("t")
    assert W._plain(column.combine_chunks()) == (["", "ab", ""], [0])


def test_words_of_one_number_are_told_apart(monkeypatch):
    monkeypatch.setattr(W, "_BASES", (1, W._BASES[1]))
    bounds, code, different = W._cut(["ab ba Ab", "", "abc cab"], {})
    assert [different[c] for c in code] == ["ab", "ba", "ab", "abc", "cab"] and bounds.tolist() == [0, 3, 3, 5]


def test_misses_and_lexicon_equal_a_row_for_each_word(spark, monkeypatch):
    posts = spark.createDataFrame(TEXTS, "id long, lang string, t string").repartition(2)
    index = spark.createDataFrame([("der", 1, 0), ("hund", 1, 1), ("the", 0, 1), ("x²", 0, 0), ("ς", 1, 0), ("σ", 0, 1), ("漢字", 0, 1)],
                                  "word string, in_de int, in_en int")

    def rates():
        return sorted(L.error_rates(posts, index, ["de", "en"], "id", "t", 7, skip=F.col("id").eqNullSafe(3)).collect(), key=str)

    lexicon = {tuple(r) for r in L.build_lexicon(posts, "t", "lang", "id", 1).collect()}
    per_text = posts.where("lang is not null").select("lang", F.explode(F.array_distinct(words(F.lower("t")))).alias("word"))
    assert lexicon == {(*k, n) for k, n in Counter(map(tuple, per_text.collect())).items()}
    monkeypatch.setattr(W, "RUN_WORDS", 2)
    assert {tuple(r) for r in L.build_lexicon(posts, "t", "lang", "id", 1).collect()} == lexicon
    fast = rates()
    monkeypatch.setattr(L, "HELD_WORDS", 0)
    assert fast == rates() and len(fast) == 3


def test_words_of_a_plain_post_are_no_rows(spark):
    """Fails where words are exploded and joined: the join reads one row for each post, not one for each word."""
    posts = spark.createDataFrame([(i, "der hund " * 50) for i in range(4)], "id long, t string")
    index = spark.createDataFrame([("der", 1)], "word string, in_de int")
    rates = L.error_rates(posts, index, ["de"], "id", "t", 1)
    assert [tuple(r)[1:] for r in rates.collect()] == [(100, 0.5)] * 4
    plan = rates._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan


def test_texts_are_not_sorted_for_the_gate(spark):
    """Fails where the gated posts come from a sort-merge join, which holds a partition's texts."""
    docs = spark.createDataFrame([(i, "der hund und die katze", "de") for i in range(3)], "doc_id long, text string, lang string")
    model = L.train_language_model(docs, ["en", "de"])
    posts = spark.createDataFrame([("a", "der hund und die katze"), ("a", "der hund und"), ("b", "x")], "id string, body string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for labels, value in ((L.label_single(posts, model), True), (L.label_multi(posts, model, ["de"]), "de")):
            assert "ShuffledHashJoin" in labels._jdf.queryExecution().executedPlan().toString()
            assert sorted(map(tuple, labels.collect()), key=str) == [("a", value), ("a", value), ("b", None)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_large_lexicons_are_looked_up_in_the_tasks(spark, monkeypatch):
    """Fails where a lexicon beyond a million words turns every word of a post into a row."""
    posts = spark.createDataFrame(TEXTS, "id long, lang string, t string").repartition(2)
    # No plain text holds the words from "Hund" on: those with great letters, other signs or other code points.
    index = spark.createDataFrame([("der", 1, 0), ("x²", 0, 1), ("the", 0, 1), ("äpfelß", 1, 1), ("Hund", 1, 1), ("der hund", 1, 1), ("", 1, 1),
                                   (None, 1, 1), ("漢字", 0, 1), ("x\n", 1, 1)], "word string, in_de int, in_en int")

    def rates(rows):
        return L.error_rates(posts, index, ["de", "en"], "id", "t", rows)

    expected = sorted(map(tuple, rates(7).collect()), key=str)
    plan = rates(1_500_000)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan
    # Beyond the size for a broadcast in the JVM, words of texts that are handed on are joined by a shuffle.
    assert sorted(map(tuple, rates(3_000_000).collect()), key=str) == expected
    monkeypatch.setattr(L, "HELD_WORDS", 0)
    assert sorted(map(tuple, rates(7).collect()), key=str) == expected and len(expected) == 3


def test_words_of_one_number_are_looked_up_by_both(spark, monkeypatch):
    monkeypatch.setattr(W, "_BASES", (1, W._BASES[1]))
    one, two = [n.tolist() for n in W._coded(["ab ba cd"], {})[2]]
    assert one[0] == one[1] and two[0] != two[1]
    held = tuple(W.np.array(c) for c in zip(*sorted((a, b, f) for a, b, f in zip(one[:2], two[:2], (1, 2)))))
    held = (held[0].astype("uint64"), held[1].astype("uint64"), held[2])
    numbers = W._coded(["cd ba ab dc"], {})[2]
    assert W._flags_of(numbers, held, 2).tolist() == [0, 2, 1, 0]
    assert W._flags_of(numbers, tuple(c[:0] for c in held), 0).tolist() == [0] * 4


def test_the_least_copy_travels_once(spark):
    """Fails where a text is sent both as the row and as its order."""
    posts = spark.createDataFrame([("c", "a", "y"), ("c", "a", "x"), ("c", "b", None), ("c", None, "z"), ("c", None, None)],
                                  "kind string, id string, body string")
    one = L.one_each(posts)
    assert sorted(map(tuple, one.collect()), key=str) == [("c", "a", "x"), ("c", "b", None), ("c", None, None)]
    assert "min_by" not in one._jdf.queryExecution().executedPlan().toString()
