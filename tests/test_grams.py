from collections import Counter

from pyspark.sql import functions as F

from threadcorpus.operators import features as FT
from threadcorpus.operators import grams as G
from threadcorpus.operators import lang as L

TEXTS = [(1, "de", "aé😀cd aé😀"), (2, "de", "ab"), (2, "fr", None), (3, None, ""), (4, "fr", "x" * 50 + "\n\x00퟿"), (1, "de", "aé😀")]


def frame(spark):
    return spark.createDataFrame(TEXTS, "id long, lang string, t string")


def of(text, n):
    return [text[i:i + n] for i in range(len(text) - n + 1)]


def test_lists_equal_every_place(spark, monkeypatch):
    got = Counter()
    for r in G.gram_lists(frame(spark).repartition(2), "id", "t", [3]).collect():
        got[r["id"], r["gram"]] += r["cnt"]
    assert got == Counter((i, g) for i, _, t in TEXTS for g in of(t or "", 3))
    exploded = frame(spark).select("id", F.explode(L.char_ngrams(F.col("t"))).alias("gram")).collect()
    assert got == Counter((r["id"], r["gram"]) for r in exploded)


def test_totals_equal_every_place(spark):
    df, sizes = frame(spark), FT.SIZES
    got = {(r["lang"], r["gram"]): r["cnt"] for r in G.gram_totals(df.repartition(3), ["lang"], "t", sizes).collect()}
    assert got == Counter((lang, g) for _, lang, t in TEXTS for n in sizes for g in of(t or "", n))
    once = {(r["lang"], r["gram"]): r["cnt"] for r in G.gram_totals(df, ["lang"], "t", sizes, once=True).collect()}
    assert once == Counter((lang, g) for _, lang, t in TEXTS for g in {g for n in sizes for g in of(t or "", n)})


def test_runs_do_not_change_counts(monkeypatch):
    texts = [t or "" for _, _, t in TEXTS]
    monkeypatch.setattr(G, "RUN_CHARS", 5)
    runs = list(G._runs(texts))
    assert len(runs) > 2 and runs[0][0] == 0 and runs[-1][1] == len(texts) and all(a[1] == b[0] for a, b in zip(runs, runs[1:]))
    assert list(G._runs([])) == [] and list(G._runs([""])) == [(0, 1)]


def test_training_and_scoring_count_before_rows(spark):
    """A repeated gram of a post is one row of the plan, not one for each place."""
    docs = spark.createDataFrame([(i, "ab " * 100, "de") for i in range(3)], "doc_id long, text string, lang string")
    profile = L.train_langid(docs)
    assert {r["gram"] for r in profile.table.collect()} == {"ab ", "b a", " ab"}
    assert G.gram_totals(docs, ["lang"], "text", [3]).count() == 3
    plan = L.score_langid(docs.selectExpr("doc_id AS id", "text AS clean"), profile)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "regexp_extract_all" not in plan


def test_sums_equal_every_place(spark, monkeypatch):
    """Scores are summed where the texts are: one row for each text, none for each gram."""
    table = spark.createDataFrame([("aé😀", 5, None), ("xxx", -7, 2), ("é😀c", None, 1), ("\n\x00퟿", 3, 3)], "gram string, a long, b long")
    value = {r["gram"]: (r["a"], r["b"]) for r in table.collect()}
    expected = Counter()
    for i, _, t in TEXTS:
        grams = of(t or "", 3)
        if grams:
            expected[(i, *(sum(m if value.get(g, (None, None))[j] is None else value[g][j] for g in grams)
                           for j, m in enumerate((-100, -1000))))] += 1
    for run_chars in (4, 1 << 20):
        monkeypatch.setattr(G, "RUN_CHARS", run_chars)
        sums = G.gram_sums(frame(spark).coalesce(1), "id", "t", 3, table, [-100, -1000])
        assert Counter(map(tuple, sums.collect())) == expected
    assert G.gram_sums(frame(spark), "id", "t", 3, table.limit(0), [1, 2]).where("id = 2").collect() == []
    profile = L.train_langid(spark.createDataFrame([(1, "ab " * 9, "de"), (2, "cd " * 9, "fr")], "doc_id long, text string, lang string"))
    posts = spark.createDataFrame([(1, "ab ab"), (2, "cd cd"), (1, "ab cd"), (3, "x"), (4, None)], "id long, clean string")
    scored = L.score_langid(posts, profile)
    assert "Generate explode" not in scored._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(L, "BROADCAST_MAX_ROWS", 0)
    assert sorted(map(tuple, scored.collect())) == sorted(map(tuple, L.score_langid(posts, profile).collect()))


def test_totals_by_numbered_code_points(spark):
    """Small alphabets are counted by numbered code points, others by the runs' own grams: same counts."""
    many = "".join(map(chr, range(0x4E00, 0x4E00 + 3000)))
    for texts in (["aé😀cd aé😀", "ab", "", "x" * 50 + "\n\x00퟿", "aé😀"], [many, many[5:9], "a"], ["ab", ""], []):
        grams, counts = G._totals(texts, 3)
        assert dict(zip(grams.to_pylist(), counts.tolist())) == Counter(g for t in texts for g in of(t, 3))
        assert len(set(grams.to_pylist())) == len(grams)
