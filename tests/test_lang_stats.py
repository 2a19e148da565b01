from pyspark.sql import functions as F

from threadcorpus.operators import lang as L
from threadcorpus.operators import stats as S


def corpus(spark):
    de = ["der hund und die katze sind hier", "die katze und der hund spielen hier",
          "der hund schläft und die katze auch"]
    en = ["the dog and the cat are here", "the cat and the dog play here", "the dog sleeps and the cat too"]
    rows = [(i, t, "de") for i, t in enumerate(de)] + [(10 + i, t, "en") for i, t in enumerate(en)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_char_ngrams_keep_code_points(spark):
    df = spark.createDataFrame([("aé😀cd",), ("ab",)], "t string")
    got = [r[0] for r in df.select(L.char_ngrams(F.col("t"))).collect()]
    assert got == [["aé😀", "é😀c", "😀cd"], []]


def test_lexicon_threshold(spark):
    lex = L.build_lexicon(corpus(spark), min_docs=3)
    words = {(r.lang, r.word) for r in lex.collect()}
    assert ("de", "hund") in words and ("en", "dog") in words and ("de", "spielen") not in words


def test_labels_follow_the_rules(spark):
    model = L.train_language_model(corpus(spark), ["en", "de"], min_docs=2)
    posts = spark.createDataFrame([
        ("p1", "der hund und die katze sind hier"),
        ("p2", "the dog and the cat are here"),
        ("p3", "short"),
        ("p4", "!!! ??? ... ,,, ;;;"),
    ], "id string, body string")
    single = {r.id: r.label for r in L.label_single(posts, model, "de", "en").collect()}
    assert single == {"p1": True, "p2": False, "p3": None, "p4": False}
    multi = {r.id: r.language for r in L.label_multi(posts, model, ["de"], "en").collect()}
    assert multi == {"p1": "de", "p2": "other", "p3": None, "p4": None}


def test_monthly_and_corpus_share(spark):
    meta = spark.createDataFrame([
        ("a", "2010-01", True), ("a", "2010-01", False), ("a", "2010-01", None),
        ("a", "2010-02", False), ("b", "2010-01", True), ("b", "2010-02", True)],
        "subreddit string, month string, label boolean")
    monthly = {(r.month, r.subreddit): (r.n, r.total) for r in S.monthly_share(meta).collect()}
    assert monthly == {("2010-01", "a"): (1, 3), ("2010-01", "b"): (1, 1), ("2010-02", "b"): (1, 1)}
    corpus = {r.subreddit: (r.corpus_N, r.corpus_total) for r in S.corpus_share(S.monthly_share(meta)).collect()}
    # the month of "a" without a positive post does not count towards its total
    assert corpus == {"a": (1, 3), "b": (2, 2)}
    kept = [r.subreddit for r in S.filter_communities(S.corpus_share(S.monthly_share(meta))).collect()]
    assert kept == ["b"]


def test_community_and_thread_scores(spark):
    meta = spark.createDataFrame([
        ("t5_a", "t3_1", "de"), ("t5_a", "t3_1", "other"), ("t5_a", "t3_2", None), ("t5_a", "t3_2", "fr"),
        ("t5_b", "t3_3", "other")], "subreddit_id string, link_id string, language string")
    com = {(r.lang, r.subreddit_id): (r.target, r.total) for r in S.community_scores(meta, ["de", "fr"]).collect()}
    assert com == {("de", "t5_a"): (1, 4), ("fr", "t5_a"): (1, 4)}
    th = {(r.lang, r.link_id): (r.fraction, r.score) for r in
          S.thread_scores(meta, S.community_scores(meta, ["de", "fr"]), ["de", "fr"]).collect()}
    assert th == {("de", "t3_1"): (0.5, 0.125), ("fr", "t3_2"): (0.5, 0.125)}
    for r in S.community_scores(meta, ["de", "fr"]).collect():
        assert 0 < r.fraction <= 1 and r.total >= r.target >= 1


def test_thread_scores_across_communities_match_brute_force(spark):
    """A thread whose posts sit in several communities: totals count every post, the community is
    the largest id among posts of the language (the two-step aggregation keeps this)."""
    rows = [("t5_a", "t3_1", "de"), ("t5_b", "t3_1", "de"), ("t5_b", "t3_1", "other"),
            ("t5_c", "t3_1", None), ("t5_a", "t3_1", "fr"), ("t5_a", "t3_2", "fr"),
            ("t5_c", "t3_2", "de"), ("t5_b", "t3_2", "other")]
    rows += [("t5_hot", "t3_hot", "de" if i % 3 else "other") for i in range(300)]
    meta = spark.createDataFrame(rows, "subreddit_id string, link_id string, language string")
    langs = ["de", "fr"]
    com = S.community_scores(meta, langs)
    frac = {(r.lang, r.subreddit_id): r.fraction for r in com.collect()}
    expected = {}
    for lang in langs:
        for link in {r[1] for r in rows}:
            posts = [r for r in rows if r[1] == link]
            hits = [r for r in posts if r[2] == lang]
            if not hits:
                continue
            sid = max(r[0] for r in hits)
            if (lang, sid) not in frac:
                continue
            fraction = len(hits) / len(posts)
            expected[(lang, link)] = (sid, len(hits), len(posts), fraction * frac[(lang, sid)])
    got = {(r.lang, r.link_id): (r.subreddit_id, r.target, r.total, r.score)
           for r in S.thread_scores(meta, com, langs).collect()}
    assert got == expected


def test_label_with_pandas_hook(spark):
    posts = spark.createDataFrame([("a", "Hallo Welt http://x"), ("b", "hello")], "id string, body string")
    out = L.label_with(posts, lambda s: s.str.len().astype(str))
    assert sorted((r.id, r.label) for r in out.collect()) == [("a", "11"), ("b", "5")]


def test_shuffled_model_joins_equal_broadcast(spark, monkeypatch):
    """Lexicon and n-gram lookups give the same labels when the models are too big to broadcast."""
    from inputs import SF_SMALL
    from threadcorpus.session import read_table

    docs = read_table(spark, SF_SMALL, "documents")
    model = L.train_language_model(docs, ["en", "de", "fr", "es"])
    posts = docs.select(F.concat(F.lit("p"), F.col("doc_id").cast("string")).alias("id"),
                        F.col("text").alias("body"))

    def run():
        multi = {(r.id, r.language) for r in L.label_multi(posts, model, ["de", "fr", "es"], "en").collect()}
        single = {(r.id, r.label) for r in L.label_single(posts, model, "de", "en").collect()}
        lid = {tuple(r) for r in L.score_langid(posts.select("id", F.col("body").alias("clean")),
                                                model.profile).collect()}
        return multi, single, lid

    broadcast = run()
    monkeypatch.setattr(L, "BROADCAST_MAX_ROWS", 0)
    shuffled = run()
    assert shuffled == broadcast
    assert len(broadcast[0]) == docs.count()
