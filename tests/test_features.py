import math
from collections import Counter

import pytest

from threadcorpus.operators import features as FT
from threadcorpus.operators import joins

DOCS = [("en", "a", "the cat"), ("en", "b", "the dog"), ("en", "a", "the cat"), ("de", "a", "der Hund"), ("de", None, "die Äpfel"),
        ("de", "b", None), ("fr", "b", ""), ("fr", "c", "le chien 😀"), (None, "a", "xyz")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "lang string, source string, text string")


def entropy(counts):
    n = sum(counts)
    return -sum(c / n * math.log(c / n) for c in counts if c)


def gain(rows, gram, of):
    def held(with_gram):
        return [of(r) for r in rows if (gram in r[3]) == with_gram]
    n = len(rows)
    parts = sum(len(x) / n * entropy(Counter(x).values()) for x in (held(True), held(False)) if x)
    return entropy(Counter(of(r) for r in rows).values()) - parts


def brute_force():
    rows = [(lang, source or "", (text or "").lower(),) for lang, source, text in DOCS if lang]
    rows = [(*r, {r[2][i:i + n] for n in FT.SIZES for i in range(len(r[2]) - n + 1)}) for r in rows]
    out = {}
    for gram in {g for r in rows for g in r[3]}:
        holders = [r for r in rows if gram in r[3]]
        by_source = gain(rows, gram, lambda r: r[1])
        for lang in {r[0] for r in holders}:
            if sum(r[0] == lang for r in holders) / len(holders) > sum(r[0] == lang for r in rows) / len(rows):
                out[lang, gram] = len(rows) * (gain(rows, gram, lambda r: r[0] == lang) - by_source)
    return out


def test_gains_equal_brute_force(docs):
    got = {(r["lang"], r["gram"]): r["score"] for r in FT.gram_gains(docs).collect()}
    want = brute_force()
    assert set(got) == set(want) and ("fr", "😀") in got and ("de", "äp") in got
    # Up to twenty terms are rounded to thousandths.
    assert all(abs(got[k] - 1000 * want[k]) <= 12 for k in want)


def test_gains_do_not_depend_on_partitions(docs):
    a, b = (sorted(map(tuple, FT.gram_gains(docs.repartition(n)).collect())) for n in (1, 7))
    assert a == b


def test_selected_grams(docs):
    best = FT.select_features(FT.gram_gains(docs), 3).collect()
    assert Counter(r["lang"] for r in best) == {"en": 3, "de": 3, "fr": 3}
    for lang in ("en", "de", "fr"):
        mine = sorted((r["rank"], r["score"], r["gram"]) for r in best if r["lang"] == lang)
        assert [x[0] for x in mine] == [1, 2, 3] and mine == sorted(mine, key=lambda x: (-x[1], x[2]))


def test_ranks_are_limited_before_the_shuffle(docs):
    plan = FT.select_features(FT.gram_gains(docs))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_profile_and_scores(spark, docs, monkeypatch):
    profile = FT.train_features(docs, per_language=20)
    assert profile.langs == ["de", "en", "fr"] and profile.table.count() <= 60
    posts = spark.createDataFrame([(1, "the cat the"), (2, "Der Hund"), (3, None), (4, ""), (5, "☃"), (6, "chien " * 5000)],
                                  "id int, clean string")
    got = {r["id"]: r["langid"] for r in FT.score_features(posts, profile).collect()}
    assert got == {1: "en", 2: "de", 6: "fr"}
    want = sorted(map(tuple, FT.score_features(posts, profile).collect()))
    monkeypatch.setattr(joins.checked_join, "__defaults__", ("inner", 0, None))
    assert sorted(map(tuple, FT.score_features(posts, profile).collect())) == want


def test_no_labelled_rows(docs):
    none = docs.where("false")
    assert FT.select_features(FT.gram_gains(none)).count() == 0
    profile = FT.train_features(none)
    assert profile.langs == [] and profile.table.count() == 0
    got = FT.score_features(docs.selectExpr("1 AS id", "text AS clean"), profile)
    assert got.columns == ["id", "langid", "langid_score"] and got.count() == 0
