"""Spelling variants against a brute-force version."""
import random
import re
import zlib
from collections import Counter

import numpy as np

from threadcorpus.llm import spelling


def brute(rows):
    count = Counter()
    for key, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                count[run] += 1
    words = {w: n for w, n in count.items() if n >= 3}
    near = {w: set() for w in words}
    by_rest = {}
    for w in words:
        for i in range(len(w)):
            by_rest.setdefault((i, len(w), w[:i] + w[i + 1:]), []).append(w)
            if (s := w[:i] + w[i + 1:]) in words:
                near[w].add(s)
                near[s].add(w)
    for same in by_rest.values():
        for w in same:
            near[w].update(x for x in same if x != w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted((w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items())


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=lambda r: r[0])


def test_tree_finds_every_point_in_the_ball():
    rng = np.random.default_rng(3)
    points, searching = rng.integers(0, 4, (700, 9)), rng.integers(0, 4, (60, 9))
    tree = spelling.Tree(points, 5)
    away = np.abs(searching[:, None] - points[None]).sum(axis=2)
    for radius in (0, 1, 2, 4):
        found = set(zip(*(x.tolist() for x in tree.near(searching, radius))))
        assert set(zip(*(x.tolist() for x in np.nonzero(away <= radius)))) <= found
        assert len(found) < 60 * 700 / 2 or radius == 4
    inside = [set(tree.order[slice(*tree.span[leaf])].tolist()) for leaf in tree.home(points)]
    assert all(i in leaf for i, leaf in enumerate(inside))
    # A tree fitted on some points: the home of any point is among the cells within reach of its neighbours.
    some = spelling.Tree(points[:40], 4, whole=True)
    home, (who, cell) = some.home(points), some.leaves(searching, 2)
    reached = set(zip(who.tolist(), cell.tolist()))
    assert all((i, home[j]) in reached for i, j in zip(*np.nonzero(away <= 2)))


def test_variants_equal_brute_force(spark, documents):
    expected = brute([(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()])
    assert rows_of(spelling.variants(documents)) == expected
    # Many small cells and blocks, with upper trees fitted on a few words.
    assert rows_of(spelling.variants(documents, cell_letters=600, sample_words=100)) == expected


def test_ties_chains_and_anagrams(spark):
    rng = random.Random(2)
    letters = "abcde"
    anagrams = ["".join(rng.sample(letters * 2, 7)) for _ in range(300)]
    rows = [(i, " ".join([w] * (3 + i % 4))) for i, w in enumerate(anagrams)]
    rows += [(1000, "aaaaaa " * 3 + "aaaaaaa " * 6 + "aaaaaaaa " * 12 + "baaaaaa " * 6 + "caaaaaa " * 6)]
    rows += [(1001, "été×÷ éTÉ×÷ ".lower() * 3 + "ÉTÉs×÷ " * 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert rows_of(spelling.variants(df, cell_letters=200, sample_words=50)) == brute(rows)


def test_odd_rows(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert rows_of(spelling.variants(odd.withColumn("word", odd.text).withColumn("root", odd.text))) == brute(rows)


def test_very_long_runs_and_empty_table(spark):
    rows = [(1, " ".join(["x" * 50_000] * 4)), (2, " ".join(["x" * 49_999 + "y"] * 9)), (3, " ".join(["x" * 49_999] * 3))]
    assert rows_of(spelling.variants(spark.createDataFrame(rows, "doc_id bigint, text string"))) == brute(rows)
    assert spelling.variants(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
