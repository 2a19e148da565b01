"""Cross-tokenizer alignment against a brute-force version."""
import hashlib
from collections import Counter

import numpy as np
import pytest

from threadcorpus.llm import align

FILES = align.load()


@pytest.fixture(scope="module")
def tokens():
    return align.Tokenizers(*FILES)


def brute(tokens, rows):
    """Byte ranges of all tokens, compared pair by pair within a document."""
    docs, count = [], Counter()
    for key, text in rows:
        text = text or ""
        a = tokens.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = tokens.b.encode(text) if text else []
        whole = (" " + text).encode()
        if not text or b"".join(tokens.bytes_a[i] for i in a) != whole or b"".join(tokens.bytes_b[i] for i in b) != whole:
            docs.append((key, [], [], [], []))
            continue
        spans = []
        for ids, table in ((a, tokens.bytes_a), (b, tokens.bytes_b)):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(table[i]), i))
                at += len(table[i])
            spans.append(out)
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]]
        ends = sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]})
        groups, lo = [], 0
        for e in ends:
            groups.append(",".join(str(x[2]) for x in spans[0] if lo < x[1] <= e) + "|"
                          + ",".join(str(y[2]) for y in spans[1] if lo < y[1] <= e))
            lo = e
        count.update(links)
        docs.append((key, a, b, groups, links))
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    return sorted(
        (key if key is not None else -1, len(a), len(b), len(g), len(k), sum(count[x] == best[x[1]] for x in k),
         sum(count[x] for x in k), hashlib.sha256(";".join(g).encode()).hexdigest() if a else "")
        for key, a, b, g, k in docs)


def rows_of(df):
    return sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in df.collect())


def test_gallop_equals_counting():
    rng = np.random.default_rng(1)
    for n, m in ((0, 5), (5, 0), (1, 1), (7, 300), (300, 7), (1000, 1000), (5000, 90)):
        few, many = (np.unique(rng.integers(0, 3 * max(n, m, 1), k)) for k in (n, m))
        assert align.gallop(few, many).tolist() == [int((many < x).sum()) for x in few]


def test_segments_keep_the_ids(tokens, monkeypatch):
    text = "one two  three\tfour été 5 <|endoftext|> x" * 40
    whole = list(tokens.encode([text]))
    monkeypatch.setattr(align, "SEGMENT_TEXT", 16)
    assert len(align.segments(text)) > 20
    assert list(tokens.encode([text])) == whole


def test_ranks_give_the_ids_of_the_file(tokens, documents):
    assert tokens.by_ranks
    texts = [r.text for r in documents.select("text").collect() if r.text]
    texts += [f" a{chr(c)}b {chr(c)} {chr(c)}{chr(c)}1" for c in range(0x3000)] + ["x" * 50_000, " " * 9_999, "<|endoftext|>"]
    assert tokens.ids_a(texts) == [e.ids for e in tokens.a.encode_batch(texts, add_special_tokens=False)]


def test_link_equals_brute_force(spark, documents, tokens):
    docs = documents.where("doc_id % 3 = 0 and length(text) < 3000")
    expected = brute(tokens, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert rows_of(align.link(docs.repartition(3), FILES, chunk_text=20_000)) == expected


def test_link_of_odd_rows(spark, tokens):
    rows = [(1, None), (2, ""), (3, " "), (4, "\n\n\t x"), (5, "a▁b"), (6, "<|endoftext|> <s> </s> <0x41> <unk>"),
            (7, "你好 \U0001f600́"), (7, "你好 \U0001f600́"), (None, "same"), (None, "same"), (8, "\x00\x01 z"),
            (9, "word " * 300), (10, "nospace" * 200)]
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], "doc_id bigint, text string, chunk int, pair string, n_links int")
    assert rows_of(align.link(df, FILES)) == brute(tokens, rows)


def test_very_long_text(spark, tokens):
    rows = [(1, "alpha beta, gamma " * 20_000), (2, "delta")]
    got = rows_of(align.link(spark.createDataFrame(rows, "doc_id bigint, text string"), FILES, chunk_text=1000))
    a = tokens.a.encode(" " + rows[0][1], add_special_tokens=False).ids
    assert got[0][1] == len(a) and got[0][2] == len(tokens.b.encode(rows[0][1])) and got[0][4] == got[0][1] + got[0][2] - got[0][3]


def test_empty_table(spark):
    assert align.link(spark.createDataFrame([], "doc_id bigint, text string"), FILES).collect() == []
