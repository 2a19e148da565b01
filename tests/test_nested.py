import re
import time

import pytest
from pyspark.sql import functions as F

from threadcorpus.functions.nested import nested_blocks, nested_html
from threadcorpus.operators.render import render_posts


def blocks(spark, *texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, v string") \
        .select("i", nested_blocks("v").alias("b"), nested_html("v").alias("h")).orderBy("i").collect()
    return [(r["b"] and [tuple(b) for b in r["b"]], r["h"]) for r in rows]


def kinds(found):
    return [("/".join(x.rstrip("0123456789.") for x in p.split("/")), t, text) for p, t, text in found]


def test_null_empty_and_blank_texts(spark):
    assert blocks(spark, None, "", " \n\t\n\r\n") == [(None, None), ([], ""), ([], "")]
    got = render_posts(spark.createDataFrame([("a", None)], "id string, body string"), nested=True).first()
    assert got["xml"] == '<text id="a">\n\n</text>'


CASES = {
    "items of one list share it": ("- a\n- b\n\n- c", [("ul", "paragraph", "a"), ("ul", "paragraph", "b"), ("ul", "paragraph", "c")]),
    "a deeper item": ("1. a\n   - b\n2. c", [("ol", "paragraph", "a"), ("ol/ul", "paragraph", "b"), ("ol", "paragraph", "c")]),
    "lazy line": ("> > a\nb\n\nc", [("q/q", "paragraph", "a\nb"), ("", "paragraph", "c")]),
    "no lazy line after a blank": ("> a\n>\nb", [("q", "paragraph", "a"), ("", "paragraph", "b")]),
    "no lazy heading": ("> a\n# b", [("q", "paragraph", "a"), ("", "h1", "b")]),
    "fence keeps marks and blanks": ("```\n\n- a\n\n> b\n```\nc", [("", "code", "\n- a\n\n> b"), ("", "paragraph", "c")]),
    "fence never closed": ("~~~\na\n```", [("", "code", "a\n```")]),
    "longer fence": ("````\n```\n````", [("", "code", "```")]),
    "fence ends with its quote": ("> ```\n> a\nb", [("q", "code", "a"), ("", "paragraph", "b")]),
    "underlined heads": ("a\nb\n===\nc\n---", [("", "h1", "a\nb"), ("", "h2", "c")]),
    "rule, not list": ("- - -\na", [("", "rule", ""), ("", "paragraph", "a")]),
    "table ends at a blank": ("a|b\n-|-\n1|2\n\n3|4", [("", "table", "a|b\n1|2"), ("", "paragraph", "3|4")]),
    "no table without a bar": ("ab\n-|-", [("", "paragraph", "ab\n-|-")]),
    "table in an item": ("- a|b\n  -|-\n  1|2", [("ul", "table", "a|b\n1|2")]),
    "code by spaces": ("    a\n      b\nc", [("", "code", "a\n  b"), ("", "paragraph", "c")]),
    "tab as four spaces": ("\ta", [("", "code", "a")]),
    "definition inside text is text": ("a\n[l]: /x", [("", "paragraph", "a\n[l]: /x")]),
}


def test_blocks(spark):
    got = blocks(spark, *(text for text, _ in CASES.values()))
    for (name, (_, want)), (found, _) in zip(CASES.items(), got):
        assert kinds(found) == want, name


def test_siblings_differ_by_label(spark):
    (found, html), = blocks(spark, "- a\n\n  b\n- c")
    assert found[0][0] == found[1][0] != found[2][0]
    assert html == "<ul>\n<li>\n<p>a</p>\n<p>b</p>\n</li>\n<li>\n<p>c</p>\n</li>\n</ul>"


def test_references(spark):
    md = '[l]: http://a "t"\n[L]: http://b\n\n[x][l] [L][] [y][none] `[x][l]` [x](http://c)'
    (_, html), = blocks(spark, md)
    assert html == ('<p><a href="http://a" title="t">x</a> <a href="http://a" title="t">L</a> [y][none] [x][l] '
                    '<a href="http://c">x</a></p>')


def test_every_opened_tag_is_closed(spark):
    deep = "\n".join("> " * i + "- " * (i % 3) + f"x{i}" for i in range(1, 30))
    odd = "> - 1. a\n  b\n> c\n- > d\n\n> 2. e"
    for _, html in blocks(spark, deep, odd):
        stack = []
        for tag in re.findall("</?[a-z0-9]+", html):
            if tag.startswith("</"):
                assert stack.pop() == tag[2:]
            else:
                stack.append(tag[1:])
        assert stack == []


@pytest.mark.parametrize("lines", [4_000])
def test_very_long_text(spark, lines):
    """A text of many blocks, and one block of many lines."""
    text = "\n".join(f"- a{i}" for i in range(lines))
    start = time.time()
    rows = spark.createDataFrame([(text,), ("x\n" * lines,)], "v string").select(
        F.size(nested_blocks("v")).alias("n")).collect()
    assert [r["n"] for r in rows] == [lines, 1]
    assert time.time() - start < 120
