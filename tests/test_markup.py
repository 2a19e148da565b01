from threadcorpus.functions.markup import (decode_entities, escape_spoilers, markdown_html,
                                           render_open_tag, typed_blocks, xml_unescape)


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "v string").select(expr.alias("r")).first()["r"]


def test_entities_single_pass(spark):
    src = ("&auml; &#228; &#xE4; &#XE4; &bogus; a&b &copy 2 &lt;b&gt; &amp;amp; &#38; &#60; "
           "&#0; &#55296; &NotEqualTilde; &#34;x&#39; &copy2")
    want = ("ä ä ä ä &amp;bogus; a&amp;b © 2 &lt;b&gt; &amp;amp; &amp; &lt; "
            "� � ≂̸ &quot;x&apos; &amp;copy2")
    assert one(spark, decode_entities("v"), src) == want


def test_decoded_output_has_no_bare_ampersand(spark):
    out = one(spark, decode_entities("v"), "a & b &&; &#x26; &amp c")
    assert all(part.startswith(("amp;", "lt;", "gt;", "quot;", "apos;")) for part in out.split("&")[1:])


def test_spoiler_titles(spark):
    src = '<a href="#s" title="a "q" b">x</a> <a href="/s" title="ok">y</a> <a href="/x" title="a"b">'
    want = '<a href="#s" title="a &quot;q&quot; b">x</a> <a href="/s" title="ok">y</a> <a href="/x" title="a"b">'
    assert one(spark, escape_spoilers("v"), src) == want


def test_unescape_order(spark):
    assert one(spark, xml_unescape("v"), "&amp;lt; &lt;b&gt;") == "&lt; <b>"


def test_markdown_blocks(spark):
    md = "# Head **b**\n\n> q *i*\n\n- one\n- two [l](http://x)\n\n1. a\n\n    code <x>\n\n***\n\nplain ~~s~~ `c`\n"
    html = one(spark, markdown_html("v"), md)
    assert html.split("\n") == [
        "<h1>Head b</h1>", "<blockquote>", "<p>q i</p>", "</blockquote>", "<ul>", "<li>one</li>",
        '<li>two <a href="http://x">l</a></li>', "</ul>", "<ol>", "<li>a</li>", "</ol>", "<pre><code>code &lt;x&gt;</code></pre>",
        "<hr/>", "<p>plain s c</p>"]
    types = [b["t"] for b in one(spark, typed_blocks("v"), md)]
    assert types == ["heading", "quote", "list", "list", "code", "rule", "paragraph"]


def test_open_tag_fills_na_and_escapes(spark):
    df = spark.createDataFrame([("1", None, 'a"b')], "id string, x string, y string")
    tag = df.select(render_open_tag("text", ["id", "x", "y"]).alias("t")).first()["t"]
    assert tag == '<text id="1" x="NA" y="a&quot;b">'


def test_table_decoding_equals_column_form(spark):
    from threadcorpus.operators.render import decode_entities_rows
    texts = ["&auml; &#228; &bogus; a&b &copy 2 &#0; &NotEqualTilde; x", "", "plain", "&&amp;&#x26;"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    col = {r.k: r.d for r in df.select("k", decode_entities("t").alias("d")).collect()}
    rows = {r.k: r.decoded for r in decode_entities_rows(df, ["k"], "t").collect()}
    assert rows == col


def test_headings_take_one_line(spark):
    html = one(spark, markdown_html("v"), "intro\n# Head\nbody text\n## a\n### b\n\n\n\n# c")
    assert html.split("\n") == ["<p>intro</p>", "<h1>Head</h1>", "<p>body text</p>", "<h2>a</h2>", "<h3>b</h3>",
                                "<h1>c</h1>"]


def test_links_titles_and_spoilers(spark):
    from threadcorpus.functions.markup import post_html
    md = '[x](#s "they said "no" (twice)") [t _i_](http://a/b_c_d "w") [u](http://a/?q=1) [open'
    assert one(spark, post_html("v"), md) == (
        '<p><a href="#s" title="they said &quot;no&quot; (twice)">x</a> <a href="http://a/b_c_d" title="w">t i</a> '
        '<a href="http://a/?q=1">u</a> [open</p>')
    assert one(spark, post_html("v"), '[x](/u "a &quot;b&quot;")') == '<p><a href="/u" title="a \'b\'">x</a></p>'


def test_code_spans_and_words_keep_their_marks(spark):
    assert one(spark, markdown_html("v"), "`a*b*c` _i_ _j_ snake_case_x **b** `") == "<p>a*b*c i j snake_case_x b `</p>"


def test_padded_references(spark):
    assert one(spark, decode_entities("v"), "&#0000000228;&#x000000E4;&#1114112;&#99999999999;") == "ää��"


def test_decoding_is_narrow(spark):
    from threadcorpus.operators.render import decode_entities_rows, render_posts
    df = spark.createDataFrame([("1", None), ("1", "a"), ("1", "a")], "id string, body string")
    plan = render_posts(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert [r.decoded for r in decode_entities_rows(df, ["id"], "body").collect()] == ["", "a", "a"]
    assert render_posts(df).count() == 3
