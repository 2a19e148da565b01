"""Nested markdown: lists and quotes at any depth, lazy lines, fences, tables, reference links.

A text is read line by line by a fold whose state is the stack of open
containers and the kind of the open block, so a whole post is one expression:
no shuffle, no Python. Rules of the subset:

* ``\\r`` is removed, a tab stands for four spaces; null gives null, a blank text no blocks.
* A quote goes on with ``>``, a list item with as many spaces as its marker took (blank lines too).
  ``>``, ``- * +`` or ``1. 1)`` and a space open containers, as many as a line has.
* A paragraph's next line may leave out the marks of its containers (lazy line).
* A fence of three or more back quotes or tildes lasts until one at least as long, or until its container ends.
* A line of ``=`` or ``-`` under a paragraph makes it a head; a line of dashes and bars under a single
  line with a bar makes a table, up to a blank line or a container's end.
* ``[label]: address "title"`` defines a reference, ``[text][label]`` and ``[label][]`` use it; the first
  definition of a label (in any case) holds. Apart from fences, a blank line ends a block.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadcorpus.functions.markup import decode_entities, escape_spoilers, inline_text, xml_unescape

# ---------------------------------------------------------------- fixed values
QUOTE_MARK = "^ {0,3}> ?"
MARK = r"( {0,3}> ?| {0,3}(?:[*+-]|[0-9]{1,9}[.)]) +)"
MARKS = "^" + MARK + "+"
BLANK = r"^ *\z"
RULE = r"^ {0,3}((\* *){3,}|(- *){3,}|(_ *){3,})\z"
SETEXT = r"^ {0,3}(=+|-+) *\z"
DELIMITER = r"^ {0,3}\|?( *:?-+:? *\|)+( *:?-+:?)? *\z"
FENCE = r"^ {0,3}(`{3,}[^`]*|~{3,}[^\n]*)\z"
FENCE_END = r"^ {0,3}(`{3,}|~{3,}) *\z"
FENCE_RUN = "^ *(`{3,}|~{3,})"
HEADING = "^ {0,3}(#{1,6}) "
HEADING_MARKS = r"^ {0,3}#{1,6} +| +#+ *\z"
DEFINITION = r'^ {0,3}\[([^\[\]\n]+)\]: *([^ \n"()]+)( +"([^"\n]*)")? *\z'
# Pieces of a text for reference links: code spans, links by label, other text.
REFERENCE_PIECES = r"`[^`\n]+`|\[[^\[\]\n]+\]\[[^\[\]\n]*\]|[`\[]|[^`\[]+"
REFERENCE = r"^\[([^\[\]\n]+)\]\[([^\[\]\n]*)\]\z"

STACK = "array<struct<label:string,indent:int>>"
RECORD = "struct<starts:boolean,path:string,t:string,text:string>"
# Records are added to chunks of this size.
CHUNK = 256


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _followed(line: Column, stack: Column) -> Column:
    """``struct(rest, m, ok)``: the line after the marks of the ``m`` containers that go on."""
    def step(a: Column, s: Column) -> Column:
        quote = s["indent"] == 0
        goes_on = a["ok"] & F.when(quote, a["rest"].rlike(QUOTE_MARK)).otherwise(
            a["rest"].rlike(BLANK) | a["rest"].startswith(F.repeat(F.lit(" "), s["indent"])))
        rest = F.when(quote, F.regexp_replace(a["rest"], QUOTE_MARK, "")).otherwise(
            F.substring(a["rest"], s["indent"] + 1, F.length(a["rest"])))
        return F.struct(F.when(goes_on, rest).otherwise(a["rest"]).alias("rest"),
                        (a["m"] + goes_on.cast("int")).alias("m"), goes_on.alias("ok"))
    return F.aggregate(stack, F.struct(line.alias("rest"), F.lit(0).alias("m"), F.lit(True).alias("ok")), step)


def _opened(marks: Column, number: Column) -> Column:
    """Containers opened by the marks of line ``number``."""
    def container(mark: Column, j: Column) -> Column:
        quote = F.contains(mark, F.lit(">"))
        kind = F.when(quote, F.lit("q")).when(mark.rlike("[0-9]"), F.lit("ol")).otherwise(F.lit("ul"))
        return F.struct(F.concat(kind, number.cast("string"), F.lit("."), j.cast("string")).alias("label"),
                        F.when(quote, F.lit(0)).otherwise(F.length(mark)).alias("indent"))
    return F.transform(marks, container)


def _leaf(a: Column, x: Column) -> Column:
    """What the rest of a line is, given the state ``a`` and the marks read so far ``x``."""
    rest, plain = x["rest"], F.size(x["marks"]) == 0
    text = a["para"] & plain
    return (F.when(x["fenced"] & rest.rlike(FENCE_END) & F.ltrim(rest).startswith(a["fence"]), F.lit("close"))
            .when(x["fenced"], F.lit("fenced"))
            .when(rest.rlike(BLANK), F.lit("blank"))
            .when(text & x["all"] & rest.rlike(SETEXT), F.lit("setext"))
            .when(text & x["all"] & F.contains(a["head"], F.lit("|")) & rest.rlike(DELIMITER), F.lit("delimiter"))
            .when(a["table"] & plain & x["all"], F.lit("row"))
            .when(rest.rlike(FENCE), F.lit("open"))
            .when(rest.rlike(HEADING), F.lit("heading"))
            .when(rest.rlike(RULE), F.lit("rule"))
            .when(rest.startswith("    ") & ~text, F.lit("code"))
            .when(rest.rlike(DEFINITION) & ~text, F.lit("definition"))
            .otherwise(F.lit("paragraph")))


def _marked(a: Column, line: Column) -> Column:
    """A line against the state: what is left of it, its new marks, whether a fence holds it."""
    def after(f: Column) -> Column:
        every = f["m"] == F.size(a["stack"])
        fenced = (a["fence"] != "") & every
        closed = fenced | f["rest"].rlike(RULE) | (a["para"] & every & f["rest"].rlike(SETEXT))
        prefix = F.when(closed, F.lit("")).otherwise(F.regexp_extract(f["rest"], MARKS, 0))
        return _let(prefix, lambda p: F.struct(
            F.substring(f["rest"], F.length(p) + 1, F.length(f["rest"])).alias("rest"), f["m"].alias("m"),
            every.alias("all"), fenced.alias("fenced"),
            F.regexp_extract_all(p, F.lit(MARK), F.lit(1)).alias("marks")))
    return _let(_followed(line, a["stack"]), after)


def _step(a: Column, numbered: Column) -> Column:
    """Small state after one more line, with the line's record (null: none)."""
    def with_leaf(x: Column) -> Column:
        return _let(_leaf(a, x), lambda leaf: finish(x, leaf))

    def finish(x: Column, leaf: Column) -> Column:
        plain = F.size(x["marks"]) == 0
        lazy = a["para"] & ~x["all"] & plain & (leaf == "paragraph")
        kept = F.when(lazy | x["fenced"], a["stack"]).otherwise(
            F.concat(F.slice(a["stack"], F.lit(1), x["m"]), _opened(x["marks"], numbered["n"])))
        # A paragraph's next line that is not lazy has the marks of all its containers, so it needs no test for them.
        joins = (leaf.isin("fenced", "row", "setext", "delimiter") | ((leaf == "paragraph") & a["para"] & plain)
                 | ((leaf == "code") & (a["t"] == "code") & x["all"] & plain))
        return _let(F.struct(kept.alias("stack"), joins.alias("joins")), lambda k: state(x, leaf, k["stack"], k["joins"]))

    def state(x: Column, leaf: Column, stack: Column, joins: Column) -> Column:
        rest = x["rest"]
        level = F.length(F.regexp_extract(rest, HEADING, 1)).cast("string")
        t = (F.when(leaf.isin("blank", "close"), F.lit(""))
             .when(leaf == "setext", F.when(F.ltrim(rest).startswith("="), F.lit("h1")).otherwise(F.lit("h2")))
             .when(leaf == "delimiter", F.lit("table"))
             .when(joins, a["t"])
             .when(leaf == "heading", F.concat(F.lit("h"), level))
             .when(leaf == "open", F.lit("code")).otherwise(leaf))
        text = (F.when(leaf == "fenced", rest).when(leaf == "code", F.substring(rest, 5, F.length(rest)))
                .when(leaf == "heading", F.regexp_replace(rest, HEADING_MARKS, ""))
                .when(leaf.isin("rule", "open", "setext", "delimiter"), F.lit(None).cast("string"))
                .otherwise(F.trim(rest)))
        path = F.array_join(F.transform(stack, lambda s: s["label"]), "/")
        record = F.struct((~joins).alias("starts"), path.alias("path"), t.alias("t"), text.alias("text"))
        return F.struct(
            stack.alias("stack"),
            F.when(leaf == "open", F.regexp_extract(rest, FENCE_RUN, 1))
            .when(leaf == "fenced", a["fence"]).otherwise(F.lit("")).alias("fence"),
            (leaf == "paragraph").alias("para"), leaf.isin("delimiter", "row").alias("table"), t.alias("t"),
            F.when((leaf == "paragraph") & ~joins, rest).otherwise(F.lit("")).alias("head"),
            F.when(~leaf.isin("blank", "close"), record).alias("record"))

    return _let(_marked(a, numbered["line"]), with_leaf)


def _records(lines: Column) -> Column:
    """One ``struct(starts, path, t, text)`` for each line that belongs to a block.

    A line's record is added one step later, outside of the step's own
    expressions, to chunks. The time still grows with the square of a text's
    lines (measured: 5,000 lines 2 s, 20,000 lines 23 s).
    """
    state = f"struct<stack:{STACK},fence:string,para:boolean,table:boolean,t:string,head:string,record:{RECORD}>"
    first = F.from_json(F.lit('{"stack":[],"fence":"","para":false,"table":false,"t":"","head":""}'), state)
    empty = F.array().cast(f"array<{RECORD}>")
    start = F.struct(first.alias("state"), empty.alias("last"), F.array().cast(f"array<array<{RECORD}>>").alias("full"))

    def merge(a: Column, numbered: Column) -> Column:
        open_chunk = F.size(a["last"]) < CHUNK
        last = F.when(open_chunk, a["last"]).otherwise(empty)
        return F.struct(
            _step(a["state"], numbered).cast(state).alias("state"),
            F.when(a["state"]["record"].isNull(), last)
            .otherwise(F.concat(last, F.array(a["state"]["record"]))).alias("last"),
            F.when(open_chunk, a["full"]).otherwise(F.concat(a["full"], F.array(a["last"]))).alias("full"))

    def end(a: Column) -> Column:
        pending = F.filter(F.array(a["state"]["record"]), lambda r: r.isNotNull())
        return F.flatten(F.concat(a["full"], F.array(a["last"], pending)))

    return F.aggregate(lines, start, merge, end)


def nested_blocks(c) -> Column:
    """Blocks of a text in order: ``array<struct(path, t, text)>``.

    ``path`` names the open containers, outermost first, as ``kind line.place``
    (``q`` quote, ``ul`` and ``ol`` items), so two blocks share a container
    exactly if their paths share its label; ``t`` is paragraph, h1 to h6,
    code, rule, table (first line: the head) or definition.
    """
    c = F.col(c) if isinstance(c, str) else c
    text = F.replace(F.replace(c, F.lit("\r"), F.lit("")), F.lit("\t"), F.lit("    "))
    lines = F.transform(F.split(text, "\n"), lambda line, n: F.struct(line.alias("line"), n.alias("n")))

    def block(records: Column, first: Column, after: Column) -> Column:
        lines = F.slice(records, first + 1, after - first)
        # array_join leaves out nulls: lines that give no text, such as a fence.
        return F.struct(F.get(lines, F.lit(0))["path"].alias("path"), F.get(lines, after - first - 1)["t"].alias("t"),
                        F.array_join(F.transform(lines, lambda r: r["text"]), "\n").alias("text"))

    def joined(records: Column) -> Column:
        starts = F.filter(F.transform(records, lambda r, i: F.when(r["starts"], i)), lambda i: i.isNotNull())
        return _let(F.concat(starts, F.array(F.size(records))), lambda cuts: F.transform(
            F.slice(cuts, F.lit(1), F.size(cuts) - 1), lambda s, i: block(records, s, F.get(cuts, i + 1))))

    return F.when(c.isNotNull(), _let(_records(lines), joined))


def definitions(blocks: Column) -> Column:
    """Reference definitions of a text as ``array<struct(label, url, title)>``, labels in lower case."""
    found = F.filter(blocks, lambda b: b["t"] == "definition")
    return F.transform(found, lambda b: F.struct(
        F.lower(F.regexp_extract(b["text"], DEFINITION, 1)).alias("label"),
        F.regexp_extract(b["text"], DEFINITION, 2).alias("url"),
        F.regexp_extract(b["text"], DEFINITION, 4).alias("title")))


def resolve_references(text: Column, defined: Column) -> Column:
    """Links by label written as links by address; unknown labels and code spans stay."""
    def piece(p: Column) -> Column:
        label = F.regexp_extract(p, REFERENCE, 2)
        label = F.lower(F.when(label == "", F.regexp_extract(p, REFERENCE, 1)).otherwise(label))

        def link(d: Column) -> Column:
            title = F.when(d["title"] == "", F.lit("")).otherwise(F.concat(F.lit(' "'), d["title"], F.lit('"')))
            return F.when(d.isNull(), p).otherwise(F.concat(F.lit("["), F.regexp_extract(p, REFERENCE, 1), F.lit("]("),
                                                            d["url"], title, F.lit(")")))
        return F.when(p.rlike(REFERENCE), _let(F.get(F.filter(defined, lambda d: d["label"] == label), F.lit(0)),
                                               link)).otherwise(p)

    pieces = F.regexp_extract_all(text, F.lit(REFERENCE_PIECES), F.lit(0))
    return F.when((F.size(defined) > 0) & F.contains(text, F.lit("][")),
                  F.array_join(F.transform(pieces, piece), "")).otherwise(text)


def _escaped(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _table(text: Column, inline: Callable[[Column], Column]) -> Column:
    def row(line: Column, n: Column) -> Column:
        inner = F.regexp_replace(line, r"^\||\|\z", "")
        cells = F.transform(F.split(inner, r"\|"), lambda cell: _cell(cell, n))
        return F.concat(F.lit("<tr>"), F.array_join(cells, ""), F.lit("</tr>"))

    def _cell(cell: Column, n: Column) -> Column:
        tag = F.when(n == 0, F.lit("th>")).otherwise(F.lit("td>"))
        return F.concat(F.lit("<"), tag, inline(F.trim(cell)), F.lit("</"), tag)

    return F.concat(F.lit("<table>\n"), F.array_join(F.transform(F.split(text, "\n"), row), "\n"), F.lit("\n</table>"))


def _leaf_html(b: Column, defined: Column) -> Column:
    def inline(x: Column) -> Column:
        return inline_text(resolve_references(x, defined), links=True)

    return (F.when(b["t"] == "rule", F.lit("<hr/>"))
            .when(b["t"] == "code", F.concat(F.lit("<pre><code>"), _escaped(b["text"]), F.lit("</code></pre>")))
            .when(b["t"] == "table", _table(b["text"], inline))
            .when(b["t"] == "paragraph", F.concat(F.lit("<p>"), inline(b["text"]), F.lit("</p>")))
            .otherwise(F.concat(F.lit("<"), b["t"], F.lit(">"), inline(b["text"]), F.lit("</"), b["t"], F.lit(">"))))


def _kind(label: Column) -> Column:
    return F.regexp_extract(label, "^[a-z]+", 0)


def _moves(old: Column, new: Column) -> Column:
    """Tags that lead from the containers ``old`` to ``new``: closed ones innermost first, then opened ones."""
    same = F.size(F.filter(F.sequence(F.lit(0), F.size(old)), lambda i: (i > 0) & (
        F.slice(old, F.lit(1), i) == F.slice(new, F.lit(1), i))))

    def tags(k: Column) -> Column:
        gone, come = F.get(old, k), F.get(new, k)
        sibling = F.coalesce((_kind(gone) == _kind(come)) & (_kind(come) != "q"), F.lit(False))
        inner = F.transform(F.reverse(F.slice(old, k + 2, F.size(old))), closing)
        closed = F.when(sibling, F.concat(inner, F.array(F.lit("</li>")))).otherwise(
            F.transform(F.reverse(F.slice(old, k + 1, F.size(old))), closing))
        opened = F.when(sibling, F.concat(F.array(F.lit("<li>")), F.transform(F.slice(new, k + 2, F.size(new)), opening))
                        ).otherwise(F.transform(F.slice(new, k + 1, F.size(new)), opening))
        return F.concat(closed, opened)

    def closing(label: Column) -> Column:
        return F.when(_kind(label) == "q", F.lit("</blockquote>")).otherwise(
            F.concat(F.lit("</li>\n</"), _kind(label), F.lit(">")))

    def opening(label: Column) -> Column:
        return F.when(_kind(label) == "q", F.lit("<blockquote>")).otherwise(
            F.concat(F.lit("<"), _kind(label), F.lit(">\n<li>")))

    return _let(same, tags)


def blocks_html(blocks: Column) -> Column:
    """HTML of :func:`nested_blocks`, one line per tag or block."""
    def render(defined: Column) -> Column:
        def labels(b: Column) -> Column:
            return F.filter(F.split(F.coalesce(b["path"], F.lit("")), "/"), lambda x: x != "")

        def one(b: Column, i: Column) -> Column:
            return F.concat(_moves(labels(F.get(shown, i - 1)), labels(b)),
                            F.when(b["t"] == "end", F.array().cast("array<string>"))
                            .otherwise(F.array(_leaf_html(b, defined))))
        end = F.struct(F.lit("").alias("path"), F.lit("end").alias("t"), F.lit("").alias("text"))
        shown = F.concat(F.filter(blocks, lambda b: b["t"] != "definition"), F.array(end))
        return F.array_join(F.flatten(F.transform(shown, one)), "\n")
    return _let(definitions(blocks), render)


def nested_html(c) -> Column:
    """Nested markdown to HTML (null: null)."""
    return _let(nested_blocks(c), blocks_html)


def nested_post_html(c) -> Column:
    """X2 with nested markdown: source unescape, blocks, entity decoding and spoiler escaping of a body."""
    return escape_spoilers(decode_entities(nested_html(xml_unescape(c))))
