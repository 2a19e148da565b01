"""Markup to XML text: source unescape, markdown blocks, entities, spoilers, rendering.

All functions return Column expressions built from array and regex
functions, so a whole post is converted inside one projection (no shuffle,
no Python). Regex patterns are kept free of look-around so the same patterns
can be restated in other engines.
"""

from __future__ import annotations

import html.entities
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
# Pieces of a text for entity decoding: decimal reference, hexadecimal
# reference, named reference (with or without ';'), a bare '&', plain text.
ENTITY_PIECES = r"&#[0-9]+;|&#[xX][0-9a-fA-F]+;|&[A-Za-z0-9]+;?|&|[^&]+"
# Replacement for references to code point 0, surrogates and values over U+10FFFF.
REPLACEMENT_CHAR = "�"
# Pieces of a text for spoiler escaping: spoiler link opening tags, other text.
SPOILER_PIECES = r'<a href="[#/]s" title="[^>]+">|<|[^<]+'
SPOILER_PREFIX_LEN = len('<a href="#s" title="')
# Markdown subset: block separators and block types.
BLOCK_SPLIT = "\n[ \t\n]*\n"
BLANK_START = "^[ \t\n]*\n"
# A heading is one line, whatever stands before and after it.
HEADING_LINE = "(^|\n)(#{1,6}[ \t][^\n]*)"
BLOCK_END = "[ \t\n]+\\z"
HEADING = r"^#{1,6}[ \t]"
QUOTE = r"^[ \t]*>"
CODE = "^(    |\t)"
LIST_ITEM = r"^[ \t]*([*+-]|[0-9]+\.)[ \t]"
ORDERED_ITEM = r"^[ \t]*[0-9]+\.[ \t]"
RULE = r"^[ \t]*((\*[ \t]*){3,}|(-[ \t]*){3,}|(_[ \t]*){3,})\z"
HEADING_LEVEL = "^(#{1,6})"
# Block marks removed from the text of each block type (group 1 is kept).
STRIP = {
    "heading": r"^()#{1,6}[ \t]+",
    "quote": r"(^|\n)[ \t]*>[ \t]?",
    "code": "(^|\n)(    |\t)",
    "list": r"(^|\n)[ \t]*([*+-]|[0-9]+\.)[ \t]+",
}
BLOCK_TYPES = ["heading", "rule", "code", "quote", "list"]
# Pieces of a block: code spans, links (with or without a title), other text.
INLINE_PIECES = r'`[^`\n]+`|\[[^\]\n]*\]\([^() \t\n"]*([ \t]+"[^\n]*?")?[ \t]*\)|[`\[]|[^`\[]+'
# Text, address and title of a link (groups 1, 2 and 4).
LINK = r'^\[([^\]\n]*)\]\(([^() \t\n"]*)([ \t]+"([^\n]*)")?[ \t]*\)\z'
# Inline marks reduced to their text: bold, strike-through, italics, code.
INLINE_MARKS = [
    (r"\*\*([^*]+)\*\*", "$1"),
    (r"__([^_]+)__", "$1"),
    (r"~~([^~]+)~~", "$1"),
    (r"\*([^*]+)\*", "$1"),
    (r"`([^`]+)`", "$1"),
]
# Italics by underscores, never inside a word. A match takes the character after
# it, so a second pass finds the marks that follow at once.
UNDERSCORED = r"(^|[^\p{L}\p{N}_])_([^_\n]+)_(\z|[^\p{L}\p{N}_])"
# Marks inside code spans and link tags stand as noncharacters while the others are removed.
MARKS, SHIELDED = "*_~`", "\ufdd0\ufdd1\ufdd2\ufdd3"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def xml_escape_text(c) -> Column:
    """Escape ``&``, ``<`` and ``>`` (text content)."""
    c = _col(c)
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def xml_escape_attr(c) -> Column:
    """Escape a value for a double-quoted XML attribute."""
    return F.replace(xml_escape_text(c), F.lit('"'), F.lit("&quot;"))


def xml_unescape(c) -> Column:
    """P10: undo ``&lt;``, ``&gt;`` and then ``&amp;`` in source text."""
    c = _col(c)
    return F.replace(F.replace(F.replace(c, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")),
                     F.lit("&amp;"), F.lit("&"))


def entity_table() -> dict[str, str]:
    """HTML5 named references (name incl. optional ';') -> XML-safe replacement.

    Built from the standard library table; ``& < >`` in a replacement stay
    escaped so the output remains well-formed XML.
    """
    out = {}
    for name, chars in html.entities.html5.items():
        out[name] = chars.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    return out


def _entity_map() -> Column:
    """Entity table as a constant map of maps, keyed by a name's first letter and the name."""
    by_letter: dict[str, dict[str, str]] = {}
    for name, chars in entity_table().items():
        by_letter.setdefault(name[0], {})[name] = chars
    return F.from_json(F.lit(json.dumps(by_letter)), "map<string,map<string,string>>")


def _code_point_text(cp: Column) -> Column:
    valid = (cp > 0) & (cp <= 0x10FFFF) & ~((cp >= 0xD800) & (cp <= 0xDFFF))
    char = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")) \
        .otherwise(F.lit(REPLACEMENT_CHAR))
    return (F.when(char == F.lit("&"), F.lit("&amp;")).when(char == F.lit("<"), F.lit("&lt;"))
            .when(char == F.lit(">"), F.lit("&gt;")).when(char == F.lit('"'), F.lit("&quot;"))
            .when(char == F.lit("'"), F.lit("&apos;")).otherwise(char))


def decode_entities(c) -> Column:
    """P11 + P12: decode numeric and named character references in one pass.

    Decimal ``&#N;`` and hexadecimal ``&#xH;`` references become the character
    (quotes as ``&quot;``/``&apos;``, ``& < >`` escaped, invalid code points as
    U+FFFD). Named references with ``;`` and the legacy names without ``;``
    become their characters; unknown names and bare ``&`` get their ``&``
    escaped. Text produced by a replacement is never decoded again.
    """
    c = _col(c)
    entities = _entity_map()
    pieces = F.regexp_extract_all(c, F.lit(ENTITY_PIECES), 0)

    def piece(p: Column) -> Column:
        is_hex = p.startswith("&#x") | p.startswith("&#X")
        digits = F.regexp_replace(F.substring(p, 3, F.length(p) - 3), "^0+(?=.)", "")
        hexdigits = F.regexp_replace(F.substring(p, 4, F.length(p) - 4), "^0+(?=.)", "")
        dec_cp = F.when(F.length(digits) <= 8, digits.cast("bigint")).otherwise(F.lit(-1))
        hex_cp = F.when(F.length(hexdigits) <= 7, F.conv(hexdigits, 16, 10).cast("bigint")).otherwise(F.lit(-1))
        named = F.try_element_at(F.try_element_at(entities, F.substring(p, 2, 1)), F.substring(p, 2, F.length(p)))
        return (F.when(is_hex & p.endswith(";"), _code_point_text(hex_cp))
                .when(p.startswith("&#") & p.endswith(";"), _code_point_text(dec_cp))
                .when(p.startswith("&") & (F.length(p) > 1),
                      F.coalesce(named, F.concat(F.lit("&amp;"), F.substring(p, 2, F.length(p)))))
                .when(p == F.lit("&"), F.lit("&amp;"))
                .otherwise(p))

    return F.when(F.contains(c, F.lit("&")), F.array_join(F.transform(pieces, piece), "")).otherwise(c)


def escape_spoilers(c) -> Column:
    """Inside spoiler links (``href="#s"`` or ``"/s"``) escape quotes of the title."""
    pieces = F.regexp_extract_all(_col(c), F.lit(SPOILER_PIECES), 0)

    def piece(p: Column) -> Column:
        is_spoiler = p.startswith('<a href="') & (F.length(p) > SPOILER_PREFIX_LEN + 2) & p.endswith('">') \
            & p.rlike(r'^<a href="[#/]s" title="')
        title = F.substring(p, SPOILER_PREFIX_LEN + 1, F.length(p) - SPOILER_PREFIX_LEN - 2)
        return F.when(is_spoiler, F.concat(F.substring(p, 1, SPOILER_PREFIX_LEN),
                                           F.replace(title, F.lit('"'), F.lit("&quot;")), F.lit('">'))
                      ).otherwise(p)

    return F.array_join(F.transform(pieces, piece), "")


# ------------------------------------------------------------ markdown subset

def _attr(c: Column) -> Column:
    """A value for a quoted attribute that entity decoding cannot close."""
    return F.regexp_replace(c, '"|&(quot|QUOT);?', "'")


def _link_tag(p: Column) -> Column:
    """Opening ``<a>`` tag of a link; spoiler titles keep their quotes for :func:`escape_spoilers`."""
    url, title = F.regexp_extract(p, LINK, 2), F.regexp_extract(p, LINK, 4)
    title = F.when(url.isin("#s", "/s"), title).otherwise(_attr(title))
    with_title = F.when(title == "", F.lit("")).otherwise(F.concat(F.lit('" title="'), title))
    return F.concat(F.lit('<a href="'), _attr(url), with_title, F.lit('">'))


def inline_text(c, links: bool = False) -> Column:
    """Inline marks (links, bold, italics, strike-through, code) reduced to their text.

    With ``links``, links become ``<a href title>`` elements instead. Code
    spans and addresses keep the marks they hold.
    """
    c = F.replace(F.replace(_col(c), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))

    def shield(x: Column) -> Column:
        return F.translate(x, MARKS, SHIELDED)

    def piece(p: Column) -> Column:
        text = F.regexp_extract(p, LINK, 1)
        link = F.concat(shield(_link_tag(p)), text, F.lit("</a>")) if links else text
        return (F.when(p.startswith("`") & (F.length(p) > 2), shield(F.substring(p, 2, F.length(p) - 2)))
                .when(p.startswith("[") & (F.length(p) > 1), link).otherwise(p))

    c = F.when(c.contains("[") | c.contains("`"),
               F.array_join(F.transform(F.regexp_extract_all(c, F.lit(INLINE_PIECES), F.lit(0)), piece), "")).otherwise(c)
    for pattern, text in [*INLINE_MARKS, (UNDERSCORED, "$1$2$3"), (UNDERSCORED, "$1$2$3")]:
        c = F.regexp_replace(c, pattern, text)
    return F.translate(c, SHIELDED, MARKS)


def block_type(b: Column) -> Column:
    """Type of a markdown block: heading, rule, code, quote, list or paragraph."""
    patterns = {"heading": HEADING, "rule": RULE, "code": CODE, "quote": QUOTE, "list": LIST_ITEM}
    out = F.when(b.rlike(patterns[BLOCK_TYPES[0]]), F.lit(BLOCK_TYPES[0]))
    for name in BLOCK_TYPES[1:]:
        out = out.when(b.rlike(patterns[name]), F.lit(name))
    return out.otherwise(F.lit("paragraph"))


def blocks(c) -> Column:
    """Non-blank blocks of a text separated by blank lines (``\\r`` removed), each heading line one of them."""
    text = F.regexp_replace(F.replace(_col(c), F.lit("\r"), F.lit("")), HEADING_LINE, "$1\n$2\n")
    text = F.regexp_replace(text, BLANK_START, "")
    trimmed = F.transform(F.split(text, BLOCK_SPLIT), lambda b: F.regexp_replace(b, BLOCK_END, ""))
    return F.filter(trimmed, lambda b: F.trim(b) != F.lit(""))


def block_text(b: Column, t: Column, links: bool = False) -> Column:
    """Text of a block of type ``t``: block marks removed, inline marks as in :func:`inline_text`."""
    stripped = (F.when(t == "heading", F.regexp_replace(b, STRIP["heading"], "$1"))
                .when(t == "quote", F.regexp_replace(b, STRIP["quote"], "$1"))
                .when(t == "code", F.regexp_replace(b, STRIP["code"], "$1"))
                .when(t == "list", F.regexp_replace(b, STRIP["list"], "$1"))
                .when(t == "rule", F.lit(""))
                .otherwise(b))
    return F.when(t == "code", F.replace(F.replace(stripped, F.lit("<"), F.lit("&lt;")),
                                         F.lit(">"), F.lit("&gt;"))).otherwise(inline_text(stripped, links))


def typed_blocks(c, links: bool = False) -> Column:
    """Blocks of a text as ``struct(b, t, text)``: raw block, type and text.

    Type and text are computed once per block (successive ``transform`` steps).
    """
    typed = F.transform(blocks(c), lambda b: F.struct(b.alias("b"), block_type(b).alias("t")))
    return F.transform(typed, lambda x: F.struct(x["b"].alias("b"), x["t"].alias("t"),
                                                 block_text(x["b"], x["t"], links).alias("text")))


def render_block(x: Column) -> Column:
    """HTML of one typed block."""
    b, t, text = x["b"], x["t"], x["text"]
    level = F.length(F.regexp_extract(b, HEADING_LEVEL, 1)).cast("string")
    items = F.array_join(F.transform(F.split(text, "\n"),
                                     lambda i: F.concat(F.lit("<li>"), i, F.lit("</li>"))), "\n")
    list_tag = F.when(b.rlike(ORDERED_ITEM), F.lit("ol")).otherwise(F.lit("ul"))
    return (F.when(t == "heading", F.concat(F.lit("<h"), level, F.lit(">"), text, F.lit("</h"), level, F.lit(">")))
            .when(t == "rule", F.lit("<hr/>"))
            .when(t == "code", F.concat(F.lit("<pre><code>"), text, F.lit("</code></pre>")))
            .when(t == "quote", F.concat(F.lit("<blockquote>\n<p>"), text, F.lit("</p>\n</blockquote>")))
            .when(t == "list", F.concat(F.lit("<"), list_tag, F.lit(">\n"), items, F.lit("\n</"), list_tag, F.lit(">")))
            .otherwise(F.concat(F.lit("<p>"), text, F.lit("</p>"))))


def markdown_html(c) -> Column:
    """Markdown subset to HTML, one line per block."""
    return F.array_join(F.transform(typed_blocks(c, links=True), render_block), "\n")


def post_html(c) -> Column:
    """Source unescape, markdown, entity decoding and spoiler escaping of a body."""
    return escape_spoilers(decode_entities(markdown_html(xml_unescape(c))))


def render_text(post_id, html_col) -> Column:
    """``<text id="...">`` element holding the post's HTML."""
    return F.concat(F.lit('<text id="'), xml_escape_attr(post_id), F.lit('">\n'), _col(html_col),
                    F.lit("\n</text>"))


def render_open_tag(level: str, attrs) -> Column:
    """P15 + P16: opening tag with one attribute per entry, in order; NULL renders as ``NA``.

    ``attrs`` holds column names or ``(attribute name, column)`` pairs.
    """
    parts = [F.lit(f"<{level}")]
    for a in attrs:
        name, col = (a, F.col(a)) if isinstance(a, str) else (a[0], _col(a[1]))
        value = xml_escape_attr(F.coalesce(col.cast("string"), F.lit("NA")))
        parts += [F.lit(f' {name}="'), value, F.lit('"')]
    return F.concat(*parts, F.lit(">"))
