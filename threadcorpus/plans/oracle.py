"""SQL fragments for the DuckDB oracle (tables are pre-registered views there).

Each fragment restates an operator's definition in plain SQL so the driver can
check the Spark result independently. Only the oracle uses these strings.
"""

from __future__ import annotations

import html
import html.entities

from threadcorpus.plans.fixtures import REFERENCE_LANG, SINGLE_TARGET, TARGET_LANGS

MODEL_LANGS = [REFERENCE_LANG, *TARGET_LANGS]


def words(x: str) -> str:
    return "regexp_extract_all(" + x + r", '([\p{L}\p{N}_]+)', 1)"


def sanitize(x: str) -> str:
    return ("regexp_replace(replace(replace(" + x + r", chr(13), ''), chr(10), ' '), "
            r"'\(?http[^ ]+\)?', '', 'g')")


def too_short(x: str) -> str:
    return f"(length({x}) <= 10 OR {x} = '[deleted]')"


def month(x: str) -> str:
    return f"strftime(DATE '1970-01-01' + CAST(floor({x} / 86400) AS INTEGER), '%Y-%m')"


def ngrams(chars: str) -> str:
    """Trigrams from a list of code points (``string_split(text, '')``), linear time."""
    return f"list_transform(range(1, len({chars}) - 1), lambda i: {chars}[i] || {chars}[i + 1] || {chars}[i + 2])"


def threshold(x: str) -> str:
    return f"(exp(-sqrt(CAST({x} AS DOUBLE)) / 4.0) + 0.015)"


def model_ctes(langs=MODEL_LANGS) -> str:
    """Lexicon, lexicon index and n-gram profile trained on ``documents``."""
    flags = ", ".join(f"max(CASE WHEN lang = '{l}' THEN 1 ELSE 0 END) AS in_{l}" for l in langs)
    in_list = ", ".join(f"'{l}'" for l in langs)
    return f"""
lex AS (
  SELECT lang, word, CAST(count(*) AS BIGINT) AS n_docs
  FROM (SELECT lang, unnest(list_distinct({words('lower(text)')})) AS word
        FROM documents WHERE lang IS NOT NULL) t
  GROUP BY lang, word HAVING count(*) >= 3),
lexidx AS (SELECT word, {flags} FROM lex WHERE lang IN ({in_list}) GROUP BY word),
ng_docs AS (SELECT lang, string_split(lower(text), '') AS ch FROM documents WHERE lang IS NOT NULL),
ng_cnt AS (
  SELECT lang, gram, count(*) AS cnt
  FROM (SELECT lang, unnest({ngrams('ch')}) AS gram FROM ng_docs WHERE len(ch) >= 3) g
  GROUP BY lang, gram),
ng_tot AS (SELECT lang, sum(cnt) AS total FROM ng_cnt GROUP BY lang),
ng_voc AS (SELECT count(DISTINCT gram) AS v FROM ng_cnt),
ng_nd AS (SELECT lang, count(*) AS d FROM ng_docs GROUP BY lang),
ng_prior AS (SELECT lang, CAST(round(1000000.0 * ln(d / (SELECT CAST(sum(d) AS DOUBLE) FROM ng_nd))) AS BIGINT) AS prior
             FROM ng_nd),
ng_lp AS (SELECT c.lang, c.gram,
                 CAST(round(1000000.0 * ln((c.cnt + 1) / CAST(t.total + v.v AS DOUBLE))) AS BIGINT) AS lp
          FROM ng_cnt c JOIN ng_tot t USING (lang) CROSS JOIN ng_voc v),
ng_const AS (SELECT t.lang, CAST(round(1000000.0 * ln(1.0 / (t.total + v.v))) AS BIGINT) AS u, p.prior
             FROM ng_tot t CROSS JOIN ng_voc v JOIN ng_prior p USING (lang))"""


def error_rate_ctes(src: str, out: str, langs) -> str:
    """``out(id, n_words, err_<lang>...)`` for posts ``src(id, clean)`` with at least one word."""
    errs = ", ".join(
        f"sum(CASE WHEN coalesce(x.in_{l}, 0) = 1 THEN 0 ELSE f.freq END) / sum(f.freq) AS err_{l}"
        for l in langs)
    return f"""
{out}_freq AS (SELECT id, word, count(*) AS freq
               FROM (SELECT id, lower(unnest({words('clean')})) AS word FROM {src}) t GROUP BY id, word),
{out} AS (SELECT f.id, CAST(sum(f.freq) AS BIGINT) AS n_words, {errs}
          FROM {out}_freq f LEFT JOIN lexidx x ON x.word = f.word GROUP BY f.id)"""


def langid_ctes(src: str, out: str) -> str:
    """``out(id, langid, langid_score)`` for posts ``src(id, clean)``."""
    return f"""
{out}_g AS (SELECT id, gram, count(*) AS cnt
            FROM (SELECT id, unnest({ngrams('ch')}) AS gram
                  FROM (SELECT id, string_split(lower(clean), '') AS ch FROM {src}) c
                  WHERE len(ch) >= 3) t GROUP BY id, gram),
{out}_s AS (SELECT g.id, k.lang, CAST(sum(g.cnt * coalesce(lp.lp, k.u)) + k.prior AS BIGINT) AS score
          FROM {out}_g g CROSS JOIN ng_const k
          LEFT JOIN ng_lp lp ON lp.gram = g.gram AND lp.lang = k.lang
          GROUP BY g.id, k.lang, k.prior),
{out} AS (SELECT id, lang AS langid, score AS langid_score FROM (
  SELECT id, lang, score, row_number() OVER (PARTITION BY id ORDER BY score DESC, lang DESC) AS rn
  FROM {out}_s) r WHERE rn = 1)"""


def single_label_ctes(src: str = "posts", out: str = "labels") -> str:
    """``out(id, label)``: the one-target rule on posts ``src(id, body)``."""
    ref, tgt = REFERENCE_LANG, SINGLE_TARGET
    return f"""
{out}_prep AS (SELECT id, {sanitize('body')} AS clean FROM {src}),
{out}_long AS (SELECT id, clean FROM {out}_prep WHERE NOT {too_short('clean')}),
{error_rate_ctes(out + '_long', out + '_rates', [ref, tgt])},
{out}_gated AS (SELECT l.id, l.clean FROM {out}_long l JOIN {out}_rates r USING (id)
                WHERE r.err_{ref} > 0.3 AND r.err_{tgt} < 0.7),
{langid_ctes(out + '_gated', out + '_lid')},
{out} AS (SELECT p.id, CASE WHEN {too_short('p.clean')} THEN NULL
                            ELSE coalesce(l.langid = '{tgt}', false) END AS label
          FROM {out}_prep p LEFT JOIN {out}_lid l USING (id))"""


def multi_label_ctes(src: str, out: str = "mlabels") -> str:
    """``out(id, language)``: the many-target rule on distinct posts of ``src(id, body)``."""
    ref = REFERENCE_LANG
    langs = [ref, *TARGET_LANGS]
    cand = ", ".join(f"CASE WHEN r.err_{t} < 0.7 THEN '{t}' END" for t in TARGET_LANGS)
    return f"""
{out}_prep AS (SELECT DISTINCT id, {sanitize('body')} AS clean FROM {src}),
{out}_long AS (SELECT id, clean FROM {out}_prep WHERE NOT {too_short('clean')}),
{error_rate_ctes(out + '_long', out + '_rates', langs)},
{out}_rated AS (SELECT r.id, r.err_{ref} > 0.3 AS non_ref,
                       list_filter([{cand}], lambda x: x IS NOT NULL) AS cands
                FROM {out}_rates r),
{out}_gated AS (SELECT l.id, l.clean FROM {out}_long l JOIN {out}_rated r USING (id)
                WHERE r.non_ref AND len(r.cands) > 0),
{langid_ctes(out + '_gated', out + '_lid')},
{out}_dec AS (SELECT r.id, CASE WHEN NOT r.non_ref THEN 'other'
                                WHEN list_contains(r.cands, l.langid) THEN l.langid
                                ELSE 'other' END AS language
              FROM {out}_rated r LEFT JOIN {out}_lid l USING (id)),
{out} AS (SELECT p.id, d.language FROM {out}_prep p LEFT JOIN {out}_dec d USING (id))"""


# ------------------------------------------------------------------ markup

def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# The definitions restated here on their own, in the patterns of DuckDB's engine.
BLOCK_PATTERNS = [
    ("heading", r"^#{1,6}[ \t]"),
    ("rule", r"^[ \t]*((\*[ \t]*){3,}|(-[ \t]*){3,}|(_[ \t]*){3,})$"),
    ("code", r"^(    |\t)"),
    ("quote", r"^[ \t]*>"),
    ("list", r"^[ \t]*([*+-]|[0-9]+\.)[ \t]"),
]
BLOCK_MARKS = {
    "heading": r"^()#{1,6}[ \t]+",
    "quote": r"(^|\n)[ \t]*>[ \t]?",
    "code": r"(^|\n)(?:    |\t)",
    "list": r"(^|\n)[ \t]*(?:[*+-]|[0-9]+\.)[ \t]+",
}
HEAD_LINE = r"(^|\n)(#{1,6}[ \t][^\n]*)"
BLANKS_FIRST = r"^[ \t\n]*\n"
BLANK_LINES = r"\n[ \t\n]*\n"
LINK_PARTS = r'^\[([^\]\n]*)\]\(([^() \t\n"]*)(?:[ \t]+"([^\n]*)")?[ \t]*\)$'
SPAN_PARTS = r'`[^`\n]+`|\[[^\]\n]*\]\([^() \t\n"]*(?:[ \t]+"[^\n]*?")?[ \t]*\)|[`\[]|[^`\[]+'
UNDERSCORE = r"(^|[^\p{L}\p{N}_])_([^_\n]+)_($|[^\p{L}\p{N}_])"
REFERENCE_PARTS = r"&#[0-9]+;|&#[xX][0-9a-fA-F]+;|&[A-Za-z0-9]+;?|&|[^&]+"
TAG_PARTS = r'<a href="[#/]s" title="[^>]+">|<|[^<]+'
SENTENCE_STOP = r"([.!?])[ \t\n]+"
TOKEN_PARTS = r"&[A-Za-z0-9#]+;|[\p{L}\p{N}_]+|[^ \t\n\p{L}\p{N}_]"


def xml_unescape(x: str) -> str:
    return f"replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"


def xml_escape_attr(x: str) -> str:
    return f"replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"


def _hide(x: str) -> str:
    return f"translate({x}, '*_~`', chr(64976) || chr(64977) || chr(64978) || chr(64979))"


def _quoteless(x: str) -> str:
    return f"regexp_replace({x}, '\"|&(quot|QUOT);?', chr(39), 'g')"


def inline_text(x: str, links: bool = False) -> str:
    text, url, title = (f"regexp_extract(p, {lit(LINK_PARTS)}, {g})" for g in (1, 2, 3))
    kept = f"CASE WHEN {url} IN ('#s', '/s') THEN {title} ELSE {_quoteless(title)} END"
    tag = (f"'<a href=\"' || {_quoteless(url)} || CASE WHEN {title} = '' THEN '' "
           f"ELSE '\" title=\"' || {kept} END || '\">'")
    link = f"{_hide(tag)} || {text} || '</a>'" if links else text
    piece = (f"CASE WHEN starts_with(p, '`') AND length(p) > 2 THEN {_hide('substring(p, 2, length(p) - 2)')} "
             f"WHEN starts_with(p, '[') AND length(p) > 1 THEN {link} ELSE p END")
    c = f"replace(replace({x}, '<', '&lt;'), '>', '&gt;')"
    c = f"coalesce(array_to_string(list_transform(regexp_extract_all({c}, {lit(SPAN_PARTS)}), lambda p: {piece}), ''), '')"
    for mark in (r"\*\*([^*]+)\*\*", "__([^_]+)__", "~~([^~]+)~~", r"\*([^*]+)\*", "`([^`]+)`"):
        c = f"regexp_replace({c}, {lit(mark)}, '\\1', 'g')"
    for _ in range(2):
        c = f"regexp_replace({c}, {lit(UNDERSCORE)}, '\\1\\2\\3', 'g')"
    return f"translate({c}, chr(64976) || chr(64977) || chr(64978) || chr(64979), '*_~`')"


def block_type(b: str) -> str:
    whens = " ".join(f"WHEN regexp_matches({b}, {lit(p)}) THEN '{n}'" for n, p in BLOCK_PATTERNS)
    return f"CASE {whens} ELSE 'paragraph' END"


def block_text(b: str, t: str, links: bool = False) -> str:
    whens = " ".join(f"WHEN {t} = '{n}' THEN regexp_replace({b}, {lit(p)}, '\\1', 'g')"
                     for n, p in BLOCK_MARKS.items())
    stripped = f"CASE {whens} WHEN {t} = 'rule' THEN '' ELSE {b} END"
    return (f"CASE WHEN {t} = 'code' THEN replace(replace({stripped}, '<', '&lt;'), '>', '&gt;') "
            f"ELSE {inline_text(stripped, links)} END")


def typed_blocks(x: str, links: bool = False) -> str:
    lined = f"regexp_replace(replace({x}, chr(13), ''), {lit(HEAD_LINE)}, '\\1' || chr(10) || '\\2' || chr(10), 'g')"
    text = f"regexp_replace({lined}, {lit(BLANKS_FIRST)}, '')"
    raw = f"string_split_regex({text}, {lit(BLANK_LINES)})"
    trimmed = f"list_transform({raw}, lambda b: rtrim(b, ' ' || chr(9) || chr(10)))"
    kept = f"list_filter({trimmed}, lambda b: trim(b) <> '')"
    typed = f"list_transform({kept}, lambda b: {{'b': b, 't': {block_type('b')}}})"
    return f"list_transform({typed}, lambda x: {{'b': x.b, 't': x.t, 'text': {block_text('x.b', 'x.t', links)}}})"


def render_block(x: str) -> str:
    b, t, text = f"{x}.b", f"{x}.t", f"{x}.text"
    level = f"CAST(length(regexp_extract({b}, '^#+')) AS VARCHAR)"
    items = f"array_to_string(list_transform(string_split({text}, chr(10)), lambda i: '<li>' || i || '</li>'), chr(10))"
    tag = f"(CASE WHEN regexp_matches({b}, {lit(r'^[ \t]*[0-9]+\.[ \t]')}) THEN 'ol' ELSE 'ul' END)"
    return (f"CASE WHEN {t} = 'heading' THEN '<h' || {level} || '>' || {text} || '</h' || {level} || '>' "
            f"WHEN {t} = 'rule' THEN '<hr/>' "
            f"WHEN {t} = 'code' THEN '<pre><code>' || {text} || '</code></pre>' "
            f"WHEN {t} = 'quote' THEN '<blockquote>' || chr(10) || '<p>' || {text} || '</p>' || chr(10) || '</blockquote>' "
            f"WHEN {t} = 'list' THEN '<' || {tag} || '>' || chr(10) || {items} || chr(10) || '</' || {tag} || '>' "
            f"ELSE '<p>' || {text} || '</p>' END")


def markdown_html(x: str) -> str:
    return f"coalesce(array_to_string(list_transform({typed_blocks(x, True)}, lambda x: {render_block('x')}), chr(10)), '')"


def entity_map() -> str:
    """Named references of the standard library; the characters of XML's own syntax stay escaped."""
    table = {name: html.escape(chars, quote=False) for name, chars in html.entities.html5.items()}
    return "MAP {" + ", ".join(f"{lit(k)}: {lit(v)}" for k, v in sorted(table.items())) + "}"


def _code_point_text(cp: str) -> str:
    ch = (f"(CASE WHEN {cp} > 0 AND {cp} <= 1114111 AND NOT ({cp} >= 55296 AND {cp} <= 57343) "
          f"THEN chr(CAST({cp} AS INTEGER)) ELSE chr(65533) END)")
    return (f"(CASE WHEN {ch} = '&' THEN '&amp;' WHEN {ch} = '<' THEN '&lt;' WHEN {ch} = '>' THEN '&gt;' "
            f"WHEN {ch} = '\"' THEN '&quot;' WHEN {ch} = '''' THEN '&apos;' ELSE {ch} END)")


def decode_entities(x: str, emap: str = "emap.m") -> str:
    dec = "ltrim(substring(p, 3, length(p) - 3), '0')"
    hexd = "ltrim(substring(p, 4, length(p) - 4), '0')"
    dec_cp = f"(CASE WHEN length({dec}) BETWEEN 1 AND 8 THEN CAST({dec} AS BIGINT) ELSE -1 END)"
    hex_cp = f"(CASE WHEN length({hexd}) BETWEEN 1 AND 7 THEN CAST('0x' || {hexd} AS BIGINT) ELSE -1 END)"
    piece = (f"CASE WHEN (starts_with(p, '&#x') OR starts_with(p, '&#X')) AND ends_with(p, ';') THEN {_code_point_text(hex_cp)} "
             f"WHEN starts_with(p, '&#') AND ends_with(p, ';') THEN {_code_point_text(dec_cp)} "
             f"WHEN starts_with(p, '&') AND length(p) > 1 THEN coalesce({emap}[substring(p, 2, length(p))], '&amp;' || substring(p, 2, length(p))) "
             f"WHEN p = '&' THEN '&amp;' ELSE p END")
    return (f"coalesce(array_to_string(list_transform(regexp_extract_all({x}, {lit(REFERENCE_PARTS)}, 0), "
            f"lambda p: {piece}), ''), '')")


def escape_spoilers(x: str) -> str:
    n = 20
    piece = (f"CASE WHEN starts_with(p, '<a href=\"') AND length(p) > {n + 2} AND ends_with(p, '\">') "
             f"AND regexp_matches(p, {lit('^<a href=\"[#/]s\" title=\"')}) "
             f"THEN substring(p, 1, {n}) || replace(substring(p, {n + 1}, length(p) - {n} - 2), '\"', '&quot;') || '\">' "
             f"ELSE p END")
    return (f"coalesce(array_to_string(list_transform(regexp_extract_all({x}, {lit(TAG_PARTS)}, 0), "
            f"lambda p: {piece}), ''), '')")


def entity_cte() -> str:
    return f"emap AS (SELECT {entity_map()} AS m)"


# ------------------------------------------------------------------ corpus

def _sentence_tokens(p: str) -> str:
    marked = f"regexp_replace({p}, {lit(SENTENCE_STOP)}, '\\1' || chr(1), 'g')"
    toks = f"list_transform(string_split({marked}, chr(1)), lambda s: regexp_extract_all(s, {lit(TOKEN_PARTS)}, 0))"
    return f"list_filter({toks}, lambda t: len(t) > 0)"


def vertical_lines(x: str) -> str:
    para = (f"list_concat(list_concat(['<p>'], flatten(list_transform({_sentence_tokens('p')}, "
            f"lambda toks, i: CASE WHEN i > 1 THEN list_concat([''], toks) ELSE toks END))), ['</p>'])")
    return f"flatten(list_transform(list_transform({typed_blocks(x)}, lambda b: b.text), lambda p: {para}))"


def tagged_lines(x: str) -> str:
    para = (f"list_concat(list_concat(['<p>', '<s>'], flatten(list_transform({_sentence_tokens('p')}, "
            f"lambda toks, i: CASE WHEN i > 1 THEN list_concat(['</s>', '<s>'], toks) ELSE toks END))), "
            f"['</s>', '</p>'])")
    return f"flatten(list_transform(list_transform({typed_blocks(x)}, lambda b: b.text), lambda p: {para}))"


def open_tag(level: str, attrs) -> str:
    parts = [f"'<{level}'"]
    for name, expr in attrs:
        parts.append(f"' {name}=\"' || {xml_escape_attr(f'coalesce(CAST({expr} AS VARCHAR), {lit(chr(78) + chr(65))})')} || '\"'")
    return " || ".join(parts) + " || '>'"


# ------------------------------------------------------------------ nested markdown

NESTED_MARK = r"( {0,3}> ?| {0,3}(?:[*+-]|[0-9]{1,9}[.)]) +)"


def nested_ctes(posts: str) -> str:
    """``nested(id, pos, path, t, text)``: blocks of nested markdown, by recursion over the lines of each post.

    Open containers stand as patterns that take their marks off a line; a failed one leaves ``chr(1)``.
    """
    return rf"""
nested_lines AS (SELECT id, unnest(ls) AS line, unnest(range(len(ls))) AS n FROM (
  SELECT id, string_split(replace(replace({xml_unescape('body')}, chr(13), ''), chr(9), '    '), chr(10)) AS ls FROM {posts})),
nested_scan(id, n, pieces, labels, fence, para, tab, blk, t, head, leaf, text, path) AS (
  SELECT id, CAST(-1 AS BIGINT), CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[]), '', false, false, 0, '', '', '', '', ''
  FROM nested_lines WHERE n = 0
  UNION ALL
  SELECT id, n2, CASE WHEN lazy OR fenced THEN pieces ELSE list_concat(pieces[1:m], list_transform(marks, lambda k:
      CASE WHEN contains(k, '>') THEN '^ {{0,3}}> ?' ELSE '^( {{' || length(k) || '}}| *\z)' END)) END,
    CASE WHEN lazy OR fenced THEN labels ELSE newlabels END,
    CASE leaf2 WHEN 'open' THEN regexp_extract(rest2, '^ *(`{{3,}}|~{{3,}})', 1) WHEN 'fenced' THEN fence ELSE '' END,
    leaf2 = 'paragraph', leaf2 IN ('delimiter', 'row'),
    CASE WHEN joins OR leaf2 IN ('blank', 'close') THEN blk ELSE blk + 1 END,
    CASE WHEN leaf2 IN ('blank', 'close') THEN '' WHEN leaf2 = 'delimiter' THEN 'table'
      WHEN leaf2 = 'setext' THEN CASE WHEN contains(rest2, '=') THEN 'h1' ELSE 'h2' END
      WHEN joins THEN t WHEN leaf2 = 'open' THEN 'code'
      WHEN leaf2 = 'heading' THEN 'h' || length(regexp_extract(rest2, '^ *(#+)', 1)) ELSE leaf2 END,
    CASE WHEN leaf2 = 'paragraph' AND NOT joins THEN rest2 ELSE '' END,
    leaf2,
    CASE WHEN leaf2 = 'fenced' THEN rest2 WHEN leaf2 = 'code' THEN substr(rest2, 5)
      WHEN leaf2 = 'heading' THEN regexp_replace(regexp_replace(rest2, '^ *#+ +', ''), ' +#+ *\z', '')
      WHEN leaf2 IN ('rule', 'open', 'setext', 'delimiter') THEN NULL ELSE trim(rest2, ' ') END,
    CASE WHEN joins THEN path ELSE array_to_string(CASE WHEN lazy OR fenced THEN labels ELSE newlabels END, '/') END
  FROM (SELECT *, leaf2 IN ('fenced', 'row', 'setext', 'delimiter')
      OR (leaf2 = 'paragraph' AND para AND plain)
      OR (leaf2 = 'code' AND t = 'code' AND every AND plain) AS joins,
    para AND NOT every AND plain AND leaf2 = 'paragraph' AS lazy,
    list_concat(labels[1:m], list_transform(marks, lambda k, j: CASE WHEN contains(k, '>') THEN 'q'
      WHEN regexp_matches(k, '[0-9]') THEN 'ol' ELSE 'ul' END || n2 || '.' || (j - 1))) AS newlabels
  FROM (SELECT *, CASE
      WHEN fenced AND regexp_matches(rest2, '^ {{0,3}}(`+|~+) *\z') AND starts_with(ltrim(rest2, ' '), fence) THEN 'close'
      WHEN fenced THEN 'fenced'
      WHEN trim(rest2, ' ') = '' THEN 'blank'
      WHEN para AND plain AND every AND underline THEN 'setext'
      WHEN para AND plain AND every AND contains(head, '|')
        AND regexp_matches(rest2, '^ {{0,3}}\|?( *:?-+:? *\|)+( *:?-+:?)? *\z') THEN 'delimiter'
      WHEN tab AND plain AND every THEN 'row'
      WHEN regexp_matches(rest2, '^ {{0,3}}(```[^`]*|````+[^`]*|~~~[^
]*)\z') THEN 'open'
      WHEN regexp_matches(rest2, '^ {{0,3}}#{{1,6}} ') THEN 'heading'
      WHEN regexp_matches(rest2, '^ {{0,3}}((\* *){{3,}}|(- *){{3,}}|(_ *){{3,}})\z') THEN 'rule'
      WHEN starts_with(rest2, '    ') AND NOT (para AND plain) THEN 'code'
      WHEN regexp_matches(rest2, '^ {{0,3}}\[[^\[\]
]+\]: *[^ 
"()]+( +"[^"
]*")? *\z') AND NOT (para AND plain)
        THEN 'definition'
      ELSE 'paragraph' END AS leaf2
  FROM (SELECT *, regexp_extract_all(prefix, '{NESTED_MARK}', 1) AS marks, prefix = '' AS plain,
      substr(rest, length(prefix) + 1) AS rest2
  FROM (SELECT *, CASE WHEN fenced OR (para AND every AND underline)
      OR regexp_matches(rest, '^ {{0,3}}((\* *){{3,}}|(- *){{3,}}|(_ *){{3,}})\z')
      THEN '' ELSE regexp_extract(rest, '^{NESTED_MARK}+', 0) END AS prefix
  FROM (SELECT *, m = len(pieces) AS every, fence <> '' AND m = len(pieces) AS fenced,
      regexp_matches(rest, '^ {{0,3}}(=+|-+) *\z') AS underline
  FROM (SELECT *, rests[m + 1] AS rest
  FROM (SELECT *, len(list_filter(rests, lambda x: x <> chr(1))) - 1 AS m
  FROM (SELECT r.*, l.n AS n2, list_transform(range(len(r.pieces) + 1), lambda k:
      list_reduce(list_concat([l.line], r.pieces[1:k]), lambda a, p:
        CASE WHEN regexp_matches(a, p) THEN regexp_replace(a, p, '') ELSE chr(1) END)) AS rests
  FROM nested_scan r JOIN nested_lines l ON l.id = r.id AND l.n = r.n + 1)))))))) s),
nested AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY blk) - 1 AS pos, path, t, text FROM (
  SELECT id, blk, arg_min(path, n) AS path, arg_max(t, n) AS t,
    coalesce(string_agg(text, chr(10) ORDER BY n) FILTER (WHERE text IS NOT NULL), '') AS text
  FROM nested_scan WHERE n >= 0 AND leaf NOT IN ('blank', 'close') GROUP BY id, blk))"""


def nested_html_ctes() -> str:
    """``nested_html(id, html)`` of ``nested`` and ``nested_lines``: tags by the containers that two neighbours share."""
    label = "CASE WHEN regexp_extract(p, '\\]\\[(.*)\\]$', 1) = '' THEN regexp_extract(p, '^\\[([^]]*)', 1) " \
            "ELSE regexp_extract(p, '\\]\\[(.*)\\]$', 1) END"
    found = f"list_filter(defs, lambda d: d.label = lower({label}))[1]"
    piece = (f"CASE WHEN regexp_matches(p, '^\\[[^\\[\\]]+\\]\\[[^\\[\\]]*\\]$') AND {found} IS NOT NULL THEN "
             f"regexp_extract(p, '^\\[[^]]*\\]') || '(' || {found}.url || CASE WHEN {found}.title = '' THEN '' "
             f"ELSE ' \"' || {found}.title || '\"' END || ')' ELSE p END")
    parts = lit(r"`[^`\n]+`|\[[^\[\]\n]+\]\[[^\[\]\n]*\]|[`\[]|[^`\[]+")

    def inline(x: str) -> str:
        return inline_text(f"array_to_string(list_transform(regexp_extract_all({x}, {parts}), lambda p: {piece}), '')", True)

    cells = ("list_transform(string_split(regexp_replace(r, '^\\||\\|$', '', 'g'), '|'), lambda c: "
             f"CASE WHEN i = 1 THEN '<th>' ELSE '<td>' END || coalesce({inline("trim(c, ' ')")}, '') "
             "|| CASE WHEN i = 1 THEN '</th>' ELSE '</td>' END)")
    rows = f"list_transform(string_split(text, chr(10)), lambda r, i: '<tr>' || array_to_string({cells}, '') || '</tr>')"
    return f"""
nested_defs AS (SELECT id, list({{'label': lower(regexp_extract(text, '^\\[([^]]+)', 1)),
    'url': regexp_extract(text, '\\]: *([^ ]+)', 1), 'title': regexp_extract(text, '"([^"]*)"$', 1)}} ORDER BY pos) AS defs
  FROM nested WHERE t = 'definition' GROUP BY id),
nested_shown AS (SELECT *, list_filter(string_split(path, '/'), lambda x: x <> '') AS new,
    list_filter(string_split(coalesce(lag(path) OVER (PARTITION BY id ORDER BY pos), ''), '/'), lambda x: x <> '') AS old
  FROM (SELECT * FROM nested WHERE t <> 'definition'
    UNION ALL SELECT id, 1000000000, '', 'end', '' FROM nested_lines WHERE n = 0)),
nested_moved AS (SELECT *, k > 0 AND k <= len(old) AND k <= len(new) AND kold[k] = knew[k] AND knew[k] <> 'q' AS sibling
  FROM (SELECT *, len(list_filter(range(1, least(len(old), len(new)) + 1), lambda i: old[1:i] = new[1:i])) + 1 AS k,
    list_transform(old, lambda x: regexp_extract(x, '^[a-z]+')) AS kold,
    list_transform(new, lambda x: regexp_extract(x, '^[a-z]+')) AS knew FROM nested_shown)),
nested_html AS (SELECT id, coalesce(string_agg(html, chr(10) ORDER BY pos) FILTER (WHERE html <> ''), '') AS html FROM (
  SELECT id, pos, array_to_string(list_concat(list_concat(
    list_transform(list_reverse(range(k, len(old) + 1)), lambda i: CASE WHEN i = k AND sibling THEN '</li>'
      WHEN kold[i] = 'q' THEN '</blockquote>' ELSE '</li>' || chr(10) || '</' || kold[i] || '>' END),
    list_transform(range(k, len(new) + 1), lambda i: CASE WHEN i = k AND sibling THEN '<li>'
      WHEN knew[i] = 'q' THEN '<blockquote>' ELSE '<' || knew[i] || '>' || chr(10) || '<li>' END)),
    CASE t WHEN 'end' THEN CAST([] AS VARCHAR[]) WHEN 'rule' THEN ['<hr/>']
      WHEN 'code' THEN ['<pre><code>' || replace(replace(text, '<', '&lt;'), '>', '&gt;') || '</code></pre>']
      WHEN 'table' THEN ['<table>' || chr(10) || array_to_string({rows}, chr(10)) || chr(10) || '</table>']
      WHEN 'paragraph' THEN ['<p>' || {inline('text')} || '</p>']
      ELSE ['<' || t || '>' || {inline('text')} || '</' || t || '>'] END), chr(10)) AS html
  FROM (SELECT m.*, coalesce(d.defs, []) AS defs FROM nested_moved m LEFT JOIN nested_defs d USING (id))) GROUP BY id)"""


# ------------------------------------------------------------------ language features (L2)

def mixed_ngrams(ch: str) -> str:
    """1- to 4-grams of a list of code points."""
    lists = [f"list_transform(range(1, len({ch}) - {n - 2}), lambda i: "
             + " || ".join(f"{ch}[i + {j}]" for j in range(n)) + ")" for n in (1, 2, 3, 4)]
    return "list_filter(flatten([" + ", ".join(lists) + "]), lambda g: g <> '')"


def _gain(x: str) -> str:
    return f"(CASE WHEN {x} > 0 THEN CAST(round(1000.0::DOUBLE * ({x}) * ln({x})) AS BIGINT) ELSE 0 END)"


def feature_ctes(docs: str, per_language: int) -> str:
    """``ft_best(lang, gram, score, rank)`` and the profile ``ft_lp(lang, gram, lp)``, ``ft_prior`` of ``docs``."""
    return f"""
ft_docs AS (SELECT lang, coalesce(source, '') AS source, string_split(lower(text), '') AS ch FROM {docs} WHERE lang IS NOT NULL),
ft_n AS (SELECT count(*) AS n FROM ft_docs),
ft_lang AS (SELECT lang, count(*) AS ld FROM ft_docs GROUP BY lang),
ft_src AS (SELECT source, count(*) AS sd FROM ft_docs GROUP BY source),
ft_all AS (SELECT sum({_gain('sd')}) AS x FROM ft_src),
ft_cnt AS (SELECT lang, source, gram, count(*) AS c
  FROM (SELECT lang, source, unnest(list_distinct({mixed_ngrams('ch')})) AS gram FROM ft_docs) GROUP BY ALL),
ft_gram AS (SELECT gram, sum(c) AS g, sum({_gain('c')}) AS inside, sum({_gain('(sd - c)')} - {_gain('sd')}) AS outside
  FROM (SELECT gram, source, CAST(sum(c) AS BIGINT) AS c FROM ft_cnt GROUP BY gram, source) JOIN ft_src USING (source) GROUP BY gram),
ft_pair AS (SELECT lang, gram, CAST(sum(c) AS BIGINT) AS h FROM ft_cnt GROUP BY lang, gram),
ft_score AS (SELECT lang, gram, CAST(
    ({_gain('n')} - {_gain('ld')} - {_gain('(n - ld)')}) - ({_gain('g')} - {_gain('h')} - {_gain('(g - h)')})
    - ({_gain('(n - g)')} - {_gain('(ld - h)')} - {_gain('(n - g - ld + h)')})
    - (({_gain('n')} - x) - ({_gain('g')} - inside) - ({_gain('(n - g)')} - (x + outside))) AS BIGINT) AS score
  FROM (SELECT p.lang, p.gram, p.h, CAST(g.g AS BIGINT) AS g, g.inside, g.outside, l.ld, n.n, a.x
        FROM ft_pair p JOIN ft_gram g USING (gram) JOIN ft_lang l USING (lang), ft_n n, ft_all a)
  WHERE h / g > ld / n),
ft_best AS (SELECT * FROM (SELECT lang, gram, score, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, gram) AS INTEGER)
  AS rank FROM ft_score) WHERE rank <= {per_language}),
ft_set AS (SELECT DISTINCT gram FROM ft_best),
ft_seen AS (SELECT lang, gram, count(*) AS c FROM (SELECT lang, unnest({mixed_ngrams('ch')}) AS gram FROM ft_docs)
  WHERE gram IN (SELECT gram FROM ft_set) GROUP BY lang, gram),
ft_lp AS (SELECT l.lang, s.gram, CAST(round(1000000.0 * ln((coalesce(c.c, 0) + 1) / CAST(t.total + v.v AS DOUBLE))) AS BIGINT) AS lp
  FROM ft_lang l CROSS JOIN ft_set s LEFT JOIN ft_seen c ON c.lang = l.lang AND c.gram = s.gram
  JOIN (SELECT lang, sum(c) AS total FROM ft_seen GROUP BY lang) t ON t.lang = l.lang
  CROSS JOIN (SELECT count(*) AS v FROM ft_set) v),
ft_prior AS (SELECT lang, CAST(round(1000000.0 * ln(ld / CAST(n AS DOUBLE))) AS BIGINT) AS prior FROM ft_lang, ft_n)"""


def feature_langid_ctes(src: str, out: str) -> str:
    """``out(id, langid, langid_score)`` of posts ``src(id, clean)`` by the selected grams."""
    return f"""
{out}_g AS (SELECT id, unnest({mixed_ngrams('ch')}) AS gram FROM (SELECT id, string_split(lower(clean), '') AS ch FROM {src})),
{out}_s AS (SELECT g.id, p.lang, CAST(sum(p.lp) AS BIGINT) + any_value(r.prior) AS score
  FROM {out}_g g JOIN ft_lp p USING (gram) JOIN ft_prior r ON r.lang = p.lang GROUP BY g.id, p.lang),
{out} AS (SELECT id, lang AS langid, score AS langid_score FROM {out}_s
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, lang DESC) = 1)"""
