"""Views that present the driver tables as forum posts and threads.

The SQL text runs unchanged on Spark (``spark.sql`` with DataFrame arguments,
no session-global views) and on DuckDB (the oracle). These views only give
rows in the shape the jobs expect; all labelling, scoring and assembling is
done by the library operators on top of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadcorpus.session import read_table

# Comments with a known language; communities either one language or mixed.
POSTS = """
SELECT concat('c', CAST(doc_id AS STRING)) AS id, 'comment' AS kind,
  concat('t3_', subreddit, '_', CAST(doc_id % 3 AS STRING)) AS link_id,
  concat('t5_', subreddit) AS subreddit_id, subreddit,
  CAST(1262304000 + ((doc_id * 7919) % 365) * 86400 + doc_id % 86400 AS BIGINT) AS created_utc,
  text AS body, lang AS gold, doc_id
FROM (SELECT *, CASE WHEN doc_id % 4 = 0 THEN concat('mixed_', source)
             ELSE concat(lang, '_', CAST(doc_id % 5 AS STRING)) END AS subreddit FROM {documents}) d
"""

# Threads with a submission at turn 0; equal created_utc pairs exercise tie-breaks.
POSTS_CONV = """
SELECT CASE WHEN turn = 0 THEN CAST(conv_id AS STRING)
       ELSE concat(CAST(conv_id AS STRING), '_', CAST(turn AS STRING)) END AS id,
  CASE WHEN turn = 0 THEN 'submission' ELSE 'comment' END AS kind,
  concat('t3_', CAST(conv_id AS STRING)) AS link_id,
  CASE WHEN turn = 0 THEN 'None' WHEN turn = 1 THEN concat('t3_', CAST(conv_id AS STRING))
       ELSE concat('t1_', CAST(conv_id AS STRING), '_', CAST(turn - 1 AS STRING)) END AS parent_id,
  concat('t5_', CAST(conv_id % 10 AS STRING)) AS subreddit_id,
  concat('board_', CAST(conv_id % 10 AS STRING)) AS subreddit,
  CAST(1388534400 + conv_id * 86400 + (turn - turn % 2) * 60 AS BIGINT) AS created_utc,
  role AS author, text AS body, conv_id, turn
FROM {conversations}
"""

# Repeated posts (exact copies) for duplicate handling.
POSTS_CONV_DUP = """
SELECT * FROM {posts_conv} UNION ALL SELECT * FROM {posts_conv} WHERE conv_id % 7 = 0 AND turn = 1
"""

# Repeated posts, and threads whose first post is no submission.
POSTS_OPEN = """
SELECT id, CASE WHEN conv_id % 6 = 0 THEN 'comment' ELSE kind END AS kind, link_id, created_utc, author, body
FROM {posts_conv_dup}
"""

# Metadata of their posts; some have none.
COMMENT_META = """
SELECT DISTINCT id, author, CAST(created_utc AS STRING) AS created_utc FROM {posts_open}
WHERE kind = 'comment' AND length(body) % 10 <> 0
"""
SUBMISSION_META = """
SELECT DISTINCT id, author FROM {posts_open} WHERE kind = 'submission' AND length(body) % 10 <> 0
"""

# Thread metadata; some threads are missing on purpose.
THREAD_META = """
SELECT CAST(conv_id AS STRING) AS id, max(subreddit) AS subreddit, CAST(min(created_utc) AS STRING) AS created_utc
FROM {posts_conv} WHERE conv_id % 9 <> 0 GROUP BY conv_id
"""

# Posts in markup: headings, links, spoilers, quotes, lists, code, rules and references around the texts.
POSTS_MARKUP = """
SELECT id, kind, created_utc, CASE (conv_id + turn) % 9
  WHEN 0 THEN concat('# Head **x** &#0000228;', chr(10), body)
  WHEN 1 THEN concat('see [the _link_](http://x.org/a_b_c "a title") or [q](http://y.org/?a=1&amp;copy "two &quot;q&quot;") ', body)
  WHEN 2 THEN concat('[hidden](#s "they said "no" (twice)") and [more](/s "&lt;i&gt; &quot;x&quot;") ', body)
  WHEN 3 THEN concat('> ', body, chr(10), '> second', chr(10), chr(10), chr(10), '- one', chr(10), '- two `a*b*c` *i* _j_ _k_')
  WHEN 4 THEN concat('    code <b> &#x000000E4;', chr(10), chr(10), body, ' &bogus; &copy 2 &#0; &#xD800; &#1114112;')
  WHEN 5 THEN concat('1. a', chr(10), '2. b', chr(10), chr(10), '***', chr(10), chr(10), body, ' snake_case_name **bold** ~~gone~~ ```')
  WHEN 6 THEN concat(chr(10), '### h3', chr(10), '# h1', chr(10), body, chr(10), chr(10), chr(10), chr(10), '## h2')
  WHEN 7 THEN concat('a &lt;b&gt; &amp;amp; R&D &#34;q&#x27; [open ', body, ' ** * _ `x')
  ELSE concat(chr(13), chr(10), chr(9), 'tabbed', chr(13), chr(10), body) END AS body
FROM {posts_conv}
"""

# Posts in nested markup; their sentences stand on lines of their own, so containers have lazy lines.
POSTS_NESTED = """
SELECT id, kind, created_utc, CASE (conv_id + turn) % 10
  WHEN 0 THEN concat('- ', body, chr(10), '  - two', chr(10), '    > ', body, chr(10), chr(10), '    in two', chr(10), '- three *x*')
  WHEN 1 THEN concat('> ', body, chr(10), '> > deeper', chr(10), 'lazy', chr(10), '>', chr(10), '> 1. a', chr(10), '>    b',
                     chr(10), '> 2) c', chr(10), chr(10), 'out')
  WHEN 2 THEN concat('```sql', chr(10), '- ', body, chr(10), chr(10), '~~~', chr(10), '````', chr(10), body, chr(10), '> ~~~',
                     chr(10), '> x &lt;b&gt;', chr(10), 'not lazy')
  WHEN 3 THEN concat('| name | text |', chr(10), '|:---|---:|', chr(10), '| `a` | ', body, chr(10), 'b | **c**', chr(10), chr(10), body)
  WHEN 4 THEN concat('see [the _page_][Page], [page][] and [none][no] `[x][page]` ', body, chr(10), chr(10),
                     '[page]: http://x.org/a_b "A &amp; B"', chr(10), '[PAGE]: http://y.org')
  WHEN 5 THEN concat(body, chr(10), '===', chr(10), 'Second', chr(10), '---', chr(10), '***', chr(10), '    code &lt;a&gt;',
                     chr(10), '      more', chr(10), body)
  WHEN 6 THEN concat('10. ', body, chr(10), chr(10), '    after ten', chr(10), chr(9), 'code?', chr(10), '    * [x][ten] sub', chr(10),
                     'lazy', chr(10), chr(10), '[ten]: /10')
  WHEN 7 THEN concat('* - + ', body, chr(10), '    - x', chr(10), '- - -', chr(13), chr(10), '# head #', chr(10), '####### seven ', body)
  WHEN 8 THEN concat('> - ', body, chr(10), '>   ```', chr(10), '>   in list', chr(10), '> out of list', chr(10), 'a|b', chr(10), '-|-',
                     chr(10), '> 1|2')
  ELSE concat(body, chr(10), chr(10), '-', chr(10), '-x 1.y ', body) END AS body
FROM (SELECT id, kind, created_utc, conv_id, turn, replace(body, '. ', concat('.', chr(10))) AS body FROM {posts_conv}) p
"""

FIXTURES = {
    "posts_nested": (POSTS_NESTED, ("posts_conv",)),
    "posts_markup": (POSTS_MARKUP, ("posts_conv",)),
    "posts": (POSTS, ("documents",)),
    "posts_conv": (POSTS_CONV, ("conversations",)),
    "posts_conv_dup": (POSTS_CONV_DUP, ("posts_conv",)),
    "posts_open": (POSTS_OPEN, ("posts_conv_dup",)),
    "comment_meta": (COMMENT_META, ("posts_open",)),
    "submission_meta": (SUBMISSION_META, ("posts_open",)),
    "thread_meta": (THREAD_META, ("posts_conv",)),
}

# Target languages of the many-language rule and the reference language.
TARGET_LANGS = ("de", "fr", "es")
REFERENCE_LANG = "en"
SINGLE_TARGET = "de"


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build one fixture view as a DataFrame."""
    sql, deps = FIXTURES[name]
    args = {}
    for dep in deps:
        args[dep] = fixture(spark, sf_dir, dep) if dep in FIXTURES else read_table(spark, sf_dir, dep)
    return spark.sql(sql, **args)


def oracle_views(*names: str) -> str:
    """``WITH`` clause defining the named fixtures (and their inputs) for DuckDB."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered or name not in FIXTURES:
            return
        for dep in FIXTURES[name][1]:
            visit(dep)
        ordered.append(name)

    for name in names:
        visit(name)
    parts = []
    for name in ordered:
        sql = FIXTURES[name][0]
        for dep in FIXTURES[name][1]:
            sql = sql.replace("{" + dep + "}", dep)
        parts.append(f"{name} AS ({sql.strip()})")
    return "WITH " + ",\n".join(parts) if parts else ""
