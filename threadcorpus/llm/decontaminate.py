"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are windows of 13 consecutive item words (a shorter item is one
window). Words are the symbols: the shift table holds, for each block of two
words, how far the search may jump; a block that can end a window selects a
bucket, hashed by that block and the window's first block, and direct
comparison with the strings of that bucket confirms an occurrence. Each window
length has its own tables, so that a short item does not shorten the jumps of
the others.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadcorpus.llm.common import arrow_map, strings, text_of
from threadcorpus.session import materialize

WINDOW_WORDS = 13
# Windows of one search block. A larger benchmark is searched block after block,
# each pass over all documents, so that no task holds more than this many.
BLOCK_WINDOWS = 100_000
# A document is contaminated when 1/20 of its words are hit.
HIT_SHARE = 20

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: str) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z, as UTF-8."""
    return _WORD.findall(text.encode("utf-8").lower())


def windows(text: str) -> Iterator[tuple[bytes, ...]]:
    """Windows of an item; an item of fewer words, but not none, is one window."""
    w = words(text)
    if w:
        size = min(len(w), WINDOW_WORDS)
        for i in range(len(w) - size + 1):
            yield tuple(w[i:i + size])


class WuManber:
    """Search tables for patterns of one length ``m`` over word sequences."""

    def __init__(self, patterns: dict[tuple[bytes, ...], list[str]], m: int):
        self.m, self.block = m, min(2, m)
        self.default = m - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], list[tuple[tuple[bytes, ...], list[str]]]] = {}
        for pattern, items in patterns.items():
            for end in range(self.block, m + 1):
                block = pattern[end - self.block:end]
                self.shift[block] = min(self.shift.get(block, self.default), m - end)
            key = pattern[-self.block:] + pattern[:self.block]
            self.buckets.setdefault(key, []).append((pattern, items))

    def search(self, text: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        """First word and items of every occurrence."""
        m, b, shift, default, buckets = self.m, self.block, self.shift, self.default, self.buckets
        end, n = m, len(text)
        while end <= n:
            tail = tuple(text[end - b:end])
            jump = shift.get(tail, default)
            if jump:
                end += jump
                continue
            first = end - m
            for pattern, items in buckets.get(tail + tuple(text[first:first + b]), ()):
                if tuple(text[first:end]) == pattern:
                    yield first, items
            end += 1


def build(block: Iterable[tuple[tuple[bytes, ...], str]]) -> list[WuManber]:
    """Search tables of ``(window, item)`` rows, one per window length."""
    by_length: dict[int, dict[tuple[bytes, ...], list[str]]] = {}
    for pattern, item in block:
        by_length.setdefault(len(pattern), {}).setdefault(pattern, []).append(item)
    return [WuManber(p, m) for m, p in sorted(by_length.items())]


def window_blocks(benchmark: DataFrame, size: int = BLOCK_WINDOWS) -> Iterator[list[tuple[tuple[bytes, ...], str]]]:
    """The benchmark's windows in blocks of at most ``size``, read row by row."""
    block: list[tuple[tuple[bytes, ...], str]] = []
    rows = benchmark.select(F.col("item_id").cast("string").alias("i"), text_of().alias("t"))
    for row in rows.toLocalIterator():
        for w in windows(row["t"]):
            block.append((w, row["i"]))
            if len(block) == size:
                yield block
                block = []
    if block:
        yield block


def hits(text: str, tables: list[WuManber]) -> tuple[int, np.ndarray, set[str]]:
    """Number of words, hit flags and found items of one text."""
    w = words(text)
    flags = np.zeros(len(w), bool)
    found: set[str] = set()
    for t in tables:
        for first, items in t.search(w):
            flags[first:first + t.m] = True
            found.update(i for i in items if i is not None)
    return len(w), flags, found


def is_contaminated(n_words: int, n_hit: int) -> bool:
    return n_hit > 0 and HIT_SHARE * n_hit >= n_words


_STATE = "__flags binary, __items array<string>"


def search(docs: DataFrame, benchmark: DataFrame, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``(doc_id, n_words, n_hit, items, contaminated)`` of every row of ``docs``.

    ``items`` are the ids of items with an occurring window, sorted as strings.
    A null or empty text has no words and is never hit; an item without words
    has no window; items sharing a window are all reported; a repeated row
    gives its result again; an empty benchmark hits nothing. Other columns of
    either table are ignored. An item without an id counts for hits but is
    not listed.
    """
    state = docs.select("doc_id", text_of().alias("text"), F.lit(None).cast("binary").alias("f"),
                        F.lit(None).cast("array<string>").alias("items"))
    schema = state.schema
    blocks = window_blocks(benchmark, block_windows)
    block = next(blocks, [])
    while True:
        following = next(blocks, None)
        tables = docs.sparkSession.sparkContext.broadcast(build(block))
        if following is None:
            break

        def add(batches, tables=tables):
            for batch in batches:
                flags, items = [], []
                for text, old, had in zip(strings(batch.column("text")).to_pylist(), batch.column("f").to_pylist(),
                                          batch.column("items").to_pylist()):
                    n, f, found = hits(text, tables.value)
                    if old is not None:
                        f |= np.frombuffer(old, bool)
                    flags.append(f.tobytes())
                    items.append(sorted(found.union(had or ())))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("text"), pa.array(flags, pa.binary()),
                     pa.array(items, pa.list_(pa.string()))], names=batch.schema.names)

        state = materialize(arrow_map(state, add, schema))
        block = following

    def finish(batches):
        for batch in batches:
            rows = []
            for text, old, had in zip(strings(batch.column("text")).to_pylist(), batch.column("f").to_pylist(),
                                      batch.column("items").to_pylist()):
                n, f, found = hits(text, tables.value)
                if old is not None:
                    f |= np.frombuffer(old, bool)
                k = int(f.sum())
                rows.append((n, k, sorted(found.union(had or ())), is_contaminated(n, k)))
            n, k, items, bad = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(k, pa.int64()),
                 pa.array(items, pa.list_(pa.string())), pa.array(bad, pa.bool_())],
                names=["doc_id", "n_words", "n_hit", "items", "contaminated"])

    key = state.schema["doc_id"].dataType.simpleString()
    return arrow_map(state, finish, f"doc_id {key}, n_words bigint, n_hit bigint, items array<string>, contaminated boolean")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``docs`` without contaminated rows; columns, of any type and name, and the cases of :func:`search` stay as they are."""
    blocks = window_blocks(benchmark, block_windows)
    block = next(blocks, [])
    if next(blocks, None) is None:
        tables = docs.sparkSession.sparkContext.broadcast(build(block))

        def keep(batches):
            for batch in batches:
                good = []
                for text in strings(batch.column("text")).to_pylist():
                    n, f, _ = hits(text, tables.value)
                    good.append(not is_contaminated(n, int(f.sum())))
                yield batch.filter(pa.array(good, pa.bool_()))

        return arrow_map(docs, keep, docs.schema)
    key = "row"
    while key in docs.columns:
        key = "_" + key
    keyed = materialize(docs.withColumn(key, F.monotonically_increasing_id()))
    bad = search(keyed.select(F.col(key).alias("doc_id"), "text"), benchmark, block_windows)
    bad = bad.where("contaminated").select(F.col("doc_id").alias(key))
    return keyed.join(bad, key, "left_anti").select(*docs.columns)


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def digest(found: DataFrame) -> DataFrame:
    """The digest columns of :func:`search`'s rows."""
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


ORACLE = r"""
WITH iw AS (SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT item, len(w) AS m, least(len(w), 13) AS size, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i
        FROM iw WHERE len(w) > 0),
pat AS (SELECT DISTINCT item, size, list_slice(w, i, i + size - 1) AS words FROM win),
dw AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM pat),
dwin AS (SELECT doc_id, size, list_slice(w, i, i + size - 1) AS words, i FROM (
           SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM dw, sizes WHERE len(w) >= size)),
occ AS (SELECT DISTINCT d.doc_id, d.i, d.size, p.item FROM dwin d JOIN pat p ON d.size = p.size AND d.words = p.words),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (
          SELECT doc_id, unnest(range(i, i + size)) AS pos FROM occ) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
