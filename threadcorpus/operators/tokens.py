"""Words counted in the tasks that hold the texts.

A row for each word makes words the most expensive rows of labelling. Here a
task cuts and counts the words of its texts with numpy, and only counts become
rows; sums over all texts stay Spark's. In texts of other code points than those known
here, words and small letters depend on the Unicode tables of the JVM: the task
hands such a text on, and the JVM cuts it into a row for each word.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadcorpus.functions.text import words
from threadcorpus.operators.grams import _runs
from threadcorpus.operators.joins import BROADCAST_MAX_ROWS, checked_join
from threadcorpus.session import ship

# Words of a lexicon that a task holds: a word takes two numbers and its flags there, 17 bytes.
HELD_WORDS = 8_000_000
# Different words counted before they become rows.
RUN_WORDS = 1 << 18

# All but Latin letters (without the dotted I, whose small letter is two code points), punctuation and currency signs:
# these are words, and have small letters, alike in Python and the JVM.
_OTHER = re.compile("[^\\x00-\u012f\u0131-\u024f\u2010-\u205e\u20a0-\u20bf]")
# The small letter of each code point of a word, 0 for all others.
_LOWER = np.array([ord(chr(p).lower()) if p != 0x130 and (chr(p).isalnum() or p == 0x5F) else 0 for p in range(0x20C0)], np.uint16)
# A word's two numbers are sums of its code points times powers of these, modulo 2**64.
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def _plain(column: pa.Array) -> tuple[list[str], list[int]]:
    """The texts, empty where the JVM must cut them, and the places of those."""
    out, other = [], []
    try:
        texts = column.to_pylist()
    except UnicodeDecodeError:
        texts = [b.decode("utf-8", "replace") if b is not None else None for b in column.cast(pa.binary()).to_pylist()]
    for i, text in enumerate(texts):
        if text and _OTHER.search(text):  # the sign for broken bytes is another code point, too
            other.append(i)
            text = ""
        out.append(text or "")
    return out, other


def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _coded(texts: list[str], powers: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], Callable]:
    """The words of plain texts: bounds of each text's words, the number of each word, and of the different words by
    number their two 64-bit numbers, by which words are told apart, and a function that spells them.

    ``powers`` keeps what the numbers need from one call to the next.
    """
    points = np.frombuffer("\n".join([*texts, ""]).encode("utf-16-le"), np.uint16)
    letters = _LOWER[points]
    inside = np.concatenate([[False], letters != 0, [False]])
    change = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = change[::2], change[1::2]
    bounds = np.searchsorted(start, np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]))
    if not len(start):
        return bounds, np.zeros(0, np.int64), [np.zeros(0, np.uint64)] * 2, lambda: []
    numbers = []
    for base in _BASES:
        if base not in powers or len(powers[base]) < len(points):
            powers[base] = _powers(base, len(points))
            powers[-base] = _powers(pow(base, -1, 1 << 64), len(points))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letters * powers[base][:len(points)])])
        numbers.append((sums[end] - sums[start]) * powers[-base][start])
    code, different = pd.factorize(numbers[0])
    first = np.zeros(len(different), np.int64)
    first[code[::-1]] = np.arange(len(code))[::-1]
    if (numbers[1][first][code] != numbers[1]).any():  # two words of one number: by both
        code = pd.factorize(pd.Series(list(zip(*(n.tolist() for n in numbers)))))[0]
        first = np.zeros(int(code.max()) + 1, np.int64)
        first[code[::-1]] = np.arange(len(code))[::-1]

    def spell() -> list[str]:
        small = letters.tobytes().decode("utf-16-le")
        return [small[i:j] for i, j in zip(start[first].tolist(), end[first].tolist())]

    return bounds, code, [n[first] for n in numbers], spell


def _cut(texts: list[str], powers: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """The words of plain texts: bounds of each text's words, the number of each word, the different words by number."""
    bounds, code, _, spell = _coded(texts, powers)
    return bounds, code, spell()


def _held(index: DataFrame, flags: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of ``index`` that plain texts can hold: both numbers, sorted, and the flags of each."""
    def run(batches):
        powers: dict = {}
        for batch in batches:
            whole, _ = _plain(batch.column(0))
            for lo, hi in _runs(whole):
                bounds, code, numbers, spell = _coded(whole[lo:hi], powers)
                different = spell()
                # A text of one word which is that text: others are found in no plain text.
                at = [i for i in np.flatnonzero(np.diff(bounds) == 1).tolist() if different[code[bounds[i]]] == whole[lo + i]]
                found = [n[code[bounds[:-1][at]]].view(np.int64) for n in numbers]
                yield pa.RecordBatch.from_arrays([*map(pa.array, found), batch.column(1).take(pa.array(np.array(at, np.int64) + lo))],
                                                 names=["a", "b", "f"])

    found = index.select("word", F.col(flags).cast("int")).mapInArrow(run, "a long, b long, f int").toArrow()
    one, two = (found.column(c).to_numpy().view(np.uint64) for c in ("a", "b"))
    order = np.lexsort([two, one])
    return one[order], two[order], found.column("f").to_numpy()[order].astype(np.int64)


def _flags_of(numbers: Sequence[np.ndarray], held: tuple[np.ndarray, np.ndarray, np.ndarray], most: int) -> np.ndarray:
    """The flags of each word by its numbers, 0 where ``held`` lacks it; ``most`` of its words share their first number."""
    out = np.zeros(len(numbers[0]), np.int64)
    if not len(held[0]):
        return out
    order = np.argsort(numbers[0])  # neighbours are sought in one part of the table
    one, two = numbers[0][order], numbers[1][order]
    place = np.searchsorted(held[0], one)
    for _ in range(most):
        at = np.minimum(place, len(held[0]) - 1)
        hit = (held[0][at] == one) & (held[1][at] == two)
        out[order[hit]] = held[2][at[hit]]
        place += 1
    return out


def word_misses(texts: DataFrame, key: str, text_col: str, index: DataFrame, flags: Sequence[str], index_rows: int) -> DataFrame:
    """``key, n_words`` and for each of ``flags`` ``miss_<flag>``: words, and words without that flag in ``index``.

    Sums over all texts of a key; a key without words has no row. ``index``
    has ``word``, each once, and 0/1 flags; the numbers of its words are
    broadcast, so its size ``index_rows`` must have been checked.
    """
    spark = texts.sparkSession
    ship(spark)
    flags = list(flags)
    bits = [F.when(F.col(f) == 1, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(flags)]
    flagged = index.select("word", sum(bits, F.lit(0)).cast("int").alias("_flags"))
    held = _held(flagged, "_flags")
    most = int(np.unique(held[0], return_counts=True)[1].max(initial=0))
    shared = spark.sparkContext.broadcast((held[0], held[1], held[2].astype(np.min_scalar_type(1 << len(flags)))))
    source = texts.select(key, F.col(text_col).alias("_text"))
    misses = [f"miss_{f}" for f in flags]
    names = [key, "n_words", *misses, "_text"]

    def run(batches):
        table, powers = shared.value, {}
        for batch in batches:
            whole, other = _plain(batch.column(1))
            for lo, hi in _runs(whole):
                bounds, code, numbers, _ = _coded(whole[lo:hi], powers)
                rows = np.flatnonzero(np.diff(bounds))
                if not len(rows):
                    continue
                known = _flags_of(numbers, table, most)[code]
                found = [bounds[rows + 1] - bounds[rows]]
                for i in range(len(flags)):
                    total = np.concatenate([[0], np.cumsum(known >> i & 1 == 0)])[bounds]
                    found.append(total[rows + 1] - total[rows])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(lo + rows)), *(pa.array(f, pa.int64()) for f in found),
                                                  pa.nulls(len(rows), batch.column(1).type)], names=names)
            if other:
                at = pa.array(other)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), *[pa.nulls(len(other), pa.int64())] * (len(flags) + 1),
                                                  batch.column(1).take(at)], names=names)

    fields = [T.StructField(c, T.LongType()) for c in ("n_words", *misses)]
    counted = source.mapInArrow(run, T.StructType([T.StructField(key, source.schema[key].dataType), *fields,
                                                   T.StructField("_text", T.StringType())]))
    # One row with counts, or a row for each word of a text that was handed on.
    pieces = counted.select(key, "n_words", *misses, F.explode_outer(words("_text")).alias("_token")) \
        .where(F.col("n_words").isNotNull() | F.col("_token").isNotNull()).withColumn("word", F.lower("_token"))
    if index_rows > BROADCAST_MAX_ROWS:  # rows with counts have no word: they must not meet in one task
        pieces = pieces.withColumn("word", F.coalesce("word", F.concat(F.lit(" "), F.xxhash64(key).cast("string"))))
    joined = checked_join(pieces, flagged, "word", "left", small_rows=index_rows)
    missed = [F.coalesce(F.col(c), F.when(F.coalesce(F.col("_flags"), F.lit(0)).bitwiseAND(1 << i) == 0, 1).otherwise(0))
              for i, c in enumerate(misses)]
    return joined.groupBy(key).agg(F.sum(F.coalesce("n_words", F.lit(1))).alias("n_words"),
                                   *[F.sum(m).alias(c) for m, c in zip(missed, misses)])


def word_texts(texts: DataFrame, key: str, text_col: str) -> DataFrame:
    """``key, word, n``: texts of each ``key`` that hold the lower-cased word.

    Texts are counted in their task until their words are ``RUN_WORDS``, so a frequent word is a row a run before the shuffle.
    """
    ship(texts.sparkSession)
    source = texts.select(key, F.col(text_col).alias("_text"))
    names = [key, "word", "n", "_text"]

    def rows(counts: dict, types: Sequence[pa.DataType]) -> pa.RecordBatch:
        sizes = [len(c) for c in counts.values()]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), types[0]).take(pa.array(np.repeat(np.arange(len(sizes)), sizes))),
             pa.array([w for c in counts.values() for w in c], pa.string()),
             pa.array([n for c in counts.values() for n in c.values()], pa.int64()), pa.nulls(sum(sizes), types[1])], names=names)

    def run(batches):
        counts: dict = {}
        held, types, powers = 0, (), {}
        for batch in batches:
            types = [f.type for f in batch.schema]
            whole, other = _plain(batch.column(1))
            values = batch.column(0).to_pylist()
            for value in dict.fromkeys(values):
                mine = [t for v, t in zip(values, whole) if v == value and t]
                for lo, hi in _runs(mine):
                    bounds, code, different = _cut(mine[lo:hi], powers)
                    pair = pd.unique(np.repeat(np.arange(hi - lo), np.diff(bounds)) * max(len(different), 1) + code)
                    texts_of = np.bincount(pair % max(len(different), 1), minlength=len(different)).tolist()
                    count = counts.setdefault(value, {})
                    held -= len(count)
                    for word, n in zip(different, texts_of):
                        count[word] = count.get(word, 0) + n
                    held += len(count)
                    if held >= RUN_WORDS:
                        yield rows(counts, types)
                        counts, held = {}, 0
            if other:
                at = pa.array(other)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.nulls(len(other), pa.string()),
                                                  pa.nulls(len(other), pa.int64()), batch.column(1).take(at)], names=names)
        if held:
            yield rows(counts, types)

    counted = source.mapInArrow(run, T.StructType([
        T.StructField(key, source.schema[key].dataType), T.StructField("word", T.StringType()),
        T.StructField("n", T.LongType()), T.StructField("_text", T.StringType())]))
    pieces = counted.select(key, "word", "n", F.explode_outer(F.array_distinct(words(F.lower("_text")))).alias("_token")) \
        .select(key, F.coalesce("word", "_token").alias("word"), F.coalesce("n", F.lit(1)).alias("n")).where(F.col("word").isNotNull())
    return pieces.groupBy(key, "word").agg(F.sum("n").alias("n"))
