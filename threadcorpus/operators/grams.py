"""Character n-grams counted in the tasks that hold the texts.

A text of n characters has about n grams of each size, so one row for each of
them makes n-grams the most expensive rows of a job. Here a task counts the
grams of its texts with numpy, a bounded run of texts at a time, and only
counted grams become rows; joins and sums over all texts stay Spark's.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadcorpus.session import ship

# Characters counted at once; a longer single text is a run of its own.
RUN_CHARS = 1 << 20
# Bits of a code point, and how many code points fit into 64 bits.
POINT_BITS, PACKED = 21, 3

_COUNTED = pa.struct([("gram", pa.string()), ("cnt", pa.int64())])


def _runs(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Bounds of runs of whole texts."""
    lo = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > RUN_CHARS:
            yield lo, i
            lo, size = i, 0
        size += len(text)
    if lo < len(texts):
        yield lo, len(texts)


def _counted(texts: list[str], sizes: Sequence[int], once: bool = False,
             group: np.ndarray | None = None) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Row, gram and count of the grams of each text, by row; with ``group`` of each group of texts.

    ``once`` counts a gram once a text. Grams are overlapping runs of code points inside one text.
    """
    joined = "".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t) for t in texts], np.int64)
    row = np.repeat(np.arange(len(texts)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(points))
    codes, grams, pairs = None, [], []
    for n in range(1, max(sizes) + 1):
        if n > len(points):
            break
        if n <= PACKED:
            codes = pd.factorize(_packed(points, n))[0] if n in sizes or n == PACKED else None
        else:
            codes = pd.factorize(codes[:-1].astype(np.uint64) << np.uint64(POINT_BITS) | points[n - 1:])[0]
        if n not in sizes:
            continue
        at = np.flatnonzero(left[:len(codes)] >= n)
        found = codes[at]
        first = np.full(int(codes.max()) + 1, -1)
        first[found[::-1]] = at[::-1]
        used = np.flatnonzero(first >= 0)
        number = np.zeros(len(first), np.int64)
        number[used] = np.arange(len(grams), len(grams) + len(used))
        grams += [joined[p:p + n] for p in first[used].tolist()]
        pairs.append((row[at], number[found]))
    if not pairs:
        return np.zeros(0, np.int64), pa.array([], pa.string()), np.zeros(0, np.int64)
    of, width = np.concatenate([p[0] for p in pairs]), max(len(grams), 1)
    if group is not None and not once:
        of = group[of]
    pair = of * width + np.concatenate([p[1] for p in pairs])
    if once:
        pair = np.unique(pair)
        if group is not None:
            pair = group[pair // width] * width + pair % width
    if len(pair) and int(pair.max()) < 4 * len(pair):
        counts = np.bincount(pair)
        pair = np.flatnonzero(counts)
        counts = counts[pair]
    else:
        pair, counts = np.unique(pair, return_counts=True)
    return pair // width, pa.array(grams, pa.string()).take(pa.array(pair % width)), counts.astype(np.int64)


def _packed(points: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` code points from each place on as one number, ``n`` at most ``PACKED``."""
    out = points[:len(points) - n + 1].astype(np.uint64)
    for i in range(1, n):
        out = out << np.uint64(POINT_BITS) | points[i:len(points) - n + 1 + i]
    return out


def _texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def gram_lists(texts: DataFrame, key: str, text_col: str, sizes: Sequence[int]) -> DataFrame:
    """``key, gram, cnt``: the grams of every text with their number; a null text has none."""
    ship(texts.sparkSession)
    source = texts.select(key, F.col(text_col).alias("_text"))
    counted = T.ArrayType(T.StructType([T.StructField("gram", T.StringType()), T.StructField("cnt", T.LongType())]))
    sizes = tuple(sizes)

    def run(batches):
        for batch in batches:
            whole = _texts(batch.column(1))
            for lo, hi in _runs(whole):
                rows, grams, counts = _counted(whole[lo:hi], sizes)
                offsets = pa.array(np.searchsorted(rows, np.arange(hi - lo + 1)), pa.int32())
                values = pa.StructArray.from_arrays([grams, pa.array(counts)], fields=list(_COUNTED))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(offsets, values)],
                                                 names=[key, "_grams"])

    schema = T.StructType([T.StructField(key, source.schema[key].dataType), T.StructField("_grams", counted)])
    return source.mapInArrow(run, schema).select(key, F.explode("_grams").alias("_g")).select(key, "_g.gram", "_g.cnt")


def _totals(texts: list[str], n: int) -> tuple[pa.Array, np.ndarray]:
    """The grams of size ``n`` of all texts and their counts.

    Code points are numbered, so that a gram is a small number and counting is an array; where
    the texts have too many different ones for that, grams are told apart by :func:`_counted`.
    """
    texts = [t for t in texts if len(t) >= n]
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    seen = np.zeros(int(points.max(initial=0)) + 1, bool)
    seen[points] = True
    alphabet = np.flatnonzero(seen)
    if len(alphabet) ** n > max(4 * len(points), 1 << 20):
        return _counted(texts, [n], group=np.zeros(len(texts), np.int64))[1:]
    number = np.zeros(len(seen), np.int64)
    number[alphabet] = np.arange(len(alphabet))
    places = number[points]
    code = np.zeros(max(len(points) - n + 1, 0), np.int64)
    for i in range(n):
        code = code * len(alphabet) + places[i:i + len(code)]
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)[:-1]
    over = (ends[:, None] - np.arange(1, n)).ravel()  # grams that reach into the next text
    counts = np.bincount(code, minlength=1) - np.bincount(code[over], minlength=int(code.max(initial=0)) + 1)
    held = np.flatnonzero(counts)
    parts = [alphabet[held // len(alphabet) ** (n - 1 - i) % len(alphabet)] for i in range(n)] if len(held) else []
    grams = np.stack(parts, 1).astype("<u4").tobytes().decode("utf-32-le", "surrogatepass") if parts else ""
    return pa.array([grams[i:i + n] for i in range(0, len(grams), n)], pa.string()), counts[held].astype(np.int64)


def gram_totals(texts: DataFrame, keys: Sequence[str], text_col: str, sizes: Sequence[int], once: bool = False) -> DataFrame:
    """``*keys, gram, cnt``: grams counted over all texts of the same ``keys``; ``once`` counts texts that hold the gram.

    Every run of texts is combined in its task, so a frequent gram is a row a run before the shuffle.
    """
    ship(texts.sparkSession)
    source = texts.select(*keys, F.col(text_col).alias("_text"))
    names, sizes = list(keys), tuple(sizes)

    def run(batches):
        for batch in batches:
            whole = _texts(batch.column(len(names)))
            of: dict[tuple, int] = {}
            group = np.array([of.setdefault(k, len(of)) for k in zip(*(batch.column(i).to_pylist() for i in range(len(names))))],
                             np.int64)
            distinct = [pa.array(values, batch.schema.field(i).type) for i, values in enumerate(zip(*of))]
            for lo, hi in _runs(whole):
                if len(sizes) == 1 and not once:
                    used = np.unique(group[lo:hi])
                    found = [_totals([whole[i] for i in range(lo, hi) if group[i] == g], sizes[0]) for g in used]
                    rows = np.repeat(used, [len(counts) for _, counts in found])
                    grams = pa.concat_arrays([grams for grams, _ in found])
                    counts = np.concatenate([counts for _, counts in found])
                else:
                    rows, grams, counts = _counted(whole[lo:hi], sizes, once, group[lo:hi])
                yield pa.RecordBatch.from_arrays([*(d.take(pa.array(rows)) for d in distinct), grams, pa.array(counts)],
                                                 names=[*names, "gram", "cnt"])

    fields = [T.StructField(k, source.schema[k].dataType) for k in names]
    counted = source.mapInArrow(run, T.StructType([*fields, T.StructField("gram", T.StringType()),
                                                   T.StructField("cnt", T.LongType())]))
    return counted.groupBy(*names, "gram").agg(F.sum("cnt").alias("cnt"))


def gram_sums(texts: DataFrame, key: str, text_col: str, n: int, table: DataFrame, missing: Sequence[int]) -> DataFrame:
    """``key`` and the sums, over the grams of each text, of the value columns of ``table``; a text without grams has no row.

    ``table`` has ``gram``, each once, and a BIGINT column for each of
    ``missing``, which counts where a gram or its value is absent. It is
    broadcast, so its size must have been checked, and looked up in the tasks
    that hold the texts; ``n`` is at most ``PACKED``.
    """
    spark = texts.sparkSession
    ship(spark)
    names = [c for c in table.columns if c != "gram"]
    held = table.select("gram", *[F.coalesce(F.col(c), F.lit(m)).cast("bigint").alias(c) for c, m in zip(names, missing)]).toArrow()
    grams = "".join(held.column("gram").to_pylist())
    keys = _packed(np.frombuffer(grams.encode("utf-32-le", "surrogatepass"), np.uint32), n)[::n] if grams else np.zeros(0, np.uint64)
    # The values of an absent gram stand last, where a place of -1 finds them.
    values = [np.append(held.column(c).to_numpy(), m).astype(np.int64) for c, m in zip(names, missing)]
    shared = spark.sparkContext.broadcast((keys, values))
    source = texts.select(key, F.col(text_col).alias("_text"))

    def run(batches):
        places, sums_of = pd.Index(shared.value[0]), shared.value[1]
        for batch in batches:
            whole = _texts(batch.column(1))
            for lo, hi in _runs(whole):
                lengths = np.array([len(t) for t in whole[lo:hi]], np.int64)
                rows = np.flatnonzero(lengths >= n)
                if not len(rows):
                    continue
                points = np.frombuffer("".join(whole[lo + r] for r in rows).encode("utf-32-le", "surrogatepass"), np.uint32)
                at = places.get_indexer(_packed(points, n))
                ends = np.cumsum(lengths[rows])
                found = []
                for value in sums_of:
                    total = np.concatenate([[0], np.cumsum(value[at])])
                    found.append(pa.array(total[ends - n + 1] - total[ends - lengths[rows]]))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(lo + rows)), *found], names=[key, *names])

    fields = [T.StructField(c, T.LongType()) for c in names]
    return source.mapInArrow(run, T.StructType([T.StructField(key, source.schema[key].dataType), *fields]))
