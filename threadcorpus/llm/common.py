"""Helpers shared by the operators: table reading, bounded Arrow batches, hashing of text spans."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows and bytes of one Arrow batch: bounds a Python worker's memory when texts are long.
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20
# Bytes hashed at once; a longer single text is a chunk of its own.
CHUNK_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's source to the executors, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    path = os.path.join(tempfile.mkdtemp(), f"threadcorpus-{sc.applicationId}.zip")
    with open(path, "wb") as f:  # stays while the application runs: executors fetch it from the driver
        f.write(packed.getvalue())
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def prepare(spark: SparkSession) -> None:
    """What Python stages need: this package on the executors and bounded batches."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def arrow_map(df: DataFrame, fn, schema) -> DataFrame:
    """``df.mapInArrow`` with batches bounded by rows and bytes."""
    prepare(df.sparkSession)
    return df.mapInArrow(fn, schema)


def text_of(name: str = "text") -> Column:
    """The text column as a string, null as the empty string."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def strings(column: pa.Array) -> pa.Array:
    """A column as a plain string array without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.string()), "")


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a text column into runs of whole texts of about ``limit`` bytes.

    Yields ``(first_row, end_row, bytes, offsets)``; ``offsets`` has one entry
    more than the run has texts, relative to ``bytes``.
    """
    arr = strings(column)
    n = len(arr)
    if n == 0:
        return
    _, off_buf, data_buf = arr.buffers()
    offsets = np.frombuffer(off_buf, np.int32)[arr.offset:arr.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


_MULT = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (multiply and xor-shift)."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


class SpanHasher:
    """64-bit hashes of any byte spans of one buffer, equal for equal bytes wherever they stand."""

    _powers = np.ones(1, np.uint64)
    _inverse = np.ones(1, np.uint64)

    @classmethod
    def _tables(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls._powers) < n:
            size = max(n, CHUNK_BYTES + 1)
            powers, inverse = np.full(size, _MULT), np.full(size, _INV)
            powers[0] = inverse[0] = 1
            powers, inverse = np.cumprod(powers), np.cumprod(inverse)
            if size > 4 * CHUNK_BYTES:  # one very long text: not kept
                return powers, inverse
            cls._powers, cls._inverse = powers, inverse
        return cls._powers, cls._inverse

    def __init__(self, data: np.ndarray):
        powers, self.inverse = self._tables(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * powers[:len(data)], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the words (runs of bytes other than space and tab to carriage return) of the texts."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    return start, end


def chain(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive values, in order."""
    out = hashes[:len(hashes) - n + 1].copy()
    for i in range(1, n):
        out = mix(out * np.uint64(0x9FB21C651E98DF25) + hashes[i:len(hashes) - n + 1 + i])
    return out
