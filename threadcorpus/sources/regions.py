"""Regions of vertical files that reach over lines, files and tasks, by a segmented prefix scan.

A vertical corpus is one long sequence of lines: its files in the order of
their names, the lines of a file in their order. Which region a line lies in
depends on all lines before it. Each split of a file is a segment; a first
pass reduces a segment to its number of lines and, for each level, its number
of opening tags and its last tag. One row for each segment is combined in
order, so every segment knows how it starts, and a second pass numbers lines
and regions with nothing held but that state. Lines are never shuffled, and a
region of any size stays rows of one line.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadcorpus.operators.corpus import PARAGRAPH_CLOSE, PARAGRAPH_OPEN, SENTENCE_CLOSE, SENTENCE_OPEN
from threadcorpus.operators.joins import BROADCAST_MAX_ROWS
from threadcorpus.session import materialize, ship
from threadcorpus.sources.readers import region_attributes

OPENS, CLOSES, NEITHER = 1, -1, 0


def read_segments(spark: SparkSession, path) -> DataFrame:
    """``file, block, line``: lines of text files, in order inside each (file, block)."""
    ship(spark)
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"))


def _tags(lines: pa.Array, level: str) -> np.ndarray:
    """Whether each line opens a region of ``level``, closes one, or neither."""
    opens = pc.or_(pc.equal(lines, f"<{level}>"), pc.starts_with(lines, f"<{level} "))
    return np.where(opens.to_numpy(zero_copy_only=False), OPENS,
                    np.where(pc.equal(lines, f"</{level}>").to_numpy(zero_copy_only=False), CLOSES, NEITHER))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Slices of batches that lie in one segment, with the segment's key."""
    for batch in batches:
        if not batch.num_rows:
            continue
        block, file = batch.column("block").to_numpy(), batch.column("file").dictionary_encode().indices.to_numpy()
        cuts = [0, *(np.flatnonzero((np.diff(block) != 0) | (np.diff(file) != 0)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi > lo:
                yield (batch.column("file")[lo].as_py(), int(block[lo])), batch.slice(lo, hi - lo)


def segment_states(lines: DataFrame, levels: Sequence[str]) -> DataFrame:
    """``file, block, lines_before, regions_before, inside``: how each segment of ``read_segments`` starts.

    ``regions_before`` and ``inside`` have an entry for each level: the number
    of regions opened before the segment, and whether the last one is open.
    """
    levels = list(levels)

    def run(batches):
        key, n, opened, last = None, 0, None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([n], pa.int64()),
                 pa.array([opened.tolist()], pa.list_(pa.int64())), pa.array([last.tolist()], pa.list_(pa.int64()))],
                names=["file", "block", "n_lines", "n_opened", "last"])

        for found, part in _runs(batches):
            if found != key:
                if key is not None:
                    yield done()
                key, n, opened, last = found, 0, np.zeros(len(levels), np.int64), np.zeros(len(levels), np.int64)
            n += part.num_rows
            for i, level in enumerate(levels):
                tags = _tags(part.column("line"), level)
                opened[i] += (tags == OPENS).sum()
                some = np.flatnonzero(tags)
                if len(some):
                    last[i] = tags[some[-1]]
        if key is not None:
            yield done()

    states = materialize(lines.mapInArrow(
        run, "file string, block bigint, n_lines bigint, n_opened array<bigint>, last array<bigint>"))
    # One row of some hundred bytes for each split of the input; a single ordered pass over them is cheap.
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)

    def each(make) -> F.Column:
        return F.array(*[make(i) for i in range(len(levels))]) if levels else F.array().cast("array<bigint>")

    return materialize(states.select(
        "file", "block", F.coalesce(F.sum("n_lines").over(before), F.lit(0)).alias("lines_before"),
        each(lambda i: F.coalesce(F.sum(F.col("n_opened")[i]).over(before), F.lit(0))).alias("regions_before"),
        each(lambda i: F.coalesce(F.last(F.when(F.col("last")[i] != NEITHER, F.col("last")[i]), ignorenulls=True).over(before)
                                  == OPENS, F.lit(False)).cast("bigint")).alias("inside")))


def _scan(lines: DataFrame, states: DataFrame, run: Callable, schema: str, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``run`` over lines with the state of their segment, each segment in order and in one task."""
    if states.count() <= max_rows:
        return lines.join(F.broadcast(states), ["file", "block"]).mapInArrow(run, schema)
    placed = lines.withColumn("_row", F.monotonically_increasing_id()).join(states, ["file", "block"])
    placed = placed.repartition("file", "block").sortWithinPartitions("file", "block", "_row").drop("_row")
    return placed.mapInArrow(run, schema)


def region_lines(spark: SparkSession, path, levels: Sequence[str], max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``line_no, line`` and a column for each level: the number of the region a line lies in.

    Lines and regions are numbered from 0 over all files in the order of their
    names. A region's tags belong to it; outside of all regions the number is
    null. A region that is never closed reaches to the next one of its level
    or the end; a closing tag without an open region belongs to none.
    """
    levels = list(levels)
    lines = read_segments(spark, path)
    states = segment_states(lines, levels)

    def run(batches):
        key, n, regions, inside = None, 0, [], []
        for found, part in _runs(batches):
            if found != key:
                key, n = found, part.column("lines_before")[0].as_py()
                regions, inside = part.column("regions_before")[0].as_py(), part.column("inside")[0].as_py()
            columns = [pa.array(np.arange(n, n + part.num_rows)), part.column("line")]
            n += part.num_rows
            for i, level in enumerate(levels):
                tags = _tags(part.column("line"), level)
                number = regions[i] + np.cumsum(tags == OPENS) - 1
                # Whether a region is open: as of the last tag up to the line, or as the segment goes on.
                place = np.maximum.accumulate(np.where(tags != NEITHER, np.arange(len(tags)), -1))
                open_ = np.where(place >= 0, tags[place] == OPENS, bool(inside[i]))
                was_open = np.concatenate([[bool(inside[i])], open_[:-1]])
                member = open_ | ((tags == CLOSES) & was_open)
                columns.append(pa.array(number, pa.int64(), mask=~member))
                regions[i], inside[i] = int(number[-1]) + 1, int(open_[-1])
            yield pa.RecordBatch.from_arrays(columns, names=["line_no", "line", *levels])

    schema = ", ".join(["line_no bigint", "line string", *(f"`{level}` bigint" for level in levels)])
    return _scan(lines, states, run, schema, max_rows)


def region_table(lines: DataFrame, level: str) -> DataFrame:
    """``region, attrs, first_line, last_line`` of every region of ``level`` in :func:`region_lines`.

    Counts are partial aggregates: a region of a third of all lines is a few
    rows for each task.
    """
    tag = F.when(F.col("line").startswith(f"<{level}"), F.struct("line_no", "line"))
    return lines.where(F.col(level).isNotNull()).groupBy(F.col(level).alias("region")).agg(
        F.min(tag).alias("tag"), F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line")) \
        .select("region", region_attributes(F.col("tag.line")).alias("attrs"), "first_line", "last_line")


def tag_sentences(spark: SparkSession, path, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """X4 on vertical files: ``line_no, sub, line`` with sentence tags, in one pass without a shuffle.

    ``<s>`` follows ``<p>``, ``</s>`` precedes ``</p>``, a blank line inside a
    paragraph becomes ``</s>`` and ``<s>``, other blank lines are dropped. The
    paragraph may have begun in an earlier file.
    """
    lines = read_segments(spark, path)
    states = segment_states(lines, ["p"])

    def run(batches):
        key, n, inside = None, 0, False
        for found, part in _runs(batches):
            if found != key:
                key, n = found, part.column("lines_before")[0].as_py()
                inside = bool(part.column("inside")[0].as_py()[0])
            out: list[tuple[int, int, str]] = []
            for line in part.column("line").to_pylist():
                made = [line]
                if line == PARAGRAPH_OPEN:
                    inside, made = True, [line, SENTENCE_OPEN]
                elif line == PARAGRAPH_CLOSE:
                    inside, made = False, [SENTENCE_CLOSE, line]
                elif line == "":
                    made = [SENTENCE_CLOSE, SENTENCE_OPEN] if inside else []
                out += [(n, sub, x) for sub, x in enumerate(made)]
                n += 1
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.string()))],
                    names=["line_no", "sub", "line"])

    return _scan(lines, states, run, "line_no bigint, sub int, line string", max_rows)
