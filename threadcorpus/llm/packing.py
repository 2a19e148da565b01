"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted, each with a cost. Documents are laid
out largest first; a piece goes into the open bin it fits with the least room
left. If none fits, a bin is opened whose length costs least for the tokens
that it can be expected to hold, looking ahead at the sizes still to come.
At the end every bin shrinks to the shortest permitted length that holds its
contents.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadcorpus.llm.common import prepare, text_of
from threadcorpus.session import materialize

# Permitted sequence lengths, and the cost of a sequence beyond its length.
LENGTHS = (512, 1024, 2048, 4096)
OVERHEAD = 32
# Pieces packed together; more pieces are dealt over more groups by a hash.
GROUP_PIECES = 16_384


def cost(length: int, overhead: int = OVERHEAD) -> int:
    """Cost of a sequence: its length and a fixed share for every sequence."""
    return length + overhead


def _fill(counts: np.ndarray, room: int) -> int:
    """Tokens that sizes still to come add to ``room``, largest first."""
    taken, size, left = 0, room, room
    used: dict[int, int] = {}
    for _ in range(4):
        sizes = np.flatnonzero(counts[1:size + 1])
        while len(sizes) and used.get(int(sizes[-1]) + 1, 0) >= counts[sizes[-1] + 1]:
            sizes = sizes[:-1]
        if not len(sizes):
            break
        best = int(sizes[-1]) + 1
        used[best] = used.get(best, 0) + 1
        taken += best
        left -= best
        size = left
        if left <= 0:
            break
    return taken


def pack(sizes: np.ndarray, lengths: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD
         ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset and final length for each size; sizes are 1 to the longest length, in any order."""
    order = np.argsort(-sizes, kind="stable")
    counts = np.bincount(sizes, minlength=max(lengths) + 1) if len(sizes) else np.zeros(1, int)
    where, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    filled: list[int] = []
    rooms: list[tuple[int, int]] = []  # (room left, bin), sorted
    choice: dict[int, int] = {}
    last = -1
    for at in order:
        size = int(sizes[at])
        counts[size] -= 1
        if size != last:
            choice, last = {}, size
        i = bisect_left(rooms, (size, -1))
        if i < len(rooms):
            room, b = rooms.pop(i)
        else:
            if size not in choice:
                fits = [n for n in lengths if n >= size]
                choice[size] = min(fits, key=lambda n: (cost(n, overhead) / (size + _fill(counts, n - size)), n))
            room, b = choice[size], len(filled)
            filled.append(0)
        where[at], offset[at] = b, filled[b]
        filled[b] += size
        if room > size:
            insort(rooms, (room - size, b))
    steps = np.asarray(sorted(lengths))
    final = steps[np.searchsorted(steps, np.asarray(filled, np.int64))] if filled else np.zeros(0, np.int64)
    return where, offset, final[where] if filled else final


def count_tokens(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens)``: words of each row's text."""
    words = F.regexp_count(text_of(), F.lit(r"[^\x20\x09-\x0D]+"))
    return docs.select("doc_id", words.cast("bigint").alias("n_tokens"))


def pack_documents(docs: DataFrame, lengths: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD,
                   group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``(doc_id, piece, first_token, n_tokens, bin, bin_offset, bin_length)``: where every token goes.

    A document longer than the longest length is cut into pieces of that
    length and a rest, so no token is lost. Full pieces are bins of their own;
    rests are dealt by a hash of the row's number, piece and size into groups of
    about ``group_pieces`` and each group is packed by itself. Bins are named
    ``group:number``, full pieces' bins ``full:doc:piece``. A repeated row is
    packed again; a text that is null or without words makes no piece; an
    empty table gives no rows; other columns are ignored; a null ``doc_id`` is
    packed like any other.
    """
    prepare(docs.sparkSession)
    longest = max(lengths)
    rid = F.monotonically_increasing_id()
    sized = materialize(count_tokens(docs).where("n_tokens > 0").withColumn("row", rid))
    pieces = sized.select(
        "doc_id", "row", F.posexplode(F.sequence(F.lit(0), F.col("n_tokens") - 1, F.lit(longest).cast("bigint")))
        .alias("piece", "first_token"), F.col("n_tokens").alias("total"))
    pieces = pieces.select("doc_id", "row", F.col("piece").cast("bigint").alias("piece"), "first_token",
                           F.least(F.lit(longest), F.col("total") - F.col("first_token")).cast("bigint").alias("n_tokens"))
    full = pieces.where(F.col("n_tokens") == longest)
    rests = pieces.where(F.col("n_tokens") < longest)
    groups = sized.where(F.col("n_tokens") % longest > 0).count() // group_pieces + 1
    rests = rests.withColumn("group", F.pmod(F.xxhash64("row", "piece", "n_tokens"), F.lit(groups)))
    key = docs.schema["doc_id"].dataType.simpleString()

    def best_fit(group: pa.Table) -> pa.Table:
        group = group.sort_by([("n_tokens", "descending"), ("row", "ascending")])
        sizes = group.column("n_tokens").to_numpy()
        where, offset, final = pack(sizes, lengths, overhead)
        name = group.column("group")[0].as_py()
        bins = pa.array([f"{name}:{b}" for b in where.tolist()], pa.string())
        return group.select(["doc_id", "piece", "first_token", "n_tokens"]) \
            .append_column("bin", bins).append_column("bin_offset", pa.array(offset)) \
            .append_column("bin_length", pa.array(final.astype(np.int64)))

    packed = rests.groupBy("group").applyInArrow(
        best_fit, f"doc_id {key}, piece bigint, first_token bigint, n_tokens bigint, bin string, "
                  "bin_offset bigint, bin_length bigint")
    whole = full.select("doc_id", "piece", "first_token", "n_tokens",
                        F.concat_ws(":", F.lit("full"), F.col("row").cast("string"), F.col("piece").cast("string")).alias("bin"),
                        F.lit(0).cast("bigint").alias("bin_offset"), F.lit(longest).cast("bigint").alias("bin_length"))
    return packed.unionByName(whole)
