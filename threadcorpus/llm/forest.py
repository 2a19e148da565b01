"""N-gram Jaccard join by a MinHash LSH forest, with exact verification.

Texts of the same words form a class, and one text stands for it. Each class
has a signature in every tree of the forest: a row of MinHash values read as a
path from the root. Two texts meet in a tree as far down as their paths agree.
The tries are climbed from the full depth: classes of one path meet first, then
those whose paths agree in one value less. A class climbs until the recall of
its links reaches the target. That depth depends on its size, as a small set
cannot be similar to just the threshold: one of 7 shingles links at 0.857 or
more and stops at the full depth, while large sets climb to the depth where
pairs at the threshold itself meet with the target recall. Texts that meet may
be linked.

Meeting is recorded as an edge to the node's least class, never as all pairs
of a node, and one class of a node climbs on for all that do; connected classes
form a group of candidates. In a group all
pairs are compared exactly, shingle set against shingle set, in tiles of
bounded size: large groups are dealt by the size of the sets (sets whose sizes
differ by more than the threshold allows cannot be linked) and by a hash. A
tile returns the number of links of each of its classes and a spanning forest
of them, not the pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadcorpus.llm.common import SpanHasher, arrow_map, chain, mix, text_chunks, text_of, word_spans
from threadcorpus.llm.components import components
from threadcorpus.operators import bloom
from threadcorpus.session import materialize

SHINGLE_WORDS = 5
THRESHOLD = 0.8
TREES, DEPTH = 24, 8
TARGET_RECALL = 0.999
# Shingles of the classes of one block; a tile holds two blocks.
BLOCK_SHINGLES = 400_000
# Rows and columns compared at once inside a tile, and shingles at once.
TILE_ROWS, TILE_SHINGLES = 512, 4_096


def matched_depth(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH,
                  target: float = TARGET_RECALL) -> int:
    """The depth to which prefixes must agree: the full one, shortened until the recall is reached."""
    while depth > 1 and 1 - (1 - threshold ** depth) ** trees < target:
        depth -= 1
    return depth


# Sets of more shingles than this are taken to reach the threshold itself.
SMALL_SET = 64


def least_similarity(size: int, threshold: float = THRESHOLD) -> float:
    """The least similarity, not below the threshold, that a set of ``size`` values can have to another set."""
    least = 1.0
    for other in range(int(size * threshold), int(size / threshold) + 2):
        for common in range(1, min(size, other) + 1):
            similarity = common / (size + other - common)
            if threshold - 1e-9 <= similarity < least:
                least = similarity
    return least


def needed_depths(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH,
                  target: float = TARGET_RECALL) -> list[int]:
    """Where a class of 0, 1, 2 ... ``SMALL_SET`` shingles stops climbing; the last entry is that of all larger ones too."""
    small = [matched_depth(least_similarity(n, threshold), trees, depth, target) for n in range(1, SMALL_SET)]
    return [depth, *small, matched_depth(threshold, trees, depth, target)]


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each text's shingles, without repeats: values by text, each text's first index, and its class key.

    Words are runs of characters other than space and tab to carriage return,
    A-Z lower-cased; a text of one to four words has one shingle of them all.
    The class key is a 128-bit hash of all words (two columns).
    """
    n = len(offsets) - 1
    upper = (data >= 0x41) & (data <= 0x5A)
    data = np.where(upper, data + 32, data).astype(np.uint8) if upper.any() else data
    start, end = word_spans(data, offsets)
    words = SpanHasher(data).spans(start, end)
    doc = np.searchsorted(offsets, start, side="right") - 1
    n_words = np.bincount(doc, minlength=n)
    first_word = np.cumsum(n_words) - n_words
    k = SHINGLE_WORDS
    if len(words) >= k:
        at = np.flatnonzero(doc[k - 1:] == doc[:len(doc) - k + 1])
        values, owner = chain(words, k)[at], doc[at]
    else:
        values, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    if len(short):
        extra = [chain(words[first_word[i]:first_word[i] + n_words[i]], int(n_words[i]))[0] for i in short]
        values, owner = np.append(values, np.array(extra, np.uint64)), np.append(owner, short)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    first = np.searchsorted(owner, np.arange(n + 1))
    # Class key: two hashes of the words in their order.
    place = (np.arange(len(words)) - first_word[doc]).astype(np.uint64)
    key = np.zeros((n, 2), np.uint64)
    for j, odd in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(words * np.uint64(odd) + mix(place + np.uint64(odd))))])
        key[:, j] = mix(sums[first_word + n_words] - sums[first_word] + n_words.astype(np.uint64))
    return values, first, key


_SEEDS = (np.random.default_rng(11).integers(1, 1 << 62, (TREES, DEPTH, 2), dtype=np.uint64)
          * np.uint64(2) + np.uint64(1))


def prefixes(values: np.ndarray, first: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's path in each tree: down to ``depth`` as one value, and the rest of it. Texts must have shingles.

    The rest holds the paths' hashes at the deeper levels, the upper level in
    the higher bits, so that its order is the order of the trie below ``depth``.
    """
    path = np.broadcast_to(np.arange(TREES, dtype=np.uint64), (len(first) - 1, TREES)).copy()
    rest = np.zeros_like(path)
    bits = level_bits(depth)
    for tree in range(TREES):
        at = path[:, tree]
        for d in range(DEPTH):
            a, b = _SEEDS[tree, d]
            least = np.minimum.reduceat(((values ^ b) * a) >> np.uint64(16), first[:-1])
            at = mix(at * np.uint64(0x9FB21C651E98DF25) + least)
            if d + 1 == depth:
                path[:, tree] = at
            elif d + 1 > depth:
                rest[:, tree] = rest[:, tree] << np.uint64(bits) | at >> np.uint64(64 - bits)
    return path, rest


def level_bits(depth: int) -> int:
    """Bits that a level below ``depth`` has in the rest of a path."""
    return min(32, 64 // max(1, DEPTH - depth))


def climb(tries: DataFrame, depth: int, top: int = DEPTH) -> DataFrame:
    """Edges ``u, v`` between classes that meet in the tries ``bucket, rest, class, need``.

    ``bucket`` names a node at ``depth``, ``rest`` the path below it. From the
    full depth upwards the classes of a node are joined to its least one; of
    those that climb on, one stands for the others.
    """
    edges, current = None, tries
    for level in range(top, depth - 1, -1):
        node = F.shiftrightunsigned("rest", level_bits(depth) * (top - level)) if level > depth else F.lit(0).cast("bigint")
        at = current.withColumn("node", node)
        climbing = F.struct("need", "class", "rest")
        nodes = materialize(at.groupBy("bucket", "node").agg(
            F.min("class").alias("m"), F.count("*").alias("n"), F.min(F.when(F.col("need") < level, climbing)).alias("up")))
        met = at.join(nodes.where("n > 1").select("bucket", "node", "m"), ["bucket", "node"]).where("class <> m")
        met = met.select(F.col("class").alias("u"), F.col("m").alias("v"))
        edges = met if edges is None else edges.unionByName(met)
        # The one that stands for the others climbs as far as any of them.
        current = nodes.where("up is not null").select("bucket", "up.rest", "up.class", "up.need")
    return edges


def _binary(keys: np.ndarray) -> pa.Array:
    """Rows of two 64-bit values as binaries of 16 bytes."""
    data = np.ascontiguousarray(keys)
    offsets = np.arange(0, 16 * len(data) + 1, 16, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def row_key(columns: Sequence[str]) -> Column:
    """A 128-bit hash of a row's columns of any type: equal rows have one, and no row number must be written."""
    return F.unhex(F.md5(F.to_json(F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in columns]))))


def paths(rows: DataFrame, depth: int) -> DataFrame:
    """``doc_id, row, class, n_shingles, prefixes, rests`` of each row: the key of its words, and its path in each tree."""
    source = rows.select("doc_id", "row", text_of().alias("text"))

    def run(batches):
        for batch in batches:
            keys, sizes, none = [np.zeros((0, 2), np.uint64)], [np.zeros(0, np.int64)], np.zeros((0, TREES), np.uint64)
            trees, rests = [none], [none]
            for _, _, data, offsets in text_chunks(batch.column("text")):
                values, first, key = shingle_sets(data, offsets)
                n = np.diff(first)
                some = np.flatnonzero(n)
                if len(some):
                    path, rest = prefixes(values, np.append(first[:-1][some], len(values)), depth)
                    trees.append(path)
                    rests.append(rest)
                keys.append(key)
                sizes.append(n)
            size = np.concatenate(sizes)
            ends = np.concatenate([[0], np.cumsum(np.where(size > 0, TREES, 0))]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(v).view(np.int64).ravel())) for v in (trees, rests)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), _binary(np.concatenate(keys)), pa.array(size.astype(np.int64)), *lists],
                names=["doc_id", "row", "class", "n_shingles", "prefixes", "rests"])

    key_type = source.schema["doc_id"].dataType.simpleString()
    return arrow_map(source, run, f"doc_id {key_type}, row binary, class binary, n_shingles bigint, "
                     "prefixes array<bigint>, rests array<bigint>")


def _links(left: list[np.ndarray], right: list[np.ndarray] | None, threshold: float):
    """Linked pairs (i, j) of two lists of sets, or i < j of one, block by block, compared exactly.

    Two sets of sizes a and b with c common values are linked when
    c >= threshold * (a + b - c).
    """
    every = left if right is None else left + right
    sizes = np.array([len(s) for s in every])
    values, owner = np.concatenate(every), np.repeat(np.arange(len(every)), sizes)
    # Values that only one set holds add to no pair.
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    same = ordered[1:] == ordered[:-1]
    shared = np.append(same, False) | np.append(False, same)
    column = np.cumsum(np.append(True, ~same))[shared] - 1
    column = np.unique(column, return_inverse=True)[1]
    row = owner[order][shared]
    by_row = np.argsort(row, kind="stable")
    row, column = row[by_row], column[by_row]
    lo_rows = range(0, len(left), TILE_ROWS)
    base = 0 if right is None else len(left)
    for a in lo_rows:
        a_end = min(a + TILE_ROWS, len(left))
        for b in range(a if right is None else base, len(every), TILE_ROWS):
            b_end = min(b + TILE_ROWS, len(every))
            both = np.zeros((a_end - a, b_end - b), np.float32)
            ra, rb = (slice(*np.searchsorted(row, [lo, hi])) for lo, hi in ((a, a_end), (b, b_end)))
            common = np.intersect1d(column[ra], column[rb])
            for c in range(0, len(common), TILE_SHINGLES):
                some = common[c:c + TILE_SHINGLES]
                x, y = (_dense(row[r] - lo, column[r], hi - lo, some) for r, lo, hi in ((ra, a, a_end), (rb, b, b_end)))
                both += x @ y.T
            total = sizes[a:a_end, None] + sizes[None, b:b_end] - both
            linked = both >= threshold * total - 1e-6
            if right is None and a == b:
                linked = np.triu(linked, 1)
            i, j = np.nonzero(linked)
            yield i + a, j + b - base


def _dense(row: np.ndarray, column: np.ndarray, n: int, some: np.ndarray) -> np.ndarray:
    at = np.searchsorted(some, column)
    at[at == len(some)] = 0
    inside = some[at] == column
    out = np.zeros((n, len(some)), np.float32)
    out[row[inside], at[inside]] = 1
    return out


def _forest(copies: np.ndarray, pairs) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Linked documents of each class, and a spanning forest, of links that come block by block."""
    n = len(copies)
    degree, parent, edges = np.zeros(n), np.arange(n), []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j in pairs:
        degree += np.bincount(i, copies[j], minlength=n) + np.bincount(j, copies[i], minlength=n)
        while not np.array_equal(top := parent[parent], parent):
            parent[:] = top
        apart = parent[i] != parent[j]
        for a, b in zip(i[apart].tolist(), j[apart].tolist()):
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
                edges.append((a, b))
    return degree.astype(np.int64), edges


# Sides of a tile: both of a tile of one block, else the first and the second block.
ALONE, FIRST, SECOND = -1, 0, 1


def _tile(rows: list[tuple[int, bytes, int, bytes]], threshold: float):
    """Classes, linked documents and spanning links of one tile; rows are (side, class, copies, shingles)."""
    rows = list({(r[0], r[1]): r for r in rows}.values())  # a repeated row stands once
    sides = {k: [r for r in rows if r[0] == k] for k in (ALONE, FIRST, SECOND)}
    ordered = sides[ALONE] + sides[FIRST] + sides[SECOND]
    sets = {k: [np.frombuffer(r[3], np.uint64) for r in side] for k, side in sides.items()}
    n = len(sets[FIRST])
    if sides[ALONE]:
        pairs = _links(sets[ALONE], None, threshold)
    elif n and sides[SECOND]:
        pairs = ((i, j + n) for i, j in _links(sets[FIRST], sets[SECOND], threshold))
    else:
        pairs = iter(())
    degree, edges = _forest(np.array([r[2] for r in ordered]), pairs)
    names = [r[1] for r in ordered]
    return names, degree, [(names[a], names[b]) for a, b in edges]


def _verify(tiles: DataFrame, threshold: float) -> DataFrame:
    """``u, v, n``: the tiles' spanning links, and (v null) the number of documents linked to a class in a tile.

    ``tiles`` has ``tile, side, class, n_copies, shingles``, sorted by tile
    within its partitions; one tile is held at a time.
    """
    def run(batches):
        current, rows = None, []

        def done():
            names, degree, edges = _tile(rows, threshold)
            hit = np.flatnonzero(degree)
            u = [names[i] for i in hit] + [e[0] for e in edges]
            v = [None] * len(hit) + [e[1] for e in edges]
            n = degree[hit].tolist() + [0] * len(edges)
            return pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary()), pa.array(n, pa.int64())],
                                              names=["u", "v", "n"])

        for batch in batches:
            for tile, *row in zip(*(batch.column(c).to_pylist() for c in ("tile", "side", "class", "n_copies", "shingles"))):
                if tile != current:
                    if rows:
                        yield done()
                    current, rows = tile, []
                rows.append(tuple(row))
        if rows:
            yield done()

    return arrow_map(tiles, run, "u binary, v binary, n bigint")


def _shingles(texts: DataFrame) -> DataFrame:
    """``texts`` whose words are those of their ``class``, with shingle hashes in place of the text."""
    names = [c for c in texts.columns if c != "text"]
    schema = texts.select(*names, F.lit(b"").alias("shingles")).schema

    def run(batches):
        for batch in batches:
            sets, keys = [], [np.zeros((0, 2), np.uint64)]
            for _, _, data, offsets in text_chunks(batch.column("text")):
                values, first, key = shingle_sets(data, offsets)
                sets += [values[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
                keys.append(key)
            own = pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sets, pa.binary())],
                                             names=[*names, "shingles"])
            yield own.filter(pc.equal(_binary(np.concatenate(keys)), batch.column("class")))

    return arrow_map(texts, run, schema)


def _places(threshold: float, block_shingles: int) -> Column:
    """The tiles that a class belongs to, and its side in each.

    ``blocks`` has the number of blocks for each size class of the group. A
    class's block meets all blocks of its own size class and of the two next
    to it; sizes further apart differ by more than the threshold allows.
    """
    size = F.col("size")
    n_own = F.element_at("blocks", size)
    own = F.pmod(F.xxhash64("class"), n_own).cast("int")

    def place(first, second, side):
        key = F.concat_ws(":", F.hex("component"), F.concat_ws(".", first[0].cast("string"), first[1].cast("string")),
                          F.concat_ws(".", second[0].cast("string"), second[1].cast("string")))
        return F.struct(key.alias("tile"), side.cast("int").alias("side"))

    def each(n, fn):
        none = F.array().cast("array<struct<tile:string,side:int>>")
        return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda b: fn((b - 1).cast("int")))).otherwise(none)

    def blocks_of(other):
        return F.coalesce(F.try_element_at("blocks", other), F.lit(0))

    same = each(n_own, lambda b: place(
        (size, F.least(own, b)), (size, F.greatest(own, b)),
        F.when(own == b, F.lit(ALONE)).when(own < b, F.lit(FIRST)).otherwise(F.lit(SECOND))))
    above = each(blocks_of(size + 1), lambda b: place((size, own), (size + 1, b), F.lit(FIRST)))
    below = each(blocks_of(size - 1), lambda b: place((size - 1, b), (size, own), F.lit(SECOND)))
    zero = (F.lit(0), F.lit(0))
    return F.when(F.col("all") <= block_shingles, F.array(place(zero, zero, F.lit(ALONE)))) \
        .otherwise(F.concat(same, above, below))


def join(docs: DataFrame, threshold: float = THRESHOLD, target: float = TARGET_RECALL,
         block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """``doc_id, class_id, n_links, n_copies`` of every row.

    ``class_id`` is the least doc_id of the connected group of texts whose
    5-word shingle sets have a Jaccard similarity of ``threshold`` or more;
    ``n_links`` counts the other rows linked directly, copies included;
    ``n_copies`` those of the same words, itself included. A text of one to
    four words has one shingle; a null text or one without words is linked to
    nothing and a class of its own. A repeated row is a copy of itself; a null
    doc_id is never the least; an empty table gives no rows; other columns are
    ignored.
    """
    rows = docs.select("doc_id", "text").withColumn("row", row_key(["doc_id", "text"]))
    return _grouped(rows, threshold, target, block_shingles).select("doc_id", "class_id", "n_links", "n_copies")


def _grouped(rows: DataFrame, threshold: float = THRESHOLD, target: float = TARGET_RECALL,
             block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """The columns of :func:`join`, and ``row, alone, first_row``, of ``doc_id, text, row``.

    ``row`` is a key of the row's content; ``alone`` marks those without words,
    ``first_row`` is the group's first by doc_id (null last), then key. Texts
    are read in place; only those of classes that may be linked are moved,
    found by a filter of bounded size before the exact join.
    """
    depth, needs = matched_depth(threshold, target=target), needed_depths(threshold, target=target)
    found = materialize(paths(rows, depth))
    classes = materialize(found.where("n_shingles > 0").groupBy("class").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")).alias("first"), F.count("*").alias("n_copies"),
        F.first("n_shingles").alias("n_shingles"), F.first("prefixes").alias("prefixes"), F.first("rests").alias("rests")))
    need = F.element_at(F.array(*map(F.lit, needs)), F.least(F.col("n_shingles") + 1, F.lit(len(needs))).cast("int"))
    branches = classes.select("class", need.alias("need"), F.explode(F.arrays_zip("prefixes", "rests")).alias("p")) \
        .select("class", "need", F.col("p.prefixes").alias("bucket"), F.col("p.rests").alias("rest"))
    # A class that is alone at the least depth of a tree meets nobody in it.
    shared = classes.select(F.explode("prefixes").alias("bucket")).groupBy("bucket").count().where("count > 1").select("bucket")
    groups = components(climb(materialize(branches.join(shared, "bucket")), depth))

    # A base slightly above 1 / threshold keeps rounding from parting two sizes that may be linked.
    size = F.floor(F.log(F.col("n_shingles").cast("double")) / float(np.log(1.0001 / threshold))).cast("int")
    grouped = classes.select("class", "first", "n_copies", "n_shingles", size.alias("size")) \
        .join(groups.withColumnRenamed("node", "class"), "class")
    by_size = grouped.groupBy("component", "size").agg(F.sum("n_shingles").alias("s"))
    blocks = by_size.groupBy("component").agg(F.sum("s").alias("all"), F.map_from_entries(F.collect_list(F.struct(
        "size", F.ceil(F.col("s") / block_shingles).cast("int").alias("n")))).alias("blocks"))
    dealt = materialize(grouped.join(blocks, "component").select(
        F.col("first.row").alias("row"), "class", "n_copies", _places(threshold, block_shingles).alias("places")))
    may_link = bloom.key_filter(dealt, "row")
    texts = rows.select("row", text_of().alias("text")).where(may_link).join(dealt, "row")
    tiles = _shingles(texts.select("class", "n_copies", "places", "text")) \
        .select(F.explode("places").alias("p"), "class", "n_copies", "shingles") \
        .select("p.tile", "p.side", "class", "n_copies", "shingles")
    tiles = tiles.repartition("tile").sortWithinPartitions("tile", "side", "class")
    verified = materialize(_verify(tiles, threshold))

    linked = verified.where("v is null").groupBy(F.col("u").alias("class")).agg(F.sum("n").alias("linked"))
    joined = components(verified.where("v is not null").select("u", "v"))
    named = classes.select("class", "first", "n_copies").join(joined.withColumnRenamed("node", "class"), "class", "left") \
        .withColumn("component", F.coalesce("component", "class"))
    ids = named.groupBy("component").agg(F.min("first").alias("first"))
    about = named.drop("first").join(ids, "component").join(linked, "class", "left").select(
        "class", F.col("first.doc_id").alias("class_id"), F.col("first.row").alias("first_row"),
        (F.coalesce("linked", F.lit(0)) + F.col("n_copies") - 1).alias("n_links"), "n_copies")
    alone = F.col("n_shingles") == 0
    out = found.select("doc_id", "row", "class", "n_shingles").join(about, "class", "left")
    return out.select("row", alone.alias("alone"), "first_row", "doc_id",
                      F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                      F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("bigint").alias("n_links"),
                      F.when(alone, F.lit(1)).otherwise(F.col("n_copies")).cast("bigint").alias("n_copies"))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each group: its first by doc_id (null last), then by a hash of the whole row; columns stay.

    Rows without words (null and empty texts) all stay; a row repeated with all
    its columns stays once; an empty table gives no rows. Columns may have any
    type and name. Rows that stay and are no repeat of another are not moved:
    a filter of bounded size over the others' keys passes them in place.
    """
    key = "row"
    while key in docs.columns:
        key = "_" + key
    keyed = docs.withColumn(key, row_key(docs.columns))
    grouped = _grouped(keyed.select("doc_id", "text", F.col(key).alias("row")), threshold)
    rows = grouped.groupBy(F.col("row").alias(key)).agg(
        F.count("*").alias("n"), F.max(F.col("alone") | (F.col("row") == F.col("first_row"))).alias("kept"))
    decided = materialize(rows.where("n > 1 or not kept"))
    concerned = bloom.key_filter(decided, key)
    # Copies of a row collapse within each task, then meet the rows that go by the same key.
    moved = keyed.where(concerned).dropDuplicates([key]).join(decided.where("not kept").select(key), key, "left_anti")
    return keyed.where(~concerned).unionByName(moved).drop(key)
